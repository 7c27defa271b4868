import json

import pytest

from loomspan import cli

DATA = "/root/testdata/sf0.001"


def run(capsys, *args):
    code = cli.main(["--tables", DATA, *args])
    return code, capsys.readouterr()


@pytest.mark.parametrize("args", [("--limit", "0"), ("--offset", "-1"), ("--batch-size", "101"), ("--input", "x"), ("--stage", "scrape", "--offline")])
def test_arguments_that_make_no_sense(capsys, args):
    code, said = run(capsys, "run", *args)
    assert code == 1 and said.err


def test_unknown_commands(capsys):
    assert run(capsys, "dance")[0] == 2


def test_run_selects_and_plans(spark, capsys, tmp_path):
    code, said = run(capsys, "run", "--stage", "publish", "--limit", "5", "--preview", str(tmp_path / "preview"))
    report = json.loads(said.out)
    assert code == 0 and len(report["selected"]) == 5 and report["steps"] == {"publish_saved": 5} and report["first_publish_batch"] == 25
    assert spark.read.json(str(tmp_path / "preview")).count() == 5
    code, said = run(capsys, "run", "--scrape-only", "--limit", "4")
    assert code == 0 and json.loads(said.out)["steps"] == {"scrape": 4}


def test_edits_are_refused_as_a_whole(spark, capsys, tmp_path):
    slug = spark.read.parquet(f"{DATA}/work_items.parquet").filter("published_slug is not null").first()["published_slug"]
    path = tmp_path / "edits.json"
    path.write_text(json.dumps([{"slug": slug, "name": "Quite New Name"}, {"slug": "no-such", "name": "Other"}]))
    code, said = run(capsys, "run", "--stage", "publish", "--input", str(path))
    assert code == 1 and json.loads(said.out)["refused"] == [{"slug": "no-such", "reason": "unknown slug"}]
    path.write_text(json.dumps({"products": [{"slug": slug, "name": "Quite New Name"}]}))
    code, said = run(capsys, "run", "--stage", "publish", "--input", str(path))
    assert code == 0 and json.loads(said.out)["steps"] == {"publish_saved": 1}


def test_reports(spark, capsys):
    for name in ("status", "backlog", "quota-status"):
        code, said = run(capsys, name)
        assert code == 0 and json.loads(said.out)
