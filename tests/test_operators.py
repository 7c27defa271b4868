import gzip
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomspan.operators import checkpoint as K, drafts as D, quota as Q
from loomspan.operators.versions import VersionedTable, latest_rows, process_changes
from loomspan.session import shared_path
from loomspan.sources import files, web


def test_versions_report_only_changes(spark):
    t = VersionedTable(spark, shared_path(spark, "t"))
    t.commit(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, v string"))
    t.merge(spark.createDataFrame([("a", "1"), ("b", "3"), ("c", None), ("d", None)], "k string, v string"), "k")
    rows = {(r["op"], r["k"], r["v"]) for r in t.changes(1).collect()}
    assert rows == {("insert", "b", "3"), ("insert", "d", None), ("delete", "b", "2")}
    assert {r["k"]: r["v"] for r in t.read().collect()} == {"a": "1", "b": "3", "c": None, "d": None}
    assert t.read(1).count() == 3 and t.changes(2).count() == 0
    t.commit(spark.createDataFrame([("z", "9")], "k string, v string"), mode="replace")
    assert {r["k"] for r in t.changes(2).filter("op = 'delete'").collect()} == {"a", "b", "c", "d"}


def test_a_failed_run_is_repeated_once(spark):
    source, sink = (VersionedTable(spark, shared_path(spark, x)) for x in ("s", "o"))
    source.commit(spark.createDataFrame([(1,), (2,)], "k int"))
    assert process_changes(source, sink, lambda d: d).meta["processed"] == 1
    source.commit(spark.createDataFrame([(3,)], "k int"))
    with pytest.raises(ValueError):
        process_changes(source, sink, lambda d: (_ for _ in ()).throw(ValueError()))
    process_changes(source, sink, lambda d: d)
    assert process_changes(source, sink, lambda d: d) is None
    assert sorted(r["k"] for r in sink.read().collect()) == [1, 2, 3]


def test_two_writers_cannot_commit_one_version(spark):
    path = shared_path(spark, "w")
    a, b = VersionedTable(spark, path), VersionedTable(spark, path)
    a.commit(spark.range(1))
    b.latest = lambda: None
    with pytest.raises(FileExistsError):
        b.commit(spark.range(2))


def test_latest_rows_with_nulls_and_ties(spark):
    rows = [("a", 1, "x"), ("a", None, "y"), ("a", 1, "z"), (None, 9, "n"), ("b", None, None)]
    got = latest_rows(spark.createDataFrame(rows, "k string, o int, v string"), "k", ["o"], ["v"])
    assert {(r["k"], r["v"]) for r in got.collect()} == {("a", "z"), ("b", None)}


def test_sitemap(spark, tmp_path):
    xml = "<urlset><url><loc>https://launchboard.example/products/acme-beacon/</loc><lastmod>2026-01-02</lastmod></url><url><loc>https://launchboard.example/about</loc></url></urlset>"
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(xml.encode()))
    rows = web.read_sitemap(spark, str(tmp_path / "s.xml.gz")).collect()
    assert [(r["url"], r["last_modified"]) for r in rows] == [("https://www.launchboard.example/products/acme-beacon", "2026-01-02")]


def test_body_limits():
    body = gzip.compress(b"x" * 2000)
    assert len(web.decode_body(body, "gzip", 2000)) == 2000
    assert web.decode_body(b"x" * 2000, "identity", 1999) == b"x" * 2000
    for encoding, limit in (("gzip", 1999), ("br", 9999)):
        with pytest.raises(ValueError):
            web.decode_body(body, encoding, limit)


def test_page_signals(spark):
    html = """<title>T</title><meta name="description" content="Meta"><nav>hidden</nav><h1>Head</h1><a data-test="visit-website-button" href="https://acme.example/start?ref=x&plan=free">go</a>
    <script type="application/ld+json">{"@graph":[{"@type":["Thing","Product"],"name":"Acme Beacon - Launchboard","description":"D","category":"A, B"}]}</script>"""
    df = spark.createDataFrame([("https://launchboard.example/products/acme", html, None)], "url string, html string, last_modified string")
    r = web.product_pages(df).first()
    assert (r["source_name"], r["tagline"], r["description"], r["website_url"], r["categories"], r["reject"]) == ("Acme Beacon", "Meta", "D", "https://acme.example/start?plan=free", ["A", "B"], None)


def test_bodies_become_text(spark):
    rows = [(1, gzip.compress("größe".encode()), "gzip", "text/html"), (2, "größe".encode("cp1252"), None, 'text/html; charset="cp1252"'), (3, b"abc", "br", ""), (4, b"a\xff", "", "text/plain; charset=none"), (5, None, None, None)]
    df = spark.createDataFrame(rows, "i int, body binary, encoding string, kind string")
    got = {r["i"]: (r["t"]["text"], r["t"]["error"]) for r in df.select("i", web.body_text("body", "encoding", "kind").alias("t")).collect()}
    assert got[1] == got[2] == ("größe", None) and got[3][0] is None and "br" in got[3][1] and got[4] == ("a\ufffd", None) and got[5] == ("", None)


def test_settings_keep_unpaired_quotes(tmp_path):
    path = tmp_path / "env"
    path.write_text("# note\nexport A=1\nB=\"two words\"\nC='open\nnothing\n")
    assert files.read_settings(str(path)) == {"A": "1", "B": "two words", "C": "'open"}
    assert files.read_settings(str(tmp_path / "none")) == {}


def test_marks_and_clashes(spark):
    schema = "source_url string, external_id string, status string, external_checked boolean, draft_name_normalized string, generation_model string, source_content_hash string, published_slug string, attempts int, failed_stage string, error string"
    items = spark.createDataFrame([("u/a", "a", "failed", False, None, None, None, None, 2, "scrape", "e"), ("u/b", "b", "queued", False, None, None, None, None, 0, None, None)], schema)
    scraped = K.mark(items, spark.createDataFrame([("u/a",), ("u/a",), ("u/none",)], "source_url string"), "scraped")
    drafted = K.mark(scraped, spark.createDataFrame([("u/a", "New, Name", "m", "h")], "source_url string, name string, model string, hash string"), "transformed")
    a, b = drafted.orderBy("source_url").collect()
    assert (a["status"], a["failed_stage"], a["draft_name_normalized"], a["source_content_hash"], a["attempts"]) == ("transformed", None, "new name", "h", 2) and b["status"] == "queued"
    entries = spark.createDataFrame([("v/a", None, 0), ("u/b", None, 1)], "url string, last_modified string, ordinal int")
    assert [tuple(r) for r in K.enqueue_clashes(items, entries).collect()] == [("a", 2)]


def test_hidden_depth_and_best_product():
    facts = web.page_facts('<svg><path/></svg></svg><p>a</p><header><img><b>x</b></header>still hidden</i>shown<script>no</script><meta name="Description" content="m">')
    assert [f for f in facts if f[0] != "title"] == [("text", "a"), ("text", "shown"), ("description", "m")]
    objects = web.described_objects(['{"@graph": [{"@type": "Product", "name": "A"}, {"@type": ["Thing", "product"], "offers": {"name": "in"}}]}', "broken", '[{"url": 5, "category": "x, y "}]'])
    assert [(o["types"], o["name"], o["categories"]) for o in objects] == [([], "", []), (["product"], "A", []), (["thing", "product"], "", []), ([], "in", []), ([], "", ["x", "y"])]


def test_robots(spark):
    urls = spark.createDataFrame([("https://a.example/x", "a"), ("https://a.example/no", "a"), ("https://b.example/", "b"), ("https://c.example/", "c")], "url string, origin string")
    rules = spark.createDataFrame([("a", 200, "User-agent: *\nDisallow: /no\nCrawl-delay: 4"), ("b", 404, None), ("c", 500, None)], "origin string, status int, body string")
    got = {r["url"]: (r["allowed"], r["reason"], r["delay"]) for r in web.robots_verdicts(urls, rules).collect()}
    assert got["https://a.example/x"] == (True, None, 4.0) and got["https://a.example/no"][1] == "robots-disallowed"
    assert got["https://b.example/"][0] and got["https://c.example/"][1] == "robots-unavailable"


def test_records(spark, tmp_path):
    for name, text in (("a", '[{"x":1},{"x":2}]'), ("p", '{"products":[{"x":1}]}'), ("o", '﻿{"x":1}'), ("l", '{"x":1}\n\n{"x":2}\n{"x":3}')):
        (tmp_path / name).write_text(text, encoding="utf-8")
    count = lambda n: files.read_records(spark, str(tmp_path / n)).count()
    assert [count(n) for n in "apol"] == [2, 1, 1, 3]
    with pytest.raises(ValueError):
        files.split_records("[]")


def test_selection_filters_before_the_limit(spark):
    schema = "source_url string, status string, source_content_hash string, external_checked boolean, draft_name_normalized string, attempts int, ordinal int"
    items = spark.createDataFrame([("q", "queued", None, False, None, 0, 0), ("d", "transformed", "h", True, "n", 5, 1), ("r", "scraped", "h", True, None, 0, 2)], schema)
    urls = lambda *a, **k: [r["source_url"] for r in K.stage_entries(items, *a, **k).collect()]
    assert urls("publish") == ["d"] and urls("generate", limit=1) == ["r"] and urls("all") == ["d", "r"]


def test_edits_may_swap_names_but_not_clash(spark):
    public = spark.createDataFrame([("s1", "1", "t", "A"), ("s2", "2", "t", "B"), ("s3", "3", "t", "C")], "slug string, id string, created_at string, name string")
    edit = lambda rows: spark.createDataFrame([(*r, None, None) for r in rows], "slug string, name string, id string, created_at string")
    swap = edit([("s1", "B"), ("s2", "A")])
    assert {r["slug"]: r["name"] for r in K.applied_edits(swap, public).collect()} == {"s1": "B", "s2": "A", "s3": "C"}
    bad = {(r["slug"], r["reason"]) for r in K.edit_rejections(edit([("s1", "c"), ("x", "Q")]), public).collect()}
    assert bad == {("s1", "duplicate final name"), ("x", "unknown slug")}
    with pytest.raises(ValueError):
        K.applied_edits(edit([("x", "Q")]), public)


def plain_admission(requests, rpd, rpm, tpm):
    """Decides (at, tokens) in order, looking at every earlier admitted request each time."""
    from datetime import timezone
    from zoneinfo import ZoneInfo

    day = lambda at: at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo("America/Los_Angeles")).date()
    taken, out = [], []
    for at, n in requests:
        near = [m for t, m in taken if (at - t).total_seconds() < 60]
        fine = n <= tpm and sum(day(t) == day(at) for t, _ in taken) < rpd and len(near) < rpm and sum(near) + n <= tpm
        out.append(fine)
        taken += [(at, n)] if fine else []
    return out


def test_admission_equals_a_plain_loop(spark):
    start = datetime(2026, 3, 7, 23, 0)
    rows = [("s", m, start + timedelta(seconds=17 * i * (1 + (m == "b"))), 100 + 900 * (i % 7)) for i in range(400) for m in "ab"]
    got = Q.admit(spark.createDataFrame(rows, "scope string, model string, at timestamp, tokens long"), rpd=40, rpm=3, tpm=4000)
    for m in "ab":
        want = plain_admission([(at, n) for _, k, at, n in rows if k == m], 40, 3, 4000)
        assert [r["admitted"] for r in got.filter(F.col("model") == m).orderBy("at").collect()] == want and len(set(want)) == 2


def test_limits_and_release():
    a = Q.Admission(rpd=1)
    assert a.claim(1e9, 1) and not a.claim(1e9 + 100, 1) and a.claim(1e9 + 86400, 1)
    b = Q.Admission(rpm=5)
    assert b.claim(1e9, 24_999) and not b.claim(1e9 + 1, 2) and b.ready_at(1e9 + 1, 2) == 1e9 + 61
    assert not Q.Admission(tpm=1).claim(1e9, 2)
    pool = Q.KeyPool(2, rpd=1)
    assert [pool.claim("m", 1e9, 1) for _ in range(3)] == [0, 1, None]
    pool.block(0, "m", 2e9, 503)
    assert pool.ready_at("m", 1e9 + 90_000) == 2e9


def test_publish_reserves_and_reconciles(spark):
    rows = [("a", i, 12.0) for i in range(5)] + [("b", 0, None), ("b", 1, 12.0)] + [("c", i, 30.0 if i < 2 else 1.0) for i in range(6)]
    got = Q.publish_ledger(spark.createDataFrame(rows, "day string, pos long, written double"), 80_000, 2).orderBy("day", "pos").collect()
    of = lambda d: [(r["batch"], r["used"], r["acknowledged"]) for r in got if r["day"] == d]
    assert of("a") == [(0, 24, True), (0, 24, True), (1, 48, True), (1, 48, True), (2, 60, True)]
    # The failed batch keeps its reservation and ends the day.
    assert of("b") == [(0, 200, False), (0, 200, False)]
    assert [u for _, u, _ in of("c")][-1] == 64
    assert Q.publish_ledger(spark.createDataFrame(rows, "day string, pos long, written double"), 99, 2).count() == 0
    budget = Q.WriteBudget(80_000)
    assert budget.settle(2, 24) and budget.estimate == 22 and budget.settle(2, 2) and budget.estimate == 22


def test_a_pool_turns_through_its_keys(spark):
    at = lambda s: datetime(2026, 1, 5, 12, 0) + timedelta(seconds=s)
    schema = "pool string, model string, at timestamp, tokens long, failed_key long, status int, until timestamp"
    rows = [("p", "m", at(i), 10, None, None, None) for i in range(5)]
    rows += [("p", "m", at(100), None, 0, 503, at(400)), ("p", "m", at(200), 10, None, None, None), ("p", "m", at(401), 10, None, None, None)]
    got = Q.pool_ledger(spark.createDataFrame(rows, schema), 2, rpm=2).orderBy("at").collect()
    assert [r["key"] for r in got] == [0, 1, 0, 1, None, None, 0]


def test_running_sums_equal_one_window(spark):
    rows = [("h" if i % 3 else None, i, i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r["g"], r["o"]): r["before"] for r in Q.running_sums(df, "g", "o", "v", chunk_rows=16).collect()}
    assert got == {(g, o): sum(v for k, p, v in rows if k == g and p < o) for g, o, _ in rows}


def test_generation_retries_what_failed(spark):
    from loomspan.operators import generation as G

    product = dict(
        name="Balance Trail", category="Finance", audience="small teams of owners", problem="They lose track of what they owe to whom.", promise="One list of what is due.",
        differentiator="It reads the mails that nobody files.", workflow=["Connect the mailbox", "Read the invoices", "Pay what is due"], keywords=["invoices", "payments", "ledger", "mail"], metrics=["hours saved", "late fees"],
        intent_key="invoice-operations",
    )
    schema = (
        "id string, try int, pos long, product struct<name: string, category: string, audience: string, problem: string, promise: string, differentiator: string, workflow: array<string>, "
        "keywords: array<string>, metrics: array<string>, intent_key: string>, extra_fields boolean, issues array<string>"
    )
    jobs = spark.createDataFrame([(str(i), i) for i in range(100)], "id string, pos long")
    named = lambda i: product | {"name": f"Balance Trail {i}"}
    replies = [(str(i), 1, i, named(i), False, []) for i in range(1, 100) if i != 7] + [("0", 2, 0, named(1), False, []), ("7", 2, 0, named(7), True, []), ("foreign", 1, 0, named(0), False, [])]
    replies += [("0", 3, 0, named(0), False, []), ("7", 3, 0, None, False, [])]
    none = spark.createDataFrame([], "name_normalized string")
    saved, left = G.generate(jobs, spark.createDataFrame(replies, schema), none)
    rows = {r["id"]: (r["try"], r["batch"]) for r in saved.collect()}
    assert len(rows) == 99 and rows["1"] == (1, 0) and rows["99"] == (1, 1) and rows["0"] == (3, 3)
    assert [tuple(r) for r in left.collect()] == [("7", "missing or invalid product object")]
    assert G.generate(jobs.limit(0), spark.createDataFrame([], schema), none)[0].count() == 0


def test_models_answer_in_turn_and_lists_pair_up(spark):
    from loomspan.operators import generation as G

    rows = [("r", "full", 1, 429), ("r", "ready", 2, 200), ("r", "spare", 3, 200), ("n", "full", 1, 503), ("n", "ready", 2, None)]
    got = {r["request"]: (r["model"], r["failures"]) for r in G.answered(spark.createDataFrame(rows, "request string, model string, pref int, status int")).collect()}
    assert got == {"r": ("ready", 1), "n": (None, 2)}
    sent, back = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"])], "request string, sent array<string>"), spark.createDataFrame([("a", ["1", "2"]), ("b", [])], "request string, got array<string>")
    assert {tuple(r) for r in G.zipped(sent, back).collect()} == {("a", 0, "x", "1"), ("a", 1, "y", "2"), ("b", None, None, None)}
    keys = lambda rows: spark.createDataFrame(rows, "g int, k string")
    got = {r["g"]: r["acknowledged"] for r in G.acknowledged(keys([(1, "a"), (2, "a"), (3, "a")]), keys([(1, "a"), (2, "a"), (2, "b")]), "g", "k").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_cycles_publish_before_they_generate_and_stop(spark):
    from loomspan.operators import generation as G

    schema = "source_url string, status string, source_content_hash string, external_checked boolean, draft_name_normalized string, attempts int, ordinal int"
    rows = [("saved", "transformed", "h", True, "n", 0, 0), ("new", "queued", None, False, None, 0, 1), ("ready", "scraped", "h", True, None, 0, 2), ("stuck", "scraped", "h", True, None, 0, 3), ("later", "scraped", "h", True, None, 0, 4)]
    got = G.cycles(spark.createDataFrame(rows, schema), spark.createDataFrame([("ready",), ("later",)], "source_url string"), 2)
    assert {tuple(r) for r in got.collect()} == {(0, 1, "new"), (0, 2, "saved"), (1, 3, "ready"), (1, 3, "stuck"), (1, 4, "ready")}


def test_screening(spark):
    rows = [(1, "Acme Beacon", "we sell lamps that shine in the dark all night long", "Zed", "we sell lamps that shine in the dark")]
    rows += [(2, "Quillon Code", "x", "Zed", "ask Quillon for help"), (3, "Data Hub", None, "Zed", "open data hub tools")]
    df = spark.createDataFrame(rows, "id int, source_name string, source_text string, name string, public_text string")
    got = {r["id"]: r["issues"] for r in D.screen(df).collect()}
    assert got[1] == ["public copy contains a seven-word source phrase"]
    assert got[2] == ["source brand token appears in public copy: quillon"] and got[3] == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "source_url string, updated_at timestamp, status string")
    assert K.status_counts(K.current_items(none)).collect()[0]["n"] == 0
    assert K.reconcile(spark.createDataFrame([], "id string"), spark.createDataFrame([], "id string")).count() == 0
