"""Command line: status, stage selection, export, audit, retry and incremental runs over a table folder."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from loomspan.functions import columns as C
from loomspan.operators import checkpoint as K
from loomspan.operators.generation import cycles
from loomspan.operators.quota import WriteBudget
from loomspan.plans import catalog, incremental
from loomspan.session import drop_intermediate, local_session, persisted, table
from loomspan.sources.files import read_records, write_export

STAGES = ("all", "scrape", "generate", "generate-publish", "publish")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspan")
    p.add_argument("--tables", required=True, help="folder of Parquet tables")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="select the next work of a stage and what its cycles do")
    run.add_argument("--stage", choices=STAGES, default="all")
    run.add_argument("--scrape-only", action="store_true", help="the same as --stage scrape")
    run.add_argument("--publish", action="store_true")
    run.add_argument("--input", metavar="FILE", help="edited records to publish; only with the stage publish")
    run.add_argument("--preview", metavar="FOLDER", help="write the drafts of the selected work there")
    run.add_argument("--order", choices=("newest", "sitemap"), default="newest")
    run.add_argument("--limit", type=int, default=3)
    run.add_argument("--offset", type=int, default=0)
    run.add_argument("--offline", action="store_true", help="nothing is scraped")
    run.add_argument("--no-external", action="store_true", help="external pages count as checked")
    run.add_argument("--max-failures", type=int, default=K.MAX_FAILURES)
    run.add_argument("--batch-size", type=int, default=50)
    run.add_argument("--publish-batch-size", type=int, default=25)
    run.add_argument("--daily-row-budget", type=int, default=80_000)
    run.add_argument("--wait-minutes", type=float, default=2.0, help="a model ready later than this pauses the run")
    sub.add_parser("status")
    sub.add_parser("backlog", help="items whose content still has to be processed")
    audit = sub.add_parser("audit-brands")
    audit.add_argument("--repair", metavar="FOLDER", help="write the repaired rows there")
    export = sub.add_parser("export")
    export.add_argument("folder")
    retry = sub.add_parser("retry-failed")
    retry.add_argument("folder")
    sub.add_parser("quota-status")
    return p


def refusal(args: argparse.Namespace) -> str | None:
    """Why the arguments of `run` make no sense together."""
    least = {"limit": 1, "offset": 0, "max_failures": 1, "batch_size": 1, "publish_batch_size": 1, "daily_row_budget": 1, "wait_minutes": 0}
    for name, low in least.items():
        if getattr(args, name) < low:
            return f"--{name.replace('_', '-')} must be at least {low}"
    if args.batch_size > 100 or args.publish_batch_size > 25:
        return "--batch-size is at most 100, --publish-batch-size at most 25"
    if args.input and args.stage != "publish":
        return "--input needs --stage publish"
    if args.offline and args.stage == "scrape":
        return "--offline leaves the stage scrape nothing to do"
    return None


def run_stage(spark, d: str, args: argparse.Namespace) -> dict:
    """The selected work, what the cycles over it do, and how much the budget lets through."""
    items = K.current_items(table(spark, d, "work_items"))
    if args.no_external:
        items = items.withColumn("external_checked", F.lit(True))
    if args.input:
        public = items.filter("published_slug is not null").groupBy(F.col("published_slug").alias("slug")).agg(F.min("source_url").alias("id"), F.max("draft_name_normalized").alias("name"))
        public = public.withColumn("created_at", F.lit(catalog.CREATED))
        edits = read_records(spark, args.input).select(F.from_json("record", "slug string, name string, id string, createdAt string").alias("r"))
        edits = edits.select("r.slug", "r.name", "r.id", F.col("r.createdAt").alias("created_at"))
        refused = K.edit_rejections(edits, public)
        if not refused.isEmpty():
            return {"refused": [r.asDict() for r in refused.orderBy("slug", "reason").limit(100).collect()]}
        items = K.edited_items(items, edits, public).join(edits.select(F.col("slug").alias("published_slug")), "published_slug", "left_semi")
    stage = "all" if args.stage == "generate-publish" else args.stage
    if stage == "scrape":
        picked = K.scrape_entries(items, args.max_failures).drop("needs")
    else:
        picked = K.stage_entries(items, stage, args.publish, args.max_failures)
        if stage == "all" and not args.offline:
            picked = picked.unionByName(K.scrape_entries(items, args.max_failures).drop("needs")).distinct()
    by = [F.desc(C.modified_at(F.col("last_modified")))] if args.order == "newest" and stage in ("all", "scrape") else []
    picked = persisted(picked.orderBy(*by, "ordinal", "source_url").offset(args.offset).limit(args.limit), "picked")
    planned = cycles(picked, picked.select("source_url"), args.batch_size, args.max_failures)
    wanted = {"scrape": (1,), "generate": (3, 2, 4) if args.publish else (3,), "publish": (2,), "all": (1, 2, 3, 4) if args.publish or args.stage == "generate-publish" else (1, 3)}[stage]
    if args.offline or args.stage == "generate-publish":
        wanted = tuple(x for x in wanted if x != 1)
    steps = {r["step"]: r["n"] for r in planned.filter(F.col("step").isin(*wanted)).groupBy("step").agg(F.count("*").alias("n")).collect()}
    ledger = WriteBudget(args.daily_row_budget)
    if args.preview:
        write_export(picked.filter(K.has_draft()), args.preview)
    names = {1: "scrape", 2: "publish_saved", 3: "generate", 4: "publish_generated"}
    return {
        "selected": [r["source_url"] for r in picked.select("source_url").orderBy("source_url").collect()], "steps": {names[k]: n for k, n in sorted(steps.items())},
        "first_publish_batch": ledger.room(args.publish_batch_size),
    }


def main(argv: list[str] | None = None) -> int:
    """0: done; 1: an error or refused; 2: an unknown command; 130: interrupted."""
    try:
        args = parser().parse_args(argv)
    except SystemExit as end:
        return int(end.code or 0)
    if args.command == "run":
        args.stage = "scrape" if args.scrape_only else args.stage
        if wrong := refusal(args):
            print(wrong, file=sys.stderr)
            return 1
    spark = local_session()
    try:
        report = command(spark, args)
        print(json.dumps(report, indent=2, default=str))
        return 1 if isinstance(report, dict) and "refused" in report else 0
    except KeyboardInterrupt:
        return 130
    finally:
        drop_intermediate(spark)


def command(spark, args: argparse.Namespace):
    """The report of a command."""
    d = args.tables
    items = K.current_items(table(spark, d, "work_items"))
    if args.command == "run":
        report = run_stage(spark, d, args)
    elif args.command == "status":
        report = {r["status"]: r["n"] for r in K.status_counts(items).collect()}
    elif args.command == "backlog":
        report = {"pending": incremental.p7_found(spark, d).count()}
    elif args.command == "audit-brands":
        flagged = catalog.q_audit_flagged(spark, d).persist()
        report = {"flagged": flagged.count()}
        if args.repair:
            urls = table(spark, d, "catalog_drafts").join(flagged, "draft_id").select("source_url").distinct()
            K.repaired(items, urls).write.mode("errorifexists").parquet(args.repair)
            report["queued_for_repair"] = report["flagged"]
    elif args.command == "export":
        write_export(catalog.q_export(spark, d), args.folder)
        report = {"folder": args.folder}
    elif args.command == "retry-failed":
        K.reset_failures(items).write.mode("errorifexists").parquet(args.folder)
        report = {"reset": items.filter(F.col("status") == "failed").count()}
    else:
        from loomspan.plans import quotas

        report = [r.asDict() for r in quotas.q_outcomes(spark, d).collect()]
    return report


if __name__ == "__main__":
    sys.exit(main())
