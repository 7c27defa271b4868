"""Problem 7: exactly the work items whose current content is still to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.operators.versions import VersionedTable, latest_rows, process_changes
from loomspan.session import shared_path, table


def _tables(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Version 1: the content each item's latest `done` row processed.
    Version 2: merged with the current work items, so its delta is the backlog.
    """
    log = table(spark, sf_dir, "run_items").filter("outcome = 'done'")
    done = latest_rows(log, "source_url", ["logged_at"], ["content_hash"])
    items = table(spark, sf_dir, "work_items")
    current = latest_rows(items, "source_url", ["updated_at"], ["source_content_hash"]).select(
        "source_url", F.col("source_content_hash").alias("content_hash")
    )
    versions = VersionedTable(spark, shared_path(spark, "work"))
    versions.commit(done)
    versions.merge(current, "source_url")
    return versions


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without a `done` row, or whose latest one had other content.

    A null hash equals only a null hash. Items with a null source_url are none.
    Empty tables give an empty result, repeated rows count once.
    """
    versions = _tables(spark, sf_dir)
    return versions.changes(1, 2).filter("op = 'insert'").select("source_url")


def p7_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs over both versions with an output failure in between.

    One row per processed record with the number of times it was processed per
    version, which must be 1: the failed run left nothing behind.
    """
    versions = _tables(spark, sf_dir)
    sink = VersionedTable(spark, shared_path(spark, "sink"))
    first = versions.manifest(1)
    older = VersionedTable(spark, versions.path)
    older.latest = lambda: first  # type: ignore[method-assign]
    process_changes(older, sink, lambda d: d.withColumn("run", F.lit(1)))
    try:
        process_changes(versions, sink, _failing)
    except RuntimeError:
        pass
    process_changes(versions, sink, lambda d: d.withColumn("run", F.lit(2)))
    process_changes(versions, sink, lambda d: d.withColumn("run", F.lit(3)))
    out = sink.read()
    return out.groupBy("source_url", "run").agg(F.count("*").alias("times"))


def _failing(_: DataFrame) -> DataFrame:
    raise RuntimeError("the run is lost before its commit")


QUERIES = {"p7_found": p7_found, "p7_replay": p7_replay}

_CURRENT = """
cur as (
  select source_url, source_content_hash as h from (
    select *, row_number() over (partition by source_url
      order by updated_at desc nulls last, source_content_hash desc nulls last) as n
    from work_items where source_url is not null) where n = 1),
done as (
  select source_url, content_hash as h from (
    select *, row_number() over (partition by source_url
      order by logged_at desc nulls last, content_hash desc nulls last) as n
    from run_items where outcome = 'done' and source_url is not null) where n = 1)
"""

ORACLE = {
    "p7_found": f"""
with {_CURRENT}
select cur.source_url from cur left join done using (source_url)
where done.source_url is null or cur.h is distinct from done.h
""",
    "p7_replay": f"""
with {_CURRENT}
select source_url, cast(1 as integer) as run, cast(1 as bigint) as times from done
union all
select cur.source_url, cast(2 as integer), cast(1 as bigint) from cur left join done using (source_url)
where done.source_url is null or cur.h is distinct from done.h
""",
}
