"""Problem 2: frequencies of all distinct terms, by recursive radix partitions.

Records are made unique, terms are counted inside each Arrow batch, and the
partial counts are written to the shared folder, partitioned by the top bits
of the term's hash. A partition above the row limit is split again by the next
bits, as often as needed; DuckDB aggregates each final partition on its own, one
after the other where a task has several, and spills to the shared folder when
its memory limit is reached. Where that folder is no mounted file system nothing
spills: the row limit keeps a partition's groups below the memory limit. A hot
term costs one partial row per batch, however many records hold it.
"""

from __future__ import annotations

import itertools
import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.llm.words import words
from loomspan.operators.versions import latest_rows
from loomspan.session import persisted, shared_dir, table

BITS = 6
MAX_BITS = 30
LEAF_ROWS = 2_000_000
DUCKDB_MEMORY = "256MB"
RARE_BELOW = 3
COMMON_SHARE = 0.05
FIELDS = (
    ("keywords", "catalog_drafts", "draft_id", "created_at"),
    ("categories", "source_products", "record_id", "loaded_at"),
)

_PARTIAL = "field string, term string, radix long, occurrences long, records long"


def normal_term(raw: str | None) -> str:
    """The term an element stands for; '' if it holds none."""
    return " ".join(words(raw)) if raw else ""


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch of unique records: occurrences and records of each term."""
    for batch in batches:
        for field in pc.unique(batch["field"]).to_pylist():
            part = batch.filter(pc.equal(batch["field"], field))
            lists = part["elements"]
            coded = pc.list_flatten(lists).dictionary_encode()
            owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            names = [normal_term(x) for x in coded.dictionary.to_pylist()]
            distinct = sorted({n for n in names if n})
            number = {n: i for i, n in enumerate(distinct)}
            of_code = np.array([number.get(n, -1) for n in names] + [-1], dtype=np.int64)
            term = of_code[codes]
            keep = term >= 0
            term, owner = term[keep], owner[keep].astype(np.int64)
            if not len(term):
                continue
            occurrences = np.bincount(term, minlength=len(distinct))
            held = np.unique(term * (len(part) + 1) + owner) // (len(part) + 1)
            records = np.bincount(held, minlength=len(distinct))
            radix = [xxhash.xxh3_64_intdigest(f"{field}\x00{n}") >> (64 - MAX_BITS) for n in distinct]
            yield pa.RecordBatch.from_arrays(
                [pa.array([field] * len(distinct)), pa.array(distinct), pa.array(radix, pa.int64()), pa.array(occurrences, pa.int64()), pa.array(records, pa.int64())],
                names=["field", "term", "radix", "occurrences", "records"],
            )


def _by_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The stretches of each leaf in batches sorted by leaf."""
    for batch in batches:
        if batch.num_rows:
            runs = pc.run_end_encode(batch["leaf"])
            start = 0
            for end, leaf in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                yield leaf, batch.slice(start, end - start)
                start = end


def _aggregator(spill: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        schema = pa.schema([("field", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])
        for _, pieces in itertools.groupby(_by_leaf(batches), key=lambda x: x[0]):
            folder = f"{spill}/{uuid.uuid4().hex}" if spill else ""
            options = {"memory_limit": DUCKDB_MEMORY, "threads": "1", "preserve_insertion_order": "false", "temp_directory": folder}
            with duckdb.connect(config=options) as db:
                partials = pa.RecordBatchReader.from_batches(schema, (b.select(schema.names).cast(schema) for _, b in pieces))
                db.register("partials", partials)
                result = db.sql(
                    "select field, term, sum(occurrences)::bigint as occurrences, sum(records)::bigint as records from partials group by all"
                )
                yield from result.to_arrow_reader(8192)
            if folder:
                shutil.rmtree(folder, ignore_errors=True)

    return run


def _spill_folder(spark: SparkSession) -> str | None:
    """DuckDB spills to the shared folder where it is mounted as a file system."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        return base.removeprefix("file:").replace("//", "/", 1) + "/loomspan/duckdb"
    return base + "/loomspan/duckdb" if base.startswith("/") else None


def radix_partitions(partials: DataFrame, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Write `partials` by hash bits until no partition has over `leaf_rows` rows.

    Adds `leaf`, the path of bits. Only the row counts of the partitions, at
    most 2**BITS of each split, come to the driver. The bits end at MAX_BITS;
    more rows under one value of all bits can only be partials of very few
    terms, of which DuckDB keeps one row each.
    """
    pending, used, done = partials, 0, []
    while True:
        used += BITS
        spread = pending.withColumn("digit", F.shiftright("radix", MAX_BITS - used))
        # A digit's rows are written by as many tasks as the next bits make, so all cores take part.
        finer = F.shiftright("radix", max(0, MAX_BITS - used - BITS))
        written = persisted(spread.repartition(F.col("digit"), finer), "radix", ["digit"])
        sizes = {r["digit"]: r["count"] for r in written.groupBy("digit").count().collect()}
        large = [d for d, n in sizes.items() if n > leaf_rows] if used < MAX_BITS else []
        leaf = F.concat_ws("/", F.lit(str(used)), F.col("digit").cast("string"))
        fits = written.filter(~F.col("digit").isin(large)) if large else written
        done.append(fits.withColumn("leaf", leaf).drop("digit"))
        if not large:
            break
        pending = written.filter(F.col("digit").isin(large)).drop("digit")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def unique_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, id, elements): one row per record key of both tables."""
    parts = []
    for field, name, key, stamp in FIELDS:
        rows = table(spark, sf_dir, name).select(key, stamp, field)
        one = latest_rows(rows, key, [stamp], [field])
        parts.append(one.select(F.lit(field).alias("field"), F.col(key).alias("id"), F.col(field).alias("elements")))
    return parts[0].unionByName(parts[1])


def term_counts(records: DataFrame, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(field, term, occurrences, records) of (field, id, elements) with unique ids.

    Null lists, empty lists, null elements and elements without a letter or
    digit hold no term. A term twice in a record counts two occurrences and one
    record. An empty input gives an empty result; extra columns are ignored.
    """
    partials = records.select("field", "elements").mapInArrow(_partial_counts, _PARTIAL)
    leaves = radix_partitions(partials, leaf_rows)
    spread = leaves.repartition("leaf").sortWithinPartitions("leaf").select("leaf", "field", "term", "occurrences", "records")
    return spread.mapInArrow(_aggregator(_spill_folder(records.sparkSession)), "field string, term string, occurrences long, records long")


def marked_terms(records: DataFrame) -> DataFrame:
    """Term counts with the share of records and the mark rare, common or null."""
    totals = records.groupBy("field").agg(F.count("*").alias("total"))
    share = F.col("records") / F.col("total")
    mark = F.when(F.col("records") < RARE_BELOW, "rare").when(share > COMMON_SHARE, "common")
    return term_counts(records).join(F.broadcast(totals), "field").select("field", "term", "occurrences", "records", mark.alias("mark"))


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct term of both fields with its counts and mark."""
    return marked_terms(unique_records(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms held by too few or too many records."""
    return p2_terms(spark, sf_dir).filter("mark is not null").select("field", "term", "mark")


QUERIES = {"p2_found": p2_found, "p2_terms": p2_terms}

_TERMS = """
with rec as (
  select 'keywords' as field, draft_id as id, any_value(keywords) as els from catalog_drafts where draft_id is not null group by draft_id
  union all
  select 'categories', record_id, any_value(categories) from source_products where record_id is not null group by record_id),
tot as (select field, count(*) as total from rec group by field),
el as (select field, id, array_to_string(regexp_extract_all(strip_accents(lower(e)), '[a-z0-9]+'), ' ') as term
  from (select field, id, unnest(els) as e from rec)),
cnt as (select field, term, count(*) as occurrences, count(distinct id) as records
  from el where term is not null and term <> '' group by field, term),
marked as (select field, term, occurrences, records,
  case when records < 3 then 'rare' when records / total > 0.05 then 'common' end as mark
  from cnt join tot using (field))
"""

ORACLE = {
    "p2_found": _TERMS + "select field, term, mark from marked where mark is not null",
    "p2_terms": _TERMS + "select field, term, occurrences, records, mark from marked",
}
