"""Problem 9: sources mixed to target weights.

The tokens of each source, documents in order of id, are packed into blocks of
fixed length. Each output shard draws a multinomial count per source; the
running counts number the slots of a source. A slot's number gives its epoch and
place, and a pseudorandom permutation of the source's block indices per epoch
gives its block, so a block comes at most once per epoch, and there are at most
max_repeats epochs. Slots and blocks meet by index in an equi-join.

Counts and slots are made in the executors, a chunk of shards at a time; the
same seed gives a chunk the same counts in both passes. The driver sees one
number per mix and source.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomspan.llm.tokens import token_counts
from loomspan.operators.positions import ordinals
from loomspan.session import persisted, table

BLOCK_TOKENS = 128
SHARD_SLOTS = 256
#: Shards whose counts are drawn together.
CHUNK_SHARDS = 256
#: Standard deviations a source's slots may exceed their mean before its repeats run out.
MARGIN = 4.0
ROUNDS = 4
CHUNK = 10_000
SEED = 97


def blocks(sizes: DataFrame) -> DataFrame:
    """(source, block, doc_id, tokens): the documents' parts in each block of their source."""
    order = ordinals(sizes.filter("source is not null and tokens > 0").select("source", "doc_id", "tokens"), ["source", "doc_id"], "stream", "position")
    # Running sums: inside chunks of the order, then over the chunks.
    chunk = F.floor(F.col("position") / CHUNK)
    rows = order.withColumn("chunk", chunk)
    inside = Window.partitionBy("source", "chunk").orderBy("position")
    rows = rows.withColumn("upto", F.sum("tokens").over(inside))
    sums = rows.groupBy("source", "chunk").agg(F.sum("tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("source", "chunk", F.coalesce(before, F.lit(0)).alias("base"))
    placed = rows.join(starts, ["source", "chunk"]).select(
        "source", "doc_id", (F.col("base") + F.col("upto") - F.col("tokens")).alias("a"), (F.col("base") + F.col("upto")).alias("b")
    )
    first, last = F.floor(F.col("a") / BLOCK_TOKENS), F.floor((F.col("b") - 1) / BLOCK_TOKENS)
    spread = placed.select("source", "doc_id", "a", "b", F.explode(F.sequence(first, last)).alias("block"))
    part = F.least("b", (F.col("block") + 1) * BLOCK_TOKENS) - F.greatest("a", F.col("block") * BLOCK_TOKENS)
    return spread.select("source", "block", "doc_id", part.alias("tokens"))


@dataclass(frozen=True)
class Mix:
    """A mix with its sources, their shares, blocks and greatest number of slots."""

    name: str
    sources: tuple[str, ...]
    shares: tuple[float, ...]
    blocks: tuple[int, ...]
    caps: tuple[int, ...]
    slots: int

    @property
    def chunks(self) -> int:
        return -(-self.slots // (SHARD_SLOTS * CHUNK_SHARDS))

    def counts(self, chunk: int) -> np.ndarray:
        """Slots per shard of the chunk and source."""
        begin = chunk * SHARD_SLOTS * CHUNK_SHARDS
        left = min(self.slots - begin, SHARD_SLOTS * CHUNK_SHARDS)
        sizes = np.minimum(SHARD_SLOTS, left - SHARD_SLOTS * np.arange(-(-left // SHARD_SLOTS)))
        rng = np.random.default_rng([SEED, *self.name.encode(), 0, chunk])
        return rng.multinomial(sizes, self.shares)


def most_slots(share: float, cap: int) -> float:
    """Slots of a mix for which share * slots plus MARGIN standard deviations stay within the cap."""
    spread = MARGIN * math.sqrt(share * (1 - share))
    root = (-spread + math.sqrt(spread * spread + 4 * share * cap)) / (2 * share)
    return root * root


def mixes(targets: list[tuple[str, str, float, int]], blocks_of: dict[str, int]) -> list[Mix]:
    """The mixes that can be made, as large as the repeats allow."""
    by_mix: dict[str, list] = defaultdict(list)
    for mix, source, share, repeats in targets:
        if mix is not None and source is not None and share and share > 0:
            by_mix[mix].append((source, share, max(0, repeats or 0)))
    out = []
    for name, rows in sorted(by_mix.items()):
        rows.sort()
        total = sum(s for _, s, _ in rows)
        n = [blocks_of.get(source, 0) for source, _, _ in rows]
        caps = [k * repeats for k, (_, _, repeats) in zip(n, rows)]
        shares = [s / total for _, s, _ in rows]
        slots = int(min(most_slots(s, c) for s, c in zip(shares, caps)))
        if slots > 0:
            out.append(Mix(name, tuple(s for s, _, _ in rows), tuple(shares), tuple(n), tuple(caps), slots))
    return out


def permuted(index: np.ndarray, n: int, key: bytes) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1: a Feistel network on the next power of four, walked until inside."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [np.uint64(xxhash.xxh3_64_intdigest(key, seed=r)) for r in range(ROUNDS)]
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in rounds:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _sums(made: list[Mix]):
    """(mix, chunk, source, n): the slots of each source in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(m, c, s, int(n)) for m, c in zip(batch["mix"].to_pylist(), batch["chunk"].to_pylist()) for s, n in enumerate(made[m].counts(c).sum(axis=0))]
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["mix", "chunk", "source", "n"])

    return run


def _slots(made: list[Mix]):
    """The slots of a chunk's source: shard, slot, epoch and block."""
    names = ["mix_name", "shard", "source", "slot", "epoch", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, c, s, base, n in zip(*(batch[x].to_pylist() for x in ("mix", "chunk", "source", "base", "n"))):
                mix = made[m]
                each = mix.counts(c)[:, s]
                shard = np.repeat(c * CHUNK_SHARDS + np.arange(len(each)), each)
                slot = base + np.arange(n)
                epoch, place = slot // mix.blocks[s], slot % mix.blocks[s]
                block = np.empty(n, np.int64)
                for e in np.unique(epoch):
                    at = epoch == e
                    block[at] = permuted(place[at], mix.blocks[s], f"{SEED}\0{mix.name}\0{mix.sources[s]}\0{e}".encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([mix.name] * n, pa.string()), pa.array(shard), pa.array([mix.sources[s]] * n, pa.string()), pa.array(slot), pa.array(epoch), pa.array(block)], names=names
                )

    return run


def _chunks(spark: SparkSession, made: list[Mix]) -> DataFrame:
    """(mix, chunk) of all mixes."""
    parts = None
    for m, mix in enumerate(made):
        rows = spark.range(0, mix.chunks, 1, min(mix.chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        rows = rows.select(F.lit(m).cast("long").alias("mix"), F.col("id").alias("chunk"))
        parts = rows if parts is None else parts.unionByName(rows)
    return spark.createDataFrame([], "mix long, chunk long") if parts is None else parts


def drawn(spark: SparkSession, made: list[Mix]) -> tuple[list[Mix], DataFrame]:
    """The mixes and the sums of their chunks.

    A mix of which a source drew more slots than its repeats allow, which
    MARGIN makes rare, is made a little smaller and drawn again.
    """
    while True:
        sums = persisted(_chunks(spark, made).mapInArrow(_sums(made), "mix long, chunk long, source long, n long"), "draws")
        over: dict[int, float] = {}
        for r in sums.groupBy("mix", "source").agg(F.sum("n").alias("n")).collect():
            cap = made[r["mix"]].caps[r["source"]]
            if r["n"] > cap:
                over[r["mix"]] = max(over.get(r["mix"], 1.0), r["n"] / cap)
        if not over:
            return made, sums
        made = [Mix(*(m.name, m.sources, m.shares, m.blocks, m.caps, min(m.slots - 1, int(m.slots / over[i])))) if i in over else m for i, m in enumerate(made)]


def mix_slots(sizes: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mix_name, shard, source, slot, epoch, block) of all mixes, and (source, block, doc_id, tokens)."""
    spark = sizes.sparkSession
    parts = persisted(blocks(sizes), "blocks")
    blocks_of = {r["source"]: r["n"] for r in parts.groupBy("source").agg((F.max("block") + 1).alias("n")).collect()}
    goals = targets.select("mix_name", "source", "target_share", "max_repeats").distinct()
    made, sums = drawn(spark, mixes([tuple(r) for r in goals.collect()], blocks_of))
    before = F.sum("n").over(Window.partitionBy("mix", "source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    based = sums.withColumn("base", F.coalesce(before, F.lit(0))).filter("n > 0")
    spread = based.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "mix", "chunk", "source")
    return spread.mapInArrow(_slots(made), "mix_name string, shard long, source string, slot long, epoch long, block long"), parts


def mixed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, shard, source, slot, epoch, block, doc_id, tokens): the mixes' contents.

    Null sources belong to no target and are left out, like sources no target
    names and documents without tokens. A mix with a source that has no
    documents is empty, since its shares cannot be met. A document's part of a
    block appears at most max_repeats times in a mix. Columns besides those
    named are ignored.
    """
    slots, parts = mix_slots(sizes, targets)
    joined = slots.join(parts.hint("merge"), ["source", "block"])
    return joined.select("mix_name", "shard", "source", "slot", "epoch", "block", "doc_id", "tokens")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").filter("doc_id is not null")
    return persisted(token_counts(documents, ("doc_id", "source")), "sizes")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents of all mixes."""
    return mixed(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share per mix and source, and the most times a part was used."""
    targets = table(spark, sf_dir, "mix_targets").distinct()
    slots, parts = mix_slots(_sizes(spark, sf_dir), targets)
    # Repeats are counted before blocks meet their tokens.
    times = slots.groupBy("mix_name", "source", "block").agg(F.count("*").alias("times"))
    held = parts.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))
    used = times.join(held.hint("merge"), ["source", "block"]).select("mix_name", "source", "times", (F.col("times") * F.col("tokens")).alias("tokens"))
    per = used.groupBy("mix_name", "source").agg(F.sum("tokens").alias("tokens"), F.max("times").alias("most_repeats"))
    total = per.groupBy("mix_name").agg(F.sum("tokens").alias("total"))
    joined = targets.join(per, ["mix_name", "source"], "left").join(total, "mix_name", "left")
    return joined.select(
        "mix_name", "source", "target_share", (F.coalesce("tokens", F.lit(0)) / F.col("total")).alias("share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "max_repeats",
    )


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every mix, as one row per mix and source.

    Slots are numbered without gaps, no block comes twice in an epoch, no part
    of a document more than max_repeats times, and the drawn share is within
    five standard deviations of its target.
    """
    targets = table(spark, sf_dir, "mix_targets").select("mix_name", "source", "target_share", "max_repeats").distinct()
    slots, _ = mix_slots(_sizes(spark, sf_dir), targets)
    twice = slots.groupBy("mix_name", "source", "epoch", "block").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    per = twice.groupBy("mix_name", "source").agg(
        F.sum("n").alias("n"), F.max("n").alias("in_epoch"), (F.max("hi") - F.min("lo") + 1).alias("span"), F.min("lo").alias("lo"), (F.max("epoch") + 1).alias("epochs")
    )
    total = per.groupBy("mix_name").agg(F.sum("n").alias("all"))
    joined = targets.join(per, ["mix_name", "source"]).join(total, "mix_name")
    share, p = F.col("n") / F.col("all"), F.col("target_share")
    near = F.abs(share - p) <= 5 * F.sqrt(p * (1 - p) / F.col("all"))
    return joined.select(
        "mix_name", "source", ((F.col("n") == F.col("span")) & (F.col("lo") == 0)).alias("numbered"), (F.col("in_epoch") == 1).alias("once_an_epoch"),
        (F.col("epochs") <= F.col("max_repeats")).alias("within_repeats"), near.alias("near_target"),
    )


QUERIES = {"p9_shares": p9_shares, "p9_mix": p9_mix, "p9_checks": p9_checks}
ORACLE: dict[str, str] = {
    "p9_checks": "select distinct mix_name, source, true as numbered, true as once_an_epoch, true as within_repeats, true as near_target from mix_targets"
}
