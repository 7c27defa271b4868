"""Problem 6: near-duplicate texts by banded universal-hash minima.

A text is reduced to its set of word sequences; texts with one and the same set
share a node, so exact copies are compared once. Each node gets ROWS x BANDS
minima of universal hashes a*x+b; nodes that agree in all rows of a band are
candidates, and the shared part of the two sets decides. Components of the
verified links come from alternating large-star and small-star steps.

Band keys travel as sorted, delta-coded blocks instead of rows, which more than
halves the shuffle. A key belongs to one of as many buckets as the number of
texts asks for, so a bucket stays small however large the input is, and is told
apart in it by 32 bits. A key that more than HOT_KEY nodes share would give a
quadratic number of pairs; its nodes go to an exact prefix-filter join over their
rarest sequences instead, which loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomspan.llm.words import words
from loomspan.session import persisted, release_shuffles, table

ROWS, BANDS = 5, 32
#: Entries of band keys in a bucket, on average.
BUCKET_ENTRIES = 2_000_000
HOT_KEY = 64
EXPANDED_COPIES = 50
FLUSH_TEXTS = 40_000
BLOCK_SETS = 1_000
SEED = 20250301
SIZE_BITS = 12

FIELDS = (
    ("description", "source_products", "record_id"),
    ("problem", "catalog_drafts", "draft_id"),
    ("differentiator", "catalog_drafts", "draft_id"),
)


def _node(found: np.ndarray) -> int:
    """52 bits of the set's hash and the set's size, limited to 12 bits."""
    digest = xxhash.xxh3_64_intdigest(found.tobytes()) >> (SIZE_BITS + 1)
    return (digest << SIZE_BITS) | min(len(found), (1 << SIZE_BITS) - 1)


def _sets_of(texts: list[str], salts: np.ndarray, width: int, seen: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct sequences of all texts, one text after the other, and where each text's begin.

    `salts` keep texts of different fields apart: the same words have other hashes.
    """
    flat, sizes = [], []
    for text in texts:
        w = words(text)
        try:
            flat += [seen[x] for x in w]
        except KeyError:
            if len(seen) > 200_000:
                seen.clear()
            for x in w:
                if x not in seen:
                    seen[x] = xxhash.xxh3_64_intdigest(x)
            flat += [seen[x] for x in w]
        sizes.append(len(w))
    size = np.array(sizes, np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    w = np.array(flat, np.uint64) ^ salts[owner]
    n = max(len(w) - width + 1, 0)
    mixed = w[:n].copy()
    for k in range(1, width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    inside = owner[:n] == owner[width - 1 : width - 1 + n]
    tagged = np.sort((owner[:n][inside].astype(np.uint64) << np.uint64(32)) | (mixed[inside] >> np.uint64(32)))
    tagged = tagged[np.append(True, tagged[1:] != tagged[:-1])] if len(tagged) else tagged
    starts = np.searchsorted(tagged, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    return (tagged & np.uint64(0xFFFFFFFF)).astype(np.uint32), starts


def _set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        sent: set[int] = set()
        for batch in batches:
            columns = zip(*(batch[c].to_pylist() for c in ("field", "id", "text")))
            rows = [(f, i, t) for f, i, t in columns if t and i is not None]
            if not rows:
                continue
            salt = {f: xxhash.xxh3_64_intdigest(f) for f in {r[0] for r in rows}}
            values, starts = _sets_of([t for _, _, t in rows], np.array([salt[f] for f, _, _ in rows], np.uint64), width, seen)
            fields, ids, nodes, lengths, empty, kept = [], [], [], [], [], []
            for (field, key, _), begin, end in zip(rows, starts[:-1].tolist(), starts[1:].tolist()):
                if begin == end:
                    continue
                found = values[begin:end]
                node = _node(found)
                fields.append(field), ids.append(key), nodes.append(node)
                empty.append(node in sent)
                lengths.append(0 if empty[-1] else end - begin)
                if not empty[-1]:
                    kept.append(found)
                if len(sent) > 200_000:
                    sent.clear()
                sent.add(node)
            if ids:
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                flat = np.concatenate(kept).view(np.int32) if kept else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(empty))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fields), pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), lists],
                    names=["field", "id", "node", "seqs"],
                )

    return run


def text_sets(texts: DataFrame, width: int) -> DataFrame:
    """(field, id, node, seqs) of each text with at least `width` words.

    A task leaves seqs null where it has lately sent the set of the same node,
    so a text that fills a large part of all rows is shuffled a few times only.
    """
    out = "field string, id long, node long, seqs array<int>"
    return texts.select("field", "id", "text").mapInArrow(_set_maker(width), out)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together: the high ones of small steps are alike."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _values(buffer: bytes, kind: str, count: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(buffer, np.uint8, size * count, at).reshape(size, count)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack(keys: np.ndarray, nodes: np.ndarray) -> bytes:
    """32-bit keys, sorted, as steps; nodes as places in the list of distinct nodes."""
    distinct, place = np.unique(nodes, return_inverse=True)
    steps = np.diff(keys.astype(np.uint32), prepend=np.uint32(0))
    head = np.array([len(keys), len(distinct)], "<u4").tobytes()
    body = _planes(steps.astype("<u4")) + _planes(place.astype("<u4")) + _planes(np.diff(distinct, prepend=np.uint64(0)).astype("<u8"))
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    body = zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=8 * n + 8 * m)
    keys = np.cumsum(_values(body, "<u4", n, 0), dtype=np.uint32)
    nodes = np.cumsum(_values(body, "<u8", m, 8 * n), dtype=np.uint64)
    return keys.astype(np.uint64), nodes[_values(body, "<u4", n, 4 * n)]


def band_keys(sets: np.ndarray, starts: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A (bands, sets) array of 64-bit keys. `sets` are the concatenated uint32 hashes."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 32, rows * bands, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, rows * bands, dtype=np.uint64).astype(np.uint32)
    out = np.empty((bands, len(starts)), np.uint64)
    for band in range(bands):
        key = np.full(len(starts), band + 1, np.uint64)
        for row in range(band * rows, band * rows + rows):
            least = np.minimum.reduceat(sets * a[row] + b[row], starts)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        out[band] = key * np.uint64(0xBF58476D1CE4E5B9)
    return out


def _bander(rows: int, bands: int, buckets: int):
    def flush(nodes: np.ndarray, values: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        nodes, first = np.unique(nodes, return_index=True)
        ends = np.append(starts[1:], len(values))
        blocks = []
        for at in range(0, len(first), BLOCK_SETS):
            picked = first[at : at + BLOCK_SETS]
            lengths = ends[picked] - starts[picked]
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            index = np.repeat(starts[picked] - begin, lengths) + np.arange(lengths.sum())
            blocks.append(band_keys(values[index], begin, rows, bands))
        keys = np.concatenate(blocks, axis=1).ravel()
        owner = np.tile(nodes.astype(np.uint64), bands)
        bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
        keys = keys & np.uint64(0xFFFFFFFF)
        order = np.lexsort((owner, keys, bucket))
        keys, owner, bucket = keys[order], owner[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        rng = np.random.default_rng(int(nodes[0]) & 0xFFFF_FFFF)
        out_bucket, out_hot, out_blob = [], [], []
        for k, o, bk in zip(np.split(keys, cuts), np.split(owner, cuts), np.split(bucket, cuts)):
            _, at, count = np.unique(k, return_index=True, return_counts=True)
            hot = np.repeat(count > HOT_KEY, count)
            if hot.any():
                # Hot keys go ahead on their own, to any bucket, since only their nodes
                # matter; a marker of node 0 tells the rest.
                marks = k[at[count > HOT_KEY]]
                out_bucket.append(int(rng.integers(buckets))), out_hot.append(True), out_blob.append(_pack(k[hot], o[hot]))
                k, o = np.concatenate([k[~hot], marks]), np.concatenate([o[~hot], np.zeros(len(marks), np.uint64)])
                again = np.argsort(k, kind="stable")
                k, o = k[again], o[again]
            out_bucket.append(int(bk[0])), out_hot.append(False), out_blob.append(_pack(k, o))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_bucket, pa.int32()), pa.array(out_hot, pa.bool_()), pa.array(out_blob, pa.binary())],
            names=["bucket", "hot", "blob"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def drain():
            nodes = np.concatenate([n for n, _, _ in held])
            values = np.concatenate([v for _, v, _ in held])
            lengths = np.concatenate([s for _, _, s in held])
            yield from flush(nodes, values, np.concatenate([[0], np.cumsum(lengths)[:-1]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch["seqs"]
            held.append((batch["node"].to_numpy(), pc.list_flatten(lists).to_numpy().view(np.uint32), pc.list_value_length(lists).to_numpy().astype(np.int64)))
            total += batch.num_rows
            if total >= FLUSH_TEXTS:
                yield from drain()
                held, total = [], 0
        if held:
            yield from drain()

    return run


def _pairs(keys: np.ndarray, nodes: np.ndarray, threshold: float):
    """Pairs inside each run of one key, and the entries of runs that are too long."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    fresh = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))
    keys, nodes = keys[fresh], nodes[fresh]
    _, at, count = np.unique(keys, return_index=True, return_counts=True)
    length = np.repeat(count, count)
    marked = np.repeat(nodes[at] == 0, count)
    hot = marked | (length > HOT_KEY)
    hot_keys, hot_nodes = keys[hot & (nodes != 0)], nodes[hot & (nodes != 0)]
    keys, nodes, length = keys[~hot & (length > 1)], nodes[~hot & (length > 1)], length[~hot & (length > 1)]
    left, right = [], []
    for step in range(1, int(length.max()) if len(length) else 0):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        left.append(nodes[same])
        right.append(nodes[same + step])
    a = np.concatenate(left) if left else np.empty(0, np.uint64)
    b = np.concatenate(right) if right else np.empty(0, np.uint64)
    mask = np.uint64((1 << SIZE_BITS) - 1)
    sa, sb = (a & mask).astype(float), (b & mask).astype(float)
    full = float(mask)
    ok = (np.minimum(sa, sb) >= threshold * np.maximum(sa, sb)) | (np.maximum(sa, sb) >= full)
    pair = np.unique(np.stack([a[ok], b[ok]], axis=1), axis=0) if ok.any() else np.empty((0, 2), np.uint64)
    return pair, hot_keys, hot_nodes


def _pairer(threshold: float):
    def emit(a, b, hot: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(np.full(len(a), hot))], names=["a", "b", "hot"]
        )

    def close(held) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([k for k, _ in held])
        nodes = np.concatenate([n for _, n in held])
        pair, hot_keys, hot_nodes = _pairs(keys, nodes, threshold)
        if len(pair):
            yield emit(pair[:, 0], pair[:, 1], False)
        if len(hot_keys):
            yield emit(hot_keys, hot_nodes, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for bucket, hot, blob in zip(*(batch[c].to_pylist() for c in ("bucket", "hot", "blob"))):
                if bucket != current and held:
                    yield from close(held)
                    held = []
                current = bucket
                keys, nodes = _unpack(blob)
                if hot:
                    yield emit(keys, nodes, True)
                else:
                    held.append((keys, nodes))
        if held:
            yield from close(held)

    return run


def _prefix_pairs(hot: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs of the nodes under hot keys that can reach `threshold`, exactly.

    Two sets of that similarity share one of the first n - ceil(t*n) + 1
    elements under any common order; with the rarest first, few sets meet.
    """
    nodes = hot.select(F.col("b").alias("node")).distinct()
    each = sets.join(nodes, "node", "left_semi").select("node", F.size("seqs").alias("n"), F.explode("seqs").alias("seq"))
    often = each.groupBy("seq").agg(F.count("*").alias("df"))
    ranked = each.join(often, "seq").withColumn(
        "at", F.row_number().over(Window.partitionBy("node").orderBy("df", "seq"))
    )
    prefix = ranked.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select("node", "n", "seq")
    a = prefix.select(F.col("node").alias("a"), F.col("n").alias("na"), "seq")
    b = prefix.select(F.col("node").alias("b"), F.col("n").alias("nb"), "seq")
    close = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)
    return a.join(b, "seq").filter(close).select("a", "b").distinct()


def similar_nodes(sets: DataFrame, threshold: float, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(a, b), a < b: nodes whose sets share at least `threshold` of their union."""
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filled = sets.filter("seqs is not null").select("node", "seqs")
    buckets = max(parts, -(-filled.count() * bands // BUCKET_ENTRIES))
    blocks = filled.mapInArrow(_bander(rows, bands, buckets), "bucket int, hot boolean, blob binary")
    # A bucket is a partition of its own; by hash several would meet in one task.
    grouped = blocks.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    found = persisted(grouped.mapInArrow(_pairer(threshold), "a long, b long, hot boolean"), "candidates")
    del blocks, grouped
    release_shuffles(spark)
    # Partitioned by node once; both joins below read it in place.
    unique = filled.repartition(parts, "node").dropDuplicates(["node"]).persist()
    candidates = found.filter("not hot").select("a", "b")
    if not found.filter("hot").isEmpty():
        candidates = candidates.union(_prefix_pairs(found.filter("hot"), unique, threshold))
    a = unique.select(F.col("node").alias("a"), F.col("seqs").alias("sa"))
    b = unique.select(F.col("node").alias("b"), F.col("seqs").alias("sb"))
    # shared >= t * (sa + sb - shared), written so that the intersection is taken once
    least = (F.size("sa") + F.size("sb")) * (threshold / (1 + threshold))
    return (
        candidates.repartition(parts, "a")
        .distinct()
        .join(a.hint("merge"), "a")
        .join(b.hint("merge"), "b")
        .filter(F.size(F.array_intersect("sa", "sb")) >= least - 1e-9)
        .select("a", "b")
    )


def catalog_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, id, text) of the three text columns; repeated rows stay and count once."""
    parts = [
        table(spark, sf_dir, name).select(F.lit(field).alias("field"), F.col(key).alias("id"), F.col(field).alias("text"))
        for field, name, key in FIELDS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("text is not null")


def similar_pairs(texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """(field, id_a, id_b), id_a < id_b, of all texts at least `threshold` alike.

    Null texts and texts of fewer than `width` words are in no pair; an id
    never pairs with itself, and repeated rows give no repeated pairs. Copies
    of one text are expanded while there are at most EXPANDED_COPIES of them.
    Of a larger group the smallest id stands for the others in links to other
    texts, and each other id is linked to it, so no link is lost and the
    output stays linear in the group. Extra columns are ignored.
    """
    sets = text_sets(texts, width).persist()
    links = persisted(similar_nodes(sets, threshold), "links")
    release_shuffles(sets.sparkSession)
    ids = _ids(sets).persist()
    # One text has one field: the node's hash holds it.
    groups = ids.groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.min("field").alias("field")).persist()
    few = ids.select("node", "id").join(groups.filter(f"copies between 2 and {EXPANDED_COPIES}").select("node", "field"), "node").persist()
    inside = few.join(few.select("node", F.col("id").alias("id_b")), "node").filter("id < id_b")
    inside = inside.select("field", F.col("id").alias("id_a"), "id_b")
    many = groups.filter(f"copies > {EXPANDED_COPIES}").select("node", "rep", "field")
    star = ids.select("node", "id").join(many, "node").filter("id <> rep").select("field", F.col("rep").alias("id_a"), F.col("id").alias("id_b"))

    alone = groups.filter(f"copies = 1 or copies > {EXPANDED_COPIES}").select("node", F.col("rep").alias("id"), "field")
    speaking = alone.unionByName(few)
    a = speaking.select("field", F.col("node").alias("a"), F.col("id").alias("ia"))
    b = speaking.select(F.col("node").alias("b"), F.col("id").alias("ib"))
    across = links.join(a, "a").join(b, "b").filter("ia <> ib").select(
        "field", F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")
    )
    return across.unionByName(inside).unionByName(star).distinct()


def _ids(sets: DataFrame) -> DataFrame:
    """(field, node, id), each once, partitioned by node, so groups and joins by node find it in place."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sets.select("field", "node", "id").repartition(parts, "node").dropDuplicates(["node", "id"])


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, root): the smallest node of each component of `edges` (a, b).

    Alternating large-star and small-star. Neighbour lists are never collected:
    the least neighbour is a map-side combined minimum, one row per node, that
    is joined back; the edges of a hub, the larger side of that join, may be
    split by AQE, as no group of them has to meet. Each round is written to the
    shared folder; the rounds end when the edges repeat, after about log2 of the
    longest path. `rounds` is a guard: components still unfinished then are an
    error, never a result.
    """
    current = persisted(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = persisted(large.filter("a <> b"), "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        current = persisted(small.filter("a <> b").distinct(), "small-star")
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components are not finished after {rounds} rounds")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def similar_groups(texts: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(field, id, group_id, links): one row per record with a text of `width` words.

    `group_id` is the smallest id of its component, its own if it is alone;
    `links` counts the other texts it is directly linked to, copies as one.
    """
    sets = text_sets(texts, width).persist()
    links = persisted(similar_nodes(sets, threshold), "links")
    release_shuffles(sets.sparkSession)
    ids = _ids(sets).persist()
    roots = components(links)
    degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("links"))
    joined = ids.join(roots, "node", "left").join(degree, "node", "left")
    joined = joined.select("field", "id", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    least = joined.groupBy("root").agg(F.min("id").alias("group_id"))
    return joined.join(least, "root").select("field", "id", "group_id", "links")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose sequences of three words are at least 0.7 the same."""
    return similar_pairs(catalog_texts(spark, sf_dir), 3, 0.7)


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of records alike per field: five words, similarity 0.8."""
    return similar_groups(catalog_texts(spark, sf_dir))


QUERIES = {"p6_found": p6_found, "p6_groups": p6_groups}

_TOKENS = """
with recursive txt as (
  select distinct 'description' as field, record_id as id, description as t from source_products
  union select distinct 'problem', draft_id, problem from catalog_drafts
  union select distinct 'differentiator', draft_id, differentiator from catalog_drafts),
w as (select field, id, regexp_extract_all(strip_accents(lower(replace(replace(t, 'ª', 'a'), 'º', 'o'))), '[a-z0-9]+') as w
  from txt where t is not null and id is not null),
s as (select distinct field, id, unnest(list_transform(range(1, len(w) - {back}), lambda i: array_to_string(w[i:i+{more}], ' '))) as g
  from w where len(w) >= {width}),
n as (select field, id, count(*) as n from s group by field, id),
p as (select a.field, a.id as id_a, b.id as id_b, count(*) as c from s a join s b on a.field = b.field and a.g = b.g and a.id < b.id group by all),
hit as (select p.field, id_a, id_b from p join n x on x.field = p.field and x.id = id_a
  join n y on y.field = p.field and y.id = id_b where c >= {t} * (x.n + y.n - c) - 1e-9)
"""

_GROUPS = """
with recursive txt as (
  select distinct 'description' as field, record_id as id, description as t from source_products
  union select distinct 'problem', draft_id, problem from catalog_drafts
  union select distinct 'differentiator', draft_id, differentiator from catalog_drafts),
w as (select field, id, regexp_extract_all(strip_accents(lower(replace(replace(t, 'ª', 'a'), 'º', 'o'))), '[a-z0-9]+') as w
  from txt where t is not null and id is not null),
s as (select field, id, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) as g from w where len(w) >= 5),
k as (select field, id, md5(array_to_string(g, '|')) as node, g from s),
n as (select field, node, any_value(g) as g, min(id) as rep from k group by field, node),
e as (select field, node, len(g) as size, unnest(g) as x from n),
p as (select a.field, a.node as a, b.node as b, count(*) as c, any_value(a.size) as sa, any_value(b.size) as sb
  from e a join e b on a.field = b.field and a.x = b.x and a.node < b.node group by all),
hit as (select field, a, b from p where c >= 0.8 * (sa + sb - c) - 1e-9),
ways as (select field, a, b from hit union all select field, b, a from hit),
reach(field, a, b) as (select field, node, node from n union select r.field, r.a, x.b from reach r join ways x on x.field = r.field and x.a = r.b),
root as (select r.field, r.a, min(rep) as group_id from reach r join n on n.field = r.field and n.node = r.b group by r.field, r.a),
deg as (select field, a, count(*) as links from ways group by field, a)
select k.field, k.id, group_id, coalesce(links, 0) as links from k join root on root.field = k.field and root.a = k.node left join deg on deg.field = k.field and deg.a = k.node
"""

ORACLE = {"p6_found": _TOKENS.format(back=1, more=2, width=3, t=0.7) + "select field, id_a, id_b from hit", "p6_groups": _GROUPS}
