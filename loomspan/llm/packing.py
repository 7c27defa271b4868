"""Problem 8: documents into containers of fixed capacity, by linear grouping.

Large pieces are sorted by size and cut into groups of equal cardinality; each
is rounded up to the largest of its group. Over these few sizes the
configurations are optimised together: a linear program over all fillings of a
container, whose columns a knapsack generates from the prices of the sizes.
Whole multiples are taken from its solution and the few pieces left over are
fitted best. Actual documents replace the rounded sizes by rank, small ones then
go best-fit into the room that is really left. Only histograms over sizes and
residuals, bounded by the capacity, come to the driver; ranks and assignments are
computed in parallel.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.llm.tokens import token_counts
from loomspan.operators.positions import ordinals
from loomspan.session import persisted, table

#: Groups of sizes; up to EXACT sizes of a capacity within the grid are not rounded at all.
GROUPS, EXACT = 160, 480
SMALL_SHARE = 0.1
#: Sizes are rounded up to this share of the capacity in the knapsacks, and the linear program ends this near its bound.
GRID, GAP = 1024, 1e-3


def pieces(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(pack_name, capacity, doc_id, piece, size): whole documents, larger ones in full pieces and a rest."""
    wanted = targets.filter("capacity_tokens > 0 and pack_name is not null").select("pack_name", "capacity_tokens").distinct()
    pairs = sizes.filter("tokens > 0").select("doc_id", "tokens").crossJoin(F.broadcast(wanted))  # a few fixed targets
    cap = F.col("capacity_tokens").cast("long")
    number = F.ceil(F.col("tokens") / cap)
    cut = pairs.select("pack_name", cap.alias("capacity"), "doc_id", "tokens", F.posexplode(F.sequence(F.lit(1).cast("long"), number)).alias("piece", "_n"))
    return cut.select("pack_name", "capacity", "doc_id", "piece", F.least("capacity", F.col("tokens") - F.col("piece") * F.col("capacity")).alias("size"))


def _priciest(sizes: np.ndarray, prices: np.ndarray, capacity: int, places: np.ndarray) -> tuple[float, np.ndarray]:
    """The filling of a container that is worth most, by number of pieces.

    `places` has for each size and room the place of what is left of the room
    in a row of worths that begins with impossible ones.
    """
    worth = np.where(prices > 0, prices, -1.0)[:, None]
    held = np.concatenate([np.full(capacity + 1, -1e9), np.zeros(capacity + 1)])
    rooms = np.arange(capacity + 1)
    took: list[np.ndarray] = []
    for _ in range(capacity // int(sizes.min())):
        value = held[places]
        value += worth
        best = value.argmax(axis=0)
        more = value[best, rooms]
        better = more > held[capacity + 1 :] + 1e-12
        if not better.any():
            break
        took.append(np.where(better, best, -1))
        held[capacity + 1 :] = np.where(better, more, held[capacity + 1 :])
    room, filling = capacity, np.zeros(len(sizes), np.int64)
    for layer in reversed(took):
        if layer[room] >= 0:
            filling[layer[room]] += 1
            room -= int(sizes[layer[room]])
    return float(prices @ filling), filling


def _linear_program(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[float, np.ndarray]]:
    """Fillings and how often each is used, so that all pieces are in and few containers are used."""
    unit = max(1, capacity // GRID)
    grid, room = -(-sizes // unit), capacity // unit
    grid = np.minimum(grid, room)
    m = len(sizes)
    places = (np.arange(room + 1)[None, :] - grid[:, None] + room + 1).astype(np.int32)
    fillings = np.diag(room // grid)
    inverse = np.diag(1.0 / (room // grid))
    used = counts / (room // grid)
    for _ in range(40 * m):
        prices = inverse.sum(axis=0)
        value, filling = _priciest(grid, prices, room, places)
        # prices / value is feasible in the dual, so its worth is a lower bound.
        if value <= 1 + 1e-9 or used.sum() <= (prices @ counts) / value * (1 + GAP):
            break
        step = inverse @ filling
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        amount, row = ratio[out], inverse[out] / step[out]
        used = used - amount * step
        used[out] = amount
        inverse -= np.outer(step, row)
        inverse[out] = row
        fillings[out] = filling
        used = np.maximum(used, 0.0)
    return list(zip(used.tolist(), fillings))


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, number of each size) until all counts are used."""
    left = np.array(counts, np.int64)
    out: list[tuple[int, list[int]]] = []
    kinds = np.flatnonzero(left)
    if not len(kinds):
        return out
    chosen = _linear_program(np.array(sizes, np.int64)[kinds], left[kinds].astype(float), capacity)
    for used, filling in sorted(chosen, key=lambda x: -x[0]):
        shape = np.zeros(len(sizes), np.int64)
        shape[kinds] = filling
        held = shape > 0
        times = min(int(used + 1e-6), int((left[held] // shape[held]).min()))
        if times:
            out.append((times, shape.tolist()))
            left -= times * shape
    # What the fractions leave: a few pieces per size, each where it fits best.
    rooms: list[tuple[int, int]] = []
    shapes: list[list[int]] = []
    for size, g in sorted(((size, g) for g, size in enumerate(sizes)), reverse=True):
        for _ in range(int(left[g])):
            at = bisect.bisect_left(rooms, (size, -1))
            if at == len(rooms):
                shapes.append([0] * len(sizes))
                room, box = capacity, len(shapes) - 1
            else:
                room, box = rooms.pop(at)
            shapes[box][g] += 1
            bisect.insort(rooms, (room - size, box))
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for shape in shapes:
        merged[tuple(shape)] += 1
    return out + [(times, list(shape)) for shape, times in merged.items()]


class LargePlan:
    """Container of the i-th largest piece of a pack."""

    def __init__(self, histogram: list[tuple[int, int]], capacity: int) -> None:
        ordered = sorted(histogram, reverse=True)
        self.total = sum(n for _, n in ordered)
        width = max(1, -(-self.total // GROUPS))
        edges = np.cumsum([n for _, n in ordered]) if ordered else np.array([], np.int64)
        # With few sizes each is a group of its own and nothing is rounded.
        self.starts = [0, *edges[:-1].tolist()] if 0 < len(ordered) <= EXACT and capacity <= GRID else list(range(0, self.total, width))
        sizes = [ordered[int(np.searchsorted(edges, s, "right"))][0] for s in self.starts]
        counts = np.diff([*self.starts, self.total]).tolist()
        self.slots: list[tuple[list[int], list[int], list[int]]] = [([0], [], []) for _ in sizes]
        self.containers = 0
        for times, shape in configurations(sizes, counts, capacity):
            for g, n in enumerate(shape):
                if n:
                    until, each, base = self.slots[g]
                    until.append(until[-1] + times * n)
                    each.append(n)
                    base.append(self.containers)
            self.containers += times

    def place(self, ranks: np.ndarray) -> np.ndarray:
        out = np.empty(len(ranks), np.int64)
        group = np.searchsorted(self.starts, ranks, "right") - 1
        for g in np.unique(group):
            at = group == g
            until, each, base = (np.array(x, np.int64) for x in self.slots[g])
            inside = ranks[at] - self.starts[g]
            k = np.searchsorted(until, inside, "right") - 1
            out[at] = base[k] + (inside - until[k]) // each[k]
        return out


class SmallPlan:
    """Best-fit over classes of containers with equal room, largest pieces first."""

    def __init__(self, rooms: list[tuple[int, int]], sizes: list[tuple[int, int]], capacity: int) -> None:
        classes: dict[int, list[list[int]]] = defaultdict(list)
        start = 0
        for room, n in sorted(rooms):
            classes[room].append([start, start + n])
            start += n
        keys = sorted(classes)
        self.first: list[int] = []
        self.each: list[int] = []
        self.base: list[int] = []
        rank = 0
        for size, count in sorted(sizes, reverse=True):
            while count:
                at = bisect.bisect_left(keys, size)
                if at == len(keys):
                    opened = -(-count // (capacity // size))
                    room, piece = capacity, [start, start + opened]
                    start += opened
                else:
                    room = keys[at]
                    piece = classes[room].pop()
                    if not classes[room]:
                        del classes[room], keys[at]
                fit = room // size
                used = min(piece[1] - piece[0], -(-count // fit))
                placed = min(count, used * fit)
                self.first.append(rank)
                self.each.append(fit)
                self.base.append(piece[0])
                if piece[0] + used < piece[1]:
                    self._put(classes, keys, room, [piece[0] + used, piece[1]])
                full = placed // fit
                if full:
                    self._put(classes, keys, room - fit * size, [piece[0], piece[0] + full])
                if placed % fit:
                    self._put(classes, keys, room - (placed % fit) * size, [piece[0] + full, piece[0] + full + 1])
                rank += placed
                count -= placed
        self.containers = start

    @staticmethod
    def _put(classes, keys, room: int, piece: list[int]) -> None:
        if room > 0:
            if room not in classes:
                bisect.insort(keys, room)
            classes[room].append(piece)

    def place(self, ranks: np.ndarray) -> np.ndarray:
        first, each, base = (np.array(x, np.int64) for x in (self.first, self.each, self.base))
        k = np.searchsorted(first, ranks, "right") - 1
        return base[k] + (ranks - first[k]) // each[k]


def _placer(plans: dict, offsets: dict[str, int], column: str):
    def run(frames):
        for frame in frames:
            frame[column] = np.int64(0)
            for name, rows in frame.groupby("pack_name").groups.items():
                ranks = frame.loc[rows, "position"].to_numpy() - offsets[name]
                frame.loc[rows, column] = plans[name].place(ranks)
            yield frame.drop(columns=["position"])

    return run


def _histogram(df: DataFrame, value: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for r in df.groupBy("pack_name", value).count().collect():
        out[r["pack_name"]].append((r[value], r["count"]))
    return out


def _offsets(histogram: dict[str, list[tuple[int, int]]]) -> dict[str, int]:
    out, total = {}, 0
    for name in sorted(histogram):
        out[name] = total
        total += sum(n for _, n in histogram[name])
    return out


def packed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(pack_name, doc_id, piece, tokens, container) for every document and target.

    A document is whole (piece 0) unless it has more tokens than the capacity;
    then it fills containers and its last piece is packed like a document.
    Documents without tokens are in no container, targets without a name or a
    positive capacity have none. Repeated doc_ids are packed each for itself; columns besides
    doc_id, tokens, pack_name and capacity_tokens are ignored.
    """
    spark = sizes.sparkSession
    capacity = {r["pack_name"]: r["capacity_tokens"] for r in targets.filter("capacity_tokens > 0 and pack_name is not null").select("pack_name", "capacity_tokens").distinct().collect()}
    items = persisted(pieces(sizes, targets), "pieces")
    threshold = F.col("capacity") * SMALL_SHARE
    big = items.filter(F.col("size") > threshold)
    small = items.filter(F.col("size") <= threshold)
    order = ["pack_name", F.desc("size"), "doc_id", "piece"]
    ranked = lambda rows, by, label: ordinals(rows, by, label, "position")

    histogram = _histogram(big, "size")
    large_plans = {p: LargePlan(h, capacity[p]) for p, h in histogram.items()}
    schema = "pack_name string, capacity long, doc_id long, piece int, size long, label long"
    placed = ranked(big.select("pack_name", "capacity", "doc_id", F.col("piece").cast("int"), "size"), order, "large")
    placed = persisted(
        placed.select("pack_name", "capacity", "doc_id", "piece", "size", "position").mapInPandas(_placer(large_plans, _offsets(histogram), "label"), schema), "placed"
    )

    filled = placed.groupBy("pack_name", "label").agg((F.first("capacity") - F.sum("size")).alias("room"))
    boxes = ranked(filled, ["pack_name", "room", "label"], "boxes")
    rooms = _histogram(boxes, "room")
    small_sizes = _histogram(small, "size")
    small_plans = {p: SmallPlan(rooms.get(p, []), h, capacity[p]) for p, h in small_sizes.items()}
    box_start = spark.createDataFrame(list(_offsets(rooms).items()) or [("", 0)], "pack_name string, _first long")
    numbered = boxes.join(F.broadcast(box_start), "pack_name").select("pack_name", "label", (F.col("position") - F.col("_first")).alias("container"))
    large_out = placed.join(numbered.hint("merge"), ["pack_name", "label"]).select("pack_name", "doc_id", "piece", F.col("size").alias("tokens"), "container")

    ranks = ranked(small.select("pack_name", "capacity", "doc_id", F.col("piece").cast("int"), "size"), order, "small")
    fitted = ranks.select("pack_name", "capacity", "doc_id", "piece", "size", "position").mapInPandas(_placer(small_plans, _offsets(small_sizes), "label"), schema)
    return large_out.unionByName(fitted.select("pack_name", "doc_id", "piece", F.col("size").alias("tokens"), F.col("label").alias("container")))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, for each capacity."""
    sizes = token_counts(table(spark, sf_dir, "documents").filter("doc_id is not null"), ("doc_id",))
    return packed(persisted(sizes, "sizes"), table(spark, sf_dir, "pack_targets"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of room used, for each capacity."""
    rows = p8_containers(spark, sf_dir)
    each = rows.groupBy("pack_name", "container").agg(F.sum("tokens").alias("tokens"))
    total = each.groupBy("pack_name").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    joined = total.join(F.broadcast(table(spark, sf_dir, "pack_targets")), "pack_name")
    return joined.select("pack_name", "capacity_tokens", "containers", "tokens", "fullest", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every packing, as one row per target.

    Every token is in exactly once, no container is above its capacity, only
    documents larger than a container are split, into as few parts as possible,
    and containers are numbered without gaps.
    """
    documents = table(spark, sf_dir, "documents").filter("doc_id is not null")
    sizes = persisted(token_counts(documents, ("doc_id",)), "sizes")
    targets = table(spark, sf_dir, "pack_targets")
    rows = persisted(packed(sizes, targets), "packed")
    whole = sizes.agg(F.sum("tokens").alias("all"))
    boxes = rows.groupBy("pack_name", "container").agg(F.sum("tokens").alias("t"))
    boxes = boxes.groupBy("pack_name").agg(F.sum("t").alias("tokens"), F.max("t").alias("fullest"), F.count("*").alias("n"), F.max("container").alias("last"))
    parts = rows.groupBy("pack_name", "doc_id").agg(F.count("*").alias("parts"), F.sum("tokens").alias("t")).join(targets, "pack_name")
    split = parts.groupBy("pack_name").agg(F.min(F.col("parts") == F.ceil(F.col("t") / F.col("capacity_tokens"))).alias("fewest"))
    joined = targets.join(boxes, "pack_name").join(split, "pack_name").crossJoin(F.broadcast(whole))  # one row
    return joined.select(
        "pack_name", (F.col("tokens") == F.col("all")).alias("all_tokens"), (F.col("fullest") <= F.col("capacity_tokens")).alias("within_capacity"),
        F.col("fewest").alias("split_least"), (F.col("last") + 1 == F.col("n")).alias("numbered"),
    )


QUERIES = {"p8_containers": p8_containers, "p8_fill": p8_fill, "p8_checks": p8_checks}
ORACLE: dict[str, str] = {
    "p8_checks": "select distinct pack_name, true as all_tokens, true as within_capacity, true as split_least, true as numbered from pack_targets"
}
