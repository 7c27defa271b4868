"""Logistic regression on hashed indicator features, fitted over all rows of a table.

Examples are kept in blocks, one row per batch of the table that they come from:
units with their features, and examples that point to units, so that a line that
comes again is stored and scored once per block. A fit is L-BFGS on the whole
loss; each of its passes sums the gradient over all blocks. Where it begins, and
its first idea of the curvature, come from a fit of a few blocks in one task. The
number of tasks of a pass does not grow with the data, so what comes to the driver
is bounded by tasks times DIMENSIONS.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

DIMENSIONS = 1 << 18
#: Penalty on squared weights, on the mean loss: noise of weak labels does not lessen with more rows.
RIDGE = 2e-4
#: Passes of a fit, and the relative gain below which it ends.
PASSES, LEAST_GAIN = 20, 5e-4
MEMORY = 8
#: Files of blocks that give a fit over more of them its first guess, the features held for it at most, but for one block, and its passes.
BEGIN_FILES, BEGIN_FEATURES, BEGIN_PASSES = 2, 6_000_000, 30

#: low, high and sizes: the features of the units, their lower 16 bits apart, which keeps them small; the others: one entry per example.
_COLUMNS = {
    "low": np.uint16, "high": np.uint8, "sizes": np.int32, "unit": np.int32, "extra": np.int32, "label": np.int8, "flags": np.int8, "n": np.int64
}
COLUMNS = tuple(_COLUMNS)
SCHEMA = ", ".join(f"{c} binary" for c in _COLUMNS)


def ids(features: list[str], dimensions: int = DIMENSIONS) -> list[int]:
    return [xxhash.xxh3_64_intdigest(f) % dimensions for f in features]


def block(units: list, unit, extra, label, flags, n) -> pa.RecordBatch:
    """One row of SCHEMA."""
    return row(packed(np.fromiter((x for u in units for x in u), np.int64), [len(u) for u in units], unit, extra, label, flags, n))


def packed(flat: np.ndarray, sizes, unit, extra, label, flags, n) -> dict[str, bytes]:
    """The columns of SCHEMA; `flat` are the features of all units, one after the other."""
    parts = (flat & 0xFFFF, flat >> 16, sizes, unit, extra, label, flags, n)
    return {name: np.asarray(x).astype(t).tobytes() for x, (name, t) in zip(parts, _COLUMNS.items())}


def row(columns: dict[str, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in columns.values()], names=list(columns))


def rows(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Buffer]]:
    """The binary columns of each row, not copied."""
    binary = [c for c in batch.schema.names if pa.types.is_binary(batch.schema.field(c).type)]
    for i in range(batch.num_rows):
        yield {c: batch[c][i].as_buffer() for c in binary}


class Block:
    """The arrays of one row, and the examples of it that a fit takes."""

    def __init__(self, row: dict[str, bytes | pa.Buffer]) -> None:
        for name, kind in _COLUMNS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.flat = self.low.astype(np.int64)
        self.flat |= self.high.astype(np.int64) << 16
        self.some = np.flatnonzero(self.sizes)
        self.starts = (np.cumsum(self.sizes, dtype=np.int64) - self.sizes)[self.some]

    def score(self, weights: np.ndarray) -> np.ndarray:
        """The score of each unit."""
        out = np.zeros(len(self.sizes))
        if len(self.some):
            out[self.some] = np.add.reduceat(weights[self.flat], self.starts, dtype=float)
        return out

    def spread(self, pull: np.ndarray, dimensions: int) -> np.ndarray:
        """The sum over each feature's units."""
        return np.bincount(self.flat, np.repeat(pull, self.sizes), dimensions)


#: (labels of the examples, which are used) of a block.
Choice = Callable[[Block], tuple[np.ndarray, np.ndarray]]
#: The features that an example of this `extra` has besides those of its unit.
Extra = Callable[[int], list[int]]


class _Chosen:
    """What of a block a fit takes, ready for several passes."""

    def __init__(self, b: Block, choose: Choice, extra_of: Extra | None) -> None:
        label, used = choose(b)
        self.block, self.unit, self.n, self.y = b, b.unit[used], b.n[used].astype(float), label[used].astype(np.int64)
        self.extra = None
        if extra_of:
            codes, self.place = np.unique(b.extra[used], return_inverse=True)
            more = [extra_of(c) for c in codes.tolist()]
            self.extra, self.kinds = np.fromiter((x for m in more for x in m), np.int64), len(more)
            self.of_kind = np.repeat(np.arange(len(more)), [len(m) for m in more])

    def add(self, given, total: np.ndarray, totals: np.ndarray) -> None:
        """Add to `totals` (loss, positives, examples, features), and to `total` the gradient or without weights the counts of features."""
        b, n = self.block, self.n
        totals[1:] += n @ self.y, n.sum(), n @ b.sizes[self.unit]
        pull = n
        if given is not None:
            weights, of_class = given
            z = b.score(weights)[self.unit]
            if self.extra is not None:
                z += np.bincount(self.of_kind, weights[self.extra], self.kinds)[self.place]
            n = n * of_class[self.y]
            totals[0] += n @ np.logaddexp(0, np.where(self.y > 0, -z, z))
            pull = n * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - self.y)
        total += b.spread(np.bincount(self.unit, pull, len(b.sizes)), len(total))
        if self.extra is not None:
            total += np.bincount(self.extra, np.bincount(self.place, pull, self.kinds)[self.of_kind], len(total))


def _sums(weights_of, choose: Choice, extra_of: Extra | None, dimensions: int):
    """Per task: the sums of `_Chosen.add`, the second sparse."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = weights_of() if weights_of else None
        total, totals = np.zeros(dimensions), np.zeros(4)
        for batch in batches:
            for row in rows(batch):
                _Chosen(Block(row), choose, extra_of).add(given, total, totals)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in (totals, at.astype(np.int32), total[at])], names=["totals", "at", "sums"]
        )

    return run


def _pass(blocks: DataFrame, given, choose: Choice, extra_of: Extra | None, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(given) if given is not None else None
    run = _sums((lambda: sent.value) if sent else None, choose, extra_of, dimensions)
    total, totals = np.zeros(dimensions), np.zeros(4)
    for r in blocks.mapInArrow(run, "totals binary, at binary, sums binary").collect():
        totals += np.frombuffer(r["totals"])
        total[np.frombuffer(r["at"], np.int32)] += np.frombuffer(r["sums"])
    if sent:
        sent.destroy()
    return totals, total


def _loss(add, active: np.ndarray, scale: np.ndarray, of_class: np.ndarray, ridge: float, dimensions: int):
    """The mean loss with its penalty and the gradient, in scaled weights; `add` gives the sums over all examples."""

    def loss(u: np.ndarray) -> tuple[float, np.ndarray]:
        w = scale * u
        dense = np.zeros(dimensions, np.float32)
        dense[active] = w
        t, g = add((dense, of_class))
        return t[0] / t[2] + 0.5 * ridge * float(w @ w), scale * (g[active] / t[2] + ridge * w)

    return loss


def _begin(spread: Callable[[], tuple], choose: Choice, extra_of: Extra | None, ridge: float, dimensions: int):
    """One row: weights fitted on a task's first blocks, and the steps that led to them, all in one task's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active, scale, of_class, start, step = spread()
        held, size = [], 0
        for row in (row for batch in batches for row in rows(batch)):
            held.append(_Chosen(Block(row), choose, extra_of))
            size += len(held[-1].block.flat)
            if size > BEGIN_FEATURES:
                break

        def add(given) -> tuple[np.ndarray, np.ndarray]:
            total, totals = np.zeros(dimensions), np.zeros(4)
            for c in held:
                c.add(given, total, totals)
            return totals, total

        # What these blocks don't have stays as it is.
        own = np.flatnonzero(add(None)[1][active])
        if not len(own):
            return
        u, steps = minimum(_loss(add, active[own], scale[own], of_class, ridge, dimensions), start[own], step, most=BEGIN_PASSES)
        out = np.zeros((1 + 2 * len(steps), len(active)), np.float32)
        out[0] = start
        for at, x in enumerate((u, *(x for pair in steps for x in pair))):
            out[at, own] = x
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["begin"])

    return run


def _beginning(blocks: DataFrame, given: tuple, choose: Choice, extra_of: Extra | None, ridge: float, dimensions: int):
    """Where the fit over all blocks begins, and the steps that led there; `given` are what `_begin` takes.

    A first guess from blocks of all over the table spares passes over all of
    them; those passes still end where the whole loss gains no more. Small
    tables need none.
    """
    files = sorted(blocks.inputFiles())
    if len(files) < 2 * BEGIN_FILES:
        return given[3], []
    spark = blocks.sparkSession
    some = spark.read.schema(blocks.schema).parquet(*files[:: -(-len(files) // BEGIN_FILES)]).coalesce(1)
    sent = spark.sparkContext.broadcast(given)
    rows = some.mapInArrow(_begin(lambda: sent.value, choose, extra_of, ridge, dimensions), "begin binary").collect()
    sent.destroy()
    if not rows:
        return given[3], []
    u, *steps = np.frombuffer(rows[0]["begin"], np.float32).reshape(-1, len(given[0])).astype(float)
    return u, list(zip(steps[::2], steps[1::2]))


def fit(
    blocks: DataFrame, choose: Choice, extra_of: Extra | None = None, least: int = 1, balanced: bool = False,
    start: np.ndarray | None = None, dimensions: int = DIMENSIONS, ridge: float = RIDGE,
) -> np.ndarray:
    """Weights from all examples that `choose` takes; features of fewer than `least` examples weigh nothing.

    With `balanced` both classes weigh alike. `start` are weights to begin with.
    """
    blocks = blocks.select(*COLUMNS)
    tasks = blocks.coalesce(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    totals, counts = _pass(tasks, None, choose, extra_of, dimensions)
    _, positive, size, features = totals.tolist()
    active = np.flatnonzero(counts >= least)
    out = np.zeros(dimensions, np.float32)
    if not size or not len(active):
        return out
    share = min(max(positive / size, 1e-6), 1 - 1e-6)
    of_class = np.array([0.5 / (1 - share), 0.5 / share]) if balanced else np.ones(2)
    # In these units each weight has about the same curvature.
    scale = 1 / np.sqrt(0.25 * counts[active] / size + ridge)

    u = np.zeros(len(active)) if start is None else start[active] / scale
    step = 1 / max(1.0, features / size)
    u, steps = _beginning(blocks, (active, scale, of_class, u, step), choose, extra_of, ridge, dimensions)
    add = lambda given: _pass(tasks, given, choose, extra_of, dimensions)
    out[active] = scale * minimum(_loss(add, active, scale, of_class, ridge, dimensions), u, step, steps)[0]
    return out


Steps = list[tuple[np.ndarray, np.ndarray]]


def minimum(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, step: float, held: Steps = (), most: int = PASSES) -> tuple[np.ndarray, Steps]:
    """L-BFGS with halved steps, and its last steps; `step` is the first one along the gradient if no steps of a like loss are given."""
    value, g = loss(x)
    held = list(held)
    passes = 1
    while passes < most and np.abs(g).max() > 1e-9:
        q, alphas = g.copy(), []
        for s, y in reversed(held):
            alphas.append((s @ q) / (s @ y))
            q -= alphas[-1] * y
        q *= held[-1][0] @ held[-1][1] / (held[-1][1] @ held[-1][1]) if held else step
        for (s, y), a in zip(held, reversed(alphas)):
            q += s * (a - (y @ q) / (s @ y))
        down, size, found = float(g @ q), 1.0, None
        while passes < most and found is None:
            passes += 1
            new = loss(x - size * q)
            if new[0] <= value - 1e-4 * size * down:
                found = new
            else:
                size /= 2
        if found is None:
            break
        s, y = -size * q, found[1] - g
        if s @ y > 1e-12 * (y @ y):
            held = [*held, (s, y)][-MEMORY:]
        gain = value - found[0]
        x, value, g = x + s, *found
        if gain < LEAST_GAIN * abs(value):
            break
    return x, held
