"""Problem 1: the body of a page without its frame, by a minimum cut per page.

Each non-blank line is a node. A linear classifier gives the log-odds of frame
against body; they are the capacities to source and sink. Smoothness edges join
adjacent lines and, since a text only shows that much of the document tree,
siblings: lines of one block with the same indent that are not adjacent. An
edge inside a block binds more than one across a blank line, a change of indent,
or the border between short lines and prose. Maximum flow separates the lines.

The classifier looks at the words of a line, at its place relative to the page's
heading and last prose, at its neighbours, and at the share of its host's pages
that have the line. There are no lists of menus or phrases: its labels come from
shares and places alone. A first model sees only words, learned where place and
share leave no doubt; it decides the doubtful lines, and the final model is
fitted on both. Shares, character frequencies and all models are those of all
pages; words are hashed, so a model's size does not grow with the table. Lines
are read once, and the fits and the cuts work on blocks of hashed features.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomspan.llm import encoding, logistic
from loomspan.llm.encoding import Model
from loomspan.llm.messages import residue_lines
from loomspan.llm.words import words
from loomspan.session import drop_table, persisted, table

ROUNDS = 2
MIN_FEATURE = 3
MIN_HOST_PAGES = 5
MIN_SHARE = 0.1
SURE_SHARE, SURE_PAGES = 0.35, 20
#: From this probability on, the words alone make a doubtful line a frame's.
WORDS_SAY_FRAME = 0.45
LIMIT = 6.0
NEAR, FAR, CHANGE, SIBLING = 0.6, 0.3, 0.1, 0.2
HOT_SHARE = 0.01
CACHED_LINES = 200_000
#: Bytes of text whose lines are held at once, but for one page: what a task needs does not grow with its batches.
HELD_TEXT = 4 << 20

_DIGITS = re.compile(r"\d+")
_STEP = re.compile(r"\s*[>»/›]\s*")
_ENDS = frozenset(".!?…。！？")
_BULLET = re.compile(r"^[-•*–�] ?")


def host_of(url: str | None) -> str:
    return url.split("://", 1)[-1].split("/", 1)[0].lower() if url else ""


def host_column(url: Column) -> Column:
    """`host_of` as a column; '' for a null URL."""
    return F.coalesce(F.lower(F.substring_index(F.element_at(F.split(url, "://", 2), -1), "/", 1)), F.lit(""))


def breadcrumb(line: str, name: list[str]) -> bool:
    """A path of at least two steps that ends in the page's own name."""
    if not name or len(line) > 120 or not (">" in line or "»" in line or "/" in line or "›" in line):
        return False
    parts = [p for p in _STEP.split(line.strip()) if p]
    return len(parts) > 1 and words(parts[-1])[: len(name)] == name


def page_name(source_url: str | None) -> list[str]:
    return words(source_url.rstrip("/").rsplit("/", 1)[-1]) if source_url else []


def plain_lines(lines: list[str]) -> list[str]:
    """The lines in lower case, each number as one 0; all at once, which takes a fraction of the time."""
    return _DIGITS.sub("0", "\n".join(lines).lower()).split("\n") if lines else []


def line_keys(lines: list[str]) -> list[int]:
    """63 bits of each line without case, digits and spacing."""
    return [xxhash.xxh3_64_intdigest(" ".join(s.split())) >> 1 for s in plain_lines(lines)]


def ended(line: str) -> bool:
    """Ends as a sentence does: the mark of its end stands behind the last word."""
    for c in reversed(line):
        if c in _ENDS:
            return True
        if c.isalnum() or c == "_":
            return False
    return False


def prose(line: str) -> bool:
    """Running text: a long sentence or many words."""
    return len(line) > 60 and ended(line) or len(line) > 40 and (line.endswith("。") or len(line.split()) > 12)


class Hashes(dict):
    """Hashes of words, kept for those that come again; the lowest bit says that the word ends a sentence."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_LINES:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word) & ~1 | (word[-1] in ".!?")
        return found


#: Kinds of features.
_WORD, _FIRST, _FIRST_TWO, _LAST, _PAIR, _SHAPE, _SIZE, _PLAIN = range(8)
_END_MARK, _BULLET_MARK, _LONG_MARK = 1, 2, 3


def _feature(kind: int, a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    """Buckets of features made of two numbers."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= (np.atleast_1d(b).astype(np.uint64) + np.uint64(kind + 1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return (x * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)).astype(np.int64) % logistic.DIMENSIONS


def static_features(lines: list[str], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines one after the other, how many each line has, key of each, as by `line_keys`).

    Features of a line alone: its words, their order in short lines and at the
    start of sentences, its shape.
    """
    plain = plain_lines(lines)
    split = [s.split() for s in plain]
    count = np.fromiter(map(len, split), np.int64, len(split))
    h = np.fromiter(map(hashes.__getitem__, itertools.chain.from_iterable(split)), np.uint64, int(count.sum()))
    key = [xxhash.xxh3_64_intdigest(" ".join(w)) >> 1 for w in split]
    whole = [xxhash.xxh3_64_intdigest("l:" + s) % logistic.DIMENSIONS if 0 < len(w) <= 12 else 0 for s, w in zip(plain, split)]
    bullet = [0 < len(w) <= 12 and _BULLET.match(s) is not None for s, w in zip(plain, split)]
    end = [ended(s) for s in plain]
    first = [(line.split(None, 1) or [""])[0] for line in lines]
    shape = [x[:1].isupper() for x in first]
    mark = [0 if not x or x[-1].isalnum() else ord(x[-1]) for x in first]
    owner = np.repeat(np.arange(len(count)), count)
    start = np.cumsum(count) - count
    some, short = np.flatnonzero(count), np.flatnonzero((count > 0) & (count <= 12))
    head, n = start[some], count[some]
    second = np.where(n > 1, h[np.minimum(head + 1, len(h) - 1)], np.uint64(1)) if len(h) else np.empty(0, np.uint64)
    own = np.zeros(len(count), np.int64)
    parts = [
        (some, _feature(_FIRST, h[head])), (some, _feature(_FIRST_TWO, h[head], second)), (some, _feature(_LAST, h[head + n - 1])),
        (some, _feature(_PLAIN, own[some] + _END_MARK, np.array(end, np.int64)[some])),
        (some, _feature(_SHAPE, np.array(shape, np.int64)[some] + 2 * np.minimum(n, 13), np.array(mark, np.int64)[some])),
        (short, np.array(whole, np.int64)[short]), (short, _feature(_SIZE, count[short])),
    ]
    for which, code in ((np.flatnonzero(bullet), _BULLET_MARK), (np.flatnonzero(count > 12), _LONG_MARK)):
        parts.append((which, _feature(_PLAIN, own[which] + code)))
    long = count[owner] > 12
    parts.append((owner[~long], _feature(_WORD, h[~long])))
    pairs = (owner[1:] == owner[:-1]) & ~long[1:]
    parts.append((owner[1:][pairs], _feature(_PAIR, h[:-1][pairs], h[1:][pairs])))
    # Long lines: each word once, and the pairs that follow the end of a sentence.
    mine, words_ = owner[long], h[long]
    order = np.lexsort((words_, mine))
    mine, words_ = mine[order], words_[order]
    fresh = np.append(True, (mine[1:] != mine[:-1]) | (words_[1:] != words_[:-1]))[: len(mine)]
    parts.append((mine[fresh], _feature(_WORD, words_[fresh])))
    opens = (owner[2:] == owner[:-2]) & long[2:] & (h[:-2] & np.uint64(1) > 0)
    parts.append((owner[2:][opens], _feature(_PAIR, h[1:-1][opens], h[2:][opens])))
    of, flat = (np.concatenate(x) for x in zip(*parts))
    return flat[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(count)), np.array(key, np.int64)


#: Weights, by hashed feature, of the model of words alone and of the final one; empty before they are fitted.
Weights = tuple[np.ndarray, np.ndarray]


class Known:
    """The weights, and what lines are made of."""

    def __init__(self, weights: Weights, characters: dict[str, float]) -> None:
        self.weights, self.model, self.hashes = weights, Model(characters), Hashes()

    def of(self, raw: str) -> tuple[str, int, str, bool]:
        """(line without its encoding fault, indent, lower case, may be a breadcrumb)"""
        line = raw.strip()
        if self.model.suspicious(line):
            line = self.model.repair(line)[0]
        step = len(line) <= 120 and (">" in line or "»" in line or "/" in line or "›" in line)
        return line, len(raw) - len(raw.lstrip()), line.lower(), step


#: What is kept of pages besides the columns of `logistic`, one entry per page, line or unit: how it is stored and how it is used.
_KEPT = {
    "heading": (np.int32, np.int64), "host_pages": (np.int64, np.int64), "owner": (np.int32, np.int64), "number": (np.int32, np.int64),
    "of_unit": (np.int32, np.int64), "indent": (np.int32, np.int64), "blank": (np.bool_, np.bool_), "crumb": (np.bool_, np.bool_),
    "share": (np.float64, np.float64), "runs": (np.bool_, np.bool_), "says": (np.bool_, np.bool_),
}


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, each part with at most HELD_TEXT bytes of `text` or one row; nothing of an empty batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + HELD_TEXT, "right")))
        yield batch.slice(at, end - at)
        at = end


class Pages:
    """The non-blank lines of many pages as parallel arrays, equal lines being one unit."""

    def __init__(self, texts: list[str], urls: list[str | None], known: Known) -> None:
        lists = pc.split_pattern(pa.array(texts, pa.string()), "\n")
        coded = pc.list_flatten(lists).dictionary_encode()
        at_raw = coded.indices.to_numpy(zero_copy_only=False)
        starts = lists.offsets.to_numpy()
        page = np.repeat(np.arange(len(texts)), np.diff(starts))
        units: list[str] = []
        unit_of: dict[str, int] = {}
        infos: list[tuple | None] = []
        for raw in coded.dictionary.to_pylist():
            if not raw or raw.isspace():
                infos.append(None)
                continue
            line, space, low, step = known.of(raw)
            unit = unit_of.setdefault(line, len(units))
            if unit == len(units):
                units.append(line)
            infos.append((unit, space, low, step))
        at = np.flatnonzero(np.array([x is not None for x in infos], bool)[at_raw])
        self.owner, self.number = page[at], at - starts[page[at]]
        raws = at_raw[at]
        self.of_unit = np.array([x[0] if x else 0 for x in infos], np.int64)[raws]
        self.indent = np.array([x[1] if x else 0 for x in infos], np.int64)[raws]
        # A line stands behind a blank one if the line of the page that was kept before it is not the one above it.
        same = np.append(False, self.owner[1:] == self.owner[:-1])[: len(at)]
        self.blank = self.number > np.where(same, np.append(0, self.number[:-1])[: len(at)] + 1, 0)
        self.heading = np.full(len(texts), -1, np.int64)
        self.crumb = np.zeros(len(at), bool)
        ends, of_raw = np.searchsorted(self.owner, np.arange(len(texts) + 1)).tolist(), raws.tolist()
        for i, url in enumerate(urls):
            name = page_name(url)
            if not name:
                continue
            first, found = name[0], -1
            for k in range(ends[i], ends[i + 1]):
                unit, _, low, step = infos[of_raw[k]]
                if first in low:
                    line = units[unit]
                    if step and breadcrumb(line, name):
                        self.crumb[k] = True
                    elif found < 0 and words(line)[: len(name)] == name and not ended(line):
                        found = k
            self.heading[i] = found
        self.lines = [units[u] for u in self.of_unit.tolist()]
        self.flat, self.sizes, keys = static_features(units, known.hashes)
        self.key = keys[self.of_unit] if len(at) else np.empty(0, np.int64)
        short = [i for i, x in enumerate(units) if len(x) <= 260]
        self.says = np.zeros(len(units), bool)
        self.says[short] = residue_lines([units[i] for i in short])
        self.runs = np.array([prose(x) for x in units], bool)
        self._judge(known.weights)

    @classmethod
    def kept(cls, row: dict, weights: Weights) -> Pages:
        """The pages of a row that `packed` made, by other weights; without texts and keys."""
        self = cls.__new__(cls)
        for name, (stored, used) in _KEPT.items():
            setattr(self, name, np.frombuffer(row[name], stored).astype(used))
        block = logistic.Block(row)
        self.flat, self.sizes = block.flat, block.sizes
        self._judge(weights)
        self.see(self.share, self.host_pages)
        return self

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(stored).tobytes() for name, (stored, _) in _KEPT.items()}

    def _judge(self, weights: Weights) -> None:
        """What the words say: a message that stands for a body is prose; running text whose words are those of frames is not."""
        self.pages, self.size = len(self.heading), len(self.owner)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        by_words, final = (np.bincount(owner, w[self.flat], len(self.sizes)) if len(w) else np.zeros(len(self.sizes)) for w in weights)
        self.words = final[self.of_unit]
        self.message = self.says[self.of_unit]
        self.prose = self.message | (self.runs & (by_words <= 0))[self.of_unit]
        self.last_prose = np.full(self.pages, -1, np.int64)

    def see(self, share: np.ndarray, host_pages: np.ndarray) -> None:
        """Take what a well-known host has on many pages for no prose, and note where each page's prose ends."""
        self.share, self.host_pages = share, host_pages
        self.prose &= self.message | (host_pages[self.owner] < SURE_PAGES) | (share < MIN_SHARE)
        self.last_prose[self.owner[self.prose]] = np.flatnonzero(self.prose)

    def shares(self, host: np.ndarray, pages_of: np.ndarray, entries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Share of its host's pages that have each line, -1 for hosts with too few pages.

        `host` numbers the host of each page, `entries` are (host, line, share) triples.
        """
        if not self.size:
            return np.empty(0)
        own = host[self.owner]
        out = np.where(pages_of[self.owner] >= MIN_HOST_PAGES, 0.0, -1.0)
        if len(entries[0]):
            mix = lambda h, k: k.astype(np.uint64) ^ (h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            keys = mix(entries[0], entries[1])
            order = np.argsort(keys)
            keys, shares = keys[order], entries[2][order]
            wanted = mix(own, self.key)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = (keys[at] == wanted) & (out >= 0)
            out[hit] = shares[at[hit]]
        return out


#: Place features of a line are numbered by mixed radix over these sizes.
_RADIX = (4, 2, 4, 4, 12, 2, 2, 2)


def place_codes(p: Pages, share: np.ndarray) -> np.ndarray:
    """One number for all place features of each line."""
    n = p.size
    i = np.arange(n)
    head, last = p.heading[p.owner], p.last_prose[p.owner]
    where = np.where(head < 0, 3, np.where(i < head, 0, np.where(i == head, 1, 2)))
    tail = (i > last) & (last >= 0)
    bucket = np.where(share < 0, 0, 1 + np.minimum(share * 10, 10).astype(np.int64))
    kind = np.where(p.prose, 2, np.where(share >= SURE_SHARE, 1, 0))
    before, after = np.full(n, 3), np.full(n, 3)
    same = p.owner[1:] == p.owner[:-1]
    before[1:][same], after[:-1][same] = kind[:-1][same], kind[1:][same]
    code = np.zeros(n, np.int64)
    for size, part in zip(_RADIX, (where, tail, before, after, bucket, p.prose, p.crumb, p.blank)):
        code = code * size + part
    return code


def place_features(code: int) -> list[str]:
    parts = []
    for size in reversed(_RADIX):
        parts.append(code % size)
        code //= size
    blank, crumb, running, share, after, before, tail, where = parts
    return [
        " bias", f" place:{where}", f" place:{where}:{tail}:{running}", f" near:{before}:{after}:{tail}", f" before:{before}:{where}", f" after:{after}:{where}",
        f" share:{share}", f" share:{share}:{where}:{tail}", f" blank:{blank}:{tail}", *([" crumb"] if crumb else []), *([" prose"] if running else []),
    ]


@functools.cache
def place_ids(code: int) -> list[int]:
    return logistic.ids(place_features(code))


# -- the cut -------------------------------------------------------------------


def _augment(odds: dict[int, float], edges: dict[int, dict[int, float]]) -> dict[int, bool]:
    """Source side of a minimum cut, by shortest augmenting paths.

    odds > 0 is a capacity from the source, odds < 0 one to the sink; edges hold
    the same capacity both ways.
    """
    flow = {a: dict(out) for a, out in edges.items()}
    supply = {a: o for a, o in odds.items() if o > 0}
    demand = {a: -o for a, o in odds.items() if o < 0}

    def reach() -> tuple[dict[int, int | None], int | None]:
        came: dict[int, int | None] = {a: None for a, s in supply.items() if s > 1e-12}
        queue = deque(came)
        while queue:
            a = queue.popleft()
            if demand.get(a, 0.0) > 1e-12:
                return came, a
            for b, room in flow[a].items():
                if room > 1e-12 and b not in came:
                    came[b] = a
                    queue.append(b)
        return came, None

    while True:
        came, end = reach()
        if end is None:
            return {a: a in came for a in odds}
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        amount = min(supply[path[-1]], demand[end], *(flow[b][a] for a, b in zip(path, path[1:])))
        supply[path[-1]] -= amount
        demand[end] -= amount
        for a, b in zip(path, path[1:]):
            flow[b][a] -= amount
            flow[a][b] += amount


def min_cut(odds: np.ndarray, u: np.ndarray, v: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """The nodes on the source side of the minimum cut of a graph.

    A node whose terminal capacity is at least that of all its edges stays with
    its terminal whatever the others do, so its edges become terminal capacity
    of its neighbours. All such nodes of all pages are settled at once, until
    none is left; augmenting paths decide the rest.
    """
    odds = np.array(odds, float)
    side, free = odds > 0, np.ones(len(odds), bool)
    while len(u):
        load = np.bincount(u, capacity, len(odds)) + np.bincount(v, capacity, len(odds))
        settled = free & (np.abs(odds) >= load)
        if not settled.any():
            break
        side[settled] = odds[settled] > 0
        free &= ~settled
        for a, b in ((u, v), (v, u)):
            pull = settled[a] & free[b]
            odds += np.bincount(b[pull], np.where(side[a[pull]], capacity[pull], -capacity[pull]), len(odds))
        left = free[u] & free[v]
        u, v, capacity = u[left], v[left], capacity[left]
    if len(u):
        edges: dict[int, dict[int, float]] = defaultdict(dict)
        for a, b, c in zip(u.tolist(), v.tolist(), capacity.tolist()):
            edges[a][b] = edges[a].get(b, 0.0) + c
            edges[b][a] = edges[b].get(a, 0.0) + c
        seen: set[int] = set()
        for start in edges:
            if start in seen:
                continue
            part, queue = {start}, [start]
            while queue:
                for b in edges[queue.pop()]:
                    if b not in part:
                        part.add(b)
                        queue.append(b)
            seen |= part
            for node, of_source in _augment({a: odds[a] for a in part}, {a: edges[a] for a in part}).items():
                side[node] = of_source
                free[node] = False
    side[free] = odds[free] > 0
    return side


def page_edges(p: Pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, capacity) of the smoothness edges of all pages."""
    i = np.arange(max(p.size - 1, 0))
    u, v = i, i + 1
    same = p.owner[u] == p.owner[v] if p.size else np.empty(0, bool)
    u, v = u[same], v[same]
    head = p.heading[p.owner[u]]
    change = (p.prose[u] != p.prose[v]) | (u == head) | (v == head)
    apart = p.blank[v] | (p.indent[u] != p.indent[v])
    near = np.where(change, CHANGE, np.where(apart, FAR, NEAR))
    a = np.arange(max(p.size - 2, 0))
    b = a + 2
    if len(a):
        head = p.heading[p.owner[a]]
        block = (p.owner[a] == p.owner[b]) & ~p.blank[a + 1] & ~p.blank[b] & (p.indent[a] == p.indent[b]) & (p.prose[a] == p.prose[b])
        block &= (a != head) & (b != head) & (a + 1 != head)
        a, b = a[block], b[block]
    return np.concatenate([u, a]), np.concatenate([v, b]), np.concatenate([near, np.full(len(a), SIBLING)])


class Labeller:
    """Frame or body for each line of many pages."""

    def __init__(self, weights: Weights, characters: dict[str, float]) -> None:
        self.known = Known(weights, characters)
        self.places: dict[int, float] = {}

    def odds(self, p: Pages, share: np.ndarray) -> np.ndarray:
        codes, inverse = np.unique(place_codes(p, share), return_inverse=True)
        final = self.known.weights[1]
        for code in codes.tolist():
            if code not in self.places:
                self.places[code] = float(final[place_ids(code)].sum()) if len(final) else 0.0
        at = np.array([self.places[c] for c in codes.tolist()])
        return np.clip(p.words + at[inverse], -LIMIT, LIMIT) if p.size else np.empty(0)

    def frame(self, p: Pages, share: np.ndarray) -> np.ndarray:
        return min_cut(self.odds(p, share), *page_edges(p))


# -- counts over all pages -----------------------------------------------------


def _line_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: pages of each host that have a line; line 0 counts the pages."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = pc.split_pattern(batch["text"], "\n")
        coded = pc.list_flatten(lists).dictionary_encode()
        raw = coded.dictionary.to_pylist()
        some = [i for i, line in enumerate(raw) if line and not line.isspace()]
        keys = np.zeros(len(raw), np.int64)
        keys[some] = line_keys([raw[i] for i in some])
        line = keys[coded.indices.to_numpy(zero_copy_only=False)]
        page = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        hosts = batch["host"].dictionary_encode()
        host = hosts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A line counts once per page; 0 stands for the page, blank lines included.
        line = np.concatenate([line, np.zeros(batch.num_rows, np.int64)])
        page = np.concatenate([page, np.arange(batch.num_rows)])
        order = np.lexsort((line, page))
        line, page = line[order], page[order]
        fresh = np.append(True, (line[1:] != line[:-1]) | (page[1:] != page[:-1]))
        line, own = line[fresh], host[page[fresh]]
        order = np.lexsort((line, own))
        line, own = line[order], own[order]
        start = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (own[1:] != own[:-1])))
        n = np.diff(np.append(start, len(line)))
        yield pa.RecordBatch.from_arrays(
            [hosts.dictionary.take(pa.array(own[start])), pa.array(line[start], pa.int64()), pa.array(n, pa.int64())], names=["host", "line", "n"]
        )


def line_counts(pages: DataFrame) -> DataFrame:
    """(host, line, n): pages of each host that have each line; line 0 counts all its pages."""
    counted = pages.select(host_column(F.col("final_url")).alias("host"), "text").mapInArrow(_line_counts, "host string, line long, n long")
    return counted.groupBy("host", "line").agg(F.sum("n").alias("n"))


def host_profiles(counts: DataFrame) -> DataFrame:
    """(host, host_pages, lines, shares): the lines on at least MIN_SHARE of a host's pages; none for pages without a URL.

    At most (lines per page) / MIN_SHARE lines can reach that share, so a row
    stays small however many pages the host has.
    """
    totals = counts.filter(f"line = 0 and n >= {MIN_HOST_PAGES} and host <> ''").select("host", F.col("n").alias("host_pages"))
    share = F.col("n") / F.col("host_pages")
    kept = counts.filter("line <> 0 and n > 1").join(totals, "host").filter(share >= MIN_SHARE)
    entries = F.collect_list(F.struct("line", share.alias("share")))
    grouped = kept.groupBy("host").agg(F.first("host_pages").alias("host_pages"), entries.alias("entries"))
    return grouped.select("host", "host_pages", F.col("entries.line").alias("lines"), F.col("entries.share").alias("shares"))


def content_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("page_id", "source_url", "final_url", "text")
    return table(spark, sf_dir, "external_pages").select(*columns).filter("text is not null and text <> '' and page_id is not null")


def with_profiles(pages: DataFrame, profiles: DataFrame, hot: list[tuple[str, int]] = ()) -> DataFrame:
    """Each page with its host's profile, a hot host's pages over as many salts as `hot` says."""
    pages = pages.withColumn("host", host_column(F.col("final_url")))
    if not hot:
        return pages.join(profiles, "host", "left")
    spread = F.create_map(*[F.lit(x) for pair in hot for x in pair])
    salts = lambda: F.coalesce(F.element_at(spread, F.col("host")), F.lit(1))
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id"), salts()).cast("int"))
    copies = profiles.withColumn("salt", F.explode(F.sequence(F.lit(0), salts() - 1)))
    return salted.join(copies, ["host", "salt"], "left").drop("salt")


def hot_hosts(counts: DataFrame) -> list[tuple[str, int]]:
    """Hosts with at least HOT_SHARE of all pages (at most 1 / HOT_SHARE of them) and their salts."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = counts.filter("line = 0")
    total = pages.agg(F.sum("n")).first()[0] or 0
    rows = pages.filter(F.col("n") >= F.lit(max(1, total) * HOT_SHARE)).select("host", "n").collect()
    return sorted((r["host"], max(1, math.ceil(4 * parts * r["n"] / total))) for r in rows)


def shares_of(p: Pages, hosts: list, counts: list, lines: list, shares: list) -> np.ndarray:
    """`Pages.shares` and `Pages.see` from the columns of rows with profiles."""
    number: dict = {}
    of_page = np.array([number.setdefault(h, len(number)) for h in hosts], np.int64)
    entries: tuple[list, list, list] = ([], [], [])
    done: set[int] = set()
    for h, keys, values in zip(of_page.tolist(), lines, shares):
        if keys is not None and h not in done:
            done.add(h)
            entries[0].append(np.full(len(keys), h))
            entries[1].append(np.asarray(keys, np.int64))
            entries[2].append(np.asarray(values, float))
    joined = tuple(np.concatenate(e) for e in entries) if entries[0] else (np.empty(0),) * 3
    pages_of = np.array([c or 0 for c in counts], np.int64)
    share = p.shares(of_page, pages_of, joined)
    p.see(share, pages_of)
    return share


# -- training ------------------------------------------------------------------


def weak_labels(p: Pages, share: np.ndarray, host_pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labels, doubt): 1 frame, 0 body, -1 unknown; where `doubt` holds, the words may overrule a label.

    Before the heading all is frame, and so is what a well-known host has on
    many pages. Between heading and last prose all is body by place, but boxes
    stand there too.
    """
    i = np.arange(p.size)
    head, last = p.heading[p.owner], p.last_prose[p.owner]
    common = (host_pages[p.owner] >= SURE_PAGES) & (share >= SURE_SHARE)
    out = np.full(p.size, -1)
    inside = (head >= 0) & (i > head) & (i <= last)
    # On hosts seen rarely the last running text may be a notice of the footer.
    out[inside & ((i < last) | (host_pages[p.owner] >= SURE_PAGES))] = 0
    # After the last prose a line next to one of the host's own is the frame's.
    tail = (head >= 0) & (i > np.maximum(head, last)) & (last >= 0)
    beside = np.zeros(p.size, bool)
    same = p.owner[1:] == p.owner[:-1]
    beside[1:] |= common[:-1] & same
    beside[:-1] |= common[1:] & same
    out[tail & (beside | common)] = 1
    out[common & ~inside] = 1
    out[(head >= 0) & (i < head)] = 1
    out[p.crumb] = 1
    out[(head == i) | p.message] = 0
    return out, (out < 0) | (inside | tail & ~common) & ~p.crumb & ~p.message & (head != i)


#: Bits of an example's flags.
_DOUBT, _BELOW = 1, 2


_STORED = "page_ids array<long>, " + ", ".join(f"{c} binary" for c in _KEPT) + ", " + logistic.SCHEMA


def _examples(p: Pages, places: bool) -> dict[str, bytes]:
    """The lines with weak labels, equal ones of a block counted; with `places`, their place codes too."""
    label, doubt = weak_labels(p, p.share, p.host_pages)
    # Above the heading stand menus; what they say is a heading of the body below it.
    below = np.arange(p.size) > p.heading[p.owner]
    code = place_codes(p, p.share) if places else np.zeros(p.size, np.int64)
    what = ((p.of_unit * math.prod(_RADIX) + code) * 3 + label + 1) * 4 + np.where(doubt, _DOUBT, 0) + np.where(below, _BELOW, 0)
    what, n = np.unique(what, return_counts=True)
    what, flags = what // 4, what % 4
    what, label = what // 3, what % 3 - 1
    return logistic.packed(p.flat, p.sizes, what // math.prod(_RADIX), what % math.prod(_RADIX), label, flags, n)


def _stored(p: Pages, page_ids: pa.Array, places: bool) -> pa.RecordBatch:
    """One row of _STORED."""
    columns = logistic.row({**p.packed(), **_examples(p, places)})
    ids = pa.ListArray.from_arrays(pa.array([0, len(page_ids)], pa.int32()), page_ids)
    return pa.RecordBatch.from_arrays([ids, *columns.columns], names=["page_ids", *columns.schema.names])


def _read_pages(logs: dict[str, float]):
    """Rows of _STORED from pages with their hosts' profiles; no words are known yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known((np.empty(0, np.float32),) * 2, logs)
        for batch in itertools.chain.from_iterable(map(portions, batches)):
            p = Pages(batch["text"].to_pylist(), batch["source_url"].to_pylist(), known)
            shares_of(p, *profile_columns(batch))
            yield _stored(p, batch["page_id"], False)

    return run


def _judged_again(by_words: np.ndarray):
    """The same rows with the places and labels that a model of words gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(logistic.rows(batch)):
                yield _stored(Pages.kept(row, (by_words, np.empty(0, np.float32))), batch["page_ids"][i].values, True)

    return run


def sure(b: logistic.Block) -> tuple[np.ndarray, np.ndarray]:
    """The lines whose label is known."""
    return b.label, b.label >= 0


def sure_below(b: logistic.Block) -> tuple[np.ndarray, np.ndarray]:
    """Those of them that stand below the heading."""
    return b.label, (b.label >= 0) & (b.flags & _BELOW > 0)


def decided(doubtful: np.ndarray):
    """All lines, the doubtful ones with the label that their words give."""
    at = np.flatnonzero(doubtful)
    weights = doubtful[at]

    def choose(b: logistic.Block) -> tuple[np.ndarray, np.ndarray]:
        full = np.zeros(logistic.DIMENSIONS, np.float32)
        full[at] = weights
        says_frame = b.score(full)[b.unit] > math.log(WORDS_SAY_FRAME / (1 - WORDS_SAY_FRAME))
        return np.where(b.flags & _DOUBT > 0, says_frame, b.label), np.ones(len(b.unit), bool)

    return choose


def train(joined: DataFrame) -> tuple[DataFrame, Weights, dict[str, float]]:
    """Rows of _STORED, weights of the classifier and character frequencies, from all pages with their profiles.

    Texts are read once; later passes work on what was kept of them. Repeated
    rows of a page count as often as they stand there.
    """
    logs, spark = encoding.train(joined), joined.sparkSession
    by_words = np.empty(0, np.float32)
    for at in range(ROUNDS):
        # With a first model of words, notices at the end no longer count as prose.
        made = joined.mapInArrow(_read_pages(logs), _STORED) if at == 0 else blocks.mapInArrow(_judged_again(by_words), _STORED)
        before, blocks = (None if at == 0 else blocks), persisted(made, "frame-examples")
        if before is not None:
            drop_table(before)
        by_words = logistic.fit(blocks, sure, least=MIN_FEATURE, balanced=True, start=by_words if len(by_words) else None)
    doubtful = logistic.fit(blocks, sure_below, least=MIN_FEATURE, balanced=True, start=by_words)
    return blocks, (by_words, logistic.fit(blocks, decided(doubtful), place_ids, MIN_FEATURE, True, doubtful)), logs


# -- operators -----------------------------------------------------------------


def _line_lists(p: Pages, chosen: np.ndarray) -> pa.ListArray:
    """The numbers of the chosen lines of each page."""
    ends = np.searchsorted(p.owner[chosen], np.arange(p.pages + 1))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(p.number[chosen]))


def _frame_lines(weights: Weights, logs: dict[str, float]):
    """(page_id, lines) from rows of _STORED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(weights, logs)
        for batch in batches:
            for i, row in enumerate(logistic.rows(batch)):
                p = Pages.kept(row, weights)
                yield pa.RecordBatch.from_arrays([batch["page_ids"][i].values, _line_lists(p, labeller.frame(p, p.share))], names=["page_id", "lines"])

    return run


def _bodies(weights: Weights, logs: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(weights, logs)
        for batch in itertools.chain.from_iterable(map(portions, batches)):
            texts = batch["text"].to_pylist()
            p = Pages(texts, batch["source_url"].to_pylist(), labeller.known)
            lists = _line_lists(p, ~labeller.frame(p, shares_of(p, *profile_columns(batch))))
            bodies = []
            for text, numbers in zip(texts, lists.to_pylist()):
                own = text.split("\n")
                bodies.append("\n".join([own[n] for n in numbers]))
            yield pa.RecordBatch.from_arrays([batch["page_id"], pa.array(bodies, pa.string())], names=["page_id", "body"])

    return run


def profile_columns(batch: pa.RecordBatch) -> tuple[list, list, list, list]:
    """host, host_pages, lines and shares; the arrays of a host only at its first page."""
    hosts = batch["host"].to_pylist()
    seen: set = set()
    lines: list = [None] * len(hosts)
    shares: list = [None] * len(hosts)
    for i, h in enumerate(hosts):
        if h not in seen:
            seen.add(h)
            if batch["lines"][i].is_valid:
                lines[i], shares[i] = batch["lines"][i].values.to_numpy(), batch["shares"][i].values.to_numpy()
    return hosts, batch["host_pages"].to_pylist(), lines, shares


def fitted(pages: DataFrame) -> tuple[DataFrame, tuple[Weights, dict[str, float]], DataFrame, list[tuple[str, int]]]:
    """Rows of _STORED, the model, the hosts' profiles and the hot hosts of all pages."""
    counts = persisted(line_counts(pages), "line-counts")
    profiles = persisted(host_profiles(counts), "profiles")
    hot = hot_hosts(counts)
    drop_table(counts)
    blocks, *model = train(with_profiles(pages, profiles, hot))
    return blocks, tuple(model), profiles, hot


def prepared(pages: DataFrame, chosen: DataFrame | None = None) -> tuple[DataFrame, tuple[Weights, dict[str, float]]]:
    """Pages with their hosts' profiles, and the fitted model.

    Counts and training see all pages; with `chosen` only its pages come out,
    with its columns.
    """
    pages = pages.select("page_id", "source_url", "final_url", "text")
    blocks, model, profiles, hot = fitted(pages)
    drop_table(blocks)
    wanted = pages if chosen is None else pages.join(chosen, "page_id")
    more = [] if chosen is None else [c for c in chosen.columns if c != "page_id"]
    columns = ("page_id", "source_url", "text", "host", "host_pages", "lines", "shares", *more)
    return with_profiles(wanted, profiles, hot).select(*columns), model


def frame_lines(pages: DataFrame) -> DataFrame:
    """(page_id, lines): the numbers of the frame's lines, one row per page.

    Null and empty texts have no lines and no row. Repeated rows of a page give
    one row. A page without source_url or final_url is judged by its lines
    alone. Columns besides page_id, source_url, final_url and text are ignored.
    """
    blocks, model, _, _ = fitted(pages.select("page_id", "source_url", "final_url", "text"))
    return blocks.mapInArrow(_frame_lines(*model), "page_id long, lines array<long>").dropDuplicates(["page_id"])


def page_bodies(pages: DataFrame) -> DataFrame:
    """(page_id, body): the lines that are no frame, in order, blank ones left out."""
    joined, model = prepared(pages)
    return joined.mapInArrow(_bodies(*model), "page_id long, body string").dropDuplicates(["page_id"])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame's lines of all pages."""
    found = frame_lines(content_pages(spark, sf_dir))
    return found.select("page_id", F.explode("lines").alias("line_no"))


def p1_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of every page."""
    return page_bodies(content_pages(spark, sf_dir))


def p1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, lines): frame and body lines of each page together, which must be all its non-blank lines."""
    pages = content_pages(spark, sf_dir)
    frame = frame_lines(pages).select("page_id", F.size("lines").alias("f"))
    body = page_bodies(pages).select("page_id", F.when(F.col("body") == "", 0).otherwise(F.size(F.split("body", "\n"))).alias("b"))
    return frame.join(body, "page_id").select("page_id", (F.col("f") + F.col("b")).cast("long").alias("lines"))


QUERIES = {"p1_found": p1_found, "p1_body": p1_body, "p1_lines": p1_lines}
ORACLE: dict[str, str] = {
    "p1_lines": r"""select distinct page_id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\s\x0b\x1c-\x1f\x{85}\pZ]')))::bigint as lines
from external_pages where text is not null and text <> '' and page_id is not null"""
}
