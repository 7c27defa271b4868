"""Problem 5: values that lost their end, by hashed logistic regression.

Positives are made by cutting all values that are intact: at a random
character, at the field limits the sources show, or with a mark of the cut put
behind. Cuts that happen to fall on the end of a sentence or line stay
negatives, like the uncut values. Features look at the closing characters and
punctuation, the last words, the unfinished sentence or line as a whole, whether
other values have it as a whole line or entry before their end, and the distance
to the limits of the source. Limits, words and
characters are counted over all values, and the model is fitted on all of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.llm import encoding, logistic
from loomspan.llm.encoding import Model, page_and_product_texts
from loomspan.session import persisted

CUTS = 3
SEED = 11
#: Words, lines and closing phrases count as known from so many on.
MIN_KNOWN = 3
BLOCK_VALUES = 1_000
#: Answers and lines kept for those that come again.
REMEMBERED = 100_000
LIMIT_SHARE, LIMIT_ROWS = 0.01, 20
THRESHOLD = 0.5

_SENTENCE_END = re.compile(r"(?<=[.!?。！？])\s+|\n+|(?<=[。！？])")
_MARK = re.compile(r"\s*(?:…|\.\.\.|\[\.\.\.\]|\[…\]|\(\.\.\.\)|-{2,})$")
_MARKS = ("", "", "", "…", "...", " …", " [...]")
#: What a mark ends in and is made of, what ends a sentence and what may stand behind that.
_MARK_LAST, _MARK_ALL, _END_ALL, _CLOSING = frozenset("….])-"), "….[]()-", frozenset(".!?。！？"), "\"'”’»)]"
_WORD_EDGE = ".,;:!?()\"'“”’«»"
_DIGITS = re.compile(r"\d+")
_ITEM = re.compile(r"\s*[|·/•»]\s*|\s{2,}|\s[–—-]\s|(?<=[.!?])\s")


def items(line: str) -> list[str]:
    """The parts of a line that may stand alone, as a menu's entries do, and the line itself."""
    low = _DIGITS.sub("0", line.lower()).strip()
    return [x for x in dict.fromkeys([low, *_ITEM.split(low)]) if x]


def _tail(text: str) -> tuple[str, bool]:
    """The last sentence or line with its end, and whether it opens its line."""
    body = text.rstrip()
    back = 80
    while True:
        start = max(0, len(body) - back)
        # Searched from the end, never from inside a run of spaces.
        while start > 0 and (body[start - 1].isspace() or body[start].isspace()):
            start -= 1
        last = None
        for m in _SENTENCE_END.finditer(body, start):
            if m.end() < len(body):
                last = m
        if last is not None or start == 0:
            break
        back *= 4
    return body[last.end() if last else 0 :], last is None or "\n" in last.group()


def _mark(text: str) -> re.Match | None:
    """The mark of a cut at the end of a text without trailing space."""
    # A mark and the space before it lie behind all else, so the search begins there.
    return _MARK.search(text, len(text.rstrip(_MARK_ALL).rstrip())) if text[-1:] in _MARK_LAST else None


def _terminal(text: str) -> bool:
    """Whether a text without trailing space ends as a sentence does."""
    return text.rstrip(_CLOSING)[-1:] in _END_ALL


class Words(dict):
    """Words without the marks beside them, kept for those that come again."""

    def __missing__(self, word: str) -> str:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = word.strip(_WORD_EDGE)
        return found


class Known:
    """A set of texts kept as sorted hashes, 8 bytes each."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.asked: dict[str, bool] = {}

    def __contains__(self, text: str) -> bool:
        found = self.asked.get(text)
        if found is None:
            if len(self.asked) > REMEMBERED:
                self.asked.clear()
            wanted = _hash(text)
            at = self.hashes.searchsorted(wanted)
            found = self.asked[text] = bool(at < len(self.hashes) and self.hashes[at] == wanted)
        return found


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def features(text: str, limits: tuple[int, ...], known: Known) -> list[int]:
    """Hashed features of how a value ends."""
    tail, opens = _tail(text)
    mark = _mark(tail)
    own = tail[: mark.start()] if mark else tail
    terminal = _terminal(own)
    lowered = _DIGITS.sub("0", own.lower())
    w = lowered.split()
    last = w[-1] if w else ""
    kind = ("mark" if mark else "") + ("end" if terminal else "open") + ("line" if opens else "run")
    out = ["bias", "kind:" + kind, "last:" + own[-1:], "last2:" + own[-2:], f"kind:{kind}:{own[-1:].isalnum()}"]
    out.append("space" if text[-1:].isspace() else "tight")
    if not terminal or mark:
        # Unseen names are capitalised or in the same sentence everywhere; a torn word is neither.
        seen = "seen" if last.strip(_WORD_EDGE) in known else "torn"
        out += [f"word:{seen}:{kind}", f"word:{seen}:{last[:1].isalpha()}:{own.split()[-1][:1].isupper() if w else False}"]
        out += ["w1:" + last, "w2:" + " ".join(w[-2:]), "all:" + lowered.strip("-•* "), f"n:{min(len(w), 9)}:{kind}"]
        out += ["start:" + " ".join(w[:2]), "first:" + (w[0] if w else ""), "shape:" + " ".join(["_"] + w[1:])]
        # What stands whole inside other values is whole here; a torn entry is not among them.
        if "\n" in text:
            parts = items(own.rsplit("\n", 1)[-1])
            tails = [" ".join(w[-k:]) for k in range(1, min(5, len(w)) + 1)]
            whole = "line" if parts and "\n" + parts[0] in known else "entry" if parts and "\n" + parts[-1] in known else "none"
            if whole == "none":
                whole = next((f"tail{min(k, 2)}" for k in range(len(tails), 0, -1) if "\n" + tails[k - 1] in known), "none")
            out += [f"whole:{whole}", f"whole:{whole}:{kind}:{seen}"]
        out += ["start3:" + " ".join(w[:3]), "end2of:" + (w[0] if w else "") + ":" + " ".join(w[-1:])]
        if len(w) > 2 and w[1] in ("–", "-", "—", ":", "|", "·"):
            out.append(f"titled:{kind}:{seen}")
    size = len(text)
    raw = len(text.encode()) if any(x < 0 for x in limits) else 0
    near = min((abs(size - x) for x in limits if x > 0), default=99)
    near_raw = min((-x - raw if -x >= raw else 99 for x in limits if x < 0), default=99)
    out.append(f"limit:{'at' if near <= 1 or 0 <= near_raw <= 2 else 'off'}:{kind}")
    return logistic.ids(out)


def source_limits(texts: DataFrame) -> dict[tuple[str, str], tuple[int, ...]]:
    """Lengths that stand out per source: positive in characters, negative in UTF-8 bytes.

    A length stands out if LIMIT_SHARE of the source's values, and at least
    LIMIT_ROWS, have it; there can be 2 / LIMIT_SHARE of them per source.
    """
    size = F.explode(F.array(F.length("text"), -F.octet_length("text"))).alias("size")
    counted = texts.filter("text <> ''").select("tbl", F.coalesce("source", F.lit("")).alias("source"), size).groupBy("tbl", "source", "size").agg(F.count("*").alias("n"))
    totals = counted.filter("size > 0").groupBy("tbl", "source").agg(F.sum("n").alias("total"))
    kept = counted.join(totals, ["tbl", "source"]).filter((F.col("n") >= LIMIT_ROWS) & (F.col("n") >= LIMIT_SHARE * F.col("total")) & (F.abs("size") >= 50))
    out: dict[tuple[str, str], list[int]] = {}
    for r in kept.select("tbl", "source", "size").collect():
        out.setdefault((r["tbl"], r["source"]), []).append(r["size"])
    return {k: tuple(v) for k, v in out.items()}


def _cut(text: str, rng: np.random.Generator, limits: tuple[int, ...]) -> tuple[str, int]:
    """A shortened value and whether it lost its end inside a word, sentence or line."""
    fitting = [x for x in limits if 20 < x < len(text)]
    at = fitting[int(rng.integers(len(fitting)))] if fitting and rng.random() < 0.4 else int(rng.integers(max(1, len(text) // 8), len(text)))
    head, mark = text[:at], _MARKS[int(rng.integers(len(_MARKS)))]
    following = text[at:]
    whole = head[-1:] == "\n" or following[:1] == "\n" and not head.endswith(" ") or _terminal(head.rstrip()) and (
        head[-1:].isspace() or following[:1].isspace() or head[-1:] in "。！？"
    )
    return (head.rstrip() if mark and mark[0] == " " else head) + ("" if whole else mark), int(not whole)


class Ends:
    """The fitted model: weights, known words, limits and characters."""

    def __init__(self, weights, known, limits, characters) -> None:
        self.weights, self.known, self.limits = weights, known, limits
        self.model = Model(characters)

    def score(self, tbl: str, source: str | None, text: str) -> float:
        limits = self.limits.get((tbl, source or ""), ())
        shown = text
        if self.model.suspicious(text):
            shown, _ = self.model.repair(text)
        z = float(self.weights[features(shown, limits, self.known)].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _count_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, n): hashes of whole words, of whole lines and entries, and of the last sentences that end in a mark."""
    entries: dict[str, list[str]] = {}
    bare = Words()
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"].to_pylist():
            # The last word of a value may be torn; all others are whole.
            counts.update(set(map(bare.__getitem__, _DIGITS.sub("0", text.lower()).split()[:-1])))
            lines = [line for line in text.rstrip().split("\n")[:-1] if len(line) < 200]
            whole: set[str] = set()
            for line in lines:
                found = entries.get(line)
                if found is None:
                    if len(entries) > REMEMBERED:
                        entries.clear()
                    found = entries[line] = ["\n" + x for x in items(line)]
                whole.update(found)
            counts.update(whole)
            if _mark(text.rstrip()):
                counts["\0" + _tail(text)[0]] += 1
        hashes = [_hash(x) for x in counts]
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["entry", "n"])


def known_entries(texts: DataFrame) -> Known:
    """What MIN_KNOWN values have; 8 bytes an entry come to the driver."""
    counted = texts.select("text").mapInArrow(_count_known, "entry long, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    hashes = counted.filter(F.col("n") >= MIN_KNOWN).select("entry").toArrow()["entry"]
    return Known(np.array(hashes.to_numpy(), np.int64))


def _examples(known: Known, limits: dict[tuple[str, str], tuple[int, ...]]):
    """Blocks of the values as they are, if intact, and of CUTS cuts of each."""
    every = tuple(sorted({x for found in limits.values() for x in found if x > 0}))

    def of(tbl: str, row_id: int, source: str | None, text: str) -> Iterator[tuple[list[int], int]]:
        own = limits.get((tbl, source or ""), ())
        # A value at a limit of its source, or with a mark, may be cut already.
        doubtful = len(text) in own or -len(text.encode()) in own or _mark(text.rstrip()) is not None
        if doubtful:
            # A marked ending that several values share is a closing phrase, not a cut.
            tail = _tail(text)[0]
            doubtful = not (len(tail.split()) >= 3 and "\0" + tail in known)
        if not doubtful:
            yield features(text, own, known), 0
        if len(text) > 30:
            # The cuts of a value depend on nothing but its id.
            rng = np.random.default_rng([SEED, _hash(f"{tbl}:{row_id}")])
            for _ in range(CUTS):
                cut, label = _cut(text, rng, every)
                yield features(cut, (len(cut),) if rng.random() < 0.5 else own, known), label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_VALUES):
                batch = whole.slice(at, BLOCK_VALUES)
                rows = zip(*(batch[c].to_pylist() for c in ("tbl", "row_id", "source", "text")))
                data = [x for row in rows for x in of(*row)]
                if data:
                    n = len(data)
                    yield logistic.block([d for d, _ in data], range(n), np.zeros(n), [y for _, y in data], np.zeros(n), np.ones(n))

    return run


def every_example(b: logistic.Block) -> tuple[np.ndarray, np.ndarray]:
    return b.label, np.ones(len(b.label), bool)


def train(texts: DataFrame) -> Ends:
    """Fit on all values; repeated rows count as often as they stand there.

    Values are judged by a model that has seen them, so features of less than
    MIN_KNOWN examples weigh nothing and the penalty holds the rare ones back.
    """
    values = texts.select("tbl", "row_id", "source", "text").filter(F.trim("text") != "")
    limits, known = source_limits(texts), known_entries(values)
    blocks = persisted(values.mapInArrow(_examples(known, limits), logistic.SCHEMA), "cut-examples")
    return Ends(logistic.fit(blocks, every_example, least=MIN_KNOWN), known, limits, encoding.train(values))


def _scorer(ends_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = Ends(*ends_of)
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("tbl", "row_id", "source", "text"))
            out = [(t, i, s, ends.score(t, s, x)) for t, i, s, x in zip(*columns) if x and x.strip()]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64())],
                    names=["tbl", "row_id", "source", "score"],
                )

    return run


def scored(texts: DataFrame) -> DataFrame:
    """(tbl, row_id, source, score): the probability that the value lost its end.

    Null, empty and blank values have no row. Repeated rows of one id give one
    row. Other columns than tbl, row_id, source and text are ignored; an empty
    table gives an empty result.
    """
    ends = train(texts)
    packed = (ends.weights, ends.known, ends.limits, ends.model.logs)
    out = "tbl string, row_id long, source string, score double"
    return texts.select("tbl", "row_id", "source", "text").mapInArrow(_scorer(packed), out).dropDuplicates(["tbl", "row_id"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that lost their end."""
    return scored(page_and_product_texts(spark, sf_dir)).filter(F.col("score") > THRESHOLD).select("tbl", "row_id")


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut values per fetcher and feed."""
    rows = scored(page_and_product_texts(spark, sf_dir))
    cut = F.count_if(F.col("score") > THRESHOLD)
    return rows.groupBy("tbl", "source").agg(F.count("*").alias("n"), cut.alias("n_cut"), (cut / F.count("*")).alias("share"))


QUERIES = {"p5_found": p5_found, "p5_sources": p5_sources}
ORACLE: dict[str, str] = {}
