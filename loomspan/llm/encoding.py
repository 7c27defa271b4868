"""Problem 3: text read in a wrong character encoding, found by a hidden Markov model.

The model labels the non-ASCII characters of a text, in order, with one clean
state and one state per encoding pair (written in, read in). The clean state
emits a character with its relative frequency in the whole corpus. A pair's
state emits the group of characters that one written character turns into, with
the frequency of the written character; groups that the pair cannot produce are
impossible. ASCII characters are alike in every state and only separate. Viterbi
gives the best labels, and each labelled span gets the inverse of its pair. Text
garbled twice is labelled twice; escaped text is unescaped first.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.session import table

#: (name, written in, read in); every single-byte reading of UTF-8 and two mixed-up code pages.
PAIRS = (
    ("utf8_as_cp1252", "utf-8", "cp1252"),
    ("utf8_as_macroman", "utf-8", "mac_roman"),
    ("utf8_as_cp1251", "utf-8", "cp1251"),
    ("utf8_as_cp437", "utf-8", "cp437"),
    ("utf8_as_cp850", "utf-8", "cp850"),
    ("utf8_as_latin2", "utf-8", "iso8859_2"),
    ("cp1252_as_cp1251", "cp1252", "cp1251"),
    ("cp1251_as_cp1252", "cp1251", "cp1252"),
)
#: A span of two code pages mixed up has no structure of its own; entering one is dearer.
SWITCH, SWITCH_PAGE = math.log(0.2), math.log(1e-5)
UNSEEN = math.log(1e-12)
MIXED_SCRIPT = math.log(1e-6)
LOST = "�"
#: From so many characters on, finding the stretches first is quicker.
LONG = 400


def _byte_of(encoding: str) -> dict[str, int]:
    """Character to byte; bytes the encoding leaves undefined stay control characters."""
    out = {}
    for byte in range(128, 256):
        try:
            out[bytes([byte]).decode(encoding)] = byte
        except UnicodeDecodeError:
            pass
        if encoding in ("cp1252", "cp1251"):
            out.setdefault(chr(byte), byte) if byte < 160 else None
    return out


_BYTES = {read: _byte_of(read) for _, _, read in PAIRS}
_CP1251 = {bytes([b]).decode("cp1251", "ignore"): b for b in range(192, 256)}
_CP1252 = {bytes([b]).decode("cp1252", "ignore"): b for b in range(192, 256)}
_RUN = re.compile(r"[^\x00-\x7f]+")
_ENTITY = re.compile(r"&#(?:\d{2,4}|x[0-9a-fA-F]{2,4});|&[A-Z][a-z]+;|&[a-z]+;")
_LETTER = re.compile("[A-Za-z]")


def _class(chars) -> str:
    return "[" + "".join(re.escape(c) for c in sorted(chars)) + "]"


def _suspicion() -> re.Pattern:
    """Matches wherever some state other than the clean one can emit anything."""
    parts = [LOST]
    for _, written, read in PAIRS:
        if written == "utf-8":
            lead = _class(c for c, b in _BYTES[read].items() if 0xC2 <= b <= 0xF4)
            tail = _class(c for c, b in _BYTES[read].items() if 0x80 <= b <= 0xBF)
            parts.append(lead + tail)
    cyrillic = "[Ѐ-џ]"
    parts += [f"[A-Za-z]{cyrillic}", f"{cyrillic}[A-Za-z]", "[À-ÿ]{3}"]
    return re.compile("|".join(parts))


_SUSPICIOUS = _suspicion()


_CANDIDATE = re.compile(f"[^\\x00-\\x7f]{{2,}}|{LOST}|[A-Za-z][Ѐ-џ]|[Ѐ-џ][A-Za-z]")
_LATIN = re.compile("[À-ÿ]{3}")
_checked: dict[str, bool] = {}


def stretches(text: str) -> list[str]:
    """Non-ASCII runs less than two ASCII characters apart, with those beside them: no match of _SUSPICIOUS reaches beyond."""
    at = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) > 127)
    breaks = np.flatnonzero(np.diff(at) > 2)
    starts, ends = at[np.append(0, breaks + 1)].tolist(), at[np.append(breaks, len(at) - 1)].tolist()
    return [text[max(0, s - 1) : e + 2] for s, e in zip(starts, ends)]


def _candidates(text: str) -> set[str]:
    """What _CANDIDATE finds; long texts are searched only where they are not ASCII."""
    if len(text) < LONG:
        return set(_CANDIDATE.findall(text))
    return {x for stretch in stretches(text) for x in _CANDIDATE.findall(stretch)}


def suspicious(text: str) -> bool:
    """False if the clean state is certain; true says only that the model must decide."""
    if not text.isascii():
        for part in _candidates(text):
            hit = _checked.get(part)
            if hit is None:
                if len(_checked) > 100_000:
                    _checked.clear()
                hit = _checked[part] = _SUSPICIOUS.search(part) is not None
            if hit:
                return True
    return "&" in text and _ENTITY.search(text) is not None


def _groups(state: int, run: str, at: int):
    """(length, character) of the written character that starts at run[at], if any."""
    _, written, read = PAIRS[state]
    table_ = _BYTES[read]
    if written != "utf-8":
        byte = table_.get(run[at])
        if byte is not None and byte >= 0x80:
            try:
                return 1, bytes([byte]).decode(written)
            except UnicodeDecodeError:
                return None
        return None
    lead = table_.get(run[at])
    if lead is None or not 0xC2 <= lead <= 0xF4:
        return None
    size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    if at + size > len(run):
        return None
    raw = bytearray([lead])
    for c in run[at + 1 : at + size]:
        byte = table_.get(c)
        if byte is None or not 0x80 <= byte <= 0xBF:
            return None
        raw.append(byte)
    try:
        return size, raw.decode("utf-8")
    except UnicodeDecodeError:
        return None


class Model:
    """Viterbi over the clean state (0) and the pairs (1..)."""

    def __init__(self, logs: dict[str, float]) -> None:
        self.logs = logs
        self.states = len(PAIRS) + 1
        self.gains: dict[str, bool] = {}

    def suspicious(self, text: str) -> bool:
        """False if no label but clean can win: no group is likelier than its characters."""
        if not text.isascii():
            for part in _candidates(text):
                hit = self.gains.get(part)
                if hit is None:
                    if len(self.gains) > 100_000:
                        self.gains.clear()
                    hit = self.gains[part] = self._gains(part)
                if hit:
                    return True
        return "&" in text and _ENTITY.search(text) is not None

    def _gains(self, part: str) -> bool:
        if not _SUSPICIOUS.search(part):
            return False
        if LOST in part or part[0] < "\x80" or part[-1] < "\x80" or _LATIN.search(part):
            return True
        for at, groups in enumerate(_options(part)):
            for s, size, char in groups:
                if PAIRS[s - 1][1] == "utf-8" and self.emit(char) > sum(self.emit(c) for c in part[at : at + size]):
                    return True
        return False

    def emit(self, char: str) -> float:
        return self.logs.get(char, UNSEEN)

    def labels(self, text: str, first: bool = True) -> list[tuple[int, int, int, str]]:
        """Spans (start, end, state, written character) outside the clean state.

        Later passes look for text garbled twice, which only readings of UTF-8
        can be.
        """
        marks: list[tuple[int, str]] = []  # position, character
        edge: list[bool] = []
        for m in _RUN.finditer(text):
            s, e = m.span()
            left = s > 0 and _LETTER.match(text[s - 1])
            right = e < len(text) and _LETTER.match(text[e])
            for i in range(s, e):
                marks.append((i, m.group()[i - s]))
                edge.append(bool(i == s and left or i == e - 1 and right))
        n = len(marks)
        best = [[-math.inf] * self.states for _ in range(n + 1)]
        back: list[list] = [[None] * self.states for _ in range(n + 1)]
        best[0][0] = 0.0
        enter = [SWITCH] + [SWITCH if written == "utf-8" else SWITCH_PAGE for _, written, _ in PAIRS]
        for s in range(1, self.states):
            best[0][s] = enter[s]
        bounds = []
        i = 0
        while i < n:
            j = i
            while j + 1 < n and marks[j + 1][0] == marks[j][0] + 1:
                j += 1
            bounds.append((i, j + 1))
            i = j + 1
        for begin, end in bounds:
            run = "".join(c for _, c in marks[begin:end])
            options = _options(run)
            for k in range(begin, end):
                row = best[k]
                top = max(range(self.states), key=row.__getitem__)
                switched = row[top] + SWITCH
                here = marks[k][1]
                clean = self.emit(here)
                if edge[k] and "Ѐ" <= here <= "џ":
                    clean += MIXED_SCRIPT
                stay = row[0] >= switched
                score = (row[0] if stay else switched) + clean
                if score > best[k + 1][0]:
                    best[k + 1][0] = score
                    back[k + 1][0] = (k, 0 if stay else top, None)
                for s, size, char in options[k - begin]:
                    if not first and PAIRS[s - 1][1] != "utf-8":
                        continue
                    moved = row[top] + enter[s]
                    stay = row[s] >= moved
                    score = (row[s] if stay else moved) + self.emit(char)
                    if size == 1 and edge[k] and "Ѐ" <= char <= "џ":
                        score += MIXED_SCRIPT
                    if score > best[k + size][s]:
                        best[k + size][s] = score
                        back[k + size][s] = (k, s if stay else top, char)
        spans = []
        k, s = n, max(range(self.states), key=best[n].__getitem__)
        while k > 0 and back[k][s] is not None:
            start, before, char = back[k][s]
            if s:
                spans.append((marks[start][0], marks[k - 1][0] + 1, s, char))
            k, s = start, before
        return spans[::-1]

    def repair(self, text: str) -> tuple[str, list[str]]:
        """The restored text and the names of what was found, in order."""
        found: list[str] = []
        if "&" in text and _ENTITY.search(text):
            plain = html.unescape(text)
            if self.suspicious(plain) and self.labels(plain):
                text, found = plain, ["escaped"]
        first = True
        # Ends of itself: every pass after the first turns groups of characters into one.
        while self.suspicious(text):
            spans = self.labels(text, first)
            first = False
            if not spans:
                break
            parts, at = [], 0
            for start, end, state, char in spans:
                parts += [text[at:start], char]
                at = end
                found.append(PAIRS[state - 1][0])
            text = "".join(parts) + text[at:]
        if LOST in text:
            found.append("lost")
        return text, list(dict.fromkeys(found))


_option_cache: dict[str, list] = {}


def _options(run: str) -> list[list[tuple[int, int, str]]]:
    """For each place of a run, the groups each pair's state can emit there."""
    found = _option_cache.get(run)
    if found is None:
        found = []
        for at in range(len(run)):
            here = []
            for s in range(len(PAIRS)):
                group = _groups(s, run, at)
                if group:
                    here.append((s + 1, *group))
            found.append(here)
        if len(_option_cache) > 50_000:
            _option_cache.clear()
        if len(run) <= 64:
            _option_cache[run] = found
    return found


def _count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        found: Counter = Counter()
        for text in batch["text"].to_pylist():
            if text and not text.isascii():
                found.update(stretches(text))
        for stretch, n in found.items():
            for run in _RUN.findall(_SUSPICIOUS.sub(" ", stretch)):
                for char in run:
                    counts[char] += n
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["char", "n"])


def train(texts: DataFrame) -> dict[str, float]:
    """Log frequencies of the non-ASCII characters of all texts.

    Characters in places where a pair's state could emit are left out, so the
    garbled part of the corpus hardly counts. At most as many rows as Unicode
    has characters come to the driver.
    """
    counted = texts.select("text").mapInArrow(_count_characters, "char string, n long")
    rows = counted.groupBy("char").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in rows) or 1
    return {r["char"]: math.log(r["n"] / total) for r in rows}


def page_and_product_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, row_id, source, text) of external_pages.text and source_products.description."""
    pages = table(spark, sf_dir, "external_pages").select(
        F.lit("external_pages").alias("tbl"), F.col("page_id").alias("row_id"), F.col("fetcher").alias("source"), "text"
    )
    products = table(spark, sf_dir, "source_products").select(
        F.lit("source_products").alias("tbl"), F.col("record_id").alias("row_id"), F.col("feed").alias("source"), F.col("description").alias("text")
    )
    return pages.unionByName(products).filter("text is not null and row_id is not null")


def _finder(logs: dict[str, float], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(logs)
        for batch in batches:
            out: list[tuple] = []
            for tbl, row_id, text in zip(*(batch[c].to_pylist() for c in ("tbl", "row_id", "text"))):
                if text and model.suspicious(text):
                    restored, found = model.repair(text)
                    if found:
                        out.append((tbl, row_id, ",".join(found), restored if with_text else ""))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3])], names=["tbl", "row_id", "found", "restored"]
                )

    return run


def garbled(texts: DataFrame, logs: dict[str, float], with_text: bool) -> DataFrame:
    """(tbl, row_id, found, restored): one row per garbled value.

    `found` names the encoding pairs, `escaped` and `lost`; replacement
    characters that remain in `restored` cannot be undone. Null and empty
    texts are none; repeated rows of one id count once; extra columns are
    ignored.
    """
    out = "tbl string, row_id long, found string, restored string"
    return texts.select("tbl", "row_id", "text").mapInArrow(_finder(logs, with_text), out).dropDuplicates(["tbl", "row_id"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with a garbled stretch."""
    texts = page_and_product_texts(spark, sf_dir)
    return garbled(texts, train(texts), False).select("tbl", "row_id")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with a garbled stretch and their restored text."""
    texts = page_and_product_texts(spark, sf_dir)
    return garbled(texts, train(texts), True)


QUERIES = {"p3_found": p3_found, "p3_restored": p3_restored}
ORACLE: dict[str, str] = {}
