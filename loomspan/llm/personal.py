"""Problem 10: personal information in free text, by information-theoretic sanitisation.

Patterns only propose spans. What a span discloses is estimated from the corpus:
some places hold a protected entity for certain (the lines under a closing
formula, words after a title, numbers after the name of a document), and the
pointwise mutual information of a term and such places, in bits, is the term's
disclosure. For names the terms are the words, as given or as family name, or
the ending of words unknown as a whole; for numbers the shape of their digits
and separators; for addresses the word that says what kind of street it is; for
mail addresses the way they are written, with or without the top domain. A span
whose terms disclose less than the threshold is left as it is, so numbers of
orders, batches and versions stay: no protected place ever holds their shapes.

All documents are read once; that scan counts the terms and writes the proposed
spans. Spans meet the disclosures in joins, which gather neither anywhere.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomspan.session import persisted, table

MIN_BITS = 2.0
JOINT_BITS = 6.0
ENDING = 4
#: Bits the shape or kind of a number, address or mail must disclose; below RARE sightings its class speaks for it.
FORM_BITS, RARE = 3.0, 8
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[PERSON]"}

# The forms of mail addresses, numbers and addresses.
_DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_LOCAL = r"[A-Za-z0-9À-ÿ](?:[\w.+-]*\w)?"
EMAIL = re.compile(rf"(?<![\w.+-]){_LOCAL} ?@ ?{_DOMAIN}(?![\w-])")
DISGUISED = re.compile(
    rf"(?<![\w.+-]){_LOCAL} ?[(\[{{](?:at|AT)[)\]}}] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[{{](?:dot|DOT)[)\]}}]) ?[A-Za-z0-9-]+)+"
    rf"|(?<![\w.+-]){_LOCAL} (?:at|AT) [A-Za-z0-9-]+(?: (?:dot|DOT) [A-Za-z0-9-]+)+"
)
PHONE = re.compile(
    r"(?<![\w+.-])(?:"
    r"(?:\+|00)\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?\d{1,4}\)?(?:[ ./-]?\d{2,8}){1,5}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([.-])\d{3}\1\d{4}|1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}"
    r"|0\d(?:([ .-])\d\d)(?:\2\d\d){3}|0\d{2,4}[/ -]\d{3,8}(?:[ -]\d{2,5}){0,2}|0\d{9,10}"
    r")(?![\w-]|\.\d|/\d)"
)
ID_NUMBER = re.compile(
    r"(?<![\w-])(?:\d{3}([- ])\d\d\1\d{4}|[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D]|\d{8}-?[A-Z]|[XYZ]\d{7}-?[A-Z]|[A-Z]\d{3}-\d{4}-\d{4})(?![\w-])"
)
_LABEL = (
    r"(?:passports?|reisepass|pasaporte|passeport|tax (?:id|number|no\.?)|steuer-?id|steuernummer|tin|nif|nino|ssn|dni|nie|identity (?:card|no\.?|number)"
    r"|id (?:card|no\.?|number)|personalausweis|national insurance(?: no\.?| number)?|licen[cs]e(?: no\.?| number)?|führerschein|permiso|permis)"
)
_LABELLED = re.compile(rf"{_LABEL}(?: (?:no\.?|number|nr\.?|num\.?))?[:# ]{{1,3}}(?:is )?\Z", re.IGNORECASE)
#: Without any of these in its lower case a text holds no label.
_LABEL_PARTS = ("pass", "pasaporte", "steuer", "tax ", "tin", " nif", "nino", "ssn", "dni", " nie", "identity", "id card", "id no", "id number", "ausweis", "insurance", "licen", "führerschein", "permis")
_ID_VALUE = re.compile(r"(?<![A-Z0-9-])(?=(?:[A-Z]{1,3} ?)?\d)(?=[A-Z0-9 -]*\d{2})(?:[A-Z]{1,3} ?)?\d[A-Z0-9]*(?:[ -][A-Z0-9]*\d[A-Z0-9]*){0,4}(?: [A-Z])?(?![\w-])")
_CAP = r"[A-ZÀ-Þ][\wÀ-ÿ’'-]*"
_PART = r"[A-ZÀ-Þ][^\W\d_]*(?:[’'-][^\W\d_]+)*"
_TOWN = rf"{_PART}(?: (?:(?:sur|de|la|am|an|der) )*{_PART}(?![\w-]))*"
_BREAK = r"(?:,? ?\n|, ?| )"
_STREET_EN = (
    rf"\d{{1,5}}[a-z]? (?:{_CAP} ){{1,3}}(?P<en>Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Drive|Dr|Boulevard|Blvd|Court|Ct|Way|Place|Square|Terrace|Close)(?!\w)\.?"
    r"(?:,? ?(?:Suite|Apt\.?|Unit|Floor|Flat) ?#?\w+|,? ?#\w+)?"
)
_ZIP = r"(?:,? (?:[A-Z]{2} )?\d{5}(?:-\d{4})?|,? [A-Z]{1,2}\d[\dA-Z]? ?\d[A-Z]{2})(?!\w)"
_STREET_FR = rf"\d{{1,4}}(?: ?bis)?,? (?P<fr>rue|avenue|impasse|boulevard|place|allée|chemin|quai)(?: (?:de la|de l[’']|des|du|de|d[’']))? ?{_CAP}(?: {_CAP})*"
_STREET_DE = (
    rf"(?:(?:{_CAP}[ -])?{_CAP}(?P<de>straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm)|(?P<de2>Alte[rn]?|Am|An der|Im|Zum|Zur|Neue[rn]?|Obere|Untere) {_CAP}) \d{{1,4}} ?[a-z]?(?!\w)"
)
_STREET_ES = rf"(?P<es>Calle|Avenida|Avda\.|Plaza|Paseo|Camino|C/)(?: (?:de la|de los|de las|del|de))? ?{_CAP}(?: {_CAP})*,? \d{{1,4}}(?!\w)"
_PLACE = rf"{_BREAK}\d{{4,5}} {_TOWN}"
ADDRESS = re.compile(
    rf"(?<!\w)(?:{_STREET_EN}(?:{_BREAK}{_TOWN}(?:{_ZIP})?|{_ZIP})?"
    rf"|{_STREET_FR}(?:{_PLACE})?|{_STREET_DE}(?:{_PLACE})?|{_STREET_ES}(?:{_PLACE})?"
    rf"|P\.? ?O\.? ?(?P<po>Box) \d+(?:{_BREAK}{_TOWN}(?:{_ZIP})?)?|(?P<po2>Postfach|Apartado|BP) \d+(?:{_PLACE})?)"
)

# Formulas and titles whose neighbours are persons.
_CLOSING = r"(?:(?:kind |best |warm )?regards|best|cheers|thanks|sincerely|yours|mit freundlichen grüßen|viele grüße|cordialement|bien à vous|saludos|un saludo|atentamente)"
_TITLE = r"(?:Dr|Mr|Mrs|Ms|Prof|Herr|Frau|Mme|Mlle|Sra?|Dra?|Don|Doña)\.?"
_NAME = r"[^\W\d_]+(?:[’'-][^\W\d_]+)*"
_TITLE_SLOT = re.compile(rf"(?<!\w){_TITLE} ({_NAME})(?: [A-ZÀ-Þ]\.)? ({_NAME})")
_SIGNED = re.compile(rf"({_NAME})(,?)(?: [A-ZÀ-Þ]\.)? ({_NAME})[ \t]*(?:\n|$)", re.IGNORECASE)
_TITLES = ("Dr", "Mr", "Ms", "Prof", "Herr", "Frau", "Mme", "Mlle", "Sr", "Don", "Doña")
_TOKEN = re.compile(_NAME)
_UPPER = r"[A-ZÀ-Þ][^\W\d_]*(?:[’'-][^\W\d_]+)*"
_LOWER = r"[a-zß-ÿ][^\W\d_]+(?:[’'-][^\W\d_]+)*"
#: Given Family, Given I. Family, Family Given or Family, Given, in capitals or capitalised; I. Family.
_UPPER_SPAN = re.compile(rf"(?<![\w@#’'.+-])(?:([A-ZÀ-Þ])\. ?(?:[A-ZÀ-Þ]\. ?)?({_UPPER})|({_UPPER})(,? )(?:[A-ZÀ-Þ]\. ?)?({_UPPER}))(?![\w@+])")
#: In lower case only where a name may begin: after a stop, or a word that persons follow.
_LOWER_SPAN = re.compile(
    rf"(?:^|(?<=[.!?)(\n-])\s*|(?<=\s)(?:by|with|is|to|an|à|a|ist|par|con|por|contact:)\s)(({_LOWER})(,? )(?:[A-Za-z]\. ?)?({_LOWER}))(?![\w@+])"
)
#: Where an address may begin or a number is long enough to be one of a person; found before the full patterns are tried.
_NUMBERED = re.compile(r"\d[a-z]?(?: ?bis)?,? (?:[A-ZÀ-Þ]|rue |avenue |impasse |boulevard |place |allée |chemin |quai )|[Bb]ox \d")
_STREETS = (
    "straße ", "strasse ", "str. ", "weg ", "gasse ", "platz ", "allee ", "ring ", "ufer ", "damm ", "Alte", "Am ", "An der ", "Im ", "Zum ", "Zur ", "Neue", "Obere ", "Untere ", "Calle ",
    "Avenida ", "Avda", "Plaza ", "Paseo ", "Camino ", "C/", "Postfach", "Apartado", "BP ",
)
_LONG = re.compile(r"\d(?:[ ./()-]{0,3}\d){5}")
_BLOCK = re.compile(rf"(?:^|\n){_CLOSING},?\n", re.IGNORECASE)
BLOCK_LINES = 6
_DIGIT = re.compile(r"\d")


def shape(text: str) -> str:
    """Digits to 9 and letters to A or a; a leading zero stays, since it says much."""
    out = re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", re.sub(r"[a-z]", "a", text)))
    return ("0" + out[1:]) if text[:1] == "0" else out


def shape_class(text: str) -> str:
    """How a number begins and what separates its groups."""
    first = text[:2] if text[:2] == "00" else text[:1]
    first = first if first in ("00", "0", "+", "(") else "A" if first.isalpha() else "9"
    return first + "".join(sorted(set(re.sub(r"\w", "", text[1:]))))


def closings(text: str) -> list[int]:
    """Where the lines under closing formulas begin."""
    return [m.end() for m in _BLOCK.finditer(text)] if "\n" in text else []


def proposals(text: str, lowered: str | None = None, signed: list[int] | None = None) -> list[tuple[int, int, str, str, str, bool]]:
    """(start, end, kind, term, class of the term, in a protected place) of everything but persons.

    No two overlap; mail addresses come first, then addresses, identity numbers
    and phone numbers. `lowered` and `signed` are the text in lower case and its
    closings, if known.
    """
    lowered = text.lower() if lowered is None else lowered
    signed = closings(text) if signed is None else signed
    out: list[tuple[int, int, str, str, str, bool]] = []
    digits = _DIGIT.search(text) is not None
    mails = []
    if "@" in text:
        mails += EMAIL.finditer(text)
    if "dot" in lowered or "at)" in lowered or "at]" in lowered or "at}" in lowered:
        mails += DISGUISED.finditer(text)
    if not digits and not mails:
        return out
    blocks = []
    for begin in signed:
        end = text.find("\n\n", begin)
        lines = text[begin : end if end >= 0 else len(text)].split("\n")[:BLOCK_LINES]
        blocks.append((begin, begin + sum(map(len, lines)) + len(lines)))

    def take(m, group: int, kind: str, term: str, of: str, certain: bool = False) -> None:
        s, e = m.span(group)
        if all(e <= x[0] or s >= x[1] for x in out):
            out.append((s, e, kind, term, of, certain or any(a <= s < b for a, b in blocks)))

    for m in mails:
        form = re.sub(r"[^\W_]+", "a", re.sub(r"[\w.+-]+", "a", m.group(), count=1))
        form = form if "@" in form else "disguised" + ("(" if not m.group().replace(" ", "").isalnum() else "")
        take(m, 0, "email", form + re.split(r"\W+", m.group())[-1].lower(), form[:3])
    if digits:
        for m in ADDRESS.finditer(text) if _NUMBERED.search(text) or any(street in text for street in _STREETS) else ():
            form = m.lastgroup or "po"
            take(m, 0, "address", f"{form}:{(m[form] or '').lower()}", form[:2])
        for m in _ID_VALUE.finditer(text) if any(part in lowered for part in _LABEL_PARTS) else ():
            if _LABELLED.search(text, max(0, m.start() - 48), m.start()):
                take(m, 0, "id_number", shape(m.group()), shape_class(m.group()), True)
        long = _LONG.search(text) is not None
        for m in ID_NUMBER.finditer(text) if long else ():
            take(m, 0, "id_number", shape(m.group()), shape_class(m.group()))
        for m in PHONE.finditer(text) if long else ():
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                take(m, 0, "phone", shape(m.group()), shape_class(m.group()))
    return sorted(out)


def slots(text: str, signed: list[int]) -> Iterator[tuple[str, str]]:
    """(role, term) of the words in protected places."""
    for m in _TITLE_SLOT.finditer(text) if any(t in text for t in _TITLES) else ():
        if m[1][0].isupper() and m[2][0].isupper():
            yield "given", m[1].lower()
            yield from (("family", part.lower()) for part in m[2].split("-"))
    for begin in signed:
        m = _SIGNED.match(text, begin)
        if m:
            given, family = (m[3], m[1]) if m[2] else (m[1], m[3])
            yield "given", given.lower()
            yield from (("family", part.lower()) for part in family.split("-"))


def name_spans(text: str, taken: list[tuple]) -> Iterator[tuple[int, int, str | None, str, str]]:
    """(start, end, first word, second word, form) of spans that might be names and touch no other proposal.

    `form` is `pair` for two words in either order, `comma` for a family name
    before a given name, `initial` for a family name alone.
    """
    edges = iter(taken)
    block = next(edges, None)
    at = 0
    while m := _UPPER_SPAN.search(text, at):
        s, e = m.span()
        while block and block[1] <= s:
            block = next(edges, None)
        # The next candidate may begin with this one's second word.
        at = m.start(2) if m[2] else m.start(5)
        if block and block[0] < e:
            continue
        if m[2]:
            yield s, e, None, m[2].lower(), "initial"
        else:
            yield s, e, m[3].lower(), m[5].lower(), "comma" if "," in m[4] else "pair"
    for m in _LOWER_SPAN.finditer(text):
        s, e = m.span(1)
        if all(e <= x[0] or s >= x[1] for x in taken):
            yield s, e, m[2].lower(), m[4].lower(), "comma" if "," in m[3] else "pair"


_COLUMNS = (
    ("what", pa.string()), ("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("found_text", pa.string()), ("one", pa.string()),
    ("two", pa.string()), ("form", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("in_given", pa.int64()), ("in_family", pa.int64()),
)
_SCANNED = ", ".join(f"{c} {'long' if t == pa.int64() else 'string'}" for c, t in _COLUMNS)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of three sorts: `term` with counts, `form` and `name` with a proposed span."""
    for batch in batches:
        seen: Counter = Counter()
        held: dict[str, Counter] = {"given": Counter(), "family": Counter()}
        rows: list[tuple] = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            if not text:
                continue
            lowered, signed = text.lower(), closings(text)
            seen.update(lowered.split())
            for role, term in slots(text, signed):
                held[role][term] += 1
            taken = proposals(text, lowered, signed)
            for s, e, kind, term, of, certain in taken:
                rows.append(("form", doc_id, s, e, kind, text[s:e], None, None, of, term, int(certain), None, None))
            for s, e, one, two, form in name_spans(text, taken):
                rows.append(("name", doc_id, s, e, "person", text[s:e], one, two, form, None, None, None, None))
        parts: Counter = Counter()
        # Words are taken out of their signs once per distinct form.
        for form, n in seen.items():
            for word in _TOKEN.findall(form):
                for part in word.split("-"):
                    parts[part] += n
        rows += [("term", None, None, None, None, None, None, None, None, t, n, held["given"][t], held["family"][t]) for t, n in parts.items()]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _COLUMNS)], names=[c for c, _ in _COLUMNS])


def scan(documents: DataFrame) -> DataFrame:
    """The one reading of all documents, written by sort of row."""
    return persisted(documents.filter("text is not null").select("doc_id", "text").mapInArrow(_scan, _SCANNED), "personal", ["what"])


def disclosures(scanned: DataFrame) -> DataFrame:
    """(term, given_bits, family_bits): pointwise mutual information of words and protected places, null below MIN_BITS.

    A term of the form `~xxxx` stands for all words with that ending.
    """
    counts = ("n", "in_given", "in_family")
    terms = persisted(scanned.filter("what = 'term'").groupBy("term").agg(*[F.sum(c).alias(c) for c in counts]), "terms")
    endings = terms.filter(F.length("term") > ENDING + 1).groupBy(F.concat(F.lit("~"), F.substring("term", -ENDING, ENDING)).alias("term"))
    both = terms.unionByName(endings.agg(*[F.sum(c).alias(c) for c in counts])).filter("in_given > 0 or in_family > 0")
    totals = terms.agg(*[F.sum(c).alias(c) for c in counts]).first()
    out = both.select("term", "n", "in_given", "in_family")
    for role in ("given", "family"):
        base = (totals[f"in_{role}"] or 0) / max(totals["n"] or 0, 1) or 1.0
        bits = F.log2(F.col(f"in_{role}") / F.col("n") / F.lit(base))
        out = out.withColumn(f"{role}_bits", F.when((F.col(f"in_{role}") > 0) & (bits >= MIN_BITS), bits))
    return persisted(out.select("term", "given_bits", "family_bits").filter("given_bits is not null or family_bits is not null"), "disclosures")


def disclosing_forms(scanned: DataFrame) -> DataFrame:
    """Proposed spans of numbers, addresses and mails whose terms disclose enough.

    A term seen fewer than RARE times is judged by all terms of its class.
    """
    forms = scanned.filter("what = 'form'").select("doc_id", "start", "stop", "kind", "found_text", "form", "term", F.col("n").alias("certain"))
    tokens = F.lit(float(scanned.filter("what = 'term'").agg(F.sum("n")).first()[0] or 1))
    seen = persisted(forms.groupBy("kind", "form", "term").agg(F.count("*").alias("n"), F.sum("certain").alias("k")), "forms")
    of_class = seen.groupBy("kind", "form").agg(F.sum("n").alias("cn"), F.sum("k").alias("ck"))
    of_kind = seen.groupBy("kind").agg(F.sum("k").alias("all"))
    bits = lambda k, n: F.when(F.col(k) > 0, F.log2(F.col(k) / F.col(n) / (F.col("all") / tokens))).otherwise(F.lit(0.0))
    judged = seen.join(of_class, ["kind", "form"]).join(of_kind, "kind")
    judged = judged.withColumn("bits", F.when((F.col("n") < RARE) & (F.col("k") == 0), bits("ck", "cn")).otherwise(bits("k", "n")))
    fine = judged.filter(F.col("bits") >= FORM_BITS).select("kind", "form", "term")
    return forms.join(fine, ["kind", "form", "term"]).select("doc_id", "start", "stop", "kind", "found_text")


def word_bits(names: DataFrame, scores: DataFrame) -> DataFrame:
    """(word, given_bits, family_bits) of words that disclose in a role: the least of the hyphenated parts, by word or else by ending."""
    words_ = names.select(F.explode(F.array("one", "two")).alias("word")).filter("word is not null").distinct()
    ending = F.when(F.length("term") > ENDING + 1, F.concat(F.lit("~"), F.substring("term", -ENDING, ENDING)))
    parts = words_.select("word", F.explode(F.split("word", "-")).alias("term")).withColumn("ending", ending)
    ends = scores.select(F.col("term").alias("ending"), F.col("given_bits").alias("given_end"), F.col("family_bits").alias("family_end"))
    joined = parts.join(scores, "term", "left").join(ends, "ending", "left")
    least = [F.min(F.coalesce(f"{role}_bits", f"{role}_end", F.lit(0.0))).alias(f"{role}_bits") for role in ("given", "family")]
    return joined.groupBy("word").agg(*least).filter((F.col("given_bits") >= MIN_BITS) | (F.col("family_bits") >= MIN_BITS))


def persons(scanned: DataFrame) -> DataFrame:
    """Spans whose words disclose a person together, and each one some."""
    names = scanned.filter("what = 'name'").select("doc_id", "start", "stop", "found_text", "one", "two", "form")
    bits = persisted(word_bits(names, disclosures(scanned)), "words")
    of = lambda c: bits.select(F.col("word").alias(c), F.col("given_bits").alias(f"{c}_given"), F.col("family_bits").alias(f"{c}_family"))
    # The second word discloses something in every form; few of the words in question do.
    scored = names.join(of("two"), "two").join(of("one"), "one", "left")

    def together(given: str, family: str):
        fits = (F.col(given) >= MIN_BITS) & (F.col(family) >= MIN_BITS)
        return F.when(fits, F.col(given) + F.col(family)).otherwise(F.lit(0.0))

    turned = together("two_given", "one_family")
    joint = F.when(F.col("form") == "initial", F.col("two_family")).when(F.col("form") == "comma", turned).otherwise(F.greatest(turned, together("one_given", "two_family")))
    kept = scored.withColumn("bits", joint).filter(F.col("bits") >= JOINT_BITS)
    # Of overlapping candidates the one that discloses most, then the longer; a person has few.
    best = F.max(F.struct(F.col("bits").alias("b"), (F.col("stop") - F.col("start")).alias("n"), "start", "stop", "found_text"))
    first = kept.groupBy("doc_id", "start").agg(best.alias("m")).select("doc_id", "m.*")
    last = first.groupBy("doc_id", "stop").agg(F.max(F.struct("b", "n", "start", "found_text")).alias("m")).select("doc_id", "stop", "m.*")
    return last.select("doc_id", "start", "stop", F.lit("person").alias("kind"), "found_text")


def personal_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, start, stop, kind, found_text) of all findings, without overlaps.

    Null and empty texts have none; repeated documents give repeated spans; the
    text is not changed. Columns besides doc_id and text are ignored. Positions
    count code points.
    """
    scanned = scan(documents)
    return disclosing_forms(scanned).unionByName(persons(scanned))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct findings of each document."""
    return personal_spans(table(spark, sf_dir, "documents")).select("doc_id", "kind", "found_text").distinct()


def replaced(text: str | None, spans: list[dict] | None) -> tuple[str | None, int]:
    """The text with placeholders, and by how many characters they made it longer."""
    if text is None or not spans:
        return text, 0
    parts, at, more = [], 0, 0
    for span in sorted(spans, key=lambda x: (x["start"], -x["stop"])):
        if span["start"] >= at:
            mark = PLACEHOLDERS[span["kind"]]
            parts += [text[at : span["start"]], mark]
            at = span["stop"]
            more += len(mark) - (at - span["start"])
    return "".join(parts) + text[at:], more


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [replaced(t, s)[0] for t, s in zip(batch["text"].to_pylist(), batch["spans"].to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], names=["doc_id", "text"])


def _replace_beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [replaced(t, s) for t, s in zip(batch["text"].to_pylist(), batch["spans"].to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["raw"], batch["found"], pa.array([t for t, _ in done], pa.string()), pa.array([m for _, m in done], pa.int64())],
            names=["doc_id", "raw", "found", "clean", "marks"],
        )


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its findings replaced by placeholders of their kinds."""
    documents = table(spark, sf_dir, "documents")
    spans = personal_spans(documents).distinct().groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "kind")).alias("spans"))
    joined = documents.select("doc_id", "text").join(spans, "doc_id", "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_replace, "doc_id long, text string")


def p10_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every cleaned document.

    Nothing that was found is left, and without its placeholders the text is
    as long as before without what was found.
    """
    documents = table(spark, sf_dir, "documents")
    spans = persisted(personal_spans(documents).distinct(), "spans")
    found = spans.groupBy("doc_id").agg(F.collect_set("found_text").alias("found"), F.collect_list(F.struct("start", "stop", "kind")).alias("spans"))
    rows = documents.select("doc_id", F.col("text").alias("raw")).join(found, "doc_id", "left")
    clean = rows.withColumn("text", F.col("raw")).mapInArrow(_replace_beside, "doc_id long, raw string, found array<string>, clean string, marks long")
    left = F.exists(F.coalesce("found", F.array().cast("array<string>")), lambda x: F.contains("clean", x))
    return clean.select("doc_id", (~left).alias("nothing_left"), (F.length("clean") == F.length("raw") + F.col("marks")).alias("rest_unchanged"))


QUERIES = {"p10_found": p10_found, "p10_clean": p10_clean, "p10_checks": p10_checks}
ORACLE: dict[str, str] = {"p10_checks": "select doc_id, case when text is not null then true end as nothing_left, case when text is not null then true end as rest_unchanged from documents"}
