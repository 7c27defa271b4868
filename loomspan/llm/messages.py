"""Phrase and placeholder rules for text that stands where content should be."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np

# Error messages, script and browser notices, filler and defaults.
PHRASES = r"""
page not found|seite nicht gefunden|page introuvable|página no encontrada|página não encontrada|страница не найдена|ページが見つかりません
(?:the )?page you are looking for does not exist or has moved|you do not have permission to open this address
(?:the )?server took too long to answer|(?:the )?upstream service did not respond|please try again in a few minutes
our team has been told about the fault|your request was blocked by a security rule|(?:go back|return) to the start page or use the search
diese adresse gibt es nicht mehr|cette adresse n.existe plus|esta dirección ya no existe|este endereço não existe mais
error establishing a database connection|access denied|something went wrong|internal error|this site can.t be reached
(?:this )?site (?:is )?(?:temporarily offline|under maintenance)|under maintenance|temporarily offline
(?:this )?domain is parked|coming soon ?[-–] ?default page|coming soon|index of /?\S*|welcome to your new site|welcome to nginx
nginx(?:/[\d.]+)?|apache(?:/[\d.]+)?
(?:you need to|please) enable javascript(?: to [\w ]+)?|this page requires javascript|it looks switched off|javascript (?:is )?required
please turn on scripts in your browser and reload|bitte aktivieren sie javascript, um fortzufahren|veuillez activer javascript pour continuer
(?:your )?browser is not supported|scripts must be allowed for [\w. ]+|verify that you are human by ticking the box
(?:we are )?checking (?:your browser|that your connection is safe)(?: before you proceed)?|(?:confirm|checking) that your connection is safe before you proceed
just a moment(?:\.\.\.|…)?|one moment(?:\.\.\.|…)? ?(?:please wait)?|loading(?:\.\.\.|…)? ?(?:please wait)?|redirecting(?:\.\.\.|…)? ?(?:please wait)?|please wait(?:\.\.\.|…)?|attention required!?
lorem ipsum dolor sit amet, consectetur placeholder copy|dolor amet lorem varius ipsum sed nulla tempor|aenean lorem, ipsum vitae dolor, sit placeat
lorem ipsum(?: dolor sit amet)?(?:, consectetur adipiscing elit)?|blindtext: hier steht später ihr inhalt|blindtext
(?:this is )?sample (?:text|page)|replace it with your own words|insert body copy|todo write this section|todo:? \w+(?: \w+){0,3}
add a short paragraph about your company in this block|your paragraph here|click to edit and tell visitors more|(?:text|title|headline|description|content) goes here
test test(?: test)*|asdf(?: asdf| qwer)*|\[object object\]|undefined(?: undefined)*|nan of null items|null|none|n/a|nan
untitled(?: document| page)?|new page|(?:default|your|blank|sample|test) page(?: title)?|page title|home page|default|document
"""
# The names of HTTP errors.
STATUSES = (
    "not found", "forbidden", "internal server error", "bad gateway", "service unavailable", "gateway timeout", "gateway time-out", "bad request",
    "unauthorized", "too many requests", "gone", "conflict", "method not allowed",
)
# What error pages call their numbers.
NUMBERS = ("reference", "request id", "ray id", "incident", "error code")
_RULES = [r"(?:error )?\d{3}:? " + name for name in STATUSES] + [name + r"(?: number)?:? ?[0-9a-f-]{6,}" for name in NUMBERS]
_RULES += [rule for line in PHRASES.strip().split("\n") for rule in re.split(r"\|(?![^(]*\))", line)]
def _anchor(rule: str) -> str:
    """The longest literal that every match of a rule holds."""
    rule = rule.replace("\\[", "").replace("\\]", "").replace("n/a", "n a")
    bare = re.sub(r"\{\d,\d?\}|\[[^\]]*\]\S?|\\[a-z](?:\{\d\})?|.\?", "\0", re.sub(r"\((?:[^()]|\([^()]*\))*\)[?*]?", "\0", rule))
    return max(re.split(r"[^\w,' ]+", bare), key=len).strip()


_NO_WORD, _BREAKS = re.compile(r"\W+"), re.compile(r"[^\w\n]+")
_ANCHORS = ahocorasick.Automaton()
for _number, _rule in enumerate(_RULES):
    _key = f" {_NO_WORD.sub(' ', _anchor(_rule))} "
    _ANCHORS.add_word(_key, (*_ANCHORS.get(_key, ()), _number))
_ANCHORS.make_automaton()
#: The longest word of each literal; a line without any of them holds no literal.
_STEMS = ahocorasick.Automaton()
for _key in _ANCHORS:
    _STEMS.add_word("n/a" if _key == " n a " else max(_key.split(), key=len, default=" "), True)
_STEMS.make_automaton()
_patterns: dict[tuple[int, ...], re.Pattern] = {}
_WORDS = re.compile(r"[^\W_]+")
_FORM = r"[A-Za-z_][\w.]*"
_PLACEHOLDER = re.compile(
    rf"\{{\{{\{{? ?{_FORM} ?\}}?\}}\}}|\$\{{{_FORM}\}}|#\{{{_FORM}\}}|%%{_FORM}%%|@@{_FORM}@@|\[\[{_FORM}\]\]|\[INSERT {_FORM}\]"
    rf"|\[Your {_FORM} here\]|<%= ?{_FORM} ?%>|__[A-Za-z][\w.]*?[A-Za-z]__|&lt;/?{_FORM}&gt;|<{_FORM}>|(?<![\w{{$#]){{{_FORM}\}}(?!\}})|\*\|[A-Z_]+\|\*"
)
#: What a placeholder begins with.
QUICK = re.compile(r"[{\[<%@$#_&*]")
# Words of sentences that explain placeholders instead of holding one.
_MENTION = re.compile(
    r"\b(?:notations?|syntax|placeholders?|variables?|template tags?|fill \S+ fields|fields in mails|in invoices|in a mail|fills in|merge (?:tags?|fields?))\b", re.IGNORECASE
)
_PARTS = re.compile(r"[^.!?。！？|]+[.!?。！？|]*")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_ADDRESS = re.compile(r"https?://\S+|\S+@\S+")
_DIGIT = re.compile(r"\d")
_NUMBER = re.compile(r"\S*\d\S*")


def plain(text: str) -> str:
    """Lower-case words with addresses replaced."""
    text = text.lower()
    if "@" in text or "://" in text:
        text = _ADDRESS.sub(" 0 ", text)
    return _NO_WORD.sub(" ", text).strip()


def mask(words: str) -> str:
    """Plain words with numbers, dates and ids replaced."""
    return _NUMBER.sub("0", words) if _DIGIT.search(words) else words


def phrase_pattern(words: str) -> re.Pattern | None:
    """The rules that can match in a text of these plain words, by a search for their literals; None if there are none."""
    hits = {n for _, numbers in _ANCHORS.iter(f" {words} ") for n in numbers}
    if not hits:
        return None
    key = tuple(sorted(hits))
    found = _patterns.get(key)
    if found is None:
        if len(_patterns) > 10_000:
            _patterns.clear()
        found = _patterns[key] = re.compile(r"(?<!\w)(?:" + "|".join(_RULES[n] for n in key) + r")(?!\w)", re.IGNORECASE)
    return found


def sentences(line: str) -> list[tuple[str, str]]:
    """(masked words, text) of the sentences of a line, those with a phrase taken apart into phrases and what is between."""
    out = []
    for part in _PARTS.findall(line):
        words = plain(part)
        pattern = phrase_pattern(words)
        if pattern is None:
            if words:
                out.append((mask(words), part))
            continue
        found = list(pattern.finditer(part))
        at, between = 0, []
        for m in found:
            between.append(part[at : m.start()])
            out.append((mask(plain(m.group())), m.group()))
            at = m.end()
        # A single word beside a phrase belongs to it.
        out += [(mask(plain(x)), x) for x in [*between, part[at:]] if word_count(x) > bool(found)]
    return out


def word_count(text: str) -> int:
    return len(_WORDS.findall(text))


def residue_line(line: str) -> bool:
    """A line made of messages alone, but for a word."""
    pattern = phrase_pattern(plain(line))
    if pattern is None:
        return False
    rest, n = pattern.subn(" ", line)
    return n > 0 and word_count(rest) <= 1


def residue_lines(lines: list[str]) -> list[bool]:
    """`residue_line` of lines without line breaks; the literals of the rules are sought in all of them at once."""
    out = [False] * len(lines)
    held = _lines_with(_STEMS, [line.lower() for line in lines])
    # What `plain` leaves of an address may complete a literal, so those lines are looked at one by one.
    maybe = [i for i in held if "@" in lines[i] or "://" in lines[i]]
    bare = _BREAKS.sub(" ", "\n".join([lines[i] for i in held]).lower()).split("\n")
    maybe += [held[k] for k in _lines_with(_ANCHORS, [f" {x} " for x in bare]) if k < len(held)]
    for i in maybe:
        out[i] = residue_line(lines[i])
    return out


def _lines_with(automaton: ahocorasick.Automaton, lines: list[str]) -> list[int]:
    """The numbers of the lines that hold an entry of the automaton."""
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
    hits = np.fromiter((end for end, _ in automaton.iter("\n".join(lines))), np.int64)
    return np.unique(np.searchsorted(ends, hits, "right")).tolist()


def unfilled(text: str) -> bool:
    """Holds a placeholder that no sentence explains."""
    done = 0
    for at in (x.start() for x in QUICK.finditer(text)):
        m = _PLACEHOLDER.match(text, at) if at >= done else None
        if m is None:
            continue
        done = m.end()
        start = max((x.end() for x in _SENTENCE.finditer(text, 0, m.start())), default=0)
        end = _SENTENCE.search(text, m.end())
        if not _MENTION.search(text[start : end.start() if end else len(text)]):
            return True
    return False
