"""Personal data: detection in a text as it stands and in a normalised reading of it.

A transducer rewrites disguises (look-alike characters, other scripts' digits, invisible characters,
spelled digits, ``(at)`` and ``dot``) and keeps for every output character the stretch of source it
came from.  The same detectors run over both readings; what they find in the normalised one is
mapped back to source characters and added where it covers a rewritten character and does not lie
within an identifier of its kind that was already found.  One that reaches beyond what the plain
reading found of it is added next to that fragment.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Found from their @, so that a long word without one costs nothing."""
    found, after = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            after = m.end()
    return found


def ips(text: str) -> list[Span]:
    def fits(part):
        part = part.lstrip("0")
        return len(part) <= 3 and int(part or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(fits, m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NO_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text)
            if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15]


DETECTORS = dict(zip(KINDS, (emails, ips, cards, phones)))

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅοαινρυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcyxijshdqwABEKMHOPCTYXIJSoaivpukABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
SIGNS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "。": ".",
         "․": ".", " ": " ", " ": " "}
DIGITS = {w: str(k) for k, w in enumerate("zero one two three four five six seven eight nine".split())}
_WORD = "|".join(DIGITS)
# A run of spelled or written single digits that holds at least two words in a row.
_SPELLED = re.compile(rf"(?<![A-Za-z])(?:plus[\s,-]+)?(?:(?:{_WORD}|dot|[0-9]+)(?:[\s,.-]+|(?![A-Za-z0-9])))*"
                      rf"(?:{_WORD})[\s,-]+(?:{_WORD})(?:[\s,.-]+(?:{_WORD}|dot|[0-9]+)(?![A-Za-z]))*(?![A-Za-z])", re.I)
_UNIT = re.compile(rf"plus|dot|{_WORD}|[0-9]", re.I)
_BRACKET = re.compile(r"\s*[(\[{<]\s*(at|dot|@|\.)\s*[)\]}>]\s*|[_\s]+(at|dot)_+|_+(at|dot)[_\s]+", re.I)
# Bare words need the whole form, NAME at HOST dot TOP.  In NAME at HOST.TOP the name must not be a
# mere word or number, since "look at host.com" is prose.
_BARE = re.compile(r"(?<=[A-Za-z0-9._%+-])(\s+at\s+)[A-Za-z0-9-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*\s+dot\s+[A-Za-z0-9-]+"
                   r"|(?<=[A-Za-z0-9._%+-])@[A-Za-z0-9-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*\s+dot\s+[A-Za-z0-9-]+"
                   r"|(?<=[A-Za-z0-9._%+-])(?P<prose>\s+at\s+)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
                   r"|(?<![0-9A-Za-z])[0-9]{1,3}(?:\s+dot\s+[0-9]{1,3}){3}(?![0-9A-Za-z])", re.I)
_GAP = re.compile(r"\s+(at|dot)\s+", re.I)
_PLAIN = re.compile(r"[\x00-\x7f¡-¬®-ͯ]*")
_HINT = re.compile(rf"[(\[{{<_]\s*(?:at|dot|@|\.)\s*[)\]}}>_]|\sat\s+[A-Za-z0-9.-]*\.[A-Za-z]|\sdot[\s_]|(?:{_WORD})[\s,-]+(?:{_WORD})", re.I)


def _character(c: str) -> str:
    """What a character stands for."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES or c in SIGNS:
        return LOOK_ALIKES.get(c) or SIGNS[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain < "\x7f" else c


def _rewrite(text: str, starts: list[int], ends: list[int], changed: list[bool], edits):
    """One transducer pass.  ``edits`` yields (start, end, output) in order, without overlaps."""
    out, s, e, c, at = [], [], [], [], 0
    for a, b, new in edits:
        if a < at:
            continue
        for have, of in ((s, starts), (e, ends), (c, changed)):
            have.extend(of[at:a])
        out += [text[at:a], new]
        s.extend([starts[a]] * len(new))
        e.extend([ends[b - 1]] * len(new))
        c.extend([True] * len(new))
        at = b
    for have, of in ((s, starts), (e, ends), (c, changed)):
        have.extend(of[at:])
    out.append(text[at:])
    return "".join(out), s, e, c


def _character_edits(text: str):
    at = 0
    while (at := _PLAIN.match(text, at).end()) < len(text):
        new = _character(text[at])
        if new != text[at]:
            yield at, at + 1, new
        at += 1


def _bracket_edits(text: str):
    for m in _BRACKET.finditer(text):
        word = next(filter(None, m.groups())).lower()
        yield *m.span(), "@" if word in ("at", "@") else "."


def _bare_edits(text: str):
    for m in _BARE.finditer(text):
        if m["prose"]:
            start = m.start()
            while start and text[start - 1] in _LOCAL:
                start -= 1
            name = text[start:m.start()].strip(".-_%+")
            if name.isalpha() or name.isdigit():
                continue
        for g in _GAP.finditer(text, m.start(), m.end()):
            yield *g.span(), "@" if g[1].lower() == "at" else "."


def _digit_edits(text: str):
    for m in _SPELLED.finditer(text):
        at = m.start()
        for u in _UNIT.finditer(text, m.start(), m.end()):
            word = u.group().lower()
            new = {"plus": "+", "dot": "."}.get(word) or DIGITS.get(word, word)
            if at < u.start():
                yield at, u.start(), ""
            yield *u.span(), new
            at = u.end()


def normalise(text: str):
    """(normalised text, source starts, source ends, rewritten) with a place for each character."""
    starts = list(range(len(text)))
    now = text, starts, [k + 1 for k in starts], [False] * len(text)
    for edits in (_character_edits, _bracket_edits, _digit_edits, _bare_edits):
        now = _rewrite(*now, edits(now[0]))
    return now


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by kind as listed, then start, in code points, end exclusive."""
    base = {k: detect(text) for k, detect in DETECTORS.items()}
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if _HINT.search(text) or _PLAIN.match(text).end() < len(text):
        plain, starts, ends, changed = normalise(text)
        if plain != text:
            for kind, detect in DETECTORS.items():
                for a, b in detect(plain):
                    s, e = starts[a], ends[b - 1]
                    # Characters that went without a trace make the source longer.
                    if (any(changed[a:b]) or e - s > b - a) and not any(x <= s and e <= y for x, y in base[kind] + added[kind]):
                        added[kind].append((s, e))
    return [(k, s, e, b) for k in KINDS for s, e, b in sorted(
        [(*x, True) for x in base[k]] + [(*x, False) for x in added[k]])]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``, an array of (kind, start, end, base).

    ``base`` marks what stands in the text undisguised.  Null counts as empty and has no spans.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_())]))

    def compute(columns):
        for (column,) in columns:
            rows = [find(t.decode("utf-8", "surrogateescape")) for t in texts_of(column)]
            yield [pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in r] for r in rows], kind)]

    return add_columns(docs, {"pii": SPANS}, compute, text_col)


def span_list(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
