"""Personal data against plain patterns, and disguises."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from rillmart.llm import pii
from tests.llm.helpers import EMPTY, ODD, docs

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(kind, text):
    out = []
    for m in re.finditer(PLAIN[kind], text):
        digits = re.sub("[^0-9]", "", m.group())
        if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
            continue
        if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
            continue
        if kind == "phone" and not 8 <= len(digits) <= 15:
            continue
        out.append(m.span())
    return out


@settings(max_examples=1000, deadline=None)
@given(st.text("a@.1 -+2(3)b9@.0_é", max_size=60))
def test_base_spans(text):
    for kind, detect in pii.DETECTORS.items():
        assert detect(text) == brute(kind, text)


@pytest.mark.parametrize("text, kind, hidden", [
    ("mail john.doe (at) mail dot example (dot) com now", "email", "john.doe (at) mail dot example (dot) com"),
    ("jane at example dot com.", "email", "jane at example dot com"),
    ("jane.doe at example.com.", "email", "jane.doe at example.com"),
    ("so jane42 at example.com", "email", "jane42 at example.com"),
    ("é ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("to jоhn@exаmple.com ok", "email", "jоhn@exаmple.com"),
    ("ip １９２．１６８．０．１", "ip", "１９２．１６８．０．１"),
    ("10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
    ("call plus one four one five five five five two six seven one", "phone",
     "plus one four one five five five five two six seven one"),
    ("card " + " ".join(["four"] + ["one"] * 15), "card", " ".join(["four"] + ["one"] * 15)),
])
def test_disguises(text, kind, hidden):
    (found,) = [s for s in pii.find(text) if not s[3]]
    assert found[0] == kind and text[found[1]:found[2]] == hidden


@pytest.mark.parametrize("text, kind, fragment", [
    ("jоhn.smith@host.com", "email", "hn.smith@host.com"),
    ("john (dot) smith@host.com", "email", "smith@host.com"),
    ("john@mail.example (dot) com", "email", "john@mail.example"),
    ("192.168.1.1２", "ip", "192.168.1.1"),
])
def test_disguises_around_a_plain_fragment(text, kind, fragment):
    """The fragment stays a base span, the whole identifier is added."""
    at = text.index(fragment)
    for before, after in (("", ""), ("see ", " now")):
        found = pii.find(before + text + after)
        k = len(before)
        assert sorted(found) == sorted([(kind, k, k + len(text), False),
                                        (kind, k + at, k + at + len(fragment), True)])


@pytest.mark.parametrize("text", ["é jane@host.com", "1.2.3.4 é", "jane@host.com at noon dot"])
def test_plain_identifiers_are_not_added_again(text):
    assert [s[3] for s in pii.find(text)] == [True]


@pytest.mark.parametrize("text", ["look at this. That is it", "one two three steps", "at noon dot", "a dot b", "Éé at è.è",
                                  "look at host.com now", "meet me at home.html", "open 24 at shop.example.com"])
def test_plain_texts_stay_clean(text):
    assert pii.find(text) == []


NAMES = "zero one two three four five six seven eight nine".split()
WIDE = {ord(c): ord(c) + 0xFEE0 for c in "0123456789.@abcdefghijklmnopqrstuvwxyz"}


def spelled(digits):
    return " ".join(NAMES[int(d)] for d in digits)


def card(rng):
    body = "".join(rng.choices("0123456789", k=15))
    return next(body + str(d) for d in range(10) if pii.luhn(body + str(d)))


PLANTED = {
    "email": (lambda r: f"{''.join(r.choices('abcdehno', k=6))}.{r.randrange(90)}@{''.join(r.choices('abcxyz', k=5))}.com",
              [lambda t: t.replace("@", " (at) ").replace(".", " (dot) "), lambda t: t.replace("@", "[at]"),
               lambda t: t.replace("@", " at "), lambda t: t.replace("@", " at ").replace(".com", " dot com"),
               lambda t: t.translate(WIDE), lambda t: t.replace("@", "\u200b@")]),
    "ip": (lambda r: ".".join(str(r.randrange(256)) for _ in range(4)),
           [lambda t: t.replace(".", " dot "), lambda t: t.translate(WIDE), lambda t: t.replace(".", "[.]"),
            lambda t: t.replace(".", "(dot)")]),
    "card": (card, [spelled, lambda t: t.translate(WIDE), lambda t: "\u200b".join(t), lambda t: "–".join(t)]),
    "phone": (lambda r: "+" + "".join(r.choices("123456789", k=11)),
              [lambda t: "plus " + spelled(t[1:]), lambda t: t[0] + t[1:].translate(WIDE), lambda t: "\u200d".join(t)])}


@pytest.mark.parametrize("kind", PLANTED)
def test_recall_of_planted_disguises(kind):
    """Every disguise of many identifiers, between words of prose; nothing else of its kind is added."""
    rng = random.Random(3)
    make, disguises = PLANTED[kind]
    met = added = planted = 0
    for _ in range(150):
        for disguise in disguises:
            hidden = disguise(make(rng))
            before, after = (" ".join(rng.choices(["look", "house", "dot", "street", "and"], k=4)) + ", ", " ;")
            found = [s for s in pii.find(before + hidden + after) if s[0] == kind and not s[3]]
            planted += 1
            met += any((s, e) == (len(before), len(before + hidden)) for _, s, e, _ in found)
            added += len(found)
    assert met >= 0.95 * planted and met >= 0.95 * added, (met, added, planted)


def test_tables(spark):
    rows = [*ODD, (50, "😀 a@b.co, c(at)d(dot)org")]
    found = {r.doc_id: r.pii for r in pii.personal_data(docs(spark, rows)).collect()}
    assert [tuple(s) for s in found[50]] == [("email", 2, 8, True), ("email", 10, 24, False)]
    assert all(not v for k, v in found.items() if k != 50)
    assert pii.personal_data(docs(spark, EMPTY)).count() == 0
