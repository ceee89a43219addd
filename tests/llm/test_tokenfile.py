"""Token files: exact round trips."""

import uuid

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rillmart.llm import tokenfile
from rillmart.session import shared_dir
from tests.llm.helpers import EMPTY, ODD, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=200))
def test_coding(ranks):
    values = np.array(ranks, np.uint32)
    control, data = tokenfile.pack(values)
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
    assert (tokenfile.unpack(control, data, len(ranks)) == values).all()


LIBRARY = Tokenizer.from_file(PATH)
MARKED = [c + m for c, m in zip("JHTWYABEjht", "\u030c\u0331\u0308\u030a\u030a\u0301\u0323\u0328\u030c\u0331\u0308")]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.one_of(
    st.sampled_from([*"ab'sSé É.!?-_ \n\t1'TK\u0301\u0307İß¼“", *MARKED, "<|endoftext|>", "<|ENDOFTEXT|>", "<|endof"]),
    st.characters(codec="utf-8")), max_size=40).map("".join), max_size=3))
def test_same_ids_as_the_library(texts):
    got = tokenfile.encode_texts([t.encode() for t in texts], LIBRARY, {}, "<u2")
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == \
        [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_letters_that_compose_in_one_case_only():
    texts = [*MARKED, *[m + "! x" + m.lower() + m.upper() for m in MARKED], "x<|endoftext|>y", "É! Ö? ÷! ×!"]
    cache: dict = {}
    for _ in range(2):
        got = tokenfile.encode_texts([t.encode() for t in texts], LIBRARY, cache, "<u2")
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [
            LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_files(spark):
    rows = [*ODD, (20, "it's  DON'T\x1c1\x1f2 Σας <|endoftext|> ﬁ ½\u0085z")]
    path = shared_dir(spark, f"files-{uuid.uuid4().hex}")
    tokenfile.write_tokens(docs(spark, rows), PATH, path)
    got = sorted(tokenfile.read_tokens(spark, path).collect(), key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(-1 if i is None else i for i, _ in rows)
    at, texts = 0, {}
    for i, t in rows:
        texts.setdefault(i, []).append(LIBRARY.encode(t or "", add_special_tokens=False).ids + [1])
    for r in got:
        found = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(found) and found in texts[r.doc_id]
        at += len(found)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r.tokens for r in ranks] == sorted((r.tokens for r in ranks), reverse=True)
    assert sum(r.tokens for r in ranks) == at


def test_empty_table(spark):
    path = shared_dir(spark, "files")
    tokenfile.write_tokens(docs(spark, EMPTY), PATH, path)
    assert tokenfile.read_tokens(spark, path).count() == 0


def test_added_tokens_in_capitals_are_no_added_tokens():
    texts = ["<|ENDOFTEXT|>a", "x <|EndOfText|>", "<|endoftext|>A <|ENDOFTEXT|>"]
    got = tokenfile.encode_texts([t.encode() for t in texts], LIBRARY, {}, "<u2")
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_given_together(monkeypatch):
    """Runs with the control character that parts others, texts without runs, and a memory of five runs."""
    texts = ["a\x01b \x01 c", "", " \n", "x\x01", "\x01\x01", "!a? b'!.", "́e é! ÷!", *[f"word{k}, Word{k}" for k in range(40)], "<|endoftext|>!"]
    runs, firsts = tokenfile.split_runs([t.encode() for t in texts])
    runs = [[r.decode() for r in runs[a:b].to_pylist()] for a, b in zip(firsts.tolist(), firsts[1:].tolist())]
    assert runs[:7] == [["a\x01b", "\x01", "c"], [], [], ["x\x01"], ["\x01\x01"], ["!a", "?", "b'!."], ["́e", "é", "!", "÷!"]]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    for held in (tokenfile.CACHED_WORDS, 5):
        monkeypatch.setattr(tokenfile, "CACHED_WORDS", held)
        cache: dict = {}
        for part in (texts, texts[7:20], texts[::-1]):
            got = tokenfile.encode_texts([t.encode() for t in part], LIBRARY, cache, "<u2")
            assert [np.frombuffer(g, "<u2").tolist() for g in got] == [want[texts.index(t)] for t in part]
