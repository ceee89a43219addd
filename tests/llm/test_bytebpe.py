"""Byte-level BPE against the tiktoken library, and back again."""

import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st

from rillmart.llm import bytebpe
from tests.llm.helpers import EMPTY, ODD, docs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS, CLASSES, MACHINE = bytebpe.load_ranks(PATH), bytebpe.code_classes(), bytebpe.automaton()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab 's'tre'll''d  \n\t12é中 !?_"), st.characters(codec="utf-8")),
                        max_size=60), max_size=4))
def test_same_ids_as_the_library(texts):
    got = bytebpe.encode_texts(texts, RANKS, CLASSES, MACHINE, {})
    assert [g[0] for g in got] == LIBRARY.encode_ordinary_batch(texts)
    for text, (ids, starts, counts) in zip(texts, got):
        assert sum(counts) == len(ids) and (not text or starts[0] == 0)


def test_long_pieces(spark):
    text = "abc" * 4000 + " " * 5000 + "x"
    assert bytebpe.encode_texts([text], RANKS, CLASSES, MACHINE, {})[0][0] == LIBRARY.encode_ordinary(text)


def test_tables(spark):
    coded = bytebpe.encode(docs(spark, ODD), PATH)
    for r in bytebpe.decode(coded, PATH).collect():
        assert list(r.token_ids) == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and sum(r.piece_tokens) == len(r.token_ids)
    for r in bytebpe.encode_decode(docs(spark, ODD), PATH).collect():
        assert list(r.token_ids) == LIBRARY.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bytebpe.encode(docs(spark, EMPTY), PATH).count() == 0


def test_long_batches_are_cut(monkeypatch):
    monkeypatch.setattr(bytebpe, "STRETCH", 20)
    texts = ["a b c " * k for k in range(9)] + [""] * 3
    got = bytebpe.encode_texts(texts, RANKS, CLASSES, MACHINE, {})
    assert [g[0] for g in got] == LIBRARY.encode_ordinary_batch(texts)
