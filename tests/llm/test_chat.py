"""Chat formatting: logs fold to the right messages and output reads back exactly."""

from pyspark.sql import functions as F

from rillmart.llm import chat

LOG = "conv_id long, turn long, message long, seq long, kind string, role string, text string, extra int"


def fold(spark, events):
    rows = spark.createDataFrame([(*e, 1) for e in events], LOG).repartition(3)
    return {(r.conv_id, r.turn, r.message): (r.role, r.text) for r in chat.fold(rows).collect()}


def test_deltas_edits_regenerations(spark):
    got = fold(spark, [
        (1, 0, 1, 2, "delta", None, "lo"), (1, 0, 1, 1, "delta", "user", "hel"),
        (1, 1, 2, 1, "delta", "assistant", "first"), (1, 1, 2, 2, "regenerate", None, None),
        (1, 1, 2, 3, "delta", None, "sec"), (1, 1, 2, 4, None, None, "ond"),
        (1, 2, 3, 1, "delta", "user", "typo"), (1, 2, 3, 5, "edit", None, "fixed"), (1, 2, 3, 6, "delta", None, "!"),
        (1, 3, 4, 1, "delta", None, None), (2, None, 1, None, "delta", "user", "null seq")])
    assert got == {(1, 0, 1): ("user", "hello"), (1, 1, 2): ("assistant", "second"), (1, 2, 3): ("user", "fixed!"),
                   (1, 3, 4): (None, ""), (2, None, 1): ("user", "null seq")}


def test_null_numbers_come_first(spark):
    got = fold(spark, [
        (1, 0, 1, None, "edit", "user", "new "), (1, 0, 1, 1, "delta", None, "a"), (1, 0, 1, 2, None, None, "b"),
        (1, 0, 2, None, "regenerate", None, "x"), (1, 0, 2, None, "delta", None, "y"), (1, 0, 2, 0, "delta", None, "z"),
        (1, 0, 3, None, "delta", None, "old"), (1, 0, 3, 1, "edit", None, "c"), (1, 0, 3, 2, "delta", None, "d"),
        (1, 0, 4, None, "edit", None, "old"), (1, 0, 4, 3, "edit", None, "e"), (1, 0, 4, 2, "delta", None, "gone")])
    assert got == {(1, 0, 1): ("user", "new ab"), (1, 0, 2): (None, "xyz"), (1, 0, 3): (None, "cd"),
                   (1, 0, 4): (None, "e")}


TURNS = [(1, 0, "user", "a </turn>\n<turn assistant>b\\l\\\\"), (1, 1, "assistant", "😀<>#\\g\\"), (1, 1, "assistant", ""),
         (1, 1, "assistant", ""), (2, 0, None, None), (2, None, "a>b\n", "\\"), (None, 3, "assistant", "x" * 40_000)]


def test_round_trip(spark):
    turns = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id long, turn long, role string, text string, seq int")
    out = chat.render(chat.fold(chat.log_of_turns(turns.coalesce(1))))
    rows = {r.conv_id: r for r in out.select(
        "conv_id", "n_turns", chat.parse(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in rows[1].turns] == [t[2:] for t in TURNS[:4]]
    assert rows[1].loss == "😀<>#\\g\\" and rows[1].n_turns == 4
    assert [tuple(t) for t in rows[2].turns] == [("a>b\n", "\\"), ("", "")]
    assert rows[2].loss == "" and rows[None].loss == "x" * 40_000


def test_the_log_of_turns_needs_folding(spark):
    """Its drafts are not part of what the messages end as."""
    said = ["", "abc", "abcd", "abcde", "😀<>#\\g", None]
    turns = spark.createDataFrame([(1, k, "user", t) for k, t in enumerate(said)],
                                  "conv_id long, turn long, role string, text string")
    log = chat.log_of_turns(turns)
    assert {r.kind for r in log.collect()} == {"delta", "edit", "regenerate"}
    assert {r.turn: r.text for r in chat.fold(log.repartition(3)).collect()} == {k: t or "" for k, t in enumerate(said)}
    streamed = chat.fold(log.where("kind = 'delta'"))
    assert {r.turn for r in streamed.collect() if r.text != (said[r.turn] or "")} == {2, 3}


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.render(chat.fold(chat.log_of_turns(empty)))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
