from pyspark.sql import functions as F

from paramo.llm import chat as C

ROWS = [
    (1, 0, "system", "a < b \\ <turn user>"), (1, 2, "user", "second"), (1, 1, "user", "first </turn>\n<+>"), (1, 3, "assistant", "yes"), (1, 4, "assistant", None), (1, 5, "assistant", "\\l\\b<"),
    (2, 0, "assistant", ""), (3, None, "user", "late"), (3, 0, None, "no role"), (3, 0, "a>b\\", "tie"), (3, 0, None, "no role"),
    (None, 1, "user", "lost"), (4, 0, "user", "x" * 100_000 + " <"), (4, 1, "assistant", "y\n" * 50_000),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def read(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA)
    for extra in ("turns", "loss", "conv", "c0", "blocks", "formatted", "a.b", "Turn_"):
        docs = docs.withColumn(extra, F.lit("clash"))
    done = C.format_chats(docs, **kw)
    out = done.select("conv_id", "formatted", "loss", C.parsed_turns(F.col("formatted")).alias("turns"), C.masked_text(F.col("formatted"), F.col("loss")).alias("text"))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip(spark):
    got = read(spark, ROWS)
    order = lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in ROWS}:
        mine = sorted((r for r in ROWS if r[0] == conv), key=order)
        assert [tuple(t) for t in got[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in mine]
        assert got[conv]["text"] == "".join(r[3] or "" for r in mine if r[2] == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    one = read(spark, ROWS)[1]
    assert [one["formatted"].count(f"<turn {r}>") for r in ("system", "user", "assistant")] == [1, 1, 1]
    assert len(one["loss"]) == 3 and "<+>" not in one["text"]
    for s in one["loss"]:
        assert "</turn>" not in one["formatted"][s["start"] : s["end"]]


def test_nothing(spark):
    assert read(spark, []) == {}


def test_other_role_is_trained(spark):
    assert read(spark, ROWS, trained="system")[1]["text"] == "a < b \\ <turn user>"


def test_running_sums_and_pieces(spark):
    from paramo.llm.common import pieces_at, running

    rows = [(list(range(n)),) for n in (0, 1, 2, 3, 10, 99, 100, 101)]
    for r in spark.createDataFrame(rows, "x array<int>").select("x", running(F.col("x")).alias("s")).collect():
        assert r["s"] == [sum(r["x"][:i]) for i in range(len(r["x"]))]
    text = "".join(chr(97 + i % 26) + "\U0001f600" * (i % 3) for i in range(300))
    spans = [(i, i + i % 7) for i in range(0, 500, 7)]
    got = spark.createDataFrame([(text, spans), (text, [])], "t string, s array<struct<start: int, end: int>>").select(pieces_at(F.col("t"), F.col("s")).alias("p")).collect()
    assert got[0]["p"] == [text[a:b] for a, b in spans] and got[1]["p"] == []


def test_time_grows_with_the_turns(spark):
    """Eight times the turns of one conversation take far less than the square of that."""
    import time

    def took(n):
        rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("word "), 10).alias("text"))
        at = time.perf_counter()
        done = C.format_chats(rows).select(C.masked_text(F.col("formatted"), F.col("loss")).alias("t"), F.size(C.parsed_turns(F.col("formatted"))).alias("n")).first()
        assert done["n"] == n and done["t"] == "word " * 10 * (n // 2)
        return time.perf_counter() - at

    took(1_000)
    assert took(32_000) < 20 * max(took(4_000), 0.2)
