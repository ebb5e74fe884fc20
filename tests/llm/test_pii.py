import hashlib
import re

from pyspark.sql import functions as F

from paramo.llm import pii as P
from paramo.llm import queries
from tests.llm.helpers import MEDIUM, documents, empty, messy

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        odd = sum(map(int, digits[::-1][::2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2])
        return 14 <= len(digits) <= 19 and odd % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def plain(text):
    spans = [(m.start(), i, m.end()) for i, (kind, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if passes(kind, m.group())]
    return sorted(spans)


HARD = [
    "a@b.c_x@d.e a@b@c.d a.b+c@x-y.z.w. @a.b x@.b .@a.b", "1.2.3.4.5 256.1.1.1 1.2.3 001.002.003.0255 1.2.3.99999999999999999999 10.0.0.1.10.0.0.2",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 4111111111111111 42 4 2-3 41111111111111112 0000000000000000000 00000000000000000000",
    "+1 (017) 555-7713 +1 2 +49-30.123 456 7890 ++12345678901 +123456789012345678 +1(2)3(4)5-6 7.8 9 0 ) +1 234 567 890-", "\U0001f600é +1 (017) 555-7713 ä a@b.cd \U0001f600 1.2.3.4",
    "1" * 30_000 + " " + "a" * 50_000 + " " + "x.y" * 10_000 + "@q" + ".r" * 8_000 + " " + "1 " * 9_000 + "+1" + " -" * 9_000, "", None, " ",
]


def spans(frame):
    return {r["doc_id"]: [(s["start"], s["rank"], s["end"]) for s in r["base"]] for r in P.personal_data(frame).select("doc_id", "base").collect()}


def test_base_spans_of_hard_texts(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    assert spans(frame) == {i: plain(t) for i, t in enumerate(HARD)}


def test_query_against_plain_search(spark):
    got = {r["doc_id"]: r for r in queries.op7_personal_data(spark, MEDIUM).collect()}
    for r in documents(spark).collect():
        want = plain(r["text"])
        told = ",".join(f"{list(FORMS)[k]}:{a}:{b}" for a, k, b in want)
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [got[r["doc_id"]][f"n_{kind}"] for kind in FORMS] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(filter(None, told.split(","))) <= set(got[r["doc_id"]]["spans"].split(","))


def test_contexts_discover_unseen_identifiers(spark):
    """``card number:`` and ``card no.`` teach each other; years, ids in mixed contexts and lone contexts are left alone."""
    good = ["4111111111111111", "4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117"]
    rows = [f"the card number: {g} was charged" for g in good]
    rows += ["the card number: 1234567890123450 was charged", "please bill card no. 1234567890123450 today", "order 99887766554433 came"]
    rows += [f"mixed field here {g} end" for g in good[:3]] + [f"mixed field here a{i}@b.cd end" for i in range(3)] + ["mixed field here 7777777777777 end"]
    rows += [f"ref {i} 2024-10-1{i} nothing" for i in range(9)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.personal_data(frame).select("doc_id", P.written(F.col("spans")).alias("spans"), F.size("base").alias("n")).collect()}
    assert got[6]["spans"] == "card:17:33" and got[6]["n"] == 0
    assert got[7]["spans"] == "card:21:37"  # the same value elsewhere
    assert all(got[i]["spans"] == "" for i in range(len(rows)) if got[i]["n"] == 0 and i not in (6, 7))
    assert all(got[i]["n"] == len(got[i]["spans"].split(",")) for i in got if got[i]["n"])


def test_edges(spark):
    docs = messy(spark)
    assert P.personal_data(docs).count() == docs.count()
    assert P.personal_data(empty(spark)).collect() == []


def discovered(spark, rows):
    """The spans of each text that the base patterns do not give, as written."""
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = P.personal_data(frame).select("doc_id", P.written(F.col("base")).alias("base"), P.written(F.col("spans")).alias("spans")).collect()
    return {r["doc_id"]: set(filter(None, r["spans"].split(","))) - set(r["base"].split(",")) for r in got}


def test_second_writings_of_seeds_are_spans(spark):
    """A seed is found in writings that its form misses; an IP's digits are no IP, and an address without its dots is none."""
    good = ["4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117"]
    rows = ["a 4111111111111111 b", "c 4111.1111.1111.1111 d", "e 4111  1111 1111 1111 f",
            "call +49 30 123456 7890 now", "call 49 30 123456 7890 now", "or (49)30-1234567890",
            "host 192.168.100.100 up", "order 192168100100 came", "mail jane.doe@host.example 4 you", "mail janedoe@hostexample 4 you",
            *[f"the card number: {g} was charged" for g in good], "the card number: 4111.1111.1111.1111 was charged",
            "pair +411111111111116 here", "pair 4111.11111111116 here"]
    got = discovered(spark, rows)
    want = {1: {"card:2:21"}, 2: {"card:2:22"}, 4: {"phone:5:22"}, 5: {"phone:3:20"}, 15: {"card:17:36"}, 17: {"card:5:21", "phone:5:21"}}
    assert {i: s for i, s in got.items() if s} == want


def test_identifiers_beside_other_numbers_are_found(spark):
    """Unseen identifiers next to a base span, a date or each other, and cards in a row of digits."""
    good = ["4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117"]
    rows = [f"the card number: {g} was charged" for g in good]
    rows += ["the card number: 88123456 was charged", "account 88123456 10.0.0.1", "account 88123456 2024-05-01", "10.0.0.1 88123456",
             "the card number: 5550109999 was charged", "ids 5550109999 5550108888", "the card number: 5550109999 5550108888",
             "row 4012 8888 8888 1881 5555 5555 5555 4444 end", "account 77123456 2024-05-01"]
    got = discovered(spark, rows)
    assert {i: s for i, s in got.items() if s} == {
        5: {"card:17:25"}, 6: {"card:8:16"}, 7: {"card:8:16"}, 8: {"card:9:17"}, 9: {"card:17:27"}, 10: {"card:4:14"}, 11: {"card:17:27"},
        12: {"card:4:23", "card:24:43"}}


def test_planted_identifiers_are_recalled(spark):
    """Identifiers that no base pattern fits, in prose with contexts that vary; none of them is a seed."""
    import random

    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    def card():
        body = [rng.randrange(10) for _ in range(15)]
        odd = sum(sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(body))
        return "".join(map(str, body)) + str(-odd % 10)

    phone = lambda: f"+49 {rng.randrange(100, 999)} {rng.randrange(10**6, 10**7)}"
    unseen_card, unseen_phone = (lambda: str(rng.randrange(10**11, 10**12))), (lambda: f"0{rng.randrange(100, 999)} {rng.randrange(10**6, 10**7)}")
    openers = {"card": ["billed to card no. {}", "the card: {}", "Card number {}", "on card {}"], "phone": ["call {}", "please CALL: {}", "you may call {}", "or call, {}"]}
    rows, planted = [], {}
    for kind, seed, unseen in (("card", card, unseen_card), ("phone", phone, unseen_phone)):
        for i in range(160):
            held = i % 2 == 1
            value = unseen() if held else seed()
            text = f"{filler(rng.randrange(3, 12))} {rng.choice(openers[kind]).format(value)} {filler(rng.randrange(3, 12))}"
            if held:
                at = text.index(value)
                planted[len(rows)] = f"{kind}:{at}:{at + len(value)}"
            rows.append(text)
    clean = len(rows)
    rows += [f"{filler(6)} {rng.randrange(10**7, 10**9)} {filler(6)}" for _ in range(60)]
    got = discovered(spark, rows)
    caught = sum(span in got[i] for i, span in planted.items())
    assert caught / len(planted) >= 0.9
    assert sum(bool(got[i]) for i in range(clean, len(rows))) <= 2


def test_long_texts_take_time_in_proportion(spark):
    """Dotted leaders, rows of digits and many candidates: eight times the text is far from 64 times the time."""
    import time

    def took(make, n):
        frame = spark.createDataFrame([(1, make(n))], "doc_id long, text string")
        at = time.perf_counter()
        found = frame.withColumn("base", P.base_spans(F.col("text"))).withColumn("near", P.candidate_spans(P.around(F.col("text"), F.col("base"))))
        found.select(F.size("near"), F.size(P.sides(F.col("text"), F.col("near")))).collect()
        return time.perf_counter() - at

    for make in (lambda n: "a." * n + " 5", lambda n: "1." * n + "1a", lambda n: "1 " * n + "1a", lambda n: " ".join(f"x{i}y12345" for i in range(n // 8)), lambda n: " ".join(f"a{i}@b.cd" for i in range(n // 8))):
        took(make, 500)
        assert took(make, 16_000) < 20 * max(took(make, 2_000), 0.15)
