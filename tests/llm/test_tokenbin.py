import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paramo.llm import tokenbin as T
from tests.llm.helpers import documents, empty, messy

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def plain(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(spark, docs, folder, **kw):
    """Every document is found: one after the other in the order of keys, rows of one key in some order."""
    shards = T.write_tokens(docs, folder, PATH, end=2, **kw)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in T.read_tokens(docs, folder, shards).collect())
    want = [(r["doc_id"], plain(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(i), n, c) for _, i, n, c in got) == sorted((str(i), len(ids), crc(ids)) for i, ids in want)
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    keys = [(i is not None, i or 0) for _, i, _, _ in got]
    assert keys == sorted(keys)
    return shards


def test_documents_round_trip(spark, tmp_path):
    shards = check(spark, documents(spark), f"file://{tmp_path}/t", shard_bytes=300_000, part_keys=100)
    rows = shards.orderBy("shard").collect()
    assert len(rows) > 4 and rows[0]["parts"] > 4
    files = sorted((tmp_path / "t/payload").glob("*.bin"))
    assert [f.stat().st_size for f in files] == [2 * r["ids"] for r in rows]  # raw ids, nothing else


def test_edges(spark, tmp_path):
    check(spark, messy(spark), f"file://{tmp_path}/m")
    shards = T.write_tokens(empty(spark), f"file://{tmp_path}/e", PATH, end=2)
    assert T.read_tokens(empty(spark), f"file://{tmp_path}/e", shards).collect() == []


def test_unknown_keys_are_not_found(spark, tmp_path):
    shards = T.write_tokens(documents(spark), f"file://{tmp_path}/u", PATH, end=2)
    assert T.read_tokens(spark.range(10**6, 10**6 + 500).withColumnRenamed("id", "doc_id"), f"file://{tmp_path}/u", shards).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["word", "word.,", "naïve!!", "Īİ,", "e\u0301.", "IX.", "Ⅸ,", "a's.", "\u1100\u1161,", "x.y.", "ǅ:", "ß;", "It's", "'LL", "<|endoftext|>", "x<|startoftext|>y", "Σίσυφος ΟΔΟΣ", "é", "e\u0301", "\u0301", "\u0344", "\x1c", "\x1f!", "\x85", "\xa0", "\u2003", "\u3000", "ﬁ", "İ", "①", "😀", "...", "12", "가", "\u1100\u1161", "\x00", "\u200d"]), max_size=12), st.sampled_from([" ", "\n", "\t\r", "\x0b", "\x0c", "", "  "]), st.text(max_size=12))
def test_chunks_give_the_ids_of_whole_texts(parts, glue, rest):
    text = glue.join(parts) + glue + rest
    coded = T.Encoder(PATH, 2)([text.encode()], 2)[0]
    assert np.frombuffer(coded, "<u2").tolist() == plain(text)


def test_perfect_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n, dtype=np.int64))
        hashed = T.PerfectHash.of(keys)
        assert hashed.size == len(keys) and sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
        part = T.IndexPart.of(keys, at=np.arange(len(keys)))
        got = part.get(keys)
        assert got["known"].all() and (got["at"] == np.arange(len(keys))).all()
        others = np.setdiff1d(rng.integers(-(2**63), 2**63 - 1, 1000, dtype=np.int64), keys)
        assert part.get(others)["known"].mean() < 0.01


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        T.Encoder(PATH, 1)


def test_rows_of_one_key_are_spread_and_found(spark, tmp_path):
    """A key with most of the rows fills many shards; each of its rows is found, also with equal texts."""
    rows = [(7 if i % 3 else i, f"text number {i % 50} " * (i % 4)) for i in range(600)] + [(None, f"none {i % 2}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shards = check(spark, docs, f"file://{tmp_path}/k", shard_bytes=1_500, part_keys=50)
    assert shards.count() > 8


def test_letters_before_signs_give_the_ids_of_whole_texts():
    """Every letter of every script, precomposed ones that normalise to several characters included, before every sign."""
    letters = [chr(c) for c in range(0x41, 0x30000) if chr(c).isalpha() and not 0xAC00 <= c < 0xD7A4 and not 0x4E00 <= c < 0x9FFF and not 0x20000 <= c < 0x2F800]
    encoder = T.Encoder(PATH, 2)
    for sign in ".,;:!?#$%&*":
        some = letters if sign == "." else letters[:: 7]
        texts = [f"{c}{sign} x{c}{sign}{sign} {c}{sign}y" for c in some]
        want = [e.ids + [2] for e in WHOLE.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder([t.encode() for t in texts], 2)]
        assert [c for c, a, b in zip(some, got, want) if a != b] == []


def test_pairs_of_numbers_are_hashed_perfectly():
    keys = np.column_stack([np.repeat(np.arange(200), 50), np.tile(np.arange(50), 200)])
    hashed = T.PerfectHash.of(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
