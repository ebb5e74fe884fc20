import random
import re

import pytest

from paramo.llm import decontam as D
from tests.llm.helpers import documents, empty, messy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    """{doc: (words, hit words, items)} by looking every window up."""
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(name) if name is not None else "null")
    sizes = {len(k) for k in windows}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[at : at + n]))):
                    hit.update(range(at, at + n))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def check(spark, docs, items, **kw):
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in D.contamination(frame, bench, **kw).collect()]
    assert sorted(got, key=str) == sorted(plain(docs, items, kw.get("window", 10)), key=str)
    clean = D.decontaminate(frame, bench, max_coverage=1.0, **kw)
    assert clean.columns == ["doc_id", "text"] and clean.count() == len(docs)
    left = plain([(r["doc_id"], r["text"]) for r in clean.collect()], items, kw.get("window", 10))
    assert not any(n for _, _, n, _ in left)


@pytest.mark.parametrize("seed", range(4))
def test_random_words(spark, seed):
    """Few words, so that windows overlap, repeat and share suffixes; short items; several blocks."""
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(rng.randrange(12), line(rng.randrange(0, 14))) for _ in range(14)] + [(None, "A b, c."), (99, None), (98, "--")]
    items = [x for x in items if len(words(x[1])) != 1] if seed % 2 else items
    docs = [(i, line(rng.randrange(0, 40))) for i in range(40)]
    check(spark, docs, items, window=rng.choice([3, 5, 10]))
    check(spark, docs, items, window=4, block_words=20)


def test_documents(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in documents(spark).select("doc_id", "text").collect()]
    check(spark, docs, [(r["item_id"], r["text"]) for r in bench.collect()])


def test_edges(spark):
    bench = spark.createDataFrame([(1, "dog ran over the hill to the sea the end of it"), (2, "sat on the mat")], "item_id long, text string")
    docs = messy(spark)
    clean = D.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.schema == docs.schema and clean.count() == docs.count()
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert got[1] == "The cat \n and the dog ran over the hill to the sea." and got[7] == "long words here " * 20_000
    assert D.contamination(empty(spark), bench).collect() == [] and D.decontaminate(empty(spark), bench).collect() == []
    none = bench.limit(0)
    assert D.contamination(docs, none).agg({"n_hit": "sum"}).first()[0] == 0 and D.decontaminate(docs, none).count() == docs.count()
    with pytest.raises(ValueError):
        D.automata(bench, block_words=5)


def test_mostly_contaminated_rows_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"well {item}"), (2, f"{item} and {' more' * 30}"), (3, "clean text")], "doc_id long, text string")
    clean = D.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]


@pytest.mark.parametrize("block_words", [8, 20])
def test_an_item_above_block_words_is_dealt_in_pieces(spark, block_words):
    """Windows at the ends of pieces, a last piece of any length, short items beside them."""
    rng = random.Random(block_words)
    line = lambda n: " ".join(rng.choice("abcdefg") for _ in range(n))
    long = line(37)
    items = [(1, long), (2, line(21)), (3, line(3)), (4, f"{line(4)}, Ä-{line(20)}")]
    docs = [(i, " ".join(words(long)[i : i + 4])) for i in range(34)] + [(90, long), (91, line(60)), (92, f"x {items[3][1]} x"), (93, None)]
    check(spark, docs, items, window=4, block_words=block_words)


def test_pieces_hold_every_window():
    text = " ".join(map(str, range(50))).encode()
    for block_words in range(4, 60):
        cut = [p.split() for n, p in D.pieces(text, 4, block_words) if n == len(p.split()) <= block_words]
        assert {tuple(p[i : i + 4]) for p in cut for i in range(len(p) - 3)} == {tuple(text.split()[i : i + 4]) for i in range(47)}
        assert all(len(p) >= 4 for p in cut)


def test_blocks_are_files_that_hold_all_items(spark):
    """Small blocks make many files; no block is larger than asked, and each item stands in one."""
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 30)))) for i in range(60)]
    files = D.automata(spark.createDataFrame(items, "item_id long, text string"), block_words=50, window=4)
    made = [D.loaded(f) for f in files]
    assert len(files) == len(set(files)) > 10
    assert sorted(n for a in made for n in {x for names in a.items.values() for x in names}) == sorted(str(i) for i, _ in items)
    assert all(len(a.next) <= 2 * 50 + 1 for a in made)
