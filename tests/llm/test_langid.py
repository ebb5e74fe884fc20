import zlib

from pyspark.sql import functions as F

from paramo.llm import langid as L
from tests.llm.helpers import documents, empty, messy


def test_held_out_accuracy(spark):
    docs = documents(spark)
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = L.predict_language(docs).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_edges(spark):
    docs = messy(spark).unionByName(documents(spark), allowMissingColumns=True)
    got = {}
    for r in L.predict_language(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert {r["lang_pred"] for i in (3, 4, 5, 6) for r in got[i] if r["score"] == 0} >= {"und"}
    assert all(r["held_out"] for r in got[None])
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert not [r for r in kept.collect() if not any(c.isalpha() for c in r["text"] or "")]
    assert L.predict_language(empty(spark)).collect() == [] and L.keep_identified(empty(spark)).collect() == []


def test_nothing_learned(spark):
    docs = documents(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r["lang_pred"], r["score"]) for r in L.predict_language(docs).collect()} == {("und", 0.0)}


def test_narrow_margin_is_rejected():
    same = L.Classifier({"a": b"alpha beta gamma delta" * 9, "b": b"alpha beta gamma delta" * 9})
    assert same.predict("alpha beta") == ("a", 0.0)
    told = L.Classifier({"a": b" alpha beta gamma delta epsilon ", "b": b" uno dos tres quatro cinco seis "})
    assert told.predict("Uno, dos... TRES cinco seis")[0] == "b"
    assert L.folded("12 ½ ² --") == "" and L.folded("The the THE cat") == "the cat"


def test_a_repetitive_text_is_judged_by_all_its_words(spark):
    """One English sentence many times, then a German passage: by distinct words alone, the passage would decide."""
    docs = documents(spark).where("lang IN ('en', 'de')")
    learned = L.fit(docs, ~L.is_held_out(F.col("id")))
    words = {lang: " ".join(r["text"] for r in docs.where((F.col("lang") == lang) & L.is_held_out(F.col("doc_id")) & F.col("text").isNotNull()).orderBy("doc_id").limit(20).collect())
             for lang in ("en", "de")}
    sentence, passage = " ".join(L.folded(words["en"]).split()[:10]), " ".join(L.folded(words["de"]).split()[:60])
    classifier = L.Classifier({k: v for d in L.dictionaries(learned) for k, v in d.items()})
    assert classifier.predict(passage)[0] == "de" and classifier.predict(L.folded(f"{sentence} {passage}"))[0] == "de"
    name, margin = classifier.predict(f"{sentence}. " * 440 + passage)
    assert name == "en" and margin >= L.MIN_MARGIN
    assert L.lowered("The the THE cat, 12") == "the the the cat" and L.lowered("12 ½ --") == ""


def test_against_a_plain_loop_over_the_dictionaries(spark):
    """Every verdict, also with the languages in several blocks."""
    import zstandard

    docs = documents(spark).limit(150)
    held = {k: v for d in L.dictionaries(L.fit(documents(spark), ~L.is_held_out(F.col("id")))) for k, v in d.items()}
    want = {}
    for r in docs.collect():
        line = L.lowered(r["text"]).encode()
        if not line:
            want[r["doc_id"]] = ("und", 0.0)
            continue
        sizes = []
        for name, content in held.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=L.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            padded = b" " + line + b" "
            sizes.append((sum(len(c.compress(padded[i : i + L.BLOCK])) for i in range(0, len(padded), L.BLOCK)), name))
        sizes.sort()
        want[r["doc_id"]] = (sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict_language(documents(spark)).collect() if r["doc_id"] in want}
    assert got == want


def test_every_language_is_learned_and_blocks_agree(spark, monkeypatch):
    """300 languages, most of one document; verdicts do not depend on how many are held at a time."""
    import random

    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocab = {f"l{k}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(30)] for k in range(300)}
    text = lambda k: " ".join(rng.choice(vocab[k]) for _ in range(80))
    rows = [(i, text(f"l{i % 300}"), f"l{i % 300}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = L.fit(docs, ~L.is_held_out(F.col("id")))
    names = {k for d in L.dictionaries(path) for k in d}
    assert len(names) > 280 and max(len(d) for d in L.dictionaries(path)) <= L.LANG_BLOCK
    got = L.predict_language(docs).collect()
    held = [r for r in got if r["held_out"] and f"l{r['doc_id'] % 300}" in names]
    assert sum(r["lang_pred"] == f"l{r['doc_id'] % 300}" for r in held) / len(held) > 0.95


def test_excerpts_come_from_anywhere_in_a_text(spark):
    """A header without letters, however long, does not keep a text from teaching."""
    docs = spark.createDataFrame([(i, "0123 " * 400 * (i % 3) + " ".join(f"word{chr(97 + i % 20)}" for _ in range(2_000)), "en") for i in range(40)], "doc_id long, text string, lang string")
    content = next(L.dictionaries(L.fit(docs, F.lit(True))))["en"]
    assert len(set(content.split())) > 15 and len(content) <= L.DICT_BYTES
