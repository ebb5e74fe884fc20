"""Operator 3, language identification by compression.

For each language a raw-content zstandard dictionary is filled with words of
a bounded sample of its texts, each folded to its distinct lower-case words.
A text to be judged is encoded whole, all its lower-case words in their order
and number, block by block with every dictionary, and given the language whose
total is smallest.  The score is the margin, the share by which the
smallest total is below the second; a narrow margin means: rejected.

What is learned is bounded by parameters: ``SAMPLE_DOCS`` documents of a
language, ``EXCERPT`` bytes of each, taken from a hashed place of the text;
together they fill a dictionary of ``DICT_BYTES``.  Every language is learned,
however rare and however many there are: the dictionaries are a table in the
shared folder, and tasks hold ``LANG_BLOCK`` of them at a time.  Prediction
reads whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import numbered, pick, position, restored, scratch_path, shared_folder, store

SAMPLE_DOCS, EXCERPT = 128, 512
DICT_BYTES, LANG_BLOCK = SAMPLE_DOCS * EXCERPT, 64
#: Level 9 of the compressor finds the short matches that tell languages apart; blocks of 1,024 bytes keep a text from being its own dictionary.
LEVEL, BLOCK = 9, 1_024
MIN_MARGIN = 0.003
NOT_LETTERS = re.compile(r"[\W\d_]+")


def lowered(text: str | None) -> str:
    """All lower-case words as they follow each other, between single spaces; empty if there is no letter."""
    line = " ".join(NOT_LETTERS.sub(" ", (text or "").lower()).split())
    return line if any(map(str.isalpha, line)) else ""


def folded(text: str | None) -> str:
    """The distinct words of :func:`lowered`, in order of appearance; what dictionaries are filled with."""
    return " ".join(dict.fromkeys(lowered(text).split()))


def fit(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> str:
    """The path of a table ``(lang, content)``: a dictionary for each language, from rows for which ``train`` (a condition on the key, called ``id``) holds.

    Rows without key, text or language are left out.  The documents of a
    language with the smallest hashes are its sample; a first cut by hash
    keeps the ranking of a language with most of the rows small."""
    rows = pick(docs, id=key, txt=text, lang=lang).where(train & F.col("txt").isNotNull() & F.col("lang").isNotNull())
    draw = F.xxhash64("id", F.lit("language sample"))
    # a row for each language, which the planner broadcasts if it is small
    counts = store(rows.groupBy("lang").count().withColumnRenamed("lang", "of"), "lang-counts")
    near = rows.join(counts, F.col("lang") == F.col("of"))
    near = near.where(F.pmod(draw, F.lit(1_000_000)) <= 1_000_000 * 2.0 * SAMPLE_DOCS / F.col("count"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(draw, "txt"))
    # enough characters from a hashed place on to find an excerpt's distinct words among
    start = F.pmod(F.xxhash64("id", F.lit("place")), F.greatest(F.length("txt") - 8 * EXCERPT, F.lit(0)) + 1)
    chosen = near.select("lang", place.alias("place"), start.alias("start"), F.substr("txt", (start + 1).cast("int"), F.lit(8 * EXCERPT)).alias("txt")).where(F.col("place") <= SAMPLE_DOCS)

    def fill(group: pa.Table) -> pa.Table:
        texts = []
        for at, start, txt in sorted(zip(*(group.column(c).to_pylist() for c in ("place", "start", "txt")))):
            words = folded(txt).split(" ")
            # what begins within a text may begin within a word
            texts.append(" ".join(words[1:] if start else words).encode()[: EXCERPT - 1].decode("utf-8", "ignore"))
        return pa.table({"lang": [group.column("lang")[0].as_py()], "content": [" ".join(texts).encode()[:DICT_BYTES]]}, pa.schema([("lang", pa.string()), ("content", pa.binary())]))

    path = scratch_path(docs.sparkSession, "lang-dictionaries")
    filled = chosen.withColumn("lang", F.col("lang").cast("string")).groupBy("lang").applyInArrow(fill, "lang string, content binary")  # SAMPLE_DOCS excerpts a language at most
    filled.where(F.octet_length("content") >= 8).write.parquet(path)
    return path


def dictionaries(path: str) -> Iterator[dict[str, bytes]]:
    """The dictionaries of a table that :func:`fit` wrote, ``LANG_BLOCK`` languages at a time."""
    fs, base = shared_folder(path)
    kind = pa.schema([("lang", pa.string()), ("content", pa.binary())])
    for batch in pa.dataset.dataset(base, filesystem=fs, format="parquet", schema=kind).to_batches(batch_size=LANG_BLOCK):
        if len(batch):
            yield dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))


class Classifier:
    """Some languages' dictionaries as compressors."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.coders = []
        for name, content in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress))

    def best(self, line: bytes) -> list[tuple[int, str]]:
        """The two smallest total sizes with their languages; fewer if there are fewer."""
        line = b" " + line + b" "
        blocks = [line[i : i + BLOCK] for i in range(0, len(line), BLOCK)]
        return sorted((sum(len(code(b)) for b in blocks), name) for name, code in self.coders)[:2]

    def predict(self, text: str | None) -> tuple[str, float]:
        line = lowered(text).encode()
        return verdict(line, self.best(line) if line else [])


def verdict(line: bytes, best: list[tuple[int, str]]) -> tuple[str, float]:
    """Language and margin from the two smallest sizes."""
    if not line or not best:
        return "und", 0.0
    return best[0][1], 1.0 if len(best) == 1 else (best[1][0] - best[0][0]) / best[1][0]


def identified(rows: DataFrame, path: str, keep_text: bool = False) -> DataFrame:
    """``rows`` with lang_pred and score from their column ``txt``, which becomes null unless ``keep_text``."""
    at, names = rows.columns.index("txt"), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Classifier] = []
        for b in batches:
            lines = [lowered(t.as_py()).encode() for t in b.column(at)]
            best: list[list[tuple[int, str]]] = [[] for _ in lines]
            # one block of languages stays as it is; of several, one is held at a time
            blocks = iter(held) if held else map(Classifier, dictionaries(path))
            n = 0
            for classifier in blocks:
                n += 1
                last = classifier
                best = [sorted(was + classifier.best(line))[:2] if line else was for was, line in zip(best, lines)]
            if n == 1:
                held = [last]
            found = [verdict(line, x) for line, x in zip(lines, best)]
            columns = [c if i != at or keep_text else pa.nulls(len(b), c.type) for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], [*names, "lang_pred", "score"])

    kind = rows.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(run, kind)


def is_held_out(key: Column) -> Column:
    """Whether the key's crc32 leaves remainder 1 by 3; rows without a key are held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def predict_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, held_out, lang_pred, score)`` for every row of ``docs``, learned from the rows that are not held out.

    Texts that are null or have no letter get ``und`` and score 0, as do all
    if nothing could be learned; equal totals go to the first language by
    name, with score 0.  Repeated rows are judged alike; an empty table gives an
    empty result; other columns are not read."""
    learned = fit(docs, ~is_held_out(F.col("id")), key, text, lang)
    rows = pick(docs, id=key, txt=text).select("id", is_held_out(F.col("id")).alias("held_out"), "txt")
    return identified(rows, learned).select(F.col("id").alias(key), "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is told with a margin of ``min_margin`` at least, columns as they are.

    Rejected are texts that are null, have no letter, or compress about as
    well with two languages' dictionaries.  Repeated rows are judged alike; an
    empty table stays empty."""
    learned = fit(docs, ~is_held_out(F.col("id")), key, text, lang)
    rows, _ = numbered(docs, txt=text)
    rows = rows.withColumn(f"c{position(docs, text)}", F.lit(None).cast("string"))  # the text travels once, as txt
    found = identified(rows, learned, keep_text=True).where((F.col("lang_pred") != "und") & (F.col("score") >= min_margin))
    return restored(found, docs, **{text: "txt"})
