"""Operator 11, token counts by the whole-token shortcut.

A byte-level BPE tokenizer parts a text at its special strings, then by a
pattern into pre-tokens, and merges each pre-token by itself.  So what a
pre-token costs depends on nothing around it, and:

1. Offline, once, every vocabulary string is encoded alone
   (:func:`proven`).  Those that come out as their own single id are whole
   tokens: a pre-token that equals one costs 1, without merging.
2. Tasks part whole texts into pre-tokens, count the whole ones directly and
   merge only the rest, remembering a bounded number of costs.

A single space between two other characters always begins a pre-token, so what
stands between two such spaces costs the same wherever it stands: texts are
cut there first and the costs of these words are remembered too.

The proven strings are broadcast: at most the vocabulary, under 2 MB.  The
pattern engine used here knows newer characters than the library's; a text
with a character that Python's older table leaves unassigned is parted by the
library instead, so both ways give the library's pre-tokens.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from operator import methodcaller

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import pick

#: Tokens from which on a text is over the limit; costs of merged pre-tokens that a worker remembers, and the longest such pre-token.
LIMIT, REMEMBER, LONGEST = 1024, 500_000, 64
#: Characters of a text that are cut into words at a time, about.
SLICE = 1 << 20
#: How byte-level tokenizers part a text (a fixed value): contractions, words, numbers, other signs, white space.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load(path: str):
    """The tokenizer of a ``.json`` file and its special strings; ValueError unless it is the kind that this operator can count."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    split, model = told["pre_tokenizer"] or {}, told["model"]
    marks = told["added_tokens"]
    plain = not any(m["single_word"] or m["lstrip"] or m["rstrip"] or m["normalized"] for m in marks)
    if told["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or model["type"] != "BPE" or model["dropout"] or not plain:
        raise ValueError(f"{path} is no byte-level BPE tokenizer without normaliser and prefix space")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [m["content"] for m in marks]


def proven(path: str) -> list[str]:
    """The vocabulary strings that encode alone as one token, their own: what a pre-token may equal to cost 1."""
    tokenizer, marks = load(path)
    known = {i: tokenizer.decode([i], skip_special_tokens=False) for i in tokenizer.get_vocab(with_added_tokens=False).values()}
    alone = tokenizer.encode_batch_fast(list(known.values()), add_special_tokens=False)
    return [s for (i, s), e in zip(known.items(), alone) if e.ids == [i] and s not in marks]


def unassigned() -> re.Pattern:
    """Matches a character that Python's table leaves unassigned, on which pattern engines may differ."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        free = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if free and start is None:
            start = c
        elif not free and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


#: A white space beside a space; a space that begins a pre-token for certain; a character beyond the first that is unassigned.
LOOSE, TIGHT, BEYOND = re.compile(r" \s|\s "), re.compile(r"(?<=\S)(?= \S)"), re.compile("[^\x00-\u0377]")


class Words(dict):
    """Costs by word, as far as they fit; others are made anew."""

    def __init__(self, made):
        super().__init__()
        self.made = made

    def __missing__(self, word: str) -> int:
        n = self.made(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts like ``len(Tokenizer.encode(text, add_special_tokens=False))``."""

    def __init__(self, path: str, whole: list[str]):
        tokenizer, marks = load(path)
        self.part, self.merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        # of special strings that begin alike the longest is taken, as the library does
        self.marks = re.compile("|".join(map(re.escape, sorted(marks, key=len, reverse=True)))) if marks else None
        self.parts, self.plain, self.odd = regex.compile(PARTS).finditer, re.compile(PARTS.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+"), re.ASCII).finditer, unassigned().search
        self.whole = frozenset(whole)
        self.rest, self.after, self.first = Words(self.merged), Words(lambda word: self.word(" " + word)), Words(self.word)
        # the characters that stand for bytes, learned from the library
        self.letters = {}
        for c in map(chr, [*range(0x80), *range(0x80, 0x800, 0x20), *range(0x80, 0xC0), *range(0x800, 0xD800, 0x800), *range(0xE000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]):
            self.letters.update(zip(c.encode(), "".join(x for x, _ in self.part(c))))

    def merged(self, piece: str) -> int:
        """Tokens of one pre-token that is not proven whole."""
        return len(self.merge(piece.encode().decode("latin-1").translate(self.letters)))

    def cost(self, piece: str) -> int:
        """Tokens of one pre-token."""
        return 1 if piece in self.whole else self.rest[piece]

    def pieces(self, text: str) -> Iterator[str]:
        """The pre-tokens of a text without special strings and without unassigned characters."""
        return map(methodcaller("group"), (self.plain if text.isascii() else self.parts)(text))

    def word(self, text: str) -> int:
        if text in self.whole:
            return 1
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):  # letters are one pre-token
            return self.rest[text]
        return sum(map(self.cost, self.pieces(text)))

    def between(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii() and BEYOND.search(text) and self.odd(text):
            return sum(self.cost(text[a:b]) for _, (a, b) in self.part(text))
        n = at = 0
        while at < len(text):
            cut = TIGHT.search(text, at + SLICE) if len(text) - at > SLICE else None
            here, at = (text[at : cut.start()], cut.start()) if cut else (text[at:], len(text))
            if LOOSE.search(here):
                n += sum(map(self.first.__getitem__, TIGHT.split(here)))
            else:
                word, *words = here.split(" ")
                n += self.first[word] + sum(map(self.after.__getitem__, words))
        return n

    def __call__(self, text: str) -> int:
        if self.marks is None or not self.marks.search(text):
            return self.between(text)
        parts = self.marks.split(text)
        return len(parts) - 1 + sum(map(self.between, parts))


@functools.lru_cache(2)
def _counter(path: str, whole) -> Counter:
    """One for each worker process, so that its tasks share what it remembers; ``whole`` is the broadcast of the proven strings."""
    return Counter(path, whole.value)


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for every row of ``docs``, as the tokenizers library counts whole texts.

    ``tokenizer`` is the path of a byte-level BPE ``.json`` file, the same on
    all machines.  No begin, end or added special tokens count; special
    strings inside a text are one token each.  Null and empty texts have no
    tokens; repeated rows and null keys get their row each; an empty table
    gives an empty result.  Texts are read whole, however long, a pre-token at
    a time; other columns are not read."""
    rows = pick(docs, id=key, txt=text).select("id", F.coalesce("txt", F.lit("")).alias("txt"))
    whole = docs.sparkSession.sparkContext.broadcast(proven(tokenizer))  # at most the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer, whole)
        for b in batches:
            texts = b.column(1)
            n_bytes = pa.array([len(x.as_buffer()) for x in texts.cast(pa.binary())], pa.int64())
            n_tokens = [count(x.as_py()) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                                             ["id", "n_bytes", "n_tokens", "over_limit"])

    counted = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", key)
