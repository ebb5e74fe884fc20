"""Operator 9, benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of all test items.  A document's words
are streamed through it while the length of the longest match that ends at
each word is tracked: where it reaches ``window`` words, the last ``window``
words stand in some item.  An item of fewer words counts where all of it stands.

Test items are dealt, in ranges, into blocks of at most ``block_words`` words;
the task that meets a block builds its automaton and writes it to the shared
folder, so the driver holds names of files only.  Documents are read once: a
task runs a batch of them through one block's automaton after the other, of
which it holds a bounded number.  An item above ``block_words`` words is dealt
in pieces that overlap by ``window - 1`` words, so each of its windows stands
in some piece.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import PlacedFile, numbered, pick, position, restored, scratch_path, shared_folder

#: Words are runs of a-z, 0-9 and everything beyond ASCII; A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isdigit() or 97 <= c <= 122 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")
WINDOW, BLOCK_WORDS = 10, 200_000


class Automaton:
    """Suffix automaton of several word sequences, with what is needed to name the items whose windows end in a state."""

    def __init__(self, items: Iterable[tuple[str, bytes | None]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: list[tuple[str, list[int]]] = []
        shorts: dict[int, set[str]] = {}
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in (text or b"").translate(FOLD).split()]
            if words:
                last = 0
                for w in words:
                    last = self._add(last, w)
                ends.append((name, words))
                if len(words) < window:
                    shorts.setdefault(last, set()).add(name)
        n = len(self.next)
        self.shortest = min([window, *(self.length[s] for s in shorts)])
        # of each state that a window's words may end in: the state that holds just those words
        self.home, self.short = [0] * n, [()] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[s]
            self.home[s] = 0 if self.length[s] < window else s if self.length[up] < window else self.home[up]
            # (length, items) of the short items that are suffixes of the state's words
            self.short[s] = self.short[up] + (((self.length[s], frozenset(shorts[s])),) if s in shorts else ())
        self.items: dict[int, set[str]] = {}
        for name, words in ends:
            for _, state, length in self._walk(words, 0):
                if length >= window:
                    self.items.setdefault(self.home[state], set()).add(name)

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.link.append(0 if like is None else self.link[like])
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of p's longest words followed by w, cut out of q if q holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._new(self.length[p] + 1, q)
        self.link[q] = own
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = own
            p = self.link[p]
        return own

    def _add(self, last: int, w: int) -> int:
        if w in self.next[last]:  # another item has these words
            return self._split(last, w, self.next[last][w])
        state, p = self._new(self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, w, self.next[p][w])
        return state

    def _walk(self, words: Iterable[int], at: int) -> Iterator[tuple[int, int, int]]:
        """(position, state, matched length) after each word."""
        state = length = 0
        for i, w in enumerate(words, at):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state, length = self.next[state][w], length + 1
            yield i, state, length

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words stand inside an occurrence of a window (None: none), and the items whose windows occur."""
        ids = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        # a word that no item has ends every match, so only long enough runs between such words are walked
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]]).astype(np.int8)))
        marks, found = None, set()
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i < self.shortest:
                continue
            for at, state, length in self._walk(ids[i:j].tolist(), i):
                if length >= self.window:
                    cover = self.window
                    found |= self.items[self.home[state]]
                else:
                    cover = 0
                for size, names in self.short[state]:
                    if size <= length:
                        cover, found = max(cover, size), found | names
                if cover:
                    if marks is None:
                        marks = np.zeros(len(words), bool)
                    marks[at - cover + 1 : at + 1] = True
        return marks, found


def cut(text: bytes, marks: np.ndarray) -> bytes:
    """The text without the spans of marked words, each replaced by a line break."""
    spans = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks, [0]]).astype(np.int8)))
    kept, at = [], 0
    for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept.append(text[at : spans[i][0]])
        at = spans[j - 1][1]
    return b"\n".join([*kept, text[at:]])


def pieces(text: bytes, window: int, block_words: int) -> Iterator[tuple[int, bytes]]:
    """``(words, text)`` of the text, or, above ``block_words`` words, of pieces that hold each window of it; none without words."""
    spans = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    if len(spans) <= block_words:
        if spans:
            yield len(spans), text
        return
    for at in range(0, len(spans) - window + 1, block_words - window + 1):
        piece = spans[at : at + block_words]
        yield len(piece), text[piece[0][0] : piece[-1][1]]


#: Blocks that one task builds, about; automata that a worker keeps.
BLOCKS_A_TASK, KEPT_AUTOMATA = 8, 2
#: Texts whose words are held at a time.
SLICE = 256


def automata(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS, window: int = WINDOW) -> list[str]:
    """The files of the items' automata, each of at most ``block_words`` words; an item without words is left out.

    Items go by name and text; a task takes a range of them, fills block after
    block and writes their automata, so no block passes through the driver.
    An item above ``block_words`` words is dealt in :func:`pieces` under its
    one name.  Raises ValueError where a block could not hold a window."""
    if block_words < window:
        raise ValueError(f"block_words is {block_words}; a window has {window} words")
    spark = benchmark.sparkSession
    folder = scratch_path(spark, "automata")
    rows = pick(benchmark, item=item, txt=text).select(F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"), F.col("txt").cast("binary").alias("txt")).where("txt IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("txt"))).first()[0] or 0  # a word is two bytes at least, with what parts it from the next
    tasks = max(1, -(-size // (2 * block_words * BLOCKS_A_TASK)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, part, made = [], 0, 0, []

        def write() -> None:
            file = PlacedFile(folder, f"{part:05d}-{len(made):05d}.pickle")
            file.out.write(pickle.dumps(Automaton(block, window), pickle.HIGHEST_PROTOCOL))
            file.close()
            made.append(file.name.rsplit("/", 1)[1])

        for b in batches:
            for number, name, raw in zip(*(c.to_pylist() for c in b.columns)):
                part = number
                for n, piece in pieces(raw, window, block_words):
                    if words + n > block_words:
                        write()
                        block, words = [], 0
                    block.append((name, piece))
                    words += n
        if block:
            write()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["name"])

    ranged = rows.repartitionByRange(tasks, "item", "txt").sortWithinPartitions("item", "txt").select(F.spark_partition_id().alias("part"), "item", "txt")
    names = ranged.mapInArrow(build, "name string").collect()  # a name for each block
    return [f"{folder}/{r['name']}" for r in sorted(names)]


@functools.lru_cache(KEPT_AUTOMATA)
def loaded(file: str) -> Automaton:
    fs, path = shared_folder(file)
    with fs.open_input_stream(path) as f:
        return pickle.loads(f.read())


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(key, n_words, n_hit, items)`` for every row of ``docs``: hit words, and the ids of the items found, sorted as strings.

    Null texts have no words; null item ids are called ``null``; repeated
    items count once, repeated rows each get their row; an empty table gives an
    empty result, an empty benchmark finds nothing.  Whole texts are read;
    other columns are not."""
    rows = pick(docs, id=key, txt=text)
    files = automata(benchmark, item, item_text, block_words, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # words of few texts at a time, unless that would load files again for each few
            some = SLICE if len(files) <= KEPT_AUTOMATA else max(len(whole), 1)
            for at in range(0, len(whole), some):
                b = whole.slice(at, some)
                words = [(raw or b"").translate(FOLD).split() for raw in _texts(b.column(1))]
                hit: dict[int, np.ndarray] = {}
                items: dict[int, set[str]] = {}
                for file in files:
                    automaton = loaded(file)
                    for i, w in enumerate(words):
                        marks, found = automaton.hits(w)
                        if marks is not None:
                            hit[i] = hit[i] | marks if i in hit else marks
                            items.setdefault(i, set()).update(found)
                n_hit = [int(hit[i].sum()) if i in hit else 0 for i in range(len(b))]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, words), pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(items.get(i, ())) for i in range(len(b))], pa.list_(pa.string()))],
                                                 ["id", "n_words", "n_hit", "items"])

    found = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_hit long, items array<string>")
    return found.select(F.col("id").alias(key), "n_words", "n_hit", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` with the spans of hit words cut out of their texts, columns as they are.

    A row of which more than ``max_coverage`` of the words are cut goes
    altogether.  Cutting is repeated until no window is left, also none over a
    cut.  Rows without hits, null and empty texts included, are left as they
    are; repeated rows are treated alike, an empty table stays empty, and an
    empty benchmark cuts nothing.  The texts are read and written once."""
    rows, _ = numbered(docs, txt=text)
    own = f"c{position(docs, text)}"  # the text travels once, as txt
    rows = rows.withColumns({own: F.lit(None).cast("string"), "total": F.lit(0).cast("long"), "gone": F.lit(0).cast("long")})
    files = automata(benchmark, item, item_text, block_words, window)
    width, kind = len(rows.columns) - 3, rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column(width))
            totals = [len((raw or b"").translate(FOLD).split()) for raw in texts]
            gone, todo = [0] * len(b), list(range(len(b)))
            while todo:  # a cut for one block may have made a window of another
                again = set()
                for file in files:
                    automaton = loaded(file)
                    for i in todo:
                        marks, _ = automaton.hits((texts[i] or b"").translate(FOLD).split())
                        while marks is not None:
                            texts[i] = cut(texts[i], marks)
                            gone[i] += int(marks.sum())
                            again.add(i)
                            marks, _ = automaton.hits(texts[i].translate(FOLD).split())
                todo = sorted(again) if len(files) > 1 else []
            new = [pa.array(texts, pa.binary()).cast(b.column(width).type), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *new], names=b.schema.names)

    rows = rows.mapInArrow(run, kind)
    return restored(rows.where(F.col("gone") <= F.col("total") * max_coverage), docs, **{text: "txt"})
