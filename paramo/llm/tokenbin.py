"""Operator 5, token ids in binary shards with keyed access.

File format, in one folder:

``payload/00012.bin``
    The ids of shard 12's documents, one after the other in ascending order of
    keys, each id as ``width`` bytes, little-endian; a document's ids end with
    the end id.  Shards follow each other in the order of keys.
``index/00003.npz``
    The keys whose hash falls to part 3, in a minimal perfect hash: levels of
    bit arrays, where a key's rank among the set bits of the level that
    settles it is its slot, and arrays by slot of the key's fingerprint, shard,
    offset in the shard and length (in ids).  A lookup costs a few probes
    whatever the size; a fingerprint that differs tells an unknown key.

A row's key in the index is its number and how many rows with that number
stand before it, so rows that share a number are found one by one.  Files are
written under a name of their own and then moved into place, so a task that
runs twice leaves one whole file.
"""

from __future__ import annotations

import functools
import io
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import PlacedFile, pick, shared_folder, store

#: Chunks of text whose ids a worker remembers; bytes of text a shard holds, about; keys an index part holds, about.
REMEMBER, SHARD_BYTES, PART_KEYS = 800_000, 64 << 20, 250_000
#: Before one of these signs and after a Latin letter that normalising and lower-casing leave a letter, tokenizers that part letters from signs always part (UTF-8: A-Z, a-z, U+00C0 to U+017F without signs and dotted I).
PARTED = re.compile(rb"(?=[.,;:!?#$%&*])(?:(?<=[A-Za-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])|(?<=\xc4[\x80-\xaf\xb1-\xbf])|(?<=\xc5[\x80-\xbf]))")
#: Texts that are encoded together; rows of one number that are asked for together.
SLICE, ASKED = 256, 10_000
NULL_KEY = -(2**63)


# ---------------------------------------------------------------- encoding

class Encoder:
    """Encodes like ``Tokenizer.encode(text, add_special_tokens=False)``, remembering chunks.

    With a tokenizer that drops ASCII white space, joins nothing across it and
    parts letters from signs (``chunked``), a text's ids are those of its
    white-space separated chunks, cut once more where :data:`PARTED` tells; of
    any other, whole texts are encoded."""

    def __init__(self, path: str, width: int, chunked: bool = True):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.get_vocab_size() > 256**width:
            raise ValueError(f"ids of {path} do not fit {width} bytes")
        self.encode, self.width, self.chunked, self.known = tokenizer.encode_batch_fast, width, chunked, {}
        # ASCII letters alone need only be lower-cased and merged, where the tokenizer shows that this is all it does to them
        self.merge = tokenizer.model.tokenize
        self.plain = chunked and all(tokenizer.encode(w, add_special_tokens=False).ids == self.merged(w) for w in ("Zqxwvuts", "internationalISATION", "A", "the"))

    def merged(self, word: str) -> list[int]:
        return [t.id for t in self.merge(word.lower())]

    def written(self, ids: list[int]) -> bytes:
        """The ids as little-endian numbers."""
        return np.array(ids, f"<u{self.width}").tobytes() if self.width not in (2, 4) or LITTLE is False else array(TYPES[self.width], ids).tobytes()

    def __call__(self, texts: list[bytes], end: int) -> list[bytes]:
        chunks = [PARTED.sub(b" ", t).split() if self.chunked else [t] for t in texts]
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        new = set().union(*chunks).difference(known)
        if self.plain:
            letters = [c for c in new if c.isalpha()]  # of bytes: ASCII letters
            known.update((c, self.written(self.merged(c.decode()))) for c in letters)
            new.difference_update(letters)
        new = list(new)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            known.update(zip(part, [self.written(e.ids) for e in self.encode([c.decode() for c in part], add_special_tokens=False)]))
        last = self.written([end])
        return [b"".join([*map(known.__getitem__, c), last]) for c in chunks]


#: Native arrays write little-endian numbers here, faster than numpy writes few.
TYPES, LITTLE = {2: "H", 4: "I"}, array("H", [1]).tobytes() == b"\x01\x00" and array("I").itemsize == 4


@functools.lru_cache(2)
def encoder(path: str, width: int, chunked: bool) -> Encoder:
    """One for each worker process, so that its tasks share what it remembers."""
    return Encoder(path, width, chunked)


# ------------------------------------------------- minimal perfect hashing

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key and the seed; a key is a number, or a row of two."""
    if keys.ndim == 2:
        return mixed(mixed(keys[:, 0], seed).view(np.int64) + keys[:, 1], seed + 1)
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Levels of bit arrays: a key is settled on the first level where no other key of that level has its bit."""

    GAMMA = 1.5

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.ranks, total = levels, [], 0
        for bits in levels:
            counts = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())
        self.size = total

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        levels, left = [], keys
        while len(left):
            words = max(1, int(np.ceil(cls.GAMMA * len(left) / 64)))
            at = mixed(left, len(levels)) % np.uint64(words * 64)
            alone = np.bincount(at.astype(np.int64), minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, distinct and below ``size`` for the keys it was made of; -1 or any slot for others."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for seed, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = (mixed(keys[todo], seed) % np.uint64(len(bits) * 64)).astype(np.int64)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = ranks[at[hit] >> 6] + below[hit]
            todo = todo[~hit]
        return out


FINGERPRINT_SEED = 1 << 20


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")


class IndexPart:
    """One part of the index: a perfect hash and the arrays by slot."""

    def __init__(self, levels: list[np.ndarray], arrays: dict[str, np.ndarray]):
        self.hash, self.arrays = PerfectHash(levels), arrays

    @classmethod
    def of(cls, keys: np.ndarray, **values: np.ndarray) -> IndexPart:
        hashed = PerfectHash.of(keys)
        order = np.empty(len(keys), np.int64)
        order[hashed.slots(keys)] = np.arange(len(keys))
        return cls(hashed.levels, {"mark": fingerprint(keys)[order]} | {k: v[order] for k, v in values.items()})

    def save(self, out) -> None:
        box = io.BytesIO()
        np.savez(box, **self.arrays, **{f"level{i}": x for i, x in enumerate(self.hash.levels)})
        out.write(box.getvalue())

    @classmethod
    def load(cls, raw: bytes) -> IndexPart:
        with np.load(io.BytesIO(raw)) as z:
            levels = sorted((x for x in z.files if x.startswith("level")), key=lambda x: int(x[5:]))
            return cls([z[x] for x in levels], {x: z[x] for x in z.files if not x.startswith("level")})

    def get(self, keys: np.ndarray) -> dict[str, np.ndarray]:
        """The values by key, and ``known``: whether the slot's fingerprint is the key's."""
        slots = self.hash.slots(keys)
        safe = np.maximum(slots, 0)
        if not self.hash.size:
            return {"known": np.zeros(len(keys), bool)} | {k: np.zeros(len(keys), v.dtype) for k, v in self.arrays.items()}
        return {"known": (slots >= 0) & (self.arrays["mark"][safe] == fingerprint(keys))} | {k: v[safe] for k, v in self.arrays.items()}


# ------------------------------------------------------------ Spark jobs

def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", width: int = 2, chunked: bool = True,
                 shard_bytes: int = SHARD_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """Write the payload and index of ``docs`` to ``folder``; ``(shard, base, ids)`` of each shard, ``base`` ids being before it.

    Rows go by key, null keys first, and rows that repeat a key by a hash of
    the text, so that a key with a third of all rows is spread over shards;
    each of them has its entry in the index.  Null keys are written as the
    smallest 64-bit number, which reads back as null.  Null texts have the end
    id only.  An empty table writes an empty index and no payload.  Columns
    other than key and text are not read."""
    rows = pick(docs, id=key, txt=text).select(F.coalesce(F.col("id").cast("long"), F.lit(NULL_KEY)).alias("id"), F.coalesce("txt", F.lit("")).alias("txt"))
    size = rows.agg(F.sum(F.octet_length("txt") + 1)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, placed, at, shard = encoder(tokenizer, width, chunked), None, 0, -1
        last, seen = None, 0  # rows of the last key so far
        for b in batches:
            if not len(b):
                continue
            if placed is None:
                shard = b.column(0)[0].as_py()
                placed = PlacedFile(f"{folder}/payload", f"{shard:05d}.bin")
            texts, ids = b.column(2).cast(pa.binary()), b.column(1).to_numpy()
            # few texts at a time: their chunks are many small objects
            coded = [x for at_row in range(0, len(texts), SLICE) for x in encode(texts.slice(at_row, SLICE).to_pylist(), end)]
            n = np.fromiter(map(len, coded), np.int64, len(coded)) // width
            placed.out.write(b"".join(coded))
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            k = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:
                k[: first[1] if len(first) > 1 else len(ids)] += seen
            last, seen = ids[-1], int(k[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard)), b.column(1), pa.array(k), pa.array(at + np.cumsum(n) - n), pa.array(n)], ["shard", "id", "k", "at", "n"])
            at += int(n.sum())
        if placed is not None:
            placed.close()

    order = ["id", "mark", "tie"]
    ranged = rows.withColumns({"mark": F.xxhash64("txt"), "tie": F.monotonically_increasing_id()}).repartitionByRange(shards, *order).sortWithinPartitions(*order)
    told = store(ranged.select(F.spark_partition_id().cast("long").alias("shard"), "id", "txt").mapInArrow(write, "shard long, id long, k long, at long, n long"), "token-spans")
    # a key that goes on in the next shard counts on there: only a shard's first and last key can
    ends = told.groupBy("shard").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    edge = told.join(ends, "shard").where((F.col("id") == F.col("lo")) | (F.col("id") == F.col("hi"))).groupBy("id", "shard").agg(F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(W.partitionBy("id").orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("here")
    goes_on = store(edge.withColumn("before", before).where("before > 0").select("id", "shard", "before"), "token-edges")  # a row a shard at most
    entries = told.join(goes_on, ["id", "shard"], "left").withColumn("k", F.col("k") + F.coalesce("before", F.lit(0)))
    parts = max(1, -(-told.count() // part_keys))

    def index(batch: pa.Table) -> pa.Table:
        part = batch.column("part")[0].as_py()
        values = {c: batch.column(c).to_numpy() for c in ("shard", "at", "n")}
        placed = PlacedFile(f"{folder}/index", f"{part:05d}.npz")
        IndexPart.of(np.column_stack([batch.column("id").to_numpy(), batch.column("k").to_numpy()]), **values).save(placed.out)
        placed.close()
        return pa.table({"part": [part], "keys": [len(batch)]})

    cells = entries.select("id", "k", "shard", "at", "n", F.pmod(F.xxhash64("id", "k"), F.lit(parts)).alias("part"))
    store(cells.groupBy("part").applyInArrow(index, "part long, keys long"), "token-index")
    # one row a shard
    totals = told.groupBy("shard").agg(F.sum("n").alias("ids"))
    base = F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("ids")
    return store(totals.select("shard", base.alias("base"), "ids").withColumn("parts", F.lit(parts)), "token-shards")


def read_tokens(keys: DataFrame, folder: str, shards: DataFrame, key: str = "doc_id", width: int = 2) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of each row of ``keys`` that the index knows, from the files in ``folder``.

    A key that stands in several rows asks for as many documents of that key.
    ``start`` counts the ids of all documents before it; ``ids_crc32`` is
    taken over the ids as little-endian unsigned 32-bit integers."""
    first = shards.select("parts").first()
    parts = first["parts"] if first else 1
    wanted = pick(keys, id=key).select(F.coalesce(F.col("id").cast("long"), F.lit(NULL_KEY)).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    # the rows of a key in two steps, as they may be very many
    runs = wanted.select("id", "rows", F.explode(F.expr(f"sequence(0, rows - 1, {ASKED})")).alias("begin")).repartition("id", "begin")
    asked = runs.select("id", F.explode(F.expr(f"sequence(begin, least(rows, begin + {ASKED}) - 1)")).alias("k"))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", "k"), F.lit(parts)))

    def look_up(batch: pa.Table) -> pa.Table:
        fs, base = shared_folder(folder)
        with fs.open_input_stream(f"{base}/index/{batch.column('part')[0].as_py():05d}.npz") as f:
            part = IndexPart.load(f.read())
        ids = batch.column("id").to_numpy()
        got = part.get(np.column_stack([ids, batch.column("k").to_numpy()]))
        known = got["known"]
        return pa.table({"id": ids[known], **{c: got[c][known].astype(np.int64) for c in ("shard", "at", "n")}})

    found = asked.groupBy("part").applyInArrow(look_up, "id long, shard long, at long, n long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, base), opened, payload = shared_folder(folder), None, None
        for b in batches:
            ids, shard, at, n = (b.column(i).to_pylist() for i in range(4))
            crc = []
            for s, i, k in zip(shard, at, n):
                if s != opened:
                    payload, opened = fs.open_input_file(f"{base}/payload/{s:05d}.bin"), s
                raw = payload.read_at(k * width, i * width)
                crc.append(zlib.crc32(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(crc, pa.int64())], ["id", "shard", "at", "n", "crc"])

    ordered = found.repartition("shard").sortWithinPartitions("shard", "at")
    told = ordered.mapInArrow(read, "id long, shard long, at long, n long, crc long").join(shards.select("shard", "base"), "shard")
    named = F.when(F.col("id") != NULL_KEY, F.col("id")).alias(key)
    return told.select(named, (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

