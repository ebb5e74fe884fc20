"""Queries of the operators over the test tables, and the SQL of those that SQL can express.

Names of the form ``opN_<name>``; every query reads its whole table.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.llm import chat, decontam, exact_dedup, langid, merkle, mixing, negatives, pii, sharding, simhash, tokenbin, tokencount, urlfilter
from paramo.llm.common import scratch_path

#: SimHash: words in a shingle, and the most bits by which linked fingerprints differ.
SHINGLE, RADIUS = 4, 4
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: Text of conversation -7, which holds what templates use as control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests read back from the formatted conversations."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    done = chat.format_chats(rows.unionByName(extra))
    read = done.select("conv_id", "formatted", chat.parsed_turns(F.col("formatted")).alias("turns"),
                       chat.masked_text(F.col("formatted"), F.col("loss")).alias("trained"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=SHINGLE, radius=RADIUS)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token shards and their index, and reads every document back by its key."""
    import public_tokenizers

    docs, folder = _table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")
    shards = tokenbin.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end=2)
    return tokenbin.read_tokens(docs, folder, shards)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, slot and shard of every document, over 64 shards and 6,421 slots."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.size(F.expr(f"filter(base, s -> s.rank = {i})")).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def labelled_urls(pages: DataFrame) -> DataFrame:
    """``(url, label)`` of the pages that a rule judges (1: block): what the classifier learns from."""
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    ruled = pages.select("url", urlfilter.matched_rule(host, path, URL_RULES)["verdict"].alias("verdict"))
    return ruled.where("verdict IS NOT NULL").select("url", (F.col("verdict") == "block").cast("int").alias("label"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    try:
        model = urlfilter.fit(labelled_urls(pages))
    except urlfilter.NoLabelledUrl:  # no page is under a rule: all get the default verdict
        model = None
    return urlfilter.judge(pages, model, URL_RULES)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def tampered(row: dict[str, Column]) -> dict[str, Column]:
    """The fields of a row whose text is lower-cased (A-Z only) where 5 divides the crc32 of its id."""
    chosen = F.crc32(row["doc_id"].cast("string").cast("binary")) % 5 == 0
    return row | {"text": F.when(chosen, F.translate(row["text"], string.ascii_uppercase, string.ascii_lowercase)).otherwise(row["text"])}


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and the verification of a copy of which some rows were tampered with."""
    proofs = merkle.verified(merkle.manifest(_table(spark, sf_dir, "documents"), claim=tampered).proofs)
    digests = [merkle.hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return proofs.withColumnRenamed("hash", "leaf").select(
        F.col("id").alias("doc_id"), *digests, F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, lambda key: key % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_chat": op2_chat,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_token_shards": op5_token_shards,
    "op6_sharding": op6_sharding,
    "op7_personal_data": op7_personal_data,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_mixing": op10_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}

OP1 = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
hashed AS (SELECT doc_id, n, sha256(norm) AS text_sha256 FROM rows)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM hashed WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

OP2 = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
told AS (
  SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn), false) AS goes_on,
         length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS written FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(written + CASE WHEN goes_on THEN 3 ELSE length(role) + 16 END)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""

OP6 = """
WITH RECURSIVE prefs AS (
  SELECT i, ('0x' || substr(md5(printf('offset:shard-%03d', i)), 1, 15))::BIGINT % 6421 AS off,
         ('0x' || substr(md5(printf('skip:shard-%03d', i)), 1, 15))::BIGINT % 6420 + 1 AS skip
  FROM range(64) t(i)),
picks AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, repeat('0', 6421)::BIT AS taken
  UNION ALL
  SELECT turn + 1, s, set_bit(taken, s::INT, 1) FROM (
    SELECT p.turn, p.taken, arg_min((f.off + q.j * f.skip) % 6421, q.j) AS s
    FROM picks p, prefs f, range(6421) q(j)
    WHERE p.turn < 6421 AND f.i = p.turn % 64 AND get_bit(p.taken, ((f.off + q.j * f.skip) % 6421)::INT) = 0
    GROUP BY ALL)),
placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || md5(text), 'none')), 1, 15))::BIGINT % 6421 AS slot
  FROM documents)
SELECT d.doc_id, d.slot, ((p.turn - 1) % 64)::INT AS shard FROM placed d JOIN picks p USING (slot)
"""

OP10 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS lim, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per),
-- in each round the sources that the shared level would lift above their limit stop at it, and the others share what is left
rounds AS (
  SELECT source, source_size, lim, weight, false AS stopped, true AS moved FROM weighed
  UNION ALL
  SELECT source, source_size, lim, weight, now, bool_or(now <> stopped) OVER () FROM (
    SELECT *, stopped OR coalesce(weight * ((SELECT sum(source_size) FROM per)::DOUBLE - (sum(CASE WHEN stopped THEN lim ELSE 0 END) OVER ())::DOUBLE)
                                  / nullif(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER (), 0)::DOUBLE > lim::DOUBLE, false) AS now
    FROM rounds WHERE moved) t),
settled AS (SELECT * FROM rounds WHERE NOT moved),
goal AS (
  SELECT source, source_size, CASE WHEN stopped THEN lim::DOUBLE ELSE weight * (
    ((SELECT sum(source_size) FROM per)::DOUBLE - coalesce((SELECT sum(lim) FROM settled WHERE stopped), 0)::DOUBLE) / (SELECT sum(weight) FROM settled WHERE NOT stopped)::DOUBLE) END AS target
  FROM settled),
rated AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, 'text:' || md5(md5(s.text)), 'none')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
drawn AS (
  SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rated)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM drawn
"""

OP9 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM item_words, range(1, greatest(len(w) - 9, 1) + 1) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win FROM words, sizes, range(1, len(w) - n + 2) t(i) WHERE len(w) >= n),
found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.win = x.win),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP12 = r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS name,
         [coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
          coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')].list_aggregate('string_agg', '') AS head, text FROM documents),
crcs AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda i: ord(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
hashed AS (
  SELECT l.doc_id, name, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256(head || coalesce(strlen(text) || ':' || CASE WHEN xor(c, 4294967295) % 5 = 0
           THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claimed
  FROM leaves l LEFT JOIN crcs USING (doc_id)),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY name) - 1 AS g, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY name) AS n FROM hashed),
low AS (
  SELECT 0 AS lvl, g, idx, n, h FROM placed
  UNION ALL
  SELECT lvl + 1, g, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY lvl, g, idx // 16, n),
subroots AS (SELECT g, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, g AS idx, (SELECT count(*) FROM subroots) AS n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 16, n),
climb AS (
  SELECT g, idx AS leaf, 0 AS lvl, idx, n, claimed AS h, '' AS proof FROM placed
  UNION ALL
  SELECT c.g, c.leaf, c.lvl + 1, c.idx // 16, (c.n + 15) // 16, sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.h ELSE s.h END, '' ORDER BY s.idx)),
         c.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> c.idx), '')
  FROM climb c JOIN low s ON s.g = c.g AND s.lvl = c.lvl AND s.idx // 16 = c.idx // 16
  WHERE c.n > 1 GROUP BY c.g, c.leaf, c.lvl, c.idx, c.n, c.h, c.proof),
rise AS (
  SELECT g, leaf, 0 AS lvl, g AS idx, (SELECT count(*) FROM subroots) AS n, h, proof FROM climb WHERE n = 1
  UNION ALL
  SELECT c.g, c.leaf, c.lvl + 1, c.idx // 16, (c.n + 15) // 16, sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.h ELSE s.h END, '' ORDER BY s.idx)),
         c.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> c.idx), '')
  FROM rise c JOIN high s ON s.lvl = c.lvl AND s.idx // 16 = c.idx // 16
  WHERE c.n > 1 GROUP BY c.g, c.leaf, c.lvl, c.idx, c.n, c.h, c.proof)
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM placed p JOIN rise e ON e.g = p.g AND e.leaf = p.idx AND e.n = 1 JOIN subroots s ON s.g = p.g, (SELECT h FROM high WHERE n = 1) r
"""

OP13 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {"op1_exact_dedup": OP1, "op2_chat": OP2, "op6_sharding": OP6, "op9_decontamination": OP9, "op10_mixing": OP10, "op12_merkle_manifest": OP12, "op13_hard_negatives": OP13}
