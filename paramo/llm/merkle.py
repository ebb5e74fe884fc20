"""Operator 12, a Merkle manifest of a dataset: sibling-shift self-joins.

Every row is a leaf; the leaves of a group, in the order of keys, are the
bottom level of the group's tree, and ``arity`` consecutive nodes, the last
run perhaps fewer, have one parent.  The groups' roots are the bottom level of
the top tree.  A hash is the lower-case hex SHA-256 of its inputs, one after
the other; tables hold the 32 bytes.

A level is one equijoin of the nodes with themselves: every node computes the
indices of its siblings (``index XOR 1`` for two, else the other slots of its
run, by offset) and meets them there; the rows in slot zero, which hold their
whole run, then emit the parents.  A level has a row for each node with the
hashes left and right of it, so no group is ever collected: a run of at most
``arity`` nodes is all that meets.

The index of a leaf in its group comes from a sort over all groups by ranges
of (group, key), so a group of a third of all rows spans many tasks.  Paths
to the root are put together from the top: they travel with the parents, of
which there are ``arity`` times fewer than nodes, and each join has at most
``arity`` rows a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import pick, store
from paramo.operators.ranking import global_rank

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: binary, right: binary>>"


def field(value: Column) -> Column:
    """One input of a leaf: ``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_of(values: Sequence[Column]) -> Column:
    """The 32 bytes of a leaf's hash."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def placed(leaves: DataFrame) -> DataFrame:
    """``(g, idx, n, hash, ..)`` from ``leaves(name, id, hash, row, ..)``: the number of the group in the order of names, the leaf's place in it, and its leaves.

    Rows are sorted by ranges of (name, id, hash, row); a place is the row's
    position in its range plus the group's rows in earlier ranges."""
    order = ["name", F.col("id").asc_nulls_first(), "hash", "row"]
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = store(ranged.withColumns({"pid": F.spark_partition_id(), "pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "merkle-sorted")
    # a row for each group in each range
    counts = store(ranged.groupBy("name", "pid").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("here")), "merkle-counts")
    groups = global_rank(counts.groupBy("name").agg(F.sum("here").alias("n")).withColumn("one", F.lit(0)), ["one"], ["name"], "g").drop("one")
    before = W.partitionBy("name").orderBy("pid").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = counts.withColumn("before", F.sum("here").over(before) - F.col("here")).join(groups, "name")
    found = ranged.join(offsets, ["name", "pid"]).withColumn("idx", F.col("before") + F.col("pos") - F.col("first"))
    return found.drop("pid", "pos", "first", "here", "before", "row")


def linked(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes(g, idx, n, hash, ..)`` with ``left`` and ``right``: the hashes of the siblings before and after, in order, one after the other."""
    others = [c for c in nodes.columns if c not in ("g", "idx")]
    slot = F.col("idx") % arity
    if arity == 2:
        to = F.col("idx").bitwiseXOR(F.lit(1))
    else:
        to = F.explode(F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda d: F.col("idx") - slot + (slot + d) % arity))
    told = nodes.select(F.col("g").alias("to_g"), to.alias("to"), F.struct("idx", "hash").alias("s"), "n").where("to < n").drop("n")
    # by a shuffle at any size: the plan, and what it needs, grows in proportion
    met = nodes.join(told.hint("merge"), (nodes["g"] == told["to_g"]) & (nodes["idx"] == told["to"]), "left")
    runs = met.groupBy("g", "idx").agg(*[F.first(c).alias(c) for c in others], F.sort_array(F.collect_list("s")).alias("s"))

    def joined(side: Callable[[Column], Column]) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter("s", side), lambda s: F.hex(s["hash"])), ""))

    return runs.select("g", "idx", *others, joined(lambda s: s["idx"] < F.col("idx")).alias("left"), joined(lambda s: s["idx"] > F.col("idx")).alias("right"))


def parents(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level's nodes, from the rows in slot zero, whose right siblings are the rest of their run."""
    first = level.where(F.col("idx") % arity == 0)
    return first.select("g", F.expr(f"idx DIV {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) DIV {arity}").alias("n"),
                        F.unhex(F.sha2(hex_of(F.concat("hash", "right")), 256)).alias("hash"))


def grown(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees over ``nodes``, each :func:`linked` and stored, and the trees' roots ``(g, hash)``.

    A tree ends where one node is left; the loop ends with the largest."""
    levels, roots = [], nodes.where("n = 1").select("g", "hash")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(store(linked(nodes.where("n > 1"), arity), "merkle-level"))
        nodes, most = store(parents(levels[-1], arity), "merkle-nodes"), -(-most // arity)
        roots = roots.unionByName(nodes.where("n = 1").select("g", "hash"))
    return levels, store(roots, "merkle-roots")


def climbed(nodes: DataFrame, levels: Sequence[DataFrame], above: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes`` with ``path``: the siblings ``(left, right)`` of each level up to the tree's root, then what ``above(g, path, ..)`` has for the tree.

    From the top level down; the result is not stored, as paths are longer
    than nodes."""
    step = F.array(F.struct("left", "right")).cast(PATH)
    carried = [c for c in above.columns if c not in ("g", "path")]
    own = [c for c in nodes.columns if c not in ("g", "idx")]
    higher, out = None, None
    for i, level in reversed(list(enumerate(levels))):
        keep = own if i == 0 else ["n"]
        last = level.where(F.col("n") <= arity).join(above, "g")
        out = last.select("g", "idx", *keep, F.concat(step, "path").alias("path"), *carried)
        if higher is not None:
            up = higher.select("g", F.col("idx").alias("run"), "path", *carried)
            rest = level.where(F.col("n") > arity).withColumn("run", F.expr(f"idx DIV {arity}")).join(up.hint("merge"), ["g", "run"])
            out = out.unionByName(rest.select("g", "idx", *keep, F.concat(step, "path").alias("path"), *carried))
        if i:
            higher = out = store(out.drop("n"), "merkle-paths")
    alone = nodes.where("n = 1").join(above, "g").select("g", "idx", *own, "path", *carried)
    return alone if out is None else out.unionByName(alone)


@dataclass
class Manifest:
    """``groups(g, name, n, subroot, root)``, and ``proofs(id, g, idx, n, hash, claimed, path, subroot, root)`` for every leaf; hashes as bytes."""

    groups: DataFrame
    proofs: DataFrame


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS, arity: int = ARITY,
             claim: Callable[[dict[str, Column]], dict[str, Column]] | None = None) -> Manifest:
    """The manifest of ``docs``, a leaf for each row.

    Groups go by name, null first, then bytewise; leaves by key, null keys
    first, then by hash: rows that repeat a key have one order, and equal rows
    equal hashes.  A null field is the input ``-``, so an empty text differs
    from none; texts are hashed whole.  An empty table has no groups, no
    proofs and no root.  Columns other than the key, the group and ``fields``
    are not read.  ``claim`` gives, from the fields by name, those of a copy
    whose rows are to be verified; the proofs then hold that copy's leaf as
    ``claimed`` (else the leaf itself)."""
    rows = pick(docs, id=key, name=group, **{f"f{i}": f for i, f in enumerate(fields)})
    values = {f: F.col(f"f{i}") for i, f in enumerate(fields)}
    own = leaf_of(list(values.values()))
    other = values | claim(values) if claim else values
    # null names come first, also before the empty one
    name = F.coalesce(F.concat(F.lit("="), F.col("name").cast("string")), F.lit(""))
    leaves = store(rows.select("id", name.alias("name"), own.alias("hash"), (leaf_of([other[f] for f in fields]) if claim else own).alias("claimed"),
                               F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    nodes = store(placed(leaves), "merkle-placed")
    named = nodes.where("idx = 0").select("g", F.when(F.col("name") != "", F.substring("name", 2, 2**31 - 1)).alias("name"), "n")
    nodes = nodes.drop("name")
    levels, subroots = grown(nodes, arity)
    tops = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(subroots.count()).cast("long").alias("n"), "hash")
    top_levels, root = grown(tops, arity)
    whole = root.select("g", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    above = climbed(tops, top_levels, whole, arity).select(F.col("idx").alias("g"), "path", F.col("hash").alias("subroot"), "root")
    above = store(above, "merkle-above")
    return Manifest(named.join(above.drop("path"), "g"), climbed(nodes, levels, above, arity))


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hex, that a leaf's bytes and its siblings lead to."""
    return F.aggregate(path, hex_of(leaf), lambda h, p: F.sha2(F.concat(hex_of(p["left"]), h, hex_of(p["right"])), 256))


def siblings(path: Column) -> Column:
    """All hashes of a path in hex, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: hex_of(F.concat(p["left"], p["right"]))), "")


def verified(proofs: DataFrame) -> DataFrame:
    """``proofs`` with ``folded_root``, from the claimed leaf and the proof alone, and whether it is the root."""
    told = proofs.withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
    return told.withColumn("verified", F.col("folded_root") == hex_of(F.col("root")))
