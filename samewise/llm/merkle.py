"""Merkle manifest of a dataset: bottom-up build over stored levels, top-down proofs.

Each row is a leaf: the sha256 of its fields, each with its length, so that no two rows write the same
bytes. Leaves stand in order within their group (here: lang); FANOUT consecutive nodes make their parent until
one node, the subroot, is left; the subroots in order of their groups make the root in the same way.

Build. Every level is a stored table (g, at, n, hash, children): at is the node's place among the n of its
group, so parents are one grouping by (g, at div FANOUT) of FANOUT hashes at most, whatever the size of the group.
Places come from a range partitioning by (group, order): rows are counted per partition and group, and a row's
place is the count before its partition plus its place within. So no task holds a group.

Proofs. From the root down each level joins its parents: a child takes its place and siblings from the
parent's children and prepends them to the proof that the parent inherited. A proof is an array of (at,
siblings), from the leaf up; fold() puts a leaf back in and gives the root that it leads to.

Defined results: null fields count as '-'; rows go by doc_id (nulls first), then by leaf, so ties and repeated
rows have one order; a null group comes first and is a group of its own; a group of one row has its leaf as
subroot; one group's subroot is the root; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored, work_dir

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """'-' for null, else the count of UTF-8 bytes, ':' and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_key(value: Column) -> Column:
    """Never null, in the order of the groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, by: tuple[str, ...], home: str) -> DataFrame:
    """rows (stored) with at, the place among the n of the group g in the order of the columns by."""
    ordered = rows.repartitionByRange("g", *by).sortWithinPartitions("g", *by)
    # the id counts the rows of a partition from its number times 2^33 on
    rows = stored(ordered.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33)), f"{home}/ordered")
    held = rows.groupBy("g", "__part").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("c"))
    # one row for each partition that a group reaches
    before = F.coalesce(F.sum("c").over(Window.partitionBy("g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = held.select("g", "__part", (before - F.col("__first")).alias("__shift"), F.sum("c").over(Window.partitionBy("g")).alias("n"))
    return rows.join(places, ["g", "__part"]).withColumn("at", F.col("__id") + F.col("__shift")).drop("__id", "__part", "__shift")


def build(nodes: DataFrame, home: str) -> list[DataFrame]:
    """Stored levels from stored nodes (g, at, n, hash, any more) up, the others as (g, at, n, hash, children); a group ends at its level with n = 1."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        run = levels[-1].filter("n > 1").groupBy("g", F.expr(f"at div {FANOUT}").alias("at"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))
        children = run.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"]).alias("children"))
        level = children.select("g", "at", "n", sha(F.array_join("children", "")).alias("hash"), "children")
        levels.append(stored(level, f"{home}/level-{len(levels)}"))
        most = -(-most // FANOUT)
    return levels


PROOF = "array<struct<at: int, siblings: array<string>>>"


def push(levels: list[DataFrame], tops: DataFrame, home: str, named: tuple[str, ...] = ()) -> DataFrame:
    """Level 0 with proof and the named columns; tops (g, proof, named columns) is what the last node of each group inherits.

    The proofs of the leaves, FANOUT times as many as all the others, are left to the caller's plan.
    """
    down = None
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        mine = [c for c in level.columns if c != "n"]
        found = level.filter("n = 1").select(*mine).join(tops, "g")
        if down is not None:
            above = down.select("g", F.col("at").alias("__up"), F.col("children").alias("__run"), F.col("proof").alias("__held"), *named)
            below = level.filter("n > 1").withColumn("__up", F.expr(f"at div {FANOUT}")).join(above, ["g", "__up"])
            place = (F.col("at") % FANOUT).cast("int")
            others = F.filter("__run", lambda h, i: i != place)
            step = F.array(F.struct(place.alias("at"), others.alias("siblings")))
            found = found.unionByName(below.select(*mine, F.concat(step, "__held").alias("proof"), *named))
        down = stored(found, f"{home}/proofs-{number}") if number else found
    return down


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    above = lambda h, step: sha(F.concat(F.array_join(F.slice(step["siblings"], F.lit(1), step["at"]), ""), h, F.array_join(F.slice(step["siblings"], step["at"] + 1, F.lit(FANOUT)), "")))
    return F.aggregate(proof, leaf, above)


def proof_digest(proof: Column) -> Column:
    return sha(F.array_join(F.flatten(F.transform(proof, lambda step: step["siblings"])), ""))


def leaf_of(*fields: Column) -> Column:
    return sha(F.concat(*map(field, fields)))


def manifest(docs: DataFrame, home: str | None = None, also: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof of every row; also: further columns of the row, by name (digests, not texts)."""
    home = home or work_dir(docs.sparkSession, "merkle")
    also = also or {}
    leaves = docs.select(group_key(F.col("lang")).alias("g"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(*map(F.col, FIELDS)).alias("hash"), *[c.alias(name) for name, c in also.items()])
    levels = build(stored(numbered(leaves, ("doc_id", "hash"), f"{home}/leaves"), f"{home}/level-0"), home)
    subroots = levels[0].filter("n = 1").select("g", "hash")
    for level in levels[1:]:
        subroots = subroots.unionAll(level.filter("n = 1").select("g", "hash"))
    # one more tree, of the subroots as one group
    tops = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "hash"), ("of",), f"{home}/subroots")
    upper = build(stored(tops, f"{home}/upper/level-0"), f"{home}/upper")
    root = upper[-1].select("g", F.array().cast(PROOF).alias("proof"), F.col("hash").alias("root"))
    above = push(upper, root, f"{home}/upper", ("root",))
    tops = stored(above.select(F.col("of").alias("g"), "proof", F.col("hash").alias("subroot"), "root"), f"{home}/tops")
    return push(levels, tops, home, ("subroot", "root")).select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "proof", *also)


def audit(docs: DataFrame, tampered: Column, home: str | None = None) -> DataFrame:
    """The manifest with its proofs checked, where tampered is true, against the row with A-Z of its text lower-cased."""
    doc_id, source, lang, n_chars, text = map(F.col, FIELDS)
    shown = F.when(tampered, leaf_of(doc_id, source, lang, n_chars, ascii_lower(text)))
    found = manifest(docs, home, {"shown": shown}).withColumn("folded_root", fold(F.coalesce("shown", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
