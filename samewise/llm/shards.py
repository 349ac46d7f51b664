"""Sharding by a minimax contiguous partition of atomic groups.

Rows with equal texts form one group (by a 60-bit hash of the text: equal texts always share it) and
are never cut apart. The order is: first the groups that are as large as the mean of the shards still
to fill, by size, each of which takes a shard of its own; then all others by their hash. In this order
the shards are contiguous. For the others a binary search finds the smallest capacity for which
greedily filled shards suffice, and the cuts go there.

Nothing that grows with the table comes to the driver: the order is summed in cells (leading bits of
the hash). Each round seeks the least capacity as if cells of several groups could be cut anywhere: no
partition has a smaller one. Only the cells in which a cut falls, and their neighbours, are split
further, until every cut stands between cells; then it is the capacity sought. The number of cells that
are split in a round depends on the number of shards alone.

Defined results: null and empty text are one group; null doc_id counts as 0 in the salt; repeated
rows get slots of their own; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, work_dir

#: Cells of the first round; spans of the hash and parts by doc_id in which slots are numbered.
FANOUT, SPANS, SALT = 4096, 256, 256
LOW = -(2**63)


@dataclass(frozen=True)
class Plan:
    """Hashes with a shard of their own, and the last hash of each further shard."""

    alone: tuple[int, ...]
    ends: tuple[int, ...]
    capacity: int


def feasible(prefix: list[int], whole: list[bool], shards: int, capacity: int) -> list[int] | None:
    """Greedy check: the bytes after which each shard ends, or None where shards do not suffice.

    prefix: bytes before each cell, and all bytes. A cut inside a whole cell goes to the cell's start.
    """
    cuts, at = [], 0
    while at < prefix[-1]:
        to = min(at + capacity, prefix[-1])
        cell = bisect.bisect_right(prefix, to) - 1
        if prefix[cell] < to and whole[cell]:
            to = prefix[cell]
        if to <= at or len(cuts) == shards:
            return None
        cuts.append(to)
        at = to
    return cuts


def smallest_capacity(sizes: list[int], shards: int, whole: list[bool] | None = None) -> tuple[int, list[int]]:
    """Binary search for the least capacity at which the greedy check succeeds, with its cuts."""
    whole = whole or [True] * len(sizes)
    prefix = [0, *accumulate(sizes)]
    low, high = max([0, *(s for s, w in zip(sizes, whole) if w), -(-prefix[-1] // shards)]), prefix[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(prefix, whole, shards, middle) is not None else (middle + 1, high)
    return low, feasible(prefix, whole, shards, low) or []


@dataclass(frozen=True, order=True)
class Cell:
    """Hashes from low on that share their leading bits."""

    low: int
    bits: int
    size: int
    groups: int

    @property
    def high(self) -> int:
        return self.low + 2 ** (64 - self.bits) - 1

    @property
    def lead(self) -> int:
        return (self.low - LOW) >> (64 - self.bits)


def _cells(groups: DataFrame, split: list[Cell], more: int) -> list[Cell]:
    """The non-empty cells into which more bits split the given ones, in one job."""
    lead = lambda bits: F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(LOW)), 64 - bits)
    parts = []
    for bits in sorted({c.bits for c in split}):
        finer = min(64, bits + more)
        inside = groups if not bits else groups.filter(lead(bits).isin([c.lead for c in split if c.bits == bits]))
        parts.append(inside.groupBy(lead(finer).alias("lead")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).withColumn("bits", F.lit(finer)))
    return [Cell((r["lead"] % 2**64 << 64 - r["bits"]) + LOW, r["bits"], int(r["bytes"]), r["n"]) for r in reduce(DataFrame.unionAll, parts).collect()]


def plan_shards(groups: DataFrame, shards: int, fanout: int = FANOUT) -> Plan:
    """groups: one row (h bigint, bytes bigint) per atomic group, stored. fanout: cells of the first round, a power of two."""
    top = [(r["bytes"], r["h"]) for r in groups.orderBy(F.desc("bytes"), "h").limit(shards).collect()]
    rest = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[int] = []
    for size, h in top:
        if shards - len(alone) <= 1 or size * (shards - len(alone)) < rest:
            break
        alone.append(h)
        rest -= size
    left = shards - len(alone)
    if alone:
        groups = groups.filter(~F.col("h").isin(alone))
    largest = max([size for size, h in top if h not in alone], default=0)
    bits = fanout.bit_length() - 1
    cells = sorted(_cells(groups, [Cell(LOW, 0, rest, 2)], bits))
    while True:
        starts, whole = [0, *accumulate(c.size for c in cells)], [c.groups == 1 for c in cells]
        capacity = max(smallest_capacity([c.size for c in cells], left, whole)[0], largest)
        cuts = feasible(starts, whole, left, capacity) or []
        held = {bisect.bisect_right(starts, cut) - 1 for cut in set(cuts) - set(starts)}
        if not held:  # no cell is cut apart: these are the cuts of single groups
            break
        split = [cells[i] for i in sorted({j for i in held for j in (i - 1, i, i + 1) if 0 <= j < len(cells)}) if cells[i].groups > 1]
        cells = sorted({*cells} - {*split} | {*_cells(groups, split, max(1, bits // 2))})
    ends = [cells[bisect.bisect_left(starts, cut) - 1].high for cut in cuts[:-1]]
    return Plan(tuple(alone), tuple(ends), max([capacity, *(s for s, h in top if h in alone)], default=0))


def shard_documents(docs: DataFrame, shards: int = 8, home: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard) and grown_shard of each row."""
    spark = docs.sparkSession
    home = home or work_dir(spark, "shards")
    text = F.coalesce(F.col("text"), F.lit(""))
    h = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") - F.lit(2**59)) * 16
    rows = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), h.alias("h")),
        f"{home}/rows",
    )
    groups = stored(rows.groupBy("h").agg(F.sum("size").alias("bytes")), f"{home}/groups")
    plan = plan_shards(groups, shards)
    shard = F.lit(len(plan.alone) + len(plan.ends))
    for i in reversed(range(len(plan.ends))):
        shard = F.when(F.col("h") <= plan.ends[i], F.lit(len(plan.alone) + i)).otherwise(shard)
    for i, h in enumerate(plan.alone):
        shard = F.when(F.col("h") == h, F.lit(i)).otherwise(shard)
    salt = F.conv(F.substring(F.md5(F.coalesce("doc_id", F.lit(0)).cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % SALT
    span = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(LOW)), 65 - SPANS.bit_length())
    placed = rows.withColumns({"shard": shard.cast("int"), "span": span.cast("int"), "salt": salt})
    # slots: rows are numbered inside small cells (at most SPANS * SALT of a shard), whose offsets come from their counts
    counts = placed.groupBy("shard", "span", "salt").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("offset", F.sum("n").over(Window.partitionBy("shard").orderBy("span", "salt").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
    number = F.row_number().over(Window.partitionBy("shard", "span", "salt").orderBy("h", "doc_id", "text_crc32"))
    return (
        placed.withColumn("number", number)
        .join(offsets, ["shard", "span", "salt"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.coalesce("offset", F.lit(0)) + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
