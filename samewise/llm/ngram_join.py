"""N-gram Jaccard join with vertical partitioning, and the classes that its links connect.

Sets of word n-grams (64-bit hashes) stand in one global order, rare before common; rarity comes from
counts over all documents in a table of fixed size. Equal sets are one class from the start.

1. Candidates. Two sets that reach the threshold share an n-gram of both prefixes (the leading
   n - need + 1 in the order), so only prefixes are dealt out by n-gram. Before the first n-gram that a set
   shares with any other prefix it can have nothing in common with anyone: that bounds each overlap.
   The n-grams that two prefixes share are counted, and pairs for which that count is too low are out.
2. Overlaps. The order is cut into fragments. The overlap of a candidate pair is counted in each
   fragment separately and summed; pairs that the first fragment already rules out go no further.
3. Classes. First one set of each n-gram (the leader, the one with the fewest n-grams of its own) is
   tried with the others that hold that n-gram, and links are joined to classes. Then all candidate
   pairs between different classes are tried. Pairs inside a class need no trial, so a large group of near copies costs links in
   proportion to its size while no link between classes is lost.

Defined results: null and empty texts have an empty set, link with nothing and keep their own doc_id
(null if it is null); null doc_ids are passed over when the smallest is chosen; repeated rows and
equal sets share a class; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import bitmap, by_slot, in_bitmap, lean, remove, slots, small_batches, spread_join, stored, work_dir
from .components import components

#: Counters of n-gram frequency, bits of the filter for candidate texts, fragments of the order.
SLOTS, FILTER_BITS, FRAGMENTS = 1 << 18, 1 << 24, 4
#: Sets of each n-gram that are tried with all others that hold it.
LEADERS = 3
#: A counter of one n-gram in so many, or more, is hot: its n-grams are dealt out by n-gram and set. Holders of an n-gram that one task pairs.
HOT_COUNTER, HOLDERS = 1 << 14, 1000
#: Words whose hashes a task keeps.
WORD_CACHE = 100_000
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word):
        if len(self) > WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, size: int, words: dict) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words (A-Z lower-cased, split at ASCII white space); fewer words than size make one."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh64_intdigest(b"\0".join(found), seed=len(found))], dtype=np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    count = len(found) - size + 1
    grams = hashes[:count].copy()
    for i in range(1, size):
        grams *= _MULTIPLIER
        grams += hashes[i : i + count]
    grams ^= grams >> np.uint64(32)
    grams *= _MIX
    grams ^= grams >> np.uint64(29)
    grams.sort()
    return grams[np.append(True, grams[1:] != grams[:-1])]


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, F.coalesce("text", F.lit(""))).alias("row_key"), "text")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """kind 0: doc_id, row_key, n, digest of each row; kind 1: slots and counts of a task's distinct sets."""
    names = ["kind", "doc_id", "row_key", "n", "digest", "slots", "counts"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches):
        words, seen, counts = _Words(), set(), np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            n, digests = [], []
            for text in batch.column(2).to_pylist():
                grams = shingles(text, size, words)
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                n.append(len(grams))
                digests.append(digest)
                if len(grams) and digest not in seen:
                    seen.add(digest)
                    counts += np.bincount((grams >> np.uint64(46)).astype(np.int64), minlength=SLOTS) if len(grams) > 5000 else 0
                    if len(grams) <= 5000:
                        slots, times = np.unique(grams >> np.uint64(46), return_counts=True)
                        counts[slots.astype(np.int64)] += times
            rows = len(n)
            none = pa.nulls(rows)
            yield pa.RecordBatch.from_arrays([pa.array([0] * rows, kinds[0]), batch.column(0), batch.column(1), pa.array(n, kinds[3]), pa.array(digests, kinds[4]), none.cast(kinds[5]), none.cast(kinds[6])], names)
        full = np.flatnonzero(counts)
        if len(full):
            yield pa.RecordBatch.from_arrays([pa.array([1], kinds[0]), *(pa.nulls(1).cast(k) for k in kinds[1:5]), pa.array([full.tolist()], kinds[5]), pa.array([counts[full].tolist()], kinds[6])], names)

    return _keyed(docs).mapInArrow(lean(run), "kind int, doc_id bigint, row_key bigint, n bigint, digest binary, slots array<int>, counts array<bigint>")


def _order(sets: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each counter (16 bits, coarser for large counts), the ranks at which fragments end, and which counters are hot."""
    sums = sets.filter("kind = 1").select(F.explode(F.arrays_zip("slots", "counts")).alias("x")).groupBy("x.slots").agg(F.sum("x.counts").alias("n")).toArrow()
    counts = np.zeros(SLOTS, dtype=np.int64)
    counts[sums["slots"].to_numpy()] = sums["n"].to_numpy()
    ranks = np.minimum(65535, 2048 * np.log2(1.0 + counts)).astype(np.uint16)
    mass = np.bincount(ranks, weights=counts, minlength=65536).cumsum()
    pivots = np.searchsorted(mass, mass[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS)
    return ranks, pivots.astype(np.int64), counts * HOT_COUNTER >= max(1, counts.sum())


def _in_order(grams: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams by (rank, hash), and their ranks."""
    rank = ranks[(grams >> np.uint64(46)).astype(np.int64)]
    at = np.argsort(rank, kind="stable")
    return grams[at], rank[at]


def _prefixes(docs: DataFrame, size: int, num: int, den: int, ranks: np.ndarray, hot: np.ndarray) -> DataFrame:
    """token, node, pos, n of the prefix n-grams of each distinct set of a task; salt: -1, or for n-grams of hot counters a byte of the node."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, hot))
    names = ["token", "node", "pos", "n", "salt"]

    def run(batches):
        words, seen = _Words(), set()
        ranks, hot = shared.value
        for batch in batches:
            tokens, nodes, sizes, totals = [], [], [], []
            for text in batch.column(2).to_pylist():
                grams = shingles(text, size, words)
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                if not len(grams) or digest in seen:
                    continue
                seen.add(digest)
                keep = len(grams) - -(-num * len(grams) // den) + 1
                tokens.append(_in_order(grams, ranks)[0][:keep].copy())
                nodes.append(digest)
                sizes.append(keep)
                totals.append(len(grams))
            if tokens:
                sizes = np.array(sizes)
                owner = np.repeat(np.arange(len(nodes)), sizes)
                pos = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                node = pa.array(nodes, pa.binary()).take(pa.array(owner))
                flat = np.concatenate(tokens)
                salt = np.where(hot[(flat >> np.uint64(46)).astype(np.int64)], np.array([d[0] for d in nodes])[owner], -1)
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), node, pa.array(pos.astype(np.int32)), pa.array(np.array(totals, dtype=np.int32)[owner]), pa.array(salt.astype(np.int32))], names)

    return _keyed(docs).mapInArrow(lean(run), "token bigint, node binary, pos int, n int, salt int")


def _fragments(docs: DataFrame, size: int, ranks: np.ndarray, pivots: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """node, n, part, tokens: the fragments of the sets whose row_key the bitmap holds."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pivots, wanted))

    def run(batches):
        ranks, pivots, wanted = shared.value
        words, seen = _Words(), set()
        for batch in batches:
            nodes, totals, parts, tokens = [], [], [], []
            hit = np.flatnonzero(in_bitmap(wanted, batch.column(1).to_numpy()))
            for text in batch.column(2).take(pa.array(hit)).to_pylist():
                grams = shingles(text, size, words)
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                if not len(grams) or digest in seen:
                    continue
                seen.add(digest)
                ordered, rank = _in_order(grams, ranks)
                cuts = np.searchsorted(rank, pivots, side="right").tolist()
                for part, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(grams)])):
                    nodes.append(digest)
                    totals.append(len(grams))
                    parts.append(part)
                    tokens.append(ordered[lo:hi].view(np.int64))
            if nodes:
                offsets = np.append(0, np.cumsum([len(t) for t in tokens])).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(totals, pa.int32()), pa.array(parts, pa.int32()), column], ["node", "n", "part", "tokens"])

    return _keyed(docs).mapInArrow(lean(run), "node binary, n int, part int, tokens array<bigint>")


def _reach(nu: Column, nv: Column, overlap: Column, num: int, den: int) -> Column:
    return F.lit(den) * overlap >= F.lit(num) * (nu + nv - overlap)


def _links(pairs: DataFrame, fragments: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) that reach the threshold: overlaps are counted per fragment and summed."""
    sides = lambda x, parts: fragments.filter(parts).select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), "part", F.col("tokens").alias(f"t{x}"))
    counted = lambda p, parts: p.join(sides("u", parts), "u").join(sides("v", parts), ["v", "part"]).withColumn("o", F.size(F.array_intersect("tu", "tv")))
    left = F.least(F.col("nu") - F.size("tu"), F.col("nv") - F.size("tv"))
    first = counted(pairs, F.col("part") == 0).filter(_reach(F.col("nu"), F.col("nv"), F.col("o") + left, num, den)).select("u", "v", F.col("o").alias("o0"))
    rest = counted(first, F.col("part") > 0).groupBy("u", "v").agg(F.first("nu").alias("nu"), F.first("nv").alias("nv"), (F.first("o0") + F.sum("o")).alias("o"))
    return rest.filter(_reach(F.col("nu"), F.col("nv"), F.col("o"), num, den)).select(F.col("u").alias("a"), F.col("v").alias("b"))


def _classes(docs: DataFrame, size: int, num: int, den: int, home: str | None = None) -> DataFrame:
    """jaccard_classes with the class (the digest of one of its sets) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    home = home or work_dir(spark, "ngrams")
    sets = stored(_sets(docs, size), f"{home}/sets")
    ranks, pivots, hot = _order(sets)
    rows = sets.filter("kind = 0").select("doc_id", "row_key", "n", "digest")

    # n-grams that only one prefix holds go; those of hot counters are dealt out by n-gram and set, and go below
    by_token = Window.partitionBy("token", "salt")
    shared = (
        _prefixes(docs, size, num, den, ranks, hot)
        .withColumn("before", F.lag("node").over(by_token.orderBy("node")))
        .withColumns({"low": F.min("node").over(by_token), "high": F.max("node").over(by_token)})
        .filter("(low <> high OR salt >= 0) AND NOT node <=> before")
        .select("token", "node", "pos", "n")
    )
    held = stored(shared, f"{home}/held")
    # n-grams that the same sets hold yield the same pairs: one entry stands for them, at each set's first place
    holders = F.xxhash64(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1))))
    tokens = stored(held.groupBy("token").agg(F.count(F.lit(1)).alias("c"), holders.alias("same")).filter("c > 1"), f"{home}/tokens")
    shared = stored(spread_join(held, tokens, "token", "c"), f"{home}/shared")
    for done in ("held", "tokens"):
        remove(spark, f"{home}/{done}")
    # s: n-grams before the first shared one; own and held: n-grams of the prefix that no other prefix holds, and that one does
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(num) / F.lit(den)) + 1
    starts = shared.groupBy("node").agg(F.min("pos").alias("s"), (F.first(prefix) - F.count(F.lit(1))).alias("own"), F.count(F.lit(1)).alias("held"))
    same = shared.groupBy(F.col("same").alias("token"), "node").agg(F.min("pos").alias("pos"), F.first("n").alias("n"), F.first("c").alias("c"))
    same = stored(same.join(starts, "node"), f"{home}/same")

    bound = F.least(F.col("nu") - F.col("su"), F.col("nv") - F.col("sv"))
    # with c n-grams in common among whole prefixes, at most c + need - 1 can be common in all
    need = F.ceil(F.greatest("nu", "nv") * F.lit(num) / F.lit(den))
    bound = F.least(bound, F.least("hu", "hv") + need - 1)
    # a pair that shares `alpha` n-grams shares one before the last alpha - 1 of either set
    alpha = F.expr(f"({num}L * (nu + nv) + {num + den - 1}) div {num + den}")
    may = _reach(F.col("nu"), F.col("nv"), bound, num, den) & (F.col("pu") <= F.col("nu") - alpha) & (F.col("pv") <= F.col("nv") - alpha)
    prefixes = stored(shared.groupBy("node").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens")), f"{home}/prefixes")
    most = F.least("nu", "nv", F.size(F.array_intersect("tu", "tv")) + need - 1)

    def screened(rows_: DataFrame) -> DataFrame:
        pairs = rows_.filter(may).select("u", "v").distinct()
        return pairs.join(prefixes.toDF("u", "nu", "tu"), "u").join(prefixes.toDF("v", "nv", "tv"), "v").filter(_reach(F.col("nu"), F.col("nv"), most, num, den)).select("u", "v")

    def linked(pairs: DataFrame, number: int) -> DataFrame:
        """Links among candidate pairs; only the sets of these pairs are fetched from the texts."""
        pairs = stored(pairs, f"{home}/pairs-{number}")
        nodes = pairs.select(F.col("u").alias("digest")).union(pairs.select(F.col("v").alias("digest"))).distinct()
        wanted = rows.groupBy("digest").agg(F.min("row_key").alias("row_key")).join(nodes, "digest")
        fragments = _fragments(docs, size, ranks, pivots, bitmap(wanted, "row_key", FILTER_BITS))
        fragments = stored(fragments.join(nodes.toDF("node"), "node", "left_semi").dropDuplicates(["node", "part"]), f"{home}/fragments-{number}")
        found = stored(_links(pairs, fragments, num, den), f"{home}/links-{number}")
        remove(spark, f"{home}/fragments-{number}")
        return found

    kept = ("node", "n", "s", "pos", "held")
    first = F.row_number().over(Window.partitionBy("token").orderBy("own", "node"))
    leaders = same.withColumn("number", first).filter(F.col("number") <= LEADERS).select("token", "c", *[F.col(c).alias(to) for c, to in zip(kept, ("u", "nu", "su", "pu", "hu"))])
    leaders = stored(leaders, f"{home}/leaders")
    v = same.select("token", *[F.col(c).alias(to) for c, to in zip(kept, ("v", "nv", "sv", "pv", "hv"))])
    stars = spread_join(v, leaders, "token", "c").filter(F.col("u") != F.col("v"))
    links = linked(screened(stars), 1)
    roots = components(links, f"{home}/classes-1")

    classed = stored(same.join(roots, "node", "left").select("token", *kept, F.coalesce("root", "node").alias("class")), f"{home}/classed")
    several = classed.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("c")).filter("low <> high").select("token", "c")
    classed = stored(spread_join(classed, stored(several, f"{home}/several"), "token", "c"), f"{home}/open")
    # sets that link differ little in size, so they meet by n-gram and size class; holders of a frequent n-gram are dealt over parts
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int") if num < den else F.col("n")
    parts = F.ceil(F.col("c") / F.lit(HOLDERS)).cast("int")
    u, v = (classed.select("token", parts.alias("parts"), size_class.alias("size"), *[F.col(c).alias(to) for c, to in zip((*kept, "class"), names)]) for names in (("u", "nu", "su", "pu", "hu", "cu"), ("v", "nv", "sv", "pv", "hv", "cv")))
    u = u.withColumn("size", F.explode(F.array("size", F.col("size") + 1, F.col("size") + 2))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    v = v.withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).drop("parts")
    met = u.join(v, ["token", "size", "part"]).filter("(nu < nv OR nu = nv AND u < v) AND cu <> cv")
    more = linked(screened(met), 2)
    roots = components(links.unionAll(more), f"{home}/classes-2")

    for done in ("shared", "same", "leaders", "prefixes", "classed", "several", "open", "pairs-1", "pairs-2", "links-1", "links-2", "classes-1"):
        remove(spark, f"{home}/{done}")
    # counted by set, then by class; a set or a class that many rows share is broadcast, so no task gets its rows
    each = rows.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("c"))
    each = stored(each.join(roots.toDF("digest", "root"), "digest", "left").withColumn("class", F.coalesce("root", "digest")).drop("root"), f"{home}/each")
    smallest = stored(each.groupBy("class").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("m")), f"{home}/smallest")
    told = stored(spread_join(each, smallest, "class", "m").select("digest", "class", "least", "c"), f"{home}/told")
    named = spread_join(rows.filter("n > 0"), told, "digest", "c").select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), "class")
    return named.unionByName(rows.filter("n = 0").select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("digest").alias("class")))


def jaccard_classes(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, home: str | None = None) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id (smallest doc_id that links of num/den Jaccard or more reach) of every row."""
    return _classes(docs, size, num, den, home).drop("class")


def near_dedup(spark, docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs that stay: of each class of linked sets the row with the smallest doc_id (nulls last, then row_key); rows without words stay.

    Texts that no links connect stay apart, also where their rows have one doc_id or none.
    """
    doc_id, home = F.col("doc_id").cast("long"), work_dir(spark, "near-dedup")
    classes = stored(_classes(docs, size, num, den), f"{home}/classes")
    drop = classes.filter("n_shingles > 0").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("k"))
    alone = classes.filter("n_shingles = 0").select("doc_id", "row_key")
    keep = stored(drop.select("k.doc_id", "k.row_key").unionAll(alone).distinct().toDF("__id", "__key"), f"{home}/keep")
    # rows whose key is kept and stands for one row only need no trial and do not move
    keys = classes.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    tried = keys.join(keep.select(F.col("__key").alias("row_key")).distinct().withColumn("kept", F.lit(True)), "row_key", "left").filter("n > 1 OR kept IS NULL")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), doc_id.alias("__doc_id"), F.xxhash64(doc_id, F.coalesce("text", F.lit(""))).alias("__key"))
    sure, others = by_slot(packed, F.col("__key"), slots(tried, F.col("row_key")))
    once = Window.partitionBy("__key", "__id").orderBy(F.lit(1))
    joined = others.join(keep, "__key").filter(F.col("__doc_id").eqNullSafe(F.col("__id")))
    return sure.select("__row.*").unionAll(joined.withColumn("__n", F.row_number().over(once)).filter("__n = 1").select("__row.*"))
