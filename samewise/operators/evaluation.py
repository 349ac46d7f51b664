"""Quality measures of a grouping without listing pairs, from contingency counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import spread_join


def _pairs(n):
    return n * (n - 1) / 2


def pairwise(labelled: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 of rows (truth, predicted)."""
    both = labelled.groupBy("truth", "predicted").agg(F.count(F.lit(1)).alias("n"))
    tp = both.agg(F.sum(_pairs(F.col("n"))).alias("tp"))
    truth = both.groupBy("truth").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("t"))
    pred = both.groupBy("predicted").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("p"))
    one = tp.join(F.broadcast(truth)).join(F.broadcast(pred))  # one row each
    p, r = F.col("tp") / F.greatest(F.col("p"), F.lit(1)), F.col("tp") / F.greatest(F.col("t"), F.lit(1))
    return one.select(F.col("tp").cast("long").alias("tp"), (F.col("p") - F.col("tp")).cast("long").alias("fp"), (F.col("t") - F.col("tp")).cast("long").alias("fn"), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"))


def bcubed(labelled: DataFrame) -> DataFrame:
    """One row: B-cubed precision and recall."""
    both = labelled.groupBy("truth", "predicted").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    sized = both.withColumns({"nt": F.sum("n").over(Window.partitionBy("truth")), "np": F.sum("n").over(Window.partitionBy("predicted"))})
    return sized.agg(F.round(F.sum(n * n / F.col("np")) / F.sum("n"), 6).alias("precision"), F.round(F.sum(n * n / F.col("nt")) / F.sum("n"), 6).alias("recall"))


def wilson(hits: int, total: int, z: float = 1.96) -> tuple[float, float]:
    if not total:
        return 0.0, 1.0
    p, d = hits / total, 1 + z * z / total
    half = z * (p * (1 - p) / total + z * z / (4 * total * total)) ** 0.5 / d
    return max(0.0, (p + z * z / (2 * total)) / d - half), min(1.0, (p + z * z / (2 * total)) / d + half)


def kappa(rated: DataFrame) -> DataFrame:
    """One row: Cohen's kappa of rows (a, b)."""
    m = rated.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    sized = m.withColumns({"na": F.sum("n").over(Window.partitionBy("a")), "t": F.sum("n").over(Window.partitionBy(F.lit(1)))})
    col = m.groupBy("b").agg(F.sum("n").alias("nb")).withColumnRenamed("b", "label")
    row = m.groupBy("a").agg(F.sum("n").alias("na")).withColumnRenamed("a", "label")
    chance = row.join(col, "label").agg(F.sum(F.col("na") * F.col("nb")).alias("c"))
    seen = sized.agg(F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("o"), F.first("t").alias("t"))
    po, pe = F.col("o") / F.col("t"), F.col("c") / (F.col("t") * F.col("t"))
    return seen.join(F.broadcast(chance)).select(F.round(F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(1.0), 6).alias("kappa"))


def blocking_quality(pairs: DataFrame, truth: DataFrame, n_records: int) -> DataFrame:
    """One row: pair completeness and reduction ratio of candidate pairs against rows (rec_id, truth)."""
    t = truth.select("rec_id", "truth")
    hit = pairs.join(t.toDF("id_l", "tl"), "id_l").join(t.toDF("id_r", "tr"), "id_r").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tl") == F.col("tr")).alias("hit"))
    total = truth.groupBy("truth").agg(F.count(F.lit(1)).alias("k")).agg(F.sum(_pairs(F.col("k"))).alias("total"))
    return hit.join(F.broadcast(total)).select(F.round(F.col("hit") / F.greatest(F.col("total"), F.lit(1)), 6).alias("pair_completeness"), F.round(1 - F.col("n") / F.lit(max(1.0, n_records * (n_records - 1) / 2)), 6).alias("reduction_ratio"))


def key_blocking_quality(rows: DataFrame) -> DataFrame:
    """blocking_quality() of the pairs that share a key, without making them. rows: (rec_id, truth, keys), keys an array.

    Rows with the same set of keys and the same truth are counted together, so the work grows with the rows and with the
    pairs of different sets that share a key. Rows of one rec_id are no pair; null rec_ids, keys and truths pair with none.
    """
    known = F.array_sort(F.array_distinct(F.filter("keys", lambda k: k.isNotNull())))
    unit = rows.filter("rec_id IS NOT NULL").select("rec_id", "truth", known.alias("keys")).filter(F.size("keys") > 0).groupBy("rec_id", "truth", "keys").agg(F.count(F.lit(1)).alias("m"))
    cell = unit.groupBy("truth", "keys").agg(F.sum("m").alias("n"))
    held = cell.groupBy("keys").agg(F.sum("n").alias("n"))
    by_key = held.select("keys", F.explode("keys").alias("key"))
    meet = spread_join(by_key.withColumnRenamed("keys", "kl"), by_key.withColumnRenamed("keys", "kr"), ["key"]).select("kl", "kr").distinct()
    n = meet.join(held.toDF("kl", "nl"), "kl").join(held.toDF("kr", "nr"), "kr").agg(F.coalesce(F.sum(F.col("nl") * F.col("nr")), F.lit(0)).alias("n"))
    same = meet.join(cell.toDF("truth", "kl", "nl"), "kl").join(cell.toDF("truth", "kr", "nr"), ["truth", "kr"]).agg(F.coalesce(F.sum(F.col("nl") * F.col("nr")), F.lit(0)).alias("hit"))
    # ordered pairs within one rec_id, each row with itself among them
    within = "aggregate(u, 0L, (s, a) -> s + aggregate(u, 0L, (t, b) -> t + if(arrays_overlap(a.keys, b.keys){}, a.m * b.m, 0L)))"
    own = unit.groupBy("rec_id").agg(F.collect_list(F.struct("truth", "keys", "m")).alias("u")).select(F.expr(within.format("")).alias("n"), F.expr(within.format(" AND a.truth = b.truth")).alias("hit"))
    own = own.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("own_n"), F.coalesce(F.sum("hit"), F.lit(0)).alias("own_hit"))
    total = rows.groupBy("truth").agg(F.count(F.lit(1)).alias("k")).agg(F.sum(_pairs(F.col("k"))).alias("total"), F.sum("k").alias("all"))
    one = n.join(F.broadcast(same)).join(F.broadcast(own)).join(F.broadcast(total))  # one row each
    found, hit = (F.col("n") - F.col("own_n")) / 2, (F.col("hit") - F.col("own_hit")) / 2
    return one.select(F.round(hit / F.greatest(F.col("total"), F.lit(1)), 6).alias("pair_completeness"), F.round(1 - found / F.greatest(_pairs(F.col("all")), F.lit(1)), 6).alias("reduction_ratio"))


def stratified_sample(df: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    """About n rows in proportion to the strata, one at least of each; by hash of key, so always the same ones."""
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("k"))
    quota = counts.withColumn("quota", F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("k") / F.sum("k").over(Window.partitionBy(F.lit(1))))))
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(F.xxhash64(key), key))
    return df.withColumn("__rank", rank).join(F.broadcast(quota.select(stratum, "quota")), stratum).filter("__rank <= quota").drop("__rank", "quota")
