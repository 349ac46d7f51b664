"""Tables about a result: contract, composition, sensitivity, quality by stratum, samples, fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import evaluation
from .tables import task_parts


def expand(expansion: DataFrame, compact: DataFrame, payload: DataFrame | None = None) -> DataFrame:
    """expansion (row_id, rep_id) with the compact result of its representative and, if given, its own payload (row_id, ...)."""
    whole = expansion.join(compact, "rep_id")
    return whole.join(payload, "row_id", "left") if payload is not None else whole


def with_ordinal(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ORDINAL: 0, 1, ... among rows of equal keys."""
    return df.withColumn("ORDINAL", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)


def attach_technical(rows: DataFrame, technical: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Columns of technical on rows by content, the n-th of equal rows with the n-th."""
    right = with_ordinal(technical, keys, order).drop(order)
    return with_ordinal(rows, keys, order).join(right, [*keys, "ORDINAL"], "left")


def union_method(rows: DataFrame) -> DataFrame:
    """Adds METODO_UNION to rows (group, rec_id, base): sin_pareja alone; identificador where another member has the same base; else nombre."""
    size = rows.groupBy("group").agg(F.count(F.lit(1)).alias("__size"))
    mates = rows.filter("base <> ''").groupBy("group", "base").agg(F.count(F.lit(1)).alias("__mates"))
    found = rows.join(size, "group").join(mates, ["group", "base"], "left")
    method = F.when(F.col("__size") == 1, "sin_pareja").when(F.col("__mates") > 1, "identificador").otherwise("nombre")
    return found.withColumn("METODO_UNION", method).drop("__size", "__mates")


def pair_score(rows: DataFrame, pairs: DataFrame, parts: int | None = None) -> DataFrame:
    """rec_id, SCORE_PAR: the best score of a pair with a member of the record's own group; null without one. pairs: (id_l, id_r, score).

    parts: tasks of each join; if None, rows are counted and dealt over as many as keep a task's share bounded.
    """
    n = parts or task_parts(rows)
    own = rows.select("rec_id", "group").repartition(n, "rec_id")
    left, right = (own.toDF(f"id_{s}", f"g{s}").hint("merge") for s in "lr")
    both = pairs.select("id_l", "id_r", "score").repartition(n, "id_l").join(left, "id_l").repartition(n, "id_r").join(right, "id_r").filter("gl = gr")
    ends = both.select(F.explode(F.array("id_l", "id_r")).alias("rec_id"), "score").repartition(n, "rec_id").groupBy("rec_id").agg(F.max("score").alias("SCORE_PAR"))
    return own.select("rec_id").join(ends.hint("merge"), "rec_id", "left")


def composition(rows: DataFrame) -> DataFrame:
    """src, rows, entities, linked (entities that another source shares)."""
    sources = rows.groupBy("group").agg(F.countDistinct("src").alias("n"))
    each = rows.groupBy("group", "src").agg(F.count(F.lit(1)).alias("rows")).join(sources, "group")
    return each.groupBy("src").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("entities"), F.count_if(F.col("n") > 1).alias("linked"))


def multi_source(rows: DataFrame, least: int = 2) -> DataFrame:
    return rows.groupBy("group").agg(F.countDistinct("src").alias("sources"), F.count(F.lit(1)).alias("rows")).filter(F.col("sources") >= least)


def suspicious(rows: DataFrame, names: int) -> DataFrame:
    """Groups with so many distinct names or more."""
    return rows.filter("name <> ''").groupBy("group").agg(F.countDistinct("name").alias("names")).filter(F.col("names") >= names)


def name_variety(rows: DataFrame) -> DataFrame:
    """bucket (1, 2-3, >3 distinct names), groups, most."""
    n = rows.filter("name <> ''").groupBy("group").agg(F.countDistinct("name").alias("n"))
    bucket = F.when(F.col("n") == 1, "1").when(F.col("n") <= 3, "2-3").otherwise(">3")
    return n.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("most"))


def presence_share(presence: DataFrame) -> DataFrame:
    """The presence matrix (src_a, src_b, groups) with each cell's percentage of its row's diagonal."""
    whole = F.max(F.when(F.col("src_a") == F.col("src_b"), F.col("groups"))).over(Window.partitionBy("src_a"))
    return presence.withColumn("whole", whole).filter("whole IS NOT NULL").select("src_a", "src_b", "groups", F.round(100 * F.col("groups") / F.col("whole"), 4).alias("share"))


def sensitivity(pairs: DataFrame, base: float, thresholds: list[float]) -> DataFrame:
    """threshold, merges, gained, lost against the base threshold, from one pass over stored scores."""
    s = F.col("score")
    sums = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(s >= t).alias("merges"), F.count_if((s >= t) & (s < base)).alias("gained"), F.count_if((s < t) & (s >= base)).alias("lost")) for t in thresholds]
    return pairs.agg(F.array(*sums).alias("x")).select(F.inline("x"))


def contribution(scored: DataFrame, variables: list[str], truth: str) -> DataFrame:
    """variable, truth, premia, castiga, neutro: how often each signed score rewards, punishes or is silent."""
    longer = scored.select(F.col(truth).alias("truth"), *[F.col(v).cast("double") for v in variables]).unpivot(["truth"], variables, "variable", "s")
    return longer.groupBy("variable", "truth").agg(F.count_if(F.expr("s > 0")).alias("premia"), F.count_if(F.expr("s < 0")).alias("castiga"), F.count_if(F.coalesce("s", F.lit(0.0)) == 0).alias("neutro"))


def by_stratum(labelled: DataFrame, stratum: str) -> DataFrame:
    """stratum, tp, fp, fn, f1 from rows (stratum, truth, predicted), pairs counted inside each stratum."""
    pairs = lambda n: n * (n - 1) / 2
    cells = labelled.groupBy(stratum, "truth", "predicted").agg(F.count(F.lit(1)).alias("n"))
    side = lambda c: cells.groupBy(stratum, c).agg(F.sum("n").alias("n")).groupBy(stratum).agg(F.sum(pairs(F.col("n"))).cast("long").alias(c))
    tp = cells.groupBy(stratum).agg(F.sum(pairs(F.col("n"))).cast("long").alias("tp"))
    whole = tp.join(side("truth"), stratum).join(side("predicted"), stratum)
    f1 = F.when(F.col("truth") + F.col("predicted") > 0, F.round(2 * F.col("tp") / (F.col("truth") + F.col("predicted")), 6)).otherwise(1.0)
    return whole.select(stratum, "tp", (F.col("predicted") - F.col("tp")).alias("fp"), (F.col("truth") - F.col("tp")).alias("fn"), f1.alias("f1"))


def labelled_precision(sample: DataFrame) -> DataFrame:
    """hits, total, precision and its 95 % Wilson interval from rows (label 1 or 0; null is undecided)."""
    n, k = F.count("label"), F.sum("label")
    row = sample.agg(n.alias("total"), F.coalesce(k, F.lit(0)).cast("long").alias("hits")).first()
    low, high = evaluation.wilson(row["hits"], row["total"])
    return sample.sparkSession.createDataFrame([(row["hits"], row["total"], row["hits"] / row["total"] if row["total"] else None, low, high)], "hits long, total long, precision double, low double, high double")


def partition_fingerprint(rows: DataFrame) -> DataFrame:
    """One row, fingerprint: equal for equal partitions whatever their group ids and order; sums of digest parts, so no row order is needed."""
    least = rows.groupBy("group").agg(F.min("record").alias("least"))
    digest = F.sha2(F.concat_ws("|", "record", "least"), 256)
    parts = [F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)]
    return rows.join(least, "group").agg(F.concat_ws("-", *parts).alias("fingerprint"))


def review_sample(pairs: DataFrame, bands: list[float], n: int) -> DataFrame:
    """n pairs of each band of the score (bands: rising lower bounds), by digest of the pair's ids."""
    band = reduce(lambda found, b: F.when(F.col("score") >= b, F.lit(float(b))).otherwise(found), sorted(bands), F.lit(None).cast("double"))
    order = Window.partitionBy("band").orderBy(F.sha2(F.concat_ws("|", "id_l", "id_r"), 256), "id_l", "id_r")
    return pairs.withColumn("band", band).filter("band IS NOT NULL").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n).drop("k")


def folds(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Adds fold: all rows of a key share one of k folds."""
    return rows.withColumn("fold", (F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long") % k).cast("int"))


def _check(name: str, bad: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), F.coalesce(bad, F.lit(0)).cast("long").alias("violations"))


def contract(rows: DataFrame, vocabularies: dict[str, tuple[str, ...]]) -> DataFrame:
    """check, violations over a correlative (record, ID_GRUPO, ID_ENTIDAD, vocabulary columns): ids set and unique, groups and entities one to one."""
    per_record = rows.groupBy("record").agg(F.count(F.lit(1)).alias("n")).agg(_check("ID_REGISTRO unique", F.count_if(F.expr("n > 1"))).alias("c"))
    per_group = rows.groupBy("ID_GRUPO").agg(F.countDistinct("ID_ENTIDAD").alias("n")).agg(_check("one entity per group", F.count_if(F.expr("n <> 1"))).alias("c"))
    per_entity = rows.groupBy("ID_ENTIDAD").agg(F.countDistinct("ID_GRUPO").alias("n")).agg(_check("one group per entity", F.count_if(F.expr("n <> 1"))).alias("c"))
    plain = [_check("ids set", F.count_if(F.col("record").isNull() | F.col("ID_GRUPO").isNull() | F.col("ID_ENTIDAD").isNull()))]
    plain += [_check(f"{c} vocabulary", F.count_if(~F.coalesce(F.col(c).isin(*words), F.lit(False)))) for c, words in vocabularies.items()]
    single = rows.agg(F.array(*plain).alias("x")).select(F.explode("x").alias("c"))
    return single.unionAll(per_record).unionAll(per_group).unionAll(per_entity).select("c.*")
