"""Golden records, group metrics, collapse of exact duplicates, source presence, entity ids across runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..functions import text


def group_metrics(rows: DataFrame, priority: tuple[str, ...] = ()) -> DataFrame:
    """Per group of rows (group, src, name, nit, rec_id): sources, counts and the primary source."""
    rank = F.coalesce(*[F.when(F.col("src") == s, i) for i, s in enumerate(priority)], F.lit(len(priority)))
    return rows.groupBy("group").agg(
        F.array_join(F.array_sort(F.collect_set("src")), "|").alias("SOURCES"),
        # the set of sources is at hand: each distinct count more would shuffle all rows once more
        F.size(F.collect_set("src")).cast("long").alias("SOURCES_COUNT"),
        F.count(F.lit(1)).alias("RECORDS_COUNT"),
        F.countDistinct(F.when(F.col("name") != "", F.col("name"))).alias("NAMES_COUNT"),
        F.countDistinct(F.when(F.col("nit") != "", F.col("nit"))).alias("NIT_COUNT"),
        F.min(F.struct(rank, "rec_id", "src"))["src"].alias("PRIMARY_SOURCE"),
    )


def confidence(m: DataFrame) -> DataFrame:
    """Adds CONFIDENCE, CONFIDENCE_SCORE and REQUIRES_REVIEW to group metrics."""
    nit, names, rows, src = (F.col(c) for c in ("NIT_COUNT", "NAMES_COUNT", "RECORDS_COUNT", "SOURCES_COUNT"))
    level = F.when((nit == 1) & (src >= 2), "ALTA").when((nit <= 2) & (rows <= 5), "MEDIA").otherwise("BAJA")
    mixed = F.round(0.5 / F.greatest(nit, F.lit(1)) + 0.4 / F.greatest(names, F.lit(1)) + 0.1 * F.least(F.lit(1.0), src / 3), 4)
    score = F.when((nit <= 1) & (names <= 1), F.when(src == 1, 0.85).otherwise(1.0)).otherwise(mixed)
    return m.withColumns({"CONFIDENCE": level, "CONFIDENCE_SCORE": score, "REQUIRES_REVIEW": (nit > 3) | (names > 5) | (rows > 20)})


def best_nit(rows: DataFrame) -> DataFrame:
    """group, NIT_FINAL: the digits seen most (then longer, then alphabetic), '' if none."""
    d = rows.select("group", ids.digits(F.col("nit")).alias("d"))
    counts = d.groupBy("group", "d").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("group").agg(F.coalesce(F.min(F.when(F.col("d") != "", F.struct(-F.col("n"), -F.length("d"), F.col("d").alias("d"))))["d"], F.lit("")).alias("NIT_FINAL"))


def best_name(rows: DataFrame, priority: tuple[str, ...] = ()) -> DataFrame:
    """group, NOMBRE_FINAL: among the rows of the best source the most frequent fingerprint (tie: first seen), and its most frequent, longest, first name."""
    rank = F.coalesce(*[F.when(F.col("src") == s, i) for i, s in enumerate(priority)], F.lit(len(priority)))
    named = rows.filter("name <> ''").withColumn("rank", rank)
    each = named.groupBy("group", "rank", "name").agg(F.count(F.lit(1)).alias("n"), F.min("rec_id").alias("first")).withColumn("print", text.fingerprint(F.col("name")))
    prints = each.groupBy("group", "rank", "print").agg(F.sum("n").alias("total"), F.min("first").alias("first"), F.min(F.struct(-F.col("n"), -F.length("name"), F.col("name").alias("name")))["name"].alias("name"))
    return prints.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct("rank", -F.col("total"), F.col("first"), F.col("name").alias("name")))["name"].alias("NOMBRE_FINAL"))


def golden(rows: DataFrame, priority: tuple[str, ...] = (), min_sources: int = 1) -> DataFrame:
    """One row per group: metrics, confidence, best name and identifier."""
    m = confidence(group_metrics(rows, priority)).filter(F.col("SOURCES_COUNT") >= min_sources)
    return m.join(best_name(rows, priority), "group", "left").join(best_nit(rows), "group", "left")


def collapse(df: DataFrame, columns: list[str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """(compact, expansion): one row for each combination of columns (nulls alike) with its smallest row_id, and row_id -> rep_id."""
    compact = df.groupBy(*columns).agg(F.min(row_id).alias("rep_id"), F.count(F.lit(1)).alias("n_rows"))
    same = [df[c].eqNullSafe(compact[c]) for c in columns]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return compact, df.join(compact, condition).select(df[row_id], compact["rep_id"])


def presence(rows: DataFrame) -> DataFrame:
    """(src_a, src_b, groups): groups that hold both sources, the diagonal included."""
    seen = rows.select("group", "src").distinct()
    return seen.toDF("group", "src_a").join(seen.toDF("group", "src_b"), "group").groupBy("src_a", "src_b").agg(F.count(F.lit(1)).alias("groups"))


def absent_from(rows: DataFrame, src: str) -> DataFrame:
    return rows.select("group").distinct().join(rows.filter(F.col("src") == src).select("group").distinct(), "group", "left_anti")


def cross_counts(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: groups with both sources, implied pairs, and groups with one of them alone."""
    g = rows.groupBy("group").agg(F.count_if(F.col("src") == a).alias("na"), F.count_if(F.col("src") == b).alias("nb"))
    return g.agg(F.count_if((F.col("na") > 0) & (F.col("nb") > 0)).alias("both"), F.sum(F.col("na") * F.col("nb")).alias("pairs"), F.count_if((F.col("na") > 0) & (F.col("nb") == 0)).alias("only_a"), F.count_if((F.col("na") == 0) & (F.col("nb") > 0)).alias("only_b"))


def size_distribution(rows: DataFrame) -> DataFrame:
    g = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.when(F.col("n") == 1, "1").when(F.col("n") <= 5, "2-5").otherwise(">5")
    return g.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("largest"))


def conflicts(rows: DataFrame) -> DataFrame:
    """Groups that mix more than one valid base."""
    return rows.filter("base <> ''").groupBy("group").agg(F.countDistinct("base").alias("bases")).filter("bases > 1")


def entity_ids(rows: DataFrame) -> DataFrame:
    """group, ID_ENTIDAD from rows (group, record, base): NIT-<base> for the group of a base with most records (tie: smallest record), else by content."""
    g = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("record").alias("least"), F.collect_list("record").alias("records"), F.min(F.when(F.col("base") != "", F.col("base"))).alias("base"), F.max(F.when(F.col("base") != "", F.col("base"))).alias("last"))
    # a base may be that of any share of the groups: only its best one is sought, no base is ranked in one task
    best = g.filter("base = last").groupBy("base").agg(F.min(F.struct(-F.col("n"), "least", "group"))["group"].alias("group")).select("group", F.lit(True).alias("first"))
    named = F.when(F.col("first"), F.concat(F.lit("NIT-"), F.col("base"))).otherwise(ids.content_id(F.col("records")))
    return g.join(best, "group", "left").select("group", named.alias("ID_ENTIDAD"))


def crosswalk(rows: DataFrame) -> DataFrame:
    """ID_ENTIDAD, N_REGISTROS, REGISTROS (sorted, joined by |) of rows (ID_ENTIDAD, record)."""
    return rows.groupBy("ID_ENTIDAD").agg(F.count(F.lit(1)).alias("N_REGISTROS"), F.array_join(F.array_sort(F.collect_list("record")), "|").alias("REGISTROS"))


def inherit(previous: DataFrame, current: DataFrame) -> DataFrame:
    """old_id, group, keeps: each old entity goes to the group that holds most of its records; a group keeps the id of the old entity that gives it most."""
    overlap = previous.select(F.col("ID_ENTIDAD").alias("old_id"), F.explode(F.split("REGISTROS", r"\|")).alias("record")).join(current.select("record", "group"), "record").groupBy("old_id", "group").agg(F.count(F.lit(1)).alias("n"))
    best = overlap.withColumn("r", F.row_number().over(Window.partitionBy("old_id").orderBy(F.desc("n"), "group"))).filter("r = 1")
    return best.withColumn("keeps", F.row_number().over(Window.partitionBy("group").orderBy(F.desc("n"), "old_id")) == 1).select("old_id", "group", "keeps")


def quality_report(df: DataFrame, name: Column, nit: Column) -> DataFrame:
    """One row: rows, missing and invalid values, repeated rows and a weighted score."""
    base = df.select(name.alias("name"), nit.alias("nit")).withColumn("ok", ids.process_nit(F.col("nit"))["NIT_VALID"])
    t = base.groupBy("name", "nit", "ok").agg(F.count(F.lit(1)).alias("n"))
    m = t.agg(F.sum("n").alias("rows"), F.sum(F.when(text.is_missing(F.col("name")), F.col("n")).otherwise(0)).alias("missing_names"), F.sum(F.when(~F.col("ok"), F.col("n")).otherwise(0)).alias("invalid_nits"), F.sum(F.col("n") - 1).alias("repeated"))
    return m.withColumn("score", F.round(100 * (1 - (0.4 * F.col("missing_names") + 0.4 * F.col("invalid_nits") + 0.2 * F.col("repeated")) / F.col("rows")), 4))
