"""Country spellings against a catalog: exact, then without marks and spaces; never by similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import strings, text

#: A catalog is a short list; a longer one is joined by shuffle.
MAX_CATALOG = 20_000
FREE_ZONE = r"\b(ZONA FRANCA|FREE ZONE|FREE TRADE ZONE)\b"


def _lax(c: Column) -> Column:
    return F.regexp_replace(text.ascii_upper(c), "[^A-Z0-9]", "")


def canonical(records: DataFrame, key: str, country: str, catalog: DataFrame) -> DataFrame:
    """key, spelling, code, how (exacto, laxo, zona franca, sin clasificar, vacio). catalog: (alias, code); of repeated aliases the first code stays."""
    named = catalog.select(text.ascii_upper(F.col("alias")).alias("exact"), _lax(F.col("alias")).alias("lax"), "code").filter("exact <> ''")
    exact = named.groupBy("exact").agg(F.min("code").alias("exact_code"))
    lax = named.filter("lax <> ''").groupBy("lax").agg(F.min("code").alias("lax_code"))
    if catalog.limit(MAX_CATALOG + 1).count() <= MAX_CATALOG:
        exact, lax = F.broadcast(exact), F.broadcast(lax)
    rows = records.select(F.col(key), F.col(country).alias("spelling"), text.ascii_upper(F.col(country)).alias("exact"), _lax(F.col(country)).alias("lax"))
    found = rows.join(exact, "exact", "left").join(lax, "lax", "left")
    how = F.when(text.is_missing(F.col("spelling")), "vacio").when(F.col("exact_code").isNotNull(), "exacto").when(F.col("lax_code").isNotNull(), "laxo").when(F.regexp_like("exact", F.lit(FREE_ZONE)), "zona franca").otherwise("sin clasificar")
    return found.select(key, "spelling", F.when(how != "vacio", F.coalesce("exact_code", "lax_code")).alias("code"), how.alias("how"))


def coverage(found: DataFrame, catalog: DataFrame, stop: bool = False) -> DataFrame:
    """Unknown spellings with their rows and the catalog alias most alike (a suggestion only). With stop, raises where any is left."""
    unknown = found.filter("how = 'sin clasificar'").groupBy("spelling").agg(F.count(F.lit(1)).alias("rows"))
    if stop and not unknown.isEmpty():
        raise ValueError("unknown countries: " + ", ".join(r["spelling"] for r in unknown.orderBy(F.desc("rows"), "spelling").limit(20).collect()))
    # spellings that share a first letter with an alias are compared
    first = lambda c: F.substring(text.ascii_upper(F.col(c)), 1, 1)
    pairs = unknown.withColumn("k", first("spelling")).join(catalog.select("alias", first("alias").alias("k")), "k")
    near = pairs.withColumn("s", strings.jaro_winkler_udf(text.ascii_upper(F.col("spelling")), text.ascii_upper(F.col("alias"))))
    best = near.groupBy("spelling").agg(F.max_by("alias", F.struct("s", "alias")).alias("suggestion"))
    return unknown.join(best, "spelling", "left")
