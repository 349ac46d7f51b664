"""Company or person: indicator words and patterns, and token weights learned from labelled names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text

#: Words that speak for a company or for a person, with their weights (fixed values).
COMPANY_WORDS = {"SAS": 6, "LTDA": 6, "LTD": 6, "INC": 6, "LLC": 6, "CORP": 5, "CIA": 4, "GRUPO": 3, "COMERCIALIZADORA": 4, "INVERSIONES": 4, "SERVICIOS": 3, "INDUSTRIAS": 4, "FUNDACION": 4, "BANCO": 4, "COOPERATIVA": 4}
PERSON_WORDS = {"MARIA": 4, "JOSE": 4, "JUAN": 4, "LUIS": 3, "CARLOS": 3, "ANA": 3, "PEDRO": 3, "GOMEZ": 2, "RODRIGUEZ": 2, "GARCIA": 2, "MARTINEZ": 2, "LOPEZ": 2}
#: A legal form at the end decides by itself.
LEGAL_END, GOLDEN = r"(^| )(S A S|SAS|LTDA|S A|INC|LLC|LTD)$", 100
ENOUGH, MAX_TOKEN = 2.0, 3.0


def _weighed(words: Column, weights: dict[str, int]) -> Column:
    table = F.create_map(*[x for w, n in weights.items() for x in (F.lit(w), F.lit(float(n)))])
    return F.aggregate(words, F.lit(0.0), lambda total, w: total + F.coalesce(F.element_at(table, w), F.lit(0.0)))


def indicator_score(c: Column) -> Column:
    """Positive for companies, negative for persons."""
    folded = text.ascii_upper(c)
    words = F.split(folded, "[^A-Z0-9]+")
    golden = F.when(F.regexp_like(folded, F.lit(LEGAL_END)), float(GOLDEN)).otherwise(0.0)
    return golden + _weighed(words, COMPANY_WORDS) - _weighed(words, PERSON_WORDS) + F.when(F.regexp_like(folded, F.lit("[0-9&]")), 1.0).otherwise(0.0)


def kind_of(c: Column, score: Column) -> Column:
    """empresa, persona, incierto, or invalido (no two letters)."""
    letters = F.length(F.regexp_replace(text.ascii_upper(c), "[^A-Z]", ""))
    return F.when(text.is_missing(c) | (letters < 2), "invalido").when(score >= ENOUGH, "empresa").when(score <= -ENOUGH, "persona").otherwise("incierto")


def learn_tokens(labelled: DataFrame, least: int = 5) -> DataFrame:
    """token, weight from rows (name, company boolean): half the logarithm of the smoothed odds, within MAX_TOKEN."""
    rows = labelled.filter("company IS NOT NULL").select("company", F.explode(F.array_distinct(F.split(text.ascii_upper(F.col("name")), "[^A-Z0-9]+"))).alias("token")).filter("token <> ''")
    totals = F.broadcast(labelled.agg(F.count_if("company").alias("c"), F.count_if(~F.col("company")).alias("p")))
    seen = rows.groupBy("token").agg(F.count_if("company").alias("nc"), F.count_if(~F.col("company")).alias("np")).filter(F.col("nc") + F.col("np") >= least)
    odds = 0.5 * F.log((F.col("nc") + 1) / (F.col("c") + 2) / ((F.col("np") + 1) / (F.col("p") + 2)))
    return seen.crossJoin(totals).select("token", F.greatest(F.lit(-MAX_TOKEN), F.least(F.lit(MAX_TOKEN), odds)).alias("weight"))


def classify(records: DataFrame, key: str, name: str, tokens: DataFrame | None = None) -> DataFrame:
    """key, score, kind of every record; learned token weights are joined by token and summed per record."""
    base = records.select(F.col(key), F.col(name).alias("__name"), indicator_score(F.col(name)).alias("score"))
    if tokens is not None:
        words = base.select(key, F.explode(F.array_distinct(F.split(text.ascii_upper(F.col("__name")), "[^A-Z0-9]+"))).alias("token"))
        learned = words.join(tokens, "token").groupBy(key).agg(F.sum("weight").alias("__more"))
        base = base.join(learned, key, "left").withColumn("score", F.col("score") + F.coalesce("__more", F.lit(0.0)))
    return base.select(key, "score", kind_of(F.col("__name"), F.col("score")).alias("kind"))
