"""Similarity of names that have no identifier: what they share is weighed by its rarity in the corpus, beside the likeness of their letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strings
from ..functions.identifiers import let
from .tables import shuffled


@dataclass(frozen=True)
class NameRules:
    """alpha: share of the words against the letters; generic: words that weigh neutral_weight; structural: words that never tell two names apart.

    The three gates of containment: most_difference informative words differ at most, least_shared are shared, and the rarest
    shared one is in no more than distinctive of all names (five names at least).
    """

    alpha: float = 0.25
    generic: tuple[str, ...] = ()
    structural: tuple[str, ...] = ()
    neutral_weight: float = 1.0
    most_difference: int = 0
    least_shared: int = 1
    distinctive: float = 0.01
    least_letters: int = 3


#: Names that a share of the corpus stands for at least, and letters of the words that count (fixed values).
LEAST_NAMES, WORD = 5, 2


def name_words(names: DataFrame, rules: NameRules = NameRules(), column: str = "name") -> tuple[DataFrame, int]:
    """(name, words) of the distinct names, words an array of (word, raw, weight, telling); and the number of names.

    raw = ln((1 + N) / (1 + names with the word)) + 1; generic words weigh neutral_weight at most.
    """
    distinct = names.select(F.col(column).alias("name")).filter("name <> ''").distinct()
    n = distinct.count()
    rows = distinct.select("name", F.explode(F.array_distinct(F.filter(F.split("name", " "), lambda w: F.length(w) >= WORD))).alias("word"))
    held = rows.groupBy("word").agg(F.count(F.lit(1)).alias("df")).withColumn("raw", F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)
    generic = F.col("word").isin(*rules.generic) if rules.generic else F.lit(False)
    structural = F.col("word").isin(*rules.structural) if rules.structural else F.lit(False)
    held = held.withColumn("weight", F.when(generic, F.least("raw", F.lit(rules.neutral_weight))).otherwise(F.col("raw")))
    held = held.withColumn("telling", (F.length("word") >= rules.least_letters) & ~structural & ~F.regexp_like("word", F.lit("^[0-9]+$")))
    listed = rows.join(shuffled(held), "word").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("word", "raw", "weight", "telling"))).alias("words"))
    return distinct.join(shuffled(listed), "name", "left").select("name", F.coalesce("words", F.array().cast(listed.schema["words"].dataType)).alias("words")), n


def _total(words: Column, value) -> Column:
    return F.aggregate(words, F.lit(0.0), lambda s, w: s + value(w))


def name_similarity(pairs: DataFrame, words: DataFrame, n: int, rules: NameRules = NameRules()) -> DataFrame:
    """pairs (l, r) with SIM_TOKENS, JARO_WINKLER, DIF_INFORMATIVA (null: a name is not of the corpus), USO_CONTENCION and SCORE (0 to 1).

    words, n: of name_words(). Words count by Jaccard of their weights, or, if all three gates are open, by the better of that
    and the containment of the lighter name. Pairs should be distinct: each is worked out by itself.
    """
    often = max(LEAST_NAMES, round(rules.distinctive * n)) if rules.distinctive else 0
    floor = F.log((1 + F.lit(n)) / (1 + F.lit(often))) + 1 if often else F.lit(0.0)
    wide = pairs.join(shuffled(words.toDF("l", "wl")), "l", "left").join(shuffled(words.toDF("r", "wr")), "r", "left")

    def measure(x: Column) -> Column:
        shared, weight = x["shared"], lambda w: w["weight"]
        inter, left, right = (_total(v, weight) for v in (shared, F.col("wl"), F.col("wr")))
        union, lighter = left + right - inter, F.least(left, right)
        ratio = lambda a, b: F.when(b > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), a / b))).otherwise(0.0)
        telling = lambda v: F.size(F.filter(v, lambda w: w["telling"]))
        common = telling(shared)
        difference = telling(F.col("wl")) + telling(F.col("wr")) - 2 * common
        rarest = F.coalesce(F.array_max(F.transform(F.filter(shared, lambda w: w["telling"]), lambda w: w["raw"])), F.lit(0.0))
        opens = (difference <= rules.most_difference) & (common >= rules.least_shared) & (rarest >= floor)
        known = F.col("wl").isNotNull() & F.col("wr").isNotNull()
        tokens = F.when(opens, F.greatest(ratio(inter, lighter), ratio(inter, union))).otherwise(ratio(inter, union))
        return F.struct(F.when(known, tokens).otherwise(0.0).alias("tokens"), F.when(known, difference).alias("difference"), F.coalesce(known & opens, F.lit(False)).alias("opens"))

    shared = F.filter("wl", lambda w: F.exists(F.col("wr"), lambda v: v["word"] == w["word"]))
    read = wide.withColumn("m", let(F.struct(shared.alias("shared")), measure)).withColumn("JARO_WINKLER", strings.jaro_winkler_udf("l", "r"))
    score = rules.alpha * F.col("m.tokens") + (1 - rules.alpha) * F.col("JARO_WINKLER")
    both = (F.length("l") > 0) & (F.length("r") > 0)
    return read.select(*pairs.columns, F.col("m.tokens").alias("SIM_TOKENS"), "JARO_WINKLER", F.col("m.difference").alias("DIF_INFORMATIVA"), F.col("m.opens").alias("USO_CONTENCION"), F.when(both, score).otherwise(0.5).alias("SCORE"))
