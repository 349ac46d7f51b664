"""Linking companies of one table (anchors) with the records of another (destinations).

Candidates come from shared distinctive words (one deletion apart at most) and from acronyms; pairs are
classified by level and band, web domains carry links on, human decisions come last and win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .tables import spread_join

#: Levels and bands from best to worst (fixed values).
LEVELS, BANDS = ("MATRIZ", "EMPRESA", "GRUPO", "REVISAR"), ("A", "B", "C")


def surfaces(destinations: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """key, kind, surface: one row per non-empty spelling. columns: kind -> column (name, alias, parent)."""
    wide = destinations.select(F.col(key), *[F.col(c).cast("string").alias(kind) for kind, c in columns.items()])
    return wide.unpivot([key], list(columns), "kind", "surface").filter(~text.is_missing(F.col("surface")))


def representatives(rows: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per distinct keys with N_FILAS and the sums of the metrics."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("N_FILAS"), *[F.sum(m).alias(m) for m in metrics])


def _words(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key), F.explode(F.array_distinct(text.distinctive_words(F.col(name)))).alias("word"))


def shared_word_pairs(anchors: DataFrame, destinations: DataFrame, key_a: str, key_b: str, name: str = "name") -> DataFrame:
    """(key_a, key_b, shared): all pairs with a distinctive word alike or one letter apart."""
    wa, wb = _words(anchors, key_a, name), _words(destinations, key_b, name)
    # words are few beside records: their spellings are matched once, then expanded
    keyed = lambda d, to: d.select("word").distinct().select(F.col("word").alias(to), F.explode(text.deletion_variants(F.col("word"), 3)).alias("form"))
    alike = keyed(wa, "wa").join(keyed(wb, "wb"), "form").select("wa", "wb").distinct().filter(F.levenshtein("wa", "wb") <= 1)
    hits = spread_join(spread_join(alike, wa.withColumnRenamed("word", "wa"), ["wa"]), wb.withColumnRenamed("word", "wb"), ["wb"])
    return hits.groupBy(key_a, key_b).agg(F.countDistinct("wa").alias("shared"))


def acronym_pairs(anchors: DataFrame, destinations: DataFrame, key_a: str, key_b: str, name: str = "name", least: int = 2, most: int = 5) -> DataFrame:
    """(key_a, key_b): one side's single word is the initials of the other's words (least to most of them), in either direction."""

    def sides(df, key):
        words = F.split(F.col(name), " ")
        split = df.filter(F.col(name) != "").select(F.col(key), F.col(name).alias("__name"), words.alias("w"))
        initials = split.filter(F.size("w").between(least, most)).select(key, F.array_join(F.transform("w", lambda x: F.substring(x, 1, 1)), "").alias("sigla"))
        return initials, split.filter((F.size("w") == 1) & F.length("__name").between(least, most)).select(key, F.col("__name").alias("sigla"))

    (ia, wa), (ib, wb) = sides(anchors, key_a), sides(destinations, key_b)
    return ia.join(wb, "sigla").select(key_a, key_b).union(wa.join(ib, "sigla").select(key_a, key_b)).distinct()


def same_country(own: Column, evidence: Column) -> Column:
    """SÍ, NO or SIN DATO from a code and codes joined by |."""
    return F.when((F.coalesce(own, F.lit("")) == "") | (F.coalesce(evidence, F.lit("")) == ""), "SIN DATO").when(F.array_contains(F.split(evidence, r"\|"), own), "SÍ").otherwise("NO")


def classify(pairs: DataFrame, high: float = 0.88, middle: float = 0.84) -> DataFrame:
    """Adds NIVEL, BANDA and MOTIVO to pairs (kind, similarity, compact_equal, shared, country)."""
    s, other = F.col("similarity"), F.col("country") == "NO"
    level = (
        F.when(F.col("kind") == "parent", F.when(s >= high, "MATRIZ").otherwise("REVISAR"))
        .when((F.col("compact_equal") | (s >= high)) & ~other, "EMPRESA")
        .when((F.col("compact_equal") | (s >= high)) | ((s >= middle) & (F.col("shared") > 0)), "GRUPO")
        .otherwise("REVISAR")
    )
    band = F.when(F.col("compact_equal") & (F.col("country") == "SÍ"), "A").when(s >= high, "B").otherwise("C")
    motive = F.concat_ws("; ", F.when(F.col("compact_equal"), "misma forma compacta"), F.when(F.col("shared") > 0, "palabras en común"), F.when(other, "otro país"))
    return pairs.withColumns({"NIVEL": level, "BANDA": band, "MOTIVO": motive})


def _rank(level: Column, band: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), level) * 10 + F.array_position(F.array(*map(F.lit, BANDS)), band)


def best_per_entity(pairs: DataFrame, entity: str, destination: str, tie: str) -> DataFrame:
    """Of each entity and destination the pair of best level and band, then highest score, then smallest tie."""
    columns = [c for c in pairs.columns if c not in (entity, destination)]
    order = F.struct(_rank(F.col("NIVEL"), F.col("BANDA")), -F.col("score"), F.col(tie))
    best = pairs.groupBy(entity, destination).agg(F.min_by(F.struct(*columns), order).alias("b"))
    return best.select(entity, destination, "b.*")


def mark_principal(links: DataFrame, entity: str, destination: str) -> DataFrame:
    """Adds PRINCIPAL: true for each entity's best link."""
    order = Window.partitionBy(entity).orderBy(_rank(F.col("NIVEL"), F.col("BANDA")), F.desc("score"), destination)
    return links.withColumn("PRINCIPAL", F.row_number().over(order) == 1)


def propagate_web(links: DataFrame, domains: DataFrame, entity: str, destination: str) -> DataFrame:
    """links with further rows (NIVEL GRUPO, BANDA B, VIA web): destinations that share the domain of an EMPRESA link. Existing pairs stay as they are.

    domains: (destination, domain); domains are joined by key, so a common one costs its links and not pairs of records.
    """
    named = domains.filter(F.coalesce(F.col("domain"), F.lit("")) != "").select(destination, "domain").distinct()
    held = links.filter("NIVEL = 'EMPRESA'").join(named, destination).select(entity, "domain").distinct()
    new = held.join(named, "domain").select(entity, destination).distinct().join(links.select(entity, destination), [entity, destination], "left_anti")
    more = new.withColumns({"NIVEL": F.lit("GRUPO"), "BANDA": F.lit("B"), "VIA": F.lit("web")})
    return links.withColumn("VIA", F.lit("nombre")).unionByName(more, allowMissingColumns=True)


def apply_decisions(pairs: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join: DECISION wins over the engine's verdict; decided pairs that nobody proposed are added (ORIGEN decision)."""
    d = decisions.select(*keys, F.col("decision").alias("DECISION"))
    origin = F.when(F.col("__seen").isNull(), "decision").when(F.col("DECISION").isNull(), "motor").otherwise("ambos")
    whole = pairs.withColumn("__seen", F.lit(1)).join(d, keys, "full_outer").withColumn("ORIGEN", origin)
    return whole.withColumn("FINAL", F.coalesce(F.col("DECISION"), F.col("verdict"))).drop("__seen")


def entity_sheet(rows: DataFrame, entity: str, metrics: list[str], contacts: list[str], most: int = 3) -> DataFrame:
    """Per entity: N_FILAS, sums of the metrics, and the most frequent contacts of each kind (ties by text), joined by ' | '."""
    base = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("N_FILAS"), *[F.sum(m).alias(m) for m in metrics])
    for c in contacts:
        counts = rows.filter(~text.is_missing(F.col(c))).groupBy(entity, c).agg(F.count(F.lit(1)).alias("__n"))
        rank = F.row_number().over(Window.partitionBy(entity).orderBy(F.desc("__n"), c))
        top = counts.withColumn("__k", rank).filter(F.col("__k") <= most).groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__k", c))), lambda x: x[c]), " | ").alias(c))
        base = base.join(top, entity, "left")
    return base
