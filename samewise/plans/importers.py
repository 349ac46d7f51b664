"""The importers' route: country as a hard partition, LSH and name similarity inside it, stars as groups, then the deliverables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import comparators as cmp
from ..functions import countries, text
from ..functions import identifiers as ids
from ..operators import blocking, clusters, linking, reports, scoring
from ..operators.tables import stored


@dataclass(frozen=True)
class ImporterOptions:
    """Defaults of the route (fixed values): name similarity, star cover, LSH bands and rows, largest block."""

    name_threshold: float = 0.84
    coverage: float = 0.80
    bands: int = 32
    rows: int = 4
    max_block: int = 500


@dataclass
class ImporterResult:
    """correlative (one row per input row), golden (one per group), countries (spellings), pairs (scored)."""

    correlative: DataFrame
    golden: DataFrame
    countries: DataFrame
    pairs: DataFrame


def importers(rows: DataFrame, key: str, name: str, country: str, catalog: DataFrame, metrics: tuple[str, ...] = (), options: ImporterOptions = ImporterOptions()) -> ImporterResult:
    """Rows without a known country form a partition of their own ('')."""
    found = stored(countries.canonical(rows, key, country, catalog), "countries")
    named = rows.select(F.col(key), text.clean_name(F.col(name)).alias("name"), *metrics).join(found.select(key, F.coalesce("code", F.lit("")).alias("country")), key)
    named = stored(named.withColumn("rec_id", F.xxhash64("country", "name")), "named")
    reps = stored(linking.representatives(named.filter("name <> ''"), ["rec_id", "country", "name"], list(metrics)), "reps")
    padded = F.concat(F.lit(" "), F.col("name"), F.lit(" "))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))
    banded = reps.select("rec_id", "country", F.explode(ids.band_hashes(grams, options.bands, options.rows)).alias("b"))
    pairs = stored(blocking.pairs_by_key(banded.select("rec_id", F.struct("country", "b.band", "b.hash").alias("key")), options.max_block, "connect").distinct(), "pairs")
    wide = scoring.attach(pairs, reps.select("rec_id", "name"), ["name"])
    scored = stored(wide.select("id_l", "id_r", cmp.name_similarity(F.col("name_l"), F.col("name_r")).alias("score")), "scored")
    good = scored.filter(F.col("score") >= options.name_threshold)
    groups = stored(clusters.components(reps, good), "groups")
    stars = stored(clusters.star_cover(groups.join(reps.select("rec_id", "name"), "rec_id"), options.coverage), "stars")
    scores = reports.pair_score(stars, good)
    whole = named.join(stars, "rec_id", "left").join(scores, "rec_id", "left").withColumn("group", F.coalesce("group", F.xxhash64(F.lit("alone"), F.col(key))))
    whole = stored(whole.select(key, "country", "name", *metrics, "group", "SCORE_PAR"), "correlative")
    total = whole.groupBy("group").agg(F.min("country").alias("country"), F.mode("name", True).alias("NOMBRE_FINAL"), F.count(F.lit(1)).alias("N_FILAS"), F.countDistinct("name").alias("N_NOMBRES"), *[F.sum(m).alias(m) for m in metrics])
    return ImporterResult(whole, total, countries.coverage(found, catalog), scored)


def invariants(result: ImporterResult, rows: DataFrame, key: str, metrics: tuple[str, ...] = ()) -> DataFrame:
    """check, violations: no row lost or doubled, metrics conserved, no group across countries, one golden row per group."""
    c, g = result.correlative, result.golden
    checks = [
        ("rows conserved", F.lit(abs(rows.count() - c.count()))),
        ("keys unique", F.lit(c.groupBy(key).count().filter("count > 1").count())),
        ("groups within a country", F.lit(c.groupBy("group").agg(F.countDistinct("country").alias("n")).filter("n > 1").count())),
        ("one golden row per group", F.lit(abs(g.count() - c.select("group").distinct().count()))),
    ]
    for m in metrics:
        before, after = (df.agg(F.sum(m)).first()[0] or 0 for df in (rows, g))
        checks.append((f"{m} conserved", F.lit(int(abs(before - after) > 1e-6 * max(1.0, abs(before))))))
    return rows.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("long").alias("violations")) for n, v in checks])))
