"""Public routes: linkage of several sources, link of two, dedupe of one table, and the declarative dedupe."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..functions import text
from ..operators import blocking, clusters, golden, scoring
from ..operators.tables import stored
from ..sources.readers import consolidate


@dataclass
class LinkageResult:
    """Lazy tables: correlative (one row per record), golden (one per group), pairs (scored evidence), dropped (blocks that gave no candidates)."""

    correlative: DataFrame
    golden: DataFrame
    pairs: DataFrame
    dropped: DataFrame


def prepare(whole: DataFrame, name: str, nit: str | None, own_id: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """rec_id, record, src, name, nit, base and key_<column> of each key: normalised records of consolidated sources."""
    found = ids.process_nit(F.col(nit)) if nit else F.struct(F.lit("").alias("NIT_OK"), F.lit("").alias("NIT_BASE"))
    record = F.concat(F.col("SRC"), F.lit("-F"), F.col("ORIGINAL_INDEX").cast("string"))
    if own_id:
        record = F.when(F.col(own_id).isNotNull(), F.concat_ws("-", "SRC", F.col(own_id).cast("string"))).otherwise(record)
    rows = whole.select(record.alias("record"), F.col("SRC").alias("src"), F.col(name).alias("raw_name"), text.clean_name(F.col(name)).alias("name"), found.alias("f"), *[F.col(c).alias(f"key_{c}") for c in keys])
    return rows.select(F.xxhash64("record").alias("rec_id"), "record", "src", "raw_name", "name", F.col("f.NIT_OK").alias("nit"), F.col("f.NIT_BASE").alias("base"), *[f"key_{c}" for c in keys])


def linkage(spark: SparkSession, sources: dict[str, DataFrame], name: str, nit: str | None = None, own_id: str | None = None, profile: scoring.Profile = scoring.Profile(), cross_only: bool = False, trusted: tuple[str, ...] = (), coverage: float = 0.8, keys: tuple[str, ...] = (), overflow: str = "skip") -> LinkageResult:
    """Normalise, block, score, group, split by identifier, cover by stars, golden; each step a stored table.

    keys: columns whose equal values make candidates too. overflow: "skip" leaves large blocks out and names them in dropped, "exact" leaves out none.
    """
    records = stored(prepare(consolidate(sources), name, nit, own_id, keys), "records")
    keyed = tuple(f"key_{c}" for c in keys)
    pairs = stored(blocking.hybrid(records, cross_only, trusted, keyed, overflow), "pairs")
    dropped = blocking.hybrid_dropped(records, keyed)
    dropped = dropped.limit(0) if overflow == "exact" else dropped
    scored = stored(scoring.score_pairs(pairs.select("id_l", "id_r"), records, profile), "scored")
    groups = clusters.strict(records, scored)
    torn = stored(clusters.cannot_link(groups.join(records.select("rec_id", "base"), "rec_id")), "torn")
    bare = torn.join(records.select("rec_id", "name", "base"), "rec_id")
    with_id = bare.groupBy("group").agg(F.max(F.col("base") != "").alias("has"))
    bare = bare.join(with_id, "group")
    stars = clusters.star_cover(bare.filter("NOT has").select("rec_id", "group", "name"), coverage)
    final = stored(bare.filter("has").select("rec_id", "group").unionByName(stars).join(records, "rec_id"), "groups")
    numbers = clusters.numbered(final.select("group", "record"), "record")
    entities = golden.entity_ids(final.select("group", "record", "base"))
    gold = golden.golden(final, tuple(sources)).join(numbers, "group").join(entities, "group").drop("group")
    correlative = final.join(numbers, "group").join(entities, "group").select("record", "src", "raw_name", "name", "nit", "base", "ID_GRUPO", "ID_ENTIDAD")
    return LinkageResult(correlative, gold, scored, dropped)


def link(spark: SparkSession, a: DataFrame, b: DataFrame, name: str, nit: str | None = None, **options) -> tuple[LinkageResult, DataFrame]:
    """Two tables, pairs across them only; and the counts of the cross."""
    result = linkage(spark, {"A": a, "B": b}, name, nit, cross_only=True, **options)
    return result, golden.cross_counts(result.correlative.withColumnRenamed("ID_GRUPO", "group"), "A", "B")


def dedupe(spark: SparkSession, df: DataFrame, name: str, nit: str | None = None, **options) -> LinkageResult:
    """One table as its only source: rows with and without identifier share the groups that their names allow."""
    return linkage(spark, {"BASE": df}, name, nit, **options)


def auto_blocking(records: DataFrame, schema: scoring.Schema) -> DataFrame:
    """Pairs by each field's kind: keys for identifiers and contacts, LSH for the first name, neighbourhoods for dates and numbers."""
    found, named = {}, False
    for f in schema.fields:
        kind = f.comparator
        if kind in ("exact_signed", "exact_with_check_digit", "document_signed", "phone_signed", "email_signed"):
            key = {"phone_signed": ids.phone_key, "document_signed": ids.document_key}.get(kind, lambda c: F.lower(F.trim(c)))(F.col(f.name))
            found[f.name] = blocking.pairs_by_key(records.select("rec_id", F.when(key != "", key).alias("key")))
        elif not named and kind in ("jaro_winkler_signed", "token_set_signed", "token_sort_signed", "levenshtein_signed"):
            found[f.name], named = blocking.lsh_pairs(records, f.name), True
        elif kind in ("date_delta", "number_relative", "number_absolute"):
            found[f.name] = blocking.sorted_neighbourhood(records, f.name)
    if not found:
        raise ValueError("no field of the schema can block")
    return blocking.union_pairs(**found)


def dedupe_schema(records: DataFrame, schema: scoring.Schema) -> tuple[DataFrame, DataFrame]:
    """(rec_id, group) and the decisions, by the declarative engine. records: rec_id and the schema's fields."""
    pairs = stored(auto_blocking(records, schema).select("id_l", "id_r"), "pairs")
    decisions = stored(scoring.decide_fields(pairs, records, schema), "decisions")
    return clusters.constrained(records, decisions), decisions


def dedupe_by_key(records: DataFrame, key: Column, schema: scoring.Schema) -> DataFrame:
    """(rec_id, group) by the declarative engine over all pairs with equal key, blocks of any size.

    Records that agree in key and all fields are one class. Fusions of classes are tried but not stored, only the components that they
    make; decisions are stored for components that hold a veto. The schema's comparators must give the same in both directions.
    """
    values = [f.name for f in schema.fields]
    keyed = records.select("rec_id", *values, key.alias("__key"))
    classes, members = golden.collapse(keyed, ["__key", *values], "rec_id")
    classes, members = stored(classes.withColumnRenamed("rep_id", "rec_id"), "classes"), stored(members, "members")
    link = lambda wide: scoring.decided(wide, schema).withColumn("linked", F.expr("fusion AND NOT veto"))
    whole = stored(clusters.linked(classes, values, link), "whole")
    blocked = classes.filter("__key IS NOT NULL")
    copies = blocked.filter("n_rows > 1").select("rec_id", *[F.col(v).alias(f"{v}_{s}") for v in values for s in "lr"])
    several = whole.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tied = whole.join(several, "group", "left_semi").select("rec_id").unionByName(link(copies).filter("linked").select("rec_id")).distinct()
    vetoes = scoring.veto_schema(schema)
    torn = whole.select("group").limit(0)
    if vetoes:
        torn = clusters.torn_groups(blocked.join(whole.toDF("rec_id", "__group"), "rec_id"), [f.name for f in vetoes.fields], lambda wide: scoring.decided(wide, vetoes))

    def decide(inside: DataFrame) -> DataFrame:
        pairs = blocking.pairs_by_key(inside.select("rec_id", F.col("group").alias("key")), overflow="exact")
        each = blocked.filter("n_rows > 1").join(inside.select("rec_id"), "rec_id").select(F.col("rec_id").alias("id_l"), F.col("rec_id").alias("id_r"))
        return stored(scoring.decide_fields(pairs.unionByName(each), classes, schema).filter("fusion OR veto"), "decisions")

    return clusters.constrained_copies(members, whole, tied, stored(torn, "torn"), decide)
