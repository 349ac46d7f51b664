"""Pair scores and decisions: the production profile, the declarative multi-field schema, classification."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import comparators as cmp
from ..functions import identifiers as ids
from ..functions import strings, text


@dataclass(frozen=True)
class Profile:
    """Weights and thresholds of the name and identifier score."""

    name_weight: float = 0.5
    nit_weight: float = 0.5
    score_threshold: float = 0.45
    min_name: float = 0.30
    max_nit_distance: int = 3
    veto: bool = True
    generic_penalty: float = 0.0
    extra: dict[str, tuple[str, float]] = field(default_factory=dict)


def attach(pairs: DataFrame, records: DataFrame, columns: list[str]) -> DataFrame:
    """Both records' columns as <column>_l and <column>_r."""
    for side in "lr":
        part = records.select(F.col("rec_id").alias(f"id_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(part, f"id_{side}")
    return pairs


def score_pairs(pairs: DataFrame, records: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """id_l, id_r, score, name_sim, nit_sim, nit_dist of pairs that pass. records: rec_id, name, nit, base and extra columns.

    Identifiers and the veto come first, so that the string kernels see only what is left.
    """
    wide = attach(pairs, records, ["name", "nit", "base", *profile.extra])
    wide = wide.withColumns({"nit_dist": cmp.nit_distance(F.col("nit_l"), F.col("nit_r")), "nit_sim": cmp.nit_similarity(F.col("nit_l"), F.col("nit_r"))})
    wide = wide.filter((F.col("nit_dist") <= profile.max_nit_distance) | (F.col("nit_dist") == 0))
    if profile.veto:
        differ = (F.col("base_l") != "") & (F.col("base_r") != "") & (F.col("base_l") != F.col("base_r"))
        wide = wide.filter(~differ | ids.extends_by_check_digit(F.col("nit_l"), F.col("nit_r")))
    wide = wide.withColumn("name_sim", cmp.name_similarity(F.col("name_l"), F.col("name_r")))
    if profile.generic_penalty:
        plain = lambda c: (F.size(F.split(c, " ")) <= 3) & F.forall(F.split(c, " "), lambda w: w.isin(*text.GENERIC))
        wide = wide.withColumn("name_sim", F.when(plain(F.col("name_l")) & plain(F.col("name_r")) & (F.col("name_sim") >= 0.85), F.col("name_sim") * (1 - profile.generic_penalty)).otherwise(F.col("name_sim")))
    wide = wide.filter((F.col("name_sim") >= profile.min_name) | (F.col("nit_dist") == 0))
    score = profile.name_weight * F.col("name_sim") + profile.nit_weight * F.col("nit_sim")
    for column, (kind, weight) in profile.extra.items():
        score = score + weight * cmp.REGISTRY[kind].build(F.col(f"{column}_l"), F.col(f"{column}_r"))
    wide = wide.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
    return wide.filter(F.col("score") >= profile.score_threshold).select("id_l", "id_r", "score", "name_sim", "nit_sim", "nit_dist")


@dataclass(frozen=True)
class FieldSpec:
    """A field of the declarative schema. missing: IGNORE, PENALIZE or BLOCK."""

    name: str
    comparator: str
    weight: float = 1.0
    agrees: float = 0.8
    missing: str = "IGNORE"
    veto: float | None = None

    def __post_init__(self):
        if self.comparator not in cmp.REGISTRY:
            raise ValueError(f"no comparator {self.comparator}")
        if self.missing not in ("IGNORE", "PENALIZE", "BLOCK"):
            raise ValueError(f"no policy {self.missing}")


@dataclass(frozen=True)
class Schema:
    fields: tuple[FieldSpec, ...]
    threshold: float = 0.75
    concordances: int = 2
    corroborate: int = 0


def decide_fields(pairs: DataFrame, records: DataFrame, schema: Schema) -> DataFrame:
    """id_l, id_r, score, concordances, veto, fusion: the weighted score under the missing-value policies."""
    return decided(attach(pairs, records, [f.name for f in schema.fields]), schema).select("id_l", "id_r", "score", "concordances", "veto", "fusion")


def decided(wide: DataFrame, schema: Schema) -> DataFrame:
    """wide and score, concordances, veto, fusion of its rows; it holds the fields of both records as <field>_l and <field>_r."""
    given = wide.columns
    scores = {f"s_{f.name}": cmp.REGISTRY[f.comparator].build(F.col(f"{f.name}_l"), F.col(f"{f.name}_r")) for f in schema.fields}
    known = {f"v_{f.name}": cmp.valid(F.col(f"{f.name}_l"), F.col(f"{f.name}_r")) for f in schema.fields}
    wide = wide.withColumns(scores | known)
    s, v = (lambda f: F.col(f"s_{f.name}")), (lambda f: F.col(f"v_{f.name}"))
    strong = sum((F.when(v(f) & (s(f) >= 0.99), 1).otherwise(0) for f in schema.fields if f.veto is None), F.lit(0))
    lifted = strong >= schema.corroborate if schema.corroborate else F.lit(False)
    vetoing = [(f, v(f) & (s(f) <= f.veto)) for f in schema.fields if f.veto is not None]
    veto, blocked = F.lit(False), F.lit(False)
    for _, c in vetoing:
        veto = veto | (c & ~lifted)
    top, bottom, agree = F.lit(0.0), F.lit(0.0), F.lit(0)
    off = dict((f.name, c & lifted) for f, c in vetoing)
    for f in schema.fields:
        counts = (v(f) if f.missing == "IGNORE" else F.lit(True)) & ~off.get(f.name, F.lit(False))
        top = top + F.when(counts, f.weight * F.greatest(s(f), F.lit(0.0))).otherwise(0.0)
        bottom = bottom + F.when(counts, f.weight).otherwise(0.0)
        agree = agree + F.when(v(f) & (s(f) >= f.agrees), 1).otherwise(0)
        if f.missing == "BLOCK":
            blocked = blocked | ~v(f)
    score = F.when(bottom > 0, top / bottom).otherwise(0.0)
    out = wide.select(*given, score.alias("score"), agree.alias("concordances"), veto.alias("veto"), blocked.alias("blocked"))
    return out.withColumn("fusion", (F.col("score") >= schema.threshold) & (F.col("concordances") >= schema.concordances) & ~F.col("veto") & ~F.col("blocked")).drop("blocked")


def veto_schema(schema: Schema) -> Schema | None:
    """The fields that settle whether a pair is vetoed, or None: the vetoing ones, all where others may lift a veto."""
    vetoing = tuple(f for f in schema.fields if f.veto is not None)
    return replace(schema, fields=schema.fields if schema.corroborate else vetoing) if vetoing else None


def soft_tfidf(pairs: DataFrame, token_rows: DataFrame, weights: DataFrame, threshold: float = 0.9) -> DataFrame:
    """id_l, id_r, soft: Soft TF-IDF of the pairs' token lists. weights: token, idf."""
    lists = token_rows.join(weights, "token").groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("token", "idf"))).alias("t"))
    lists = lists.select("rec_id", F.transform("t", lambda x: x["token"]).alias("w"), F.transform("t", lambda x: x["idf"]).alias("i"))

    def kernel(wl: pd.Series, il: pd.Series, wr: pd.Series, ir: pd.Series) -> pd.Series:
        return pd.Series([strings.soft_tokens(list(zip(a, b)), list(zip(c, d)), threshold) for a, b, c, d in zip(wl, il, wr, ir)], dtype="float64")

    wide = pairs.join(lists.toDF("id_l", "wl", "il"), "id_l").join(lists.toDF("id_r", "wr", "ir"), "id_r")
    return wide.select("id_l", "id_r", F.pandas_udf(kernel, DoubleType())("wl", "il", "wr", "ir").alias("soft"))


def link_level(name_sim: Column, compact_equal: Column, shared: Column, same_country: Column) -> Column:
    """struct(level, band) of an anchor and a destination: EMPRESA, GRUPO or REVISAR; a country that differs lowers the band."""
    level = F.when(compact_equal | (name_sim >= 0.88), "EMPRESA").when((name_sim >= 0.84) | (shared >= 2), "GRUPO").otherwise("REVISAR")
    band = F.when(compact_equal & same_country, "A").when((name_sim >= 0.88) & same_country, "B").otherwise("C")
    return F.struct(level.alias("level"), band.alias("band"))
