"""Groups worked over once more: consolidation by identifier, splitting by scores, what united each row, thresholds, chains of retired ids."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strings, text
from . import golden
from .clusters import components
from .pairs import group_pairs
from .tables import spread_join, stored

#: Identifiers that stand for none (fixed values).
NO_IDENTIFIER = ("222222222", "123456789", "000000000", "111111111", "999999999", "nan", "None", "")


def brand(name: Column, locale: str = "ES") -> Column:
    """The first word of three letters or more that begins the name without legal forms and generic words, else without legal forms, else as it is; else the first such word anywhere."""
    plain = text.squeeze(F.regexp_replace(text.ascii_upper(name), r"[^A-Z0-9 ]", " "))
    first = lambda c: F.when(F.length(F.substring_index(c, " ", 1)) >= 3, F.substring_index(c, " ", 1))
    anywhere = F.get(F.filter(F.split(plain, " "), lambda w: F.length(w) >= 3), F.lit(0))
    return F.coalesce(first(text.clean_name(name, locale, drop_generic=True)), first(text.clean_name(name, locale)), first(plain), anywhere, F.substring_index(plain, " ", 1))


def robust_containment(a: Column, b: Column, strict: bool = False, locale: str = "ES") -> Column:
    """Whether two names may be of one company: alike brands with a word in common (or names alike by 0.40), one name within the other (five letters), alike word sets, or alike letters by length."""
    a, b = (F.upper(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    low, high = (0.82, 0.80) if strict else (0.78, 0.75)
    ba, bb = brand(a, locale), brand(b, locale)
    short = F.least(F.length(ba), F.length(bb)) <= 6
    rest = F.size(F.array_intersect(F.array_remove(F.split(a, r"\s+"), ba), F.array_remove(F.split(b, r"\s+"), bb))) > 0
    indel = strings.indel_ratio_udf(a, b)
    branded = (F.least(F.length(ba), F.length(bb)) >= 4) & (strings.indel_ratio_udf(ba, bb) >= F.when(short, low).otherwise(high)) & (rest | (indel >= 0.40))
    inside = (a == b) | ((a.contains(b) | b.contains(a)) & (F.least(F.length(a), F.length(b)) >= 5))
    words = strings.token_set_udf(a, b) >= (0.85 if strict else 0.80)
    least = F.least(F.length(a), F.length(b))
    eight, fifteen, more = (0.85, 0.83, 0.72) if strict else (0.80, 0.78, 0.67)
    letters = F.when(least <= 8, indel >= eight).when(least <= 15, indel >= fifteen).otherwise((indel >= more) & (strings.token_sort_udf(a, b) >= 0.55))
    return (a != "") & (b != "") & (branded | inside | words | letters)


def consolidate_by_identifier(rows: DataFrame, gold: DataFrame, priority: tuple[str, ...] = (), strict: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their new group, gold of all groups that are left, refused (nit, pivot, group)).

    rows: group, src, name, nit, rec_id; gold: group, NIT_FINAL, NOMBRE_FINAL and the metrics. Of the groups with one valid identifier that
    with the longest name (ties: the smallest group) is the pivot; each other one joins it if its name is robustly contained. Metrics of
    groups that took others are worked out anew, identifier and name are the first of their rows, other columns stay the pivot's.
    """
    known = gold.filter(~F.col("NIT_FINAL").isin(*NO_IDENTIFIER) & F.col("NIT_FINAL").isNotNull()).select("group", F.col("NIT_FINAL").alias("nit"), F.coalesce("NOMBRE_FINAL", F.lit("")).alias("name"))
    pivot = known.groupBy("nit").agg(F.min(F.struct(-F.length("name"), F.col("group"), F.col("name").alias("pivot_name"))).alias("p"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # an identifier may stand for any number of groups: they are dealt, its pivot goes to each part
    met = spread_join(pivot.select("nit", F.col("p.group").alias("pivot"), "p.pivot_name"), known, ["nit"]).filter("group <> pivot")
    judged = stored(met.withColumn("good", robust_containment(F.col("pivot_name"), F.col("name"), strict)).select("nit", "pivot", "group", "good"), "judged")
    merged = judged.filter("good").select("group", "pivot")
    moved = spread_join(merged, rows, ["group"]).drop("group").withColumnRenamed("pivot", "group").select(*rows.columns)
    stay = rows.join(merged, "group", "left_anti")
    after = stored(stay.select(*rows.columns).unionByName(moved), "consolidated")
    grown = merged.select(F.col("pivot").alias("group")).distinct()
    own = after.join(grown, "group", "left_semi")
    fresh = golden.confidence(golden.group_metrics(own, priority))
    first = own.groupBy("group").agg(F.min(F.when(F.coalesce("nit", F.lit("")) != "", F.struct("rec_id", "nit")))["nit"].alias("NIT_FINAL"), F.min(F.when(F.coalesce("name", F.lit("")) != "", F.struct("rec_id", "name")))["name"].alias("NOMBRE_FINAL"))
    anew = [c for c in gold.columns if c in fresh.columns or c in ("NIT_FINAL", "NOMBRE_FINAL")]
    rest = [c for c in gold.columns if c not in anew]
    renewed = gold.select("group", *rest).join(fresh.join(first, "group").select(*anew), "group").select(*gold.columns)
    untouched = gold.join(merged.select("group").unionByName(grown), "group", "left_anti").select(*gold.columns)
    return after, untouched.unionByName(renewed), judged.filter("NOT good").select("nit", "pivot", "group")


def refine_groups(grouped: DataFrame, records: DataFrame, columns: list[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(rec_id, group): groups split by the pairs inside them that keep() lets stand; the largest part keeps the group (ties: the smallest rec_id), others are named by their smallest rec_id.

    records: rec_id and the columns that scores depend on; keep takes pairs (id_l, id_r) with the columns as <column>_l and <column>_r.
    Rows alike in all columns are one class, so pairs are made between the different records of a group, dealt over all tasks.
    """
    wide = grouped.select("rec_id", "group").join(records.select("rec_id", *columns), "rec_id")
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"k{i}") for i, c in enumerate(columns)]
    classes = stored(wide.groupBy("group", *keys).agg(F.min("rec_id").alias("rep"), F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in columns]), "classes")
    pairs = group_pairs(classes.select("rep", "group"), "rep", "group")
    sides = [classes.select(F.col("rep").alias(f"id_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "lr"]
    edges = keep(pairs.join(sides[0], "id_l").join(sides[1], "id_r")).select("id_l", "id_r")
    local = components(classes.select(F.col("rep").alias("rec_id")), stored(edges, "kept")).toDF("rep", "part")
    parts = stored(classes.select("group", "rep", "rows").join(local, "rep"), "parts")
    sizes = parts.groupBy("group", "part").agg(F.sum("rows").alias("n"))
    largest = sizes.groupBy("group").agg(F.min(F.struct(-F.col("n"), F.col("part").alias("part")))["part"].alias("largest"))
    named = parts.join(largest, "group").select("rep", F.when(F.col("part") == F.col("largest"), F.col("group")).otherwise(F.col("part")).alias("new"))
    place = classes.select("rep", "group", *[f"k{i}" for i in range(len(columns))]).join(named, "rep")
    return spread_join(place.drop("rep"), wide.select("rec_id", "group", *keys), ["group", *[f"k{i}" for i in range(len(columns))]]).select("rec_id", F.col("new").alias("group"))


def spanning_forest(edges: DataFrame, order: Column) -> DataFrame:
    """The edges (id_l, id_r and further columns) of the least spanning forest by order (ties: id_l, id_r): those that, taken in order, each unite two groups.

    Each round every group takes its least edge to another one, and what these connect becomes a group; groups at least halve each time.
    Rounds join by shuffles, so that no group table passes the driver.
    """
    rest = edges.filter("id_l <> id_r").withColumns({"__o": order, "__a": F.col("id_l"), "__b": F.col("id_r")})
    rest = stored(rest.groupBy("id_l", "id_r").agg(F.min(F.struct("__o", *[c for c in edges.columns if c not in ("id_l", "id_r")])).alias("__x"), F.first("__a").alias("__a"), F.first("__b").alias("__b")), "edges")
    taken = None
    while not rest.isEmpty():
        key = F.struct(F.col("__x.__o").alias("o"), "id_l", "id_r", "__a", "__b", "__x")
        ends = rest.select(F.col("__a").alias("g"), key.alias("k")).unionByName(rest.select(F.col("__b").alias("g"), key.alias("k")))
        # the least edge by order and ends; what comes behind these does not decide, as a pair comes once
        best = stored(ends.groupBy("g").agg(F.min_by("k", F.struct("k.o", "k.id_l", "k.id_r")).alias("k")).select("k.*").distinct(), "least-edges")
        part = best.select("id_l", "id_r", "__x")
        taken = part if taken is None else taken.unionByName(part)
        groups = best.select(F.explode(F.array("__a", "__b")).alias("rec_id")).distinct()
        into = stored(components(groups, best.select(F.col("__a").alias("id_l"), F.col("__b").alias("id_r"))), "contracted")
        for side in ("__a", "__b"):
            rest = rest.join(into.toDF(side, "__g").hint("merge"), side, "left").withColumn(side, F.coalesce("__g", side)).drop("__g")
        rest = stored(rest.filter("__a <> __b").select("id_l", "id_r", "__x", "__a", "__b"), "edges")
    more = [c for c in edges.columns if c not in ("id_l", "id_r")]
    if taken is None:
        return edges.limit(0)
    return taken.select("id_l", "id_r", *[F.col(f"__x.{c}").alias(c) for c in more]).select(*edges.columns)


def union_provenance(unions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(unions that made the groups, (rec_id, rules)) of accepted unions (number, id_l, id_r, rule): those that, taken by number, each joined two groups,
    and for each row the rules of the unions that name it, in their order, joined by ' | '."""
    forest = stored(spanning_forest(unions.select("id_l", "id_r", "number", "rule"), F.col("number")), "forest")
    each = unions.select(F.explode(F.array("id_l", "id_r")).alias("rec_id"), "number", "rule").groupBy("rec_id", "rule").agg(F.min("number").alias("number"))
    rules = each.groupBy("rec_id").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("number", "rule"))), lambda x: x["rule"]), " | ").alias("rules"))
    return forest, rules


def threshold_groups(records: DataFrame, scored: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """(threshold, rec_id, group) for all thresholds, from one spanning forest of the best scores: each threshold adds its edges to the groups of the next higher one."""
    if len(set(thresholds)) != len(thresholds):
        raise ValueError("a threshold comes twice")
    forest = stored(spanning_forest(scored.select(F.least("id_l", "id_r").alias("id_l"), F.greatest("id_l", "id_r").alias("id_r"), "score"), -F.col("score")), "forest")
    groups, found, above = records.select("rec_id", F.col("rec_id").alias("group")), None, None
    for t in sorted(thresholds, reverse=True):
        fresh = forest.filter((F.col("score") >= t) & (F.col("score") < above if above is not None else F.lit(True)))
        ends = fresh.join(groups.toDF("id_l", "gl"), "id_l").join(groups.toDF("id_r", "gr"), "id_r").select(F.col("gl").alias("id_l"), F.col("gr").alias("id_r"))
        into = components(groups.select(F.col("group").alias("rec_id")).distinct(), ends).toDF("group", "to")
        groups = stored(groups.join(into, "group").select("rec_id", F.col("to").alias("group")), "groups")
        part = groups.select(F.lit(float(t)).alias("threshold"), "rec_id", "group")
        found, above = part if found is None else found.unionByName(part), t
    return found


def threshold_points(groups: DataFrame, truth: DataFrame) -> DataFrame:
    """threshold, tp, fp, fn, precision, recall, f1 of pairs, from counts by group and true label: no pair is made. truth: rec_id, label."""
    pairs = lambda n: (n * (n - 1) / 2)
    wide = groups.join(truth, "rec_id").groupBy("threshold", "group", "label").agg(F.count(F.lit(1)).alias("n"))
    both = wide.groupBy("threshold").agg(F.sum(pairs(F.col("n"))).alias("tp"))
    by = lambda c, to: wide.groupBy("threshold", c).agg(F.sum("n").alias("n")).groupBy("threshold").agg(F.sum(pairs(F.col("n"))).alias(to))
    p = both.join(by("group", "made"), "threshold").join(by("label", "true"), "threshold")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(1.0)
    p = p.select("threshold", *[x.cast("long").alias(c) for x, c in ((F.col("tp"), "tp"), (F.col("made") - F.col("tp"), "fp"), (F.col("true") - F.col("tp"), "fn"))], ratio(F.col("tp"), F.col("made")).alias("precision"), ratio(F.col("tp"), F.col("true")).alias("recall"))
    return p.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def choose_threshold(points: DataFrame, precision: float = 0.0, recall: float = 0.0) -> DataFrame:
    """points with passes (both gates) and chosen: of those that pass the one with fewest false pairs, then most true ones, then the lower threshold; raises where none passes."""
    judged = points.withColumn("passes", (F.col("precision") >= precision) & (F.col("recall") >= recall))
    best = judged.filter("passes").agg(F.min(F.struct("fp", -F.col("tp"), "threshold"))["threshold"]).first()[0]
    if best is None:
        raise ValueError("no threshold passes the gates")
    return judged.withColumn("chosen", F.col("threshold") == F.lit(best))


def compress_chains(retired: DataFrame) -> DataFrame:
    """(old_id, new_id) with new_id the end of each chain of redirects, by doubling steps; raises where a chain closes. Redirects of an id to itself are none."""
    now = stored(retired.select("old_id", "new_id").filter("old_id <> new_id").distinct(), "redirects")
    rows, ids = now.agg(F.count(F.lit(1)), F.countDistinct("old_id")).first()
    if rows != ids:
        raise ValueError("an id is redirected twice")
    for _ in range(2 + math.ceil(math.log2(max(1, rows)))):
        ahead = now.toDF("new_id", "next")
        after = stored(now.join(ahead, "new_id", "left").select("old_id", F.coalesce("next", "new_id").alias("new_id"), F.col("next").isNotNull().alias("moved")), "redirects")
        if not after.filter("old_id = new_id").isEmpty():
            break
        if after.filter("moved").isEmpty():
            return after.select("old_id", "new_id")
        now = after.select("old_id", "new_id")
    raise ValueError("a chain of redirects closes")
