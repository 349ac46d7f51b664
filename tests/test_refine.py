"""Groups worked over against plain Python: consolidation, splitting, forests, thresholds, chains."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from samewise.operators import clusters, golden, refine


def test_robust_containment(spark):
    rows = [
        ("ZELVORA ALIMENTOS SAS", "ZELVORA ALIMENTOS Y BEBIDAS", True),
        ("KRAMENTO", "KRAMENTO DEL SUR", True),
        ("ABC", "ABCD PLASTICOS", False),
        ("COMERCIALIZADORA ORBELIA SAS", "ORBELIA COMERCIALIZADORA", True),
        ("ZELVORA NORTE", "TAVORIN SUR", False),
        ("TAVORIN GMBH", "TAVORINN GMBH", True),
        ("", "ZELVORA", False),
        (None, None, False),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, want boolean")
    got = df.select("a", "b", "want", refine.robust_containment(F.col("a"), F.col("b")).alias("x"), refine.robust_containment(F.col("b"), F.col("a")).alias("y")).collect()
    assert all(r["x"] == r["y"] == r["want"] for r in got), got
    strict = spark.createDataFrame([("ZELVORAS", "ZELVORXX")], "a string, b string").select(refine.robust_containment(F.col("a"), F.col("b"), True), refine.robust_containment(F.col("a"), F.col("b"))).first()
    assert tuple(strict) == (False, True)


def test_consolidation_of_groups_with_one_identifier(spark):
    hot = [(i, i, "A" if i % 2 else "B", f"ZELVORA ALIMENTOS SEDE {i:05d}" if i % 100 else f"TAVORIN {i:05d} PLASTICOS", "900123456") for i in range(1, 30_001)]
    rest = [(40_000, 40_000, "A", "KRAMENTO UNO", "800111222"), (40_001, 40_001, "B", "KRAMENTO UNO DEL NORTE", "800111222"), (40_002, 40_002, "B", "AJENA", "800111222"), (40_003, 40_003, "A", "SOLA", "999999999"), (40_004, 40_004, "B", "SOLA", "999999999"), (40_005, 40_005, "B", "SIN NIT", "")]
    rows = spark.createDataFrame(hot + rest, "rec_id long, group long, src string, name string, nit string").repartition(6)
    gold = golden.golden(rows, ("A", "B")).withColumn("own", F.col("group") * 10)
    after, left, refused = refine.consolidate_by_identifier(rows, gold, ("A", "B"))
    groups = {r["rec_id"]: r["group"] for r in after.collect()}
    assert len(groups) == len(hot) + len(rest)
    # the longest name of the identifier is that of the first of all with the longest spelling
    assert all(groups[i] == 1 for i, *_ in hot if i % 100) and all(groups[i] == i for i, *_ in hot if not i % 100)
    assert [groups[i] for i in range(40_000, 40_006)] == [40_001, 40_001, 40_002, 40_003, 40_004, 40_005]
    gone = {r["group"]: r.asDict() for r in left.collect()}
    assert set(gone) == set(groups.values()) and left.columns == gold.columns
    assert (gone[40_001]["RECORDS_COUNT"], gone[40_001]["SOURCES"], gone[40_001]["PRIMARY_SOURCE"], gone[40_001]["NOMBRE_FINAL"], gone[40_001]["own"]) == (2, "A|B", "A", "KRAMENTO UNO", 400_010)
    assert gone[1]["RECORDS_COUNT"] == 29_700 and gone[40_005]["RECORDS_COUNT"] == 1 and refused.count() == 301


def kruskal(edges):
    parent, kept = {}, []

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for w, a, b, *more in sorted(edges):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            kept.append((a, b, w))
    return sorted(kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_and_thresholds(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(120), 2))) for _ in range(300)}
    edges = [(round(rng.random(), 1), a, b) for a, b in pairs]
    df = spark.createDataFrame([(a, b, w) for w, a, b in edges] + [(5, 5, 0.0)], "id_l long, id_r long, score double")
    got = sorted(tuple(r) for r in refine.spanning_forest(df, F.col("score")).collect())
    assert got == kruskal(edges)
    nodes = spark.range(125).select(F.col("id").alias("rec_id"))
    thresholds = (0.15, 0.35, 0.55, 0.75, 0.95, 1.0)
    groups = refine.threshold_groups(nodes, df.filter("id_l <> id_r"), thresholds)
    found = {(r["threshold"], r["rec_id"]): r["group"] for r in groups.collect()}
    for t in thresholds:
        want = {r["rec_id"]: r["group"] for r in clusters.components(nodes, df.filter(F.col("score") >= t)).collect()}
        assert {k[1]: g for k, g in found.items() if k[0] == t} == want
    truth = nodes.select("rec_id", (F.col("rec_id") % 7).alias("label"))
    points = {r["threshold"]: r for r in refine.threshold_points(groups, truth).collect()}
    for t in thresholds:
        made = {p for p in itertools.combinations(range(125), 2) if found[t, p[0]] == found[t, p[1]]}
        true = {p for p in itertools.combinations(range(125), 2) if p[0] % 7 == p[1] % 7}
        assert (points[t]["tp"], points[t]["fp"], points[t]["fn"]) == (len(made & true), len(made - true), len(true - made))
    chosen = refine.choose_threshold(refine.threshold_points(groups, truth), recall=points[0.55]["recall"]).filter("chosen").collect()
    assert len(chosen) == 1 and chosen[0]["threshold"] == 0.55
    with pytest.raises(ValueError):
        refine.choose_threshold(refine.threshold_points(groups, truth), precision=1.1)


def test_provenance(spark):
    unions = [(1, 1, 2, "nit"), (2, 2, 3, "name"), (3, 1, 3, "alias"), (4, 7, 8, "name"), (5, 8, 7, "nit")]
    forest, rules = refine.union_provenance(spark.createDataFrame(unions, "number long, id_l long, id_r long, rule string"))
    assert sorted(r["number"] for r in forest.collect()) == [1, 2, 4]
    assert {r["rec_id"]: r["rules"] for r in rules.collect()} == {1: "nit | alias", 2: "nit | name", 3: "name | alias", 7: "name | nit", 8: "name | nit"}
    assert refine.spanning_forest(spark.createDataFrame([], "id_l long, id_r long, score double"), F.col("score")).count() == 0


def test_refined_groups(spark):
    rng = random.Random(4)
    names = ["aaaa", "aaab", "aabb", "zzzz", "zzzy", "mmmm", None]
    rows = [(i, rng.randrange(4) + 1000, rng.choice(names)) for i in range(200)] + [(900, 1009, "aaaa"), (901, 1009, "zzzz")]
    df = spark.createDataFrame(rows, "rec_id long, group long, name string")
    got = {r["rec_id"]: r["group"] for r in refine.refine_groups(df, df, ["name"], lambda p: p.filter(F.levenshtein("name_l", "name_r") <= 1)).collect()}
    kind = lambda n: "a" if n and n[0] == "a" else "z" if n and n[0] == "z" else n
    want = {}
    for g in {r[1] for r in rows}:
        parts = {}
        for i, own, n in rows:
            if own == g:
                parts.setdefault(kind(n), []).append(i)
        best = min(parts.values(), key=lambda p: (-len(p), min(p)))
        want |= {i: g if p is best else min(p) for p in parts.values() for i in p}
    assert got == want


def test_chains(spark):
    chain = [(f"E{i}", f"E{i + 1}") for i in range(5)] + [("X", "E3"), ("Y", "Z"), ("S", "S")]
    got = {r["old_id"]: r["new_id"] for r in refine.compress_chains(spark.createDataFrame(chain, "old_id string, new_id string")).collect()}
    assert got == {**{f"E{i}": "E5" for i in range(5)}, "X": "E5", "Y": "Z"}
    for closed in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], [("a", "b"), ("a", "c")]):
        with pytest.raises(ValueError):
            refine.compress_chains(spark.createDataFrame(closed, "old_id string, new_id string"))
    assert refine.compress_chains(spark.createDataFrame([], "old_id string, new_id string")).count() == 0
