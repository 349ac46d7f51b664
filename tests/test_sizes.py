"""That no step takes a whole class, base or table through one task: read from the plans."""

from pyspark.sql import functions as F

from samewise.operators import blocking, clusters, golden, pairs, refine, reports, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_truth_classes_rank_parts_first(spark):
    rows = spark.range(5000).selectExpr("id AS id_l", "id * 7 AS id_r", "1.0D AS similarity")
    got = pairs.truth_classes(rows, {"a": 30}, {"a": (0.9, 2.0)})
    assert plan(got).count("WindowGroupLimit") >= 2
    best = rows.orderBy(F.md5(F.concat_ws("|", "id_l", "id_r"))).limit(30)
    assert {r["id_l"] for r in got.collect()} == {r["id_l"] for r in best.collect()}


def test_entity_ids_rank_no_base(spark):
    rows = spark.createDataFrame([(g, f"r{g}{i}", b) for g, b, n in ((1, "x", 2), (2, "x", 3), (3, "x", 3), (4, "", 1)) for i in range(n)] + [(1, "r19", "")], "group long, record string, base string")
    got = golden.entity_ids(rows)
    assert "Window" not in plan(got)
    assert {r["group"]: r["ID_ENTIDAD"][:4] for r in got.collect()} == {1: "NIT-", 2: "ENT-", 3: "ENT-", 4: "ENT-"}


def test_best_name_joins_nothing(spark):
    rows = spark.createDataFrame([(1, "a", "Alfa", 3), (1, "b", "Beta", 1), (1, "b", "Beta", 2), (1, "a", "AL-FA", 4), (1, "a", "Gama", 0)], "group long, src string, name string, rec_id long")
    assert "Join" not in plan(golden.best_name(rows))
    assert [golden.best_name(rows, p).first()["NOMBRE_FINAL"] for p in ((), ("a",), ("b",))] == ["Beta", "AL-FA", "Beta"]


def test_presence_counts_groups_at_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a")], "group long, src string")
    got = reports.presence_share(golden.presence(rows))
    assert plan(got).count("Join") == 1
    assert {tuple(r) for r in got.collect()} == {("a", "a", 2, 100.0), ("a", "b", 1, 50.0), ("b", "a", 1, 100.0), ("b", "b", 1, 100.0)}


def test_dropped_blocks_shuffle_counts_only(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "RED BOLT RED", "") for i in range(310)], "rec_id long, name string, nit string")
    seen, real = [], blocking.dropped_blocks
    monkeypatch.setattr(blocking, "dropped_blocks", lambda keyed, most, *once: seen.append(real(keyed, most, *once)) or seen[-1])
    got = {(r["strategy"], r["key"], r["records"]) for r in blocking.hybrid_dropped(rows).collect()}
    assert ("tokens", "BOLT", 310) in got and ("tfidf", "red", 310) in got and all(plan(d).count("Exchange") == 1 for d in seen)
    doubled = {(r["strategy"], r["key"], r["records"]) for r in blocking.hybrid_dropped(rows.unionByName(rows)).collect()}
    assert ("tokens", "BOLT", 310) in doubled


def test_label_confusion_shuffles_no_pairs(spark):
    rows = spark.range(200).selectExpr("id", "CASE WHEN id % 11 > 0 THEN id % 5 END AS t", "CASE WHEN id % 13 > 0 THEN id % 5 + cast(id % 7 = 0 AS int) END AS p")
    got = pairs.label_confusion(rows, "id", "t", "p")
    want = pairs.pair_confusion(pairs.group_pairs(rows, "id", "t"), pairs.group_pairs(rows, "id", "p"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert plan(got).count("Exchange") < plan(want).count("Exchange")


def test_group_metrics_shuffle_sources_once(spark):
    rows = spark.createDataFrame([(1, "a", "x", "1", 1), (1, "b", "y", "", 2), (1, None, "x", "1", 3)], "group long, src string, name string, nit string, rec_id long")
    got = golden.group_metrics(rows)
    expand = got._jdf.queryExecution().optimizedPlan().toString().split("Expand [")[1].split("\n")[0]
    assert expand.count("], [") == 3  # copies of a row for the rest, identifiers and names, then the columns
    assert tuple(got.first())[1:6] == ("a|b", 2, 3, 2, 1)


def test_rounds_broadcast_nothing(spark, monkeypatch):
    # every round sent its labels through the driver before
    seen, real = [], clusters.stored
    for module in (clusters, refine):
        monkeypatch.setattr(module, "stored", lambda df, name="step": seen.append(plan(df)) or real(df, name))
    edges = spark.range(1, 60).selectExpr("id AS id_l", "id div 2 AS id_r", "id * 7 % 13 AS number", "'r' AS rule")
    forest, _ = refine.union_provenance(edges)
    assert forest.count() == 59 and len(seen) > 5 and not any("Broadcast" in p for p in seen)
    assert "Broadcast" not in plan(clusters.components(spark.range(60).toDF("rec_id"), forest))


def test_pair_score_parts_grow_with_rows(spark, monkeypatch):
    # as many tasks as Spark's setting or fewer before, whatever the rows
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    rows = spark.range(1000).selectExpr("id AS rec_id", "id div 3 AS group")
    got = reports.pair_score(rows, spark.range(999).selectExpr("id AS id_l", "id + 1 AS id_r", "id / 1000 AS score"))
    assert got.rdd.getNumPartitions() == 10 and "Broadcast" not in plan(got)
    want = {i: max([x / 1000 for x in (i - 1, i) if 0 <= x < 999 and x // 3 == (x + 1) // 3], default=None) for i in range(1000)}
    assert {r["rec_id"]: r["SCORE_PAR"] for r in got.collect()} == want
