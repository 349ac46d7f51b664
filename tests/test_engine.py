"""Operators against brute force, properties of the kernels, and every registered query against its SQL."""

import glob
import itertools
import math
import os
import random
import sys
import time
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samewise.functions import comparators, strings, text
from samewise.functions import identifiers as ids
from samewise.operators import blocking, clusters, evaluation, golden, scoring, tables
from samewise.plans import api, catalog
from samewise.sources import readers, sinks
from samewise.streaming.incremental import fold_bases

SF = "/root/testdata/sf0.001"
word = st.text("ABCDE ", max_size=12)


@given(word, word)
@settings(max_examples=150, deadline=None)
def test_kernels(a, b):
    for f in (strings.jaro_winkler, strings.indel_ratio, strings.token_set_ratio, strings.token_sort_ratio):
        assert 0 <= f(a, b) <= 1 and abs(f(a, b) - f(b, a)) < 1e-9
    assert strings.osa(a, b) == strings.osa(b, a) <= max(len(a), len(b))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    assert strings.common_subsequence(a, b) == table[-1][-1]


def test_known_values():
    assert strings.osa("CA", "ABC") == 3 and strings.osa("AB", "BA") == 1
    assert abs(strings.jaro_winkler("MARTHA", "MARHTA") - 0.961111) < 1e-5
    assert evaluation.wilson(0, 0) == (0.0, 1.0) and evaluation.wilson(8, 10)[0] < 0.8 < evaluation.wilson(8, 10)[1]


def test_names_and_identifiers(spark):
    rows = [("Café & Té S.A.S.", "800197268-4"), ("J. M. C. Ltda", "900.123"), (None, None), ("SAS", "111111111"), ("No disponible", "CC 12345678")]
    got = spark.createDataFrame(rows, "n string, i string").select(text.clean_name(F.col("n")).alias("n"), ids.process_nit(F.col("i")).alias("p"), ids.valid_base(F.col("i")).alias("b")).collect()
    assert [r["n"] for r in got] == ["CAFE Y TE", "JMC", "", "SAS", ""]
    assert [(r["p"]["NIT_TYPE"], r["p"]["NIT_BASE"]) for r in got] == [("STANDARD_10", "800197268"), ("SHORT", "900123"), ("EMPTY", ""), ("TEST_NUMBER", ""), ("CITIZEN", "12345678")]
    assert [r["b"] for r in got] == ["800197268", "900123", "", "", "12345678"]


def test_comparators_are_neutral_on_missing(spark):
    pairs = spark.createDataFrame([(None, "a"), ("", "a"), ("a@b.co", "a@b.co"), ("12345678", "12345678")], "l string, r string")
    for c in comparators.REGISTRY.values():
        if c.name.startswith(("geo", "date", "number")):
            continue
        got = pairs.select(c.build(F.col("l"), F.col("r")).alias("s")).collect()
        assert got[0]["s"] in (0.0, 0.5) and all(-1 <= r["s"] <= 1 for r in got), c.name


def test_grouping(spark):
    nodes = spark.createDataFrame([(i, "", str(i)) for i in range(12)], "rec_id bigint, nit string, name string")
    edges = spark.createDataFrame([(i, i + 1) for i in range(5)] + [(7, 9)], "id_l bigint, id_r bigint")
    got = {r["rec_id"]: r["group"] for r in clusters.components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(6)}, 6: 6, 7: 7, 8: 8, 9: 7, 10: 10, 11: 11}
    d = spark.createDataFrame([(0, 1, 0.9, True, False), (1, 2, 0.8, True, False), (0, 2, 0.1, False, True)], "id_l bigint, id_r bigint, score double, fusion boolean, veto boolean")
    got = {r["rec_id"]: r["group"] for r in clusters.constrained(nodes, d).collect()}
    assert got[0] == got[1] == 0 and got[2] == 2
    with pytest.raises(blocking.CandidateBudgetExceeded):
        blocking.check_budget(nodes.select("rec_id", F.lit(1).alias("key")), 10)


def test_schema_engine(spark):
    rows = spark.createDataFrame([(1, "ACME ANDINA", "900123456", "2020-01-01"), (2, "ACME ANDINAS", "900123456", None), (3, "OTRA COSA", "900999999", "2020-01-01")], "rec_id bigint, name string, nit string, day string")
    schema = scoring.Schema((scoring.FieldSpec("name", "token_set_signed", 2.0, agrees=0.5), scoring.FieldSpec("nit", "document_signed", 1.0, veto=-0.5)), 0.6, 2)
    groups, decisions = api.dedupe_schema(rows, schema)
    assert {r["rec_id"]: r["group"] for r in groups.collect()} == {1: 1, 2: 1, 3: 3}


def test_linkage(spark):
    a = spark.createDataFrame([("Acme Andina SAS", "900123456"), ("Beta Comercial Ltda", ""), ("Gamma Unida SA", "800197268")], "n string, i string").coalesce(1)
    b = spark.createDataFrame([("ACME ANDINA", "900123456"), ("Beta Comercial", ""), ("Delta Final", "")], "n string, i string").coalesce(1)
    result, counts = api.link(spark, a, b, "n", "i", profile=scoring.Profile(score_threshold=0.4))
    rows = result.correlative.collect()
    assert len(rows) == 6 and len({r["ID_GRUPO"] for r in rows}) == len({r["ID_ENTIDAD"] for r in rows}) == result.golden.count()
    acme = {r["ID_GRUPO"] for r in rows if r["name"] == "ACME ANDINA"}
    assert len(acme) == 1 and counts.first()["both"] >= 1


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("Razón Social;NIT;x\nCañón;1;=2\nnan;2;3\n".encode("cp1252"))
    assert readers.detect_encoding(str(path)) == "windows-1252" and readers.detect_delimiter(str(path), "cp1252") == ";"
    spec = readers.SourceSpec("A", str(path), {"name": "Razón Social"}, {"city": "ciudad"}, ("x",))
    got = readers.read_source(spark, spec).collect()
    assert [(r["name"], r["city"], r["x"]) for r in got] == [("Cañón", None, "=2"), (None, None, "3")]
    with pytest.raises(ValueError):
        readers.read_source(spark, readers.SourceSpec("A", str(path), {"name": "missing"}))
    df = spark.createDataFrame([("=1+1", 2), ("ok", None)], "a string, b int")
    folder = f"file://{tmp_path}/out"
    sinks.write_result(spark, {"t": df}, folder)
    assert sinks.read_result(spark, folder)["t"].count() == 2
    assert df.select(sinks.neutralise(F.col("a"))).first()[0] == "'=1+1"
    df.write.mode("append").parquet(f"{folder}/t.parquet")
    with pytest.raises(ValueError):
        sinks.read_result(spark, folder)


def test_incremental(spark, tmp_path):
    for n in range(2):
        spark.createDataFrame([("900123456",), ("800197268-4",)], "nit string").write.mode("append").parquet(f"{tmp_path}/in")
        got = fold_bases(spark, f"{tmp_path}/in", "nit string", "nit", f"{tmp_path}/ck", f"{tmp_path}/out")
        assert {r["base"]: r["records"] for r in got.collect()} == {"900123456": n + 1, "800197268": n + 1}


def rows_of(frame):
    def plain(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return "NULL"
        if isinstance(x, bool) or isinstance(x, str):
            return str(x)
        return f"{float(x):.5f}"

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(x.item() if hasattr(x, "item") else x) for x in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    ours, theirs = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows_of(ours) == rows_of(theirs)


def test_corpus_subpackage_is_optional():
    assert not [m for m in sys.modules if m.startswith("samewise.") and not m.startswith("samewise.llm") and "samewise.llm" in open(sys.modules[m].__file__).read()]


def test_encoding_of_the_whole_file(tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"name;x\n" + b"plain;1\n" * 20_000 + "Cañón;2\n".encode("cp1252"))
    assert readers.detect_encoding(str(path)) == "windows-1252"
    path.write_bytes(path.read_bytes() + b"\x81\n")
    with pytest.raises(ValueError):
        readers.detect_encoding(str(path))


def test_geo_grid_keeps_hot_cells(spark):
    hot = spark.range(2100).select(F.col("id").alias("rec_id"), F.lit(0.005).alias("lat"), F.lit(0.005).alias("lon"))
    near = spark.range(5000, 5001).select(F.col("id").alias("rec_id"), F.lit(0.015).alias("lat"), F.lit(0.005).alias("lon"))
    pairs = blocking.geo_grid(hot.unionByName(near))
    assert pairs.count() == 2100 * 2099 // 2 + 2100


def test_quality_report_takes_repeated_digits_by_length(spark):
    keys = ["11111", "111111", "77777777", "111111111", "1111111111", "22222222222", "1111111111111111", "123456", None]
    rows = spark.createDataFrame([("a name", k) for k in keys], "name string, nit string")
    made = rows.select("nit", ids.process_nit(F.col("nit")).alias("p")).collect()
    assert [(r["p"]["NIT_VALID"], r["p"]["NIT_BASE"]) for r in made] == [(False, ""), (True, "111111"), (True, "77777777"), (False, ""), (False, ""), (True, "22222222222"), (False, ""), (True, "123456"), (False, "")]
    got = golden.quality_report(rows, F.col("name"), F.col("nit")).first()
    assert (got["rows"], got["invalid_nits"], got["repeated"]) == (9, 5, 0)


def test_key_blocking_quality(spark):
    rng = random.Random(5)
    one_key = [(i, rng.choice(["a", "b", None]), [rng.choice(["x", "y", None])]) for i in range(40)]
    many_keys = [(i % 35 if i else None, rng.choice(["a", "b", None]), rng.sample(["x", "y", "z", "w", None], rng.randint(0, 3))) for i in range(40)]
    for rows in (one_key, many_keys):
        pairs = [(a, b) for a, b in itertools.combinations(rows, 2) if None not in (a[0], b[0]) and a[0] != b[0] and {*a[2]} & {*b[2]} - {None}]
        true = sum(k * (k - 1) // 2 for k in Counter(t for _, t, _ in rows).values())
        want = (round(sum(a[1] == b[1] is not None for a, b in pairs) / true, 6), round(1 - len(pairs) / (40 * 39 / 2), 6))
        assert tuple(evaluation.key_blocking_quality(spark.createDataFrame(rows, "rec_id long, truth string, keys array<string>")).first()) == want
    assert tuple(evaluation.key_blocking_quality(spark.createDataFrame([], "rec_id long, truth string, keys array<string>")).first()) == (0.0, 1.0)


def test_blocking_quality_makes_no_pairs(spark, tmp_path):
    # blocks of 20000 rows: 400 million pairs before
    spark.range(40_000).selectExpr("id AS p_partkey", "concat('n', id % 7) AS p_name", "concat('b', id % 2) AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    start = time.monotonic()
    got = catalog.blocking_quality(spark, str(tmp_path)).first()
    sizes = Counter((i % 7, i % 2) for i in range(40_000)), Counter(i % 7 for i in range(40_000))
    hits, true = (sum(k * (k - 1) // 2 for k in c.values()) for c in sizes)
    assert tuple(got) == (round(hits / true, 6), round(1 - 20_000 * 19_999 / (40_000 * 39_999 / 2), 6))
    assert time.monotonic() - start < 30


@pytest.mark.parametrize("seed", range(2))
def test_dedupe_by_key_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("kkl") if i % 17 else None, rng.choice(["ACME ANDINA", "ACME ANDINA SUR", None]), rng.choice(["red", "red", "blue", None]), rng.choice([1.0, 1.01, 1.03, 2.0, None])) for i in rng.sample(range(500), 120)]
    records = spark.createDataFrame(rows, "rec_id bigint, k string, name string, kind string, v double")
    schema = scoring.Schema((scoring.FieldSpec("name", "token_set_signed", 2.0), scoring.FieldSpec("kind", "exact_signed", 1.0, veto=-0.5), scoring.FieldSpec("v", "number_relative", 1.0)), 0.6, 2)
    got = {r["rec_id"]: r["group"] for r in api.dedupe_by_key(records, F.col("k"), schema).collect()}
    pairs = blocking.pairs_by_key(records.select("rec_id", F.col("k").alias("key")), None)
    decisions = scoring.decide_fields(pairs, records, schema)
    assert decisions.filter("veto").count() and got == {r["rec_id"]: r["group"] for r in clusters.constrained(records, decisions).collect()}


def test_dedupe_by_key_in_parts_against_all_pairs(spark, monkeypatch):
    # links too sparse for neighbours alone, rows without a key, vetoes that others lift, fields named as columns of the operator
    rng = random.Random(13)
    rows = [(i, rng.choice("kkkklm") if i % 19 else None, rng.choice(["red", "red", "red", "blue", None]), 10 ** (rng.random() * 12) if i % 13 else None, rng.choice([*range(1, 40), None])) for i in rng.sample(range(2000), 150)]
    rows += [(i + 5000, *rest) for i, *rest in rows[::11]]
    records = spark.createDataFrame(rows, "rec_id bigint, k string, key string, label double, group int")
    schema = scoring.Schema((scoring.FieldSpec("key", "exact_signed", 0.5, veto=-0.5), scoring.FieldSpec("label", "number_relative", 1.0), scoring.FieldSpec("group", "number_relative", 1.0)), 0.6, 1, 1)
    decisions = scoring.decide_fields(blocking.pairs_by_key(records.select("rec_id", F.col("k").alias("key")), None), records, schema).collect()
    vetoes = {(r["id_l"], r["id_r"]) for r in decisions if r["veto"]}
    want, held = {r[0]: r[0] for r in rows}, {r[0]: {r[0]} for r in rows}
    for r in sorted((r for r in decisions if r["fusion"]), key=lambda r: (-r["score"], r["id_l"], r["id_r"])):
        a, b = sorted((want[r["id_l"]], want[r["id_r"]]))
        if a != b and not any((min(p), max(p)) in vetoes for p in itertools.product(held[a], held[b])):
            held[a] |= held[b]
            want.update(dict.fromkeys(held.pop(b), a))
    monkeypatch.setattr(tables, "TASK_ROWS", 30)
    got = {r["rec_id"]: r["group"] for r in api.dedupe_by_key(records, F.col("k"), schema).collect()}
    assert vetoes and 1 < len(held) < len(rows) and got == want


def test_schema_dedupe_stores_no_pairs(spark, tmp_path, monkeypatch):
    # each of 1000 values differs: 499500 decisions were stored before
    spark.range(1_000).selectExpr("id AS p_partkey", "'red bolt' AS p_name", "'b' AS p_brand", "'t' AS p_type", "cast(id * 7 % 50 + 1 AS int) AS p_size", "900 + id / 10 AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    held, real = [], tables.stored
    for module in (api, clusters, tables):
        monkeypatch.setattr(module, "stored", lambda df, name="step": [d := real(df, name), held.append(d.count())][0])
    got = catalog.schema_dedupe(spark, str(tmp_path)).groupBy("group").count().collect()
    assert [tuple(r) for r in got] == [(0, 1_000)] and max(held) == 1_000


def test_schema_dedupe_takes_copies_as_one(spark, tmp_path):
    # a block of 6000 copies: 18 million pairs, and left out as too large before
    spark.range(6_000).selectExpr("id AS p_partkey", "'red bolt' AS p_name", "'b' AS p_brand", "'t' AS p_type", "cast(id % 2 * 20 + 1 AS int) AS p_size", "1.0D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.schema_dedupe(spark, str(tmp_path)).groupBy("group").count().collect()
    assert [tuple(r) for r in got] == [(0, 6_000)]


def test_geo_grid_compares_no_pairs(spark):
    # all pairs went through a distinct before
    rows = spark.range(300).select(F.col("id").alias("rec_id"), (F.col("id") % 3 * 0.01 + 0.005).alias("lat"), F.lit(0.005).alias("lon"))
    found = blocking.geo_grid(rows)
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString() and found.count() == 300 * 299 // 2 - 100 * 100
    twice = rows.unionByName(spark.createDataFrame([(1, 0.005, 0.005), (0, 0.015, 0.005), (2, 0.025, 0.005)], rows.schema))
    got = [tuple(r) for r in blocking.geo_grid(twice).collect()]
    x = {}
    for i, place in [(i, i % 3) for i in range(300)] + [(1, 0), (0, 1)]:
        x.setdefault(i, set()).add(place)
    want = {(a, b) for a in x for b in x if a < b and any(abs(p - q) <= 1 for p in x[a] for q in x[b])}
    assert len(got) == len(set(got)) and set(got) == want


def test_near_names_are_dealt_over_all_tasks(spark, tmp_path):
    # a few thousand rows fill one task, which made all their pairs before
    spark.range(3_000).selectExpr("id AS p_partkey", "concat('red bolt', id % 2) AS p_name", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    found = catalog.near_name_pairs(spark, str(tmp_path))
    spread = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 3_000 * 2_999 // 2 and max(r["count"] for r in spread) < 3_000_000
