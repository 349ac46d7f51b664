"""Linking, reports, kinds, countries, workbooks, phases and importers on small tables."""

import pytest
from pyspark.sql import functions as F

from samewise.functions import countries, kinds, text
from samewise.operators import linking, reports
from samewise.plans import importers
from samewise.plans.phases import Phases
from samewise.sources import readers, workbooks


def test_workbook_with_odd_cells(spark, tmp_path):
    rows = [("a<&>\n b", None, "=1+1"), ("", "é", "x"), (None, None, None), ("z" * 10, "0", " lead")]
    path = str(tmp_path / "w.xlsx")
    df = spark.createDataFrame(rows, "A string, `B b` string, C string").coalesce(1)
    assert workbooks.write_workbook({"one & two": df, "second": df.limit(1)}, path) == {"one & two": "sheet", "second": "sheet"}
    got = [tuple(r) for r in workbooks.read_workbook(spark, path, "one & two").orderBy("FILA_EXCEL").collect()]
    assert got == [("a<&>\n b", None, "'=1+1", 2), ("", "é", "x", 3), ("z" * 10, "0", " lead", 5)]
    assert workbooks.read_workbook(spark, path, 1).count() == 1
    with pytest.raises(Exception, match="no sheet"):
        workbooks.read_workbook(spark, path, "none").collect()
    spec = readers.SourceSpec("S", path, {"name": "B b"}, sheet="one & two")
    assert [r["name"] for r in readers.read_source(spark, spec).collect()].count("é") == 1


def test_long_cells_go_to_csv(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    placed = workbooks.write_workbook({"t": spark.createDataFrame([("x" * 40_000,)], "a string")}, path)
    assert placed["t"].endswith(".csv.gz") and spark.read.option("header", True).csv(placed["t"]).first()["a"] == "x" * 40_000
    assert workbooks.read_workbook(spark, path, "LEEME").first()["tabla"] == "t"


def test_words(spark):
    df = spark.createDataFrame([("GRUPO ACME DE B 7 SA",), ("",)], "n string")
    got = df.select(text.distinctive_words(F.col("n")).alias("d"), text.marks(F.col("n")).alias("m"), text.compact_form(F.col("n")).alias("c"), text.normal_series(F.lit("n/a")).alias("x"), text.normal_series(F.lit(" 1.5")).alias("y")).collect()
    assert got[0].asDict() == {"d": ["ACME"], "m": "7 B", "c": "GRUPOACME", "x": None, "y": 1.5}
    text.register_locale("BOTH", "ES", "EN", extra=("GmbH",))
    assert spark.range(1).select(text.clean_name(F.lit("Foo GmbH Inc"), "BOTH")).first()[0] == "FOO"


def test_kinds(spark):
    names = [(1, "Transportes Rápidos SAS"), (2, "María Gómez"), (3, "zzz"), (4, None), (5, "1")]
    got = {r["k"]: r["kind"] for r in kinds.classify(spark.createDataFrame(names, "k int, n string"), "k", "n").collect()}
    assert got == {1: "empresa", 2: "persona", 3: "incierto", 4: "invalido", 5: "invalido"}
    taught = kinds.learn_tokens(spark.createDataFrame([("zzz", True)] * 400 + [("yyy", False)] * 400, "name string, company boolean"))
    got = {r["k"]: r["kind"] for r in kinds.classify(spark.createDataFrame([(1, "zzz"), (2, "yyy")], "k int, n string"), "k", "n", taught).collect()}
    assert got == {1: "empresa", 2: "persona"}


def test_countries(spark):
    catalog = spark.createDataFrame([("Colombia", "COL"), ("Estados Unidos", "USA"), ("EE. UU.", "USA"), ("", "NIL")], "alias string, code string")
    rows = spark.createDataFrame([(1, "COLOMBIA"), (2, "estados-unidos"), (3, "Colombai"), (4, None), (5, "Zona Franca X")], "k int, c string")
    found = countries.canonical(rows, "k", "c", catalog)
    assert {r["k"]: (r["code"], r["how"]) for r in found.collect()} == {1: ("COL", "exacto"), 2: ("USA", "laxo"), 3: (None, "sin clasificar"), 4: (None, "vacio"), 5: (None, "zona franca")}
    assert [tuple(r) for r in countries.coverage(found, catalog).collect()] == [("Colombai", 1, "Colombia")]
    with pytest.raises(ValueError, match="Colombai"):
        countries.coverage(found, catalog, stop=True)


def test_classify_and_propagate(spark):
    pairs = spark.createDataFrame([("name", 0.95, True, 1, "SÍ"), ("name", 0.95, False, 1, "NO"), ("parent", 0.9, False, 0, "SÍ"), ("name", 0.5, False, 0, "SIN DATO")], "kind string, similarity double, compact_equal boolean, shared long, country string")
    assert [(r["NIVEL"], r["BANDA"]) for r in linking.classify(pairs).collect()] == [("EMPRESA", "A"), ("GRUPO", "B"), ("MATRIZ", "B"), ("REVISAR", "C")]
    empty = spark.createDataFrame([], "e int, d int, NIVEL string, BANDA string")
    assert linking.propagate_web(empty, spark.createDataFrame([(1, "x.co")], "d int, domain string"), "e", "d").count() == 0


def test_fingerprint_ignores_ids_and_order(spark):
    one = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "record string, `group` int")
    two = spark.createDataFrame([("c", 7), ("b", 5), ("a", 5)], "record string, `group` int")
    other = spark.createDataFrame([("c", 7), ("b", 7), ("a", 5)], "record string, `group` int")
    f = lambda d: reports.partition_fingerprint(d).first()[0]
    assert f(one) == f(two) != f(other)
    row = reports.labelled_precision(spark.createDataFrame([(1,), (1,), (0,), (None,)], "label int")).first()
    assert (row["hits"], row["total"]) == (2, 3) and row["low"] < 2 / 3 < row["high"]


def test_phases_reuse_and_rerun(spark, tmp_path):
    rows = spark.range(10)
    double = lambda df: {"t": df.withColumn("d", F.col("id") * 2)}

    def go(data, settings):
        p = Phases(spark, str(tmp_path), {"rows": data}, settings)
        first = p.run("one", double, data)["t"]
        second = p.run("two", double, first.select("id"))["t"]
        return second.count(), p.log

    assert go(rows, {"a": 1}) == (10, [("one", "run"), ("two", "run")])
    assert go(rows, {"a": 1}) == (10, [("one", "reused"), ("two", "reused")])
    assert go(rows, {"a": 2})[1] == [("one", "run"), ("two", "run")]
    assert go(spark.range(11), {"a": 2}) == (11, [("one", "run"), ("two", "run")])


def test_importers(spark):
    rows = spark.createDataFrame([(1, "Acme Tools SAS", "COL", 1.0), (2, "ACME TOOLS", "Colombia", 2.0), (3, "Acme Tools", "Peru", 4.0), (4, None, None, 8.0), (5, "", "Peru", 16.0)], "k long, name string, country string, fob double")
    catalog = spark.createDataFrame([("Colombia", "COL"), ("COL", "COL"), ("Peru", "PER")], "alias string, code string")
    result = importers.importers(rows, "k", "name", "country", catalog, ("fob",))
    group = {r["k"]: r["group"] for r in result.correlative.collect()}
    assert group[1] == group[2] and len(set(group.values())) == 4
    assert {r["violations"] for r in importers.invariants(result, rows, "k", ("fob",)).collect()} == {0}


def test_shared_word_pairs_keeps_common_words(spark):
    a = spark.range(310).select(F.col("id").alias("key_a"), F.lit("VALDORIA").alias("name"))
    b = spark.range(2500).select(F.col("id").alias("key_b"), F.lit("VALDORIAS").alias("name"))
    got = linking.shared_word_pairs(a, b, "key_a", "key_b")
    assert got.count() == 310 * 2500 and got.filter("shared <> 1").count() == 0
