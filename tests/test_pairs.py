"""Repairs, pair sets and restricted components against brute force."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from samewise.functions import identifiers, repair
from samewise.operators import blocking, clusters, pairs


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_repairs(spark):
    assert one(spark, "Ã‘".replace("‘", "\x91") + "andÃº", repair.repair_encoding) == "Ñandú"
    assert one(spark, "''ACME''CORP ' ", repair.strip_quote_artifacts) == "ACME CORP" and one(spark, "O'CONNOR", repair.strip_quote_artifacts) == "O'CONNOR"
    assert one(spark, None, repair.ocr_letters) == "" and one(spark, "S01UCIONES 9", repair.ocr_letters) == "SOIUCIONES 9"
    assert tuple(one(spark, None, repair.consonant_keys)) == ("", "") and tuple(one(spark, "LA CASA AZUL", repair.consonant_keys)) == ("LCSZL", "LCA")
    assert one(spark, "✅ ok  \U0001f680 go️", repair.strip_signs) == "ok go" and one(spark, None, repair.strip_signs) is None


@pytest.mark.parametrize("raw,want", [(None, ("", "", "none")), ("AB12", ("AB12", "AB12", "none")), ("900123456", ("900123456", "9001234568", "computed")), ("900123456-8", ("9001234568", "9001234568", "declared")), ("900-123-456", ("900123456", "9001234568", "computed")), ("12345.0", ("12345", "12345", "computed")), ("12345678901", ("12345678901", "12345678901", "declared")), ("--", ("", "", "none"))])
def test_fix_nit(spark, raw, want):
    got = tuple(one(spark, raw, repair.fix_nit))
    assert got[0] == want[0] and got[2] == want[2] and got[1][: len(want[0])] == want[0] and len(got[1]) == len(want[1])


def test_nit_code(spark):
    assert [one(spark, x, repair.nit_code) for x in ("0123", "123", "", None, "1" * 16, "x")] == [4 * 10**16 + 123, 3 * 10**16 + 123, -1, -1, -1, -1]


def test_web_domain_of_addresses(spark):
    assert [one(spark, x, identifiers.web_domain) for x in ("http://10.0.0.1/", "https://www2.acme.com.co/x", "WWW.acme.com", "acme", None)] == ["", "acme.com.co", "acme.com", "", ""]


def brute(records, unions, vetoes):
    group = {r: {r} for r, _ in records}
    form, done = dict(records), {}
    for number, a, b, human in sorted(unions, key=lambda u: (not u[3], u[0])):
        if group[a] is group[b]:
            done[number] = True
            continue
        both = group[a] | group[b]
        if any((x in group[a] and y in group[b]) or (y in group[a] and x in group[b]) for x, y in vetoes) or (not human and len({form[x] for x in both} - {""}) > 1):
            done[number] = False
            continue
        done[number] = True
        for x in both:
            group[x] = both
    return {r: min(map(str, group[r])) for r in group}, done


@pytest.mark.parametrize("seed", range(2))
def test_restricted_components(spark, seed):
    rng = random.Random(seed)
    records = [(i, rng.choice(["", "SA", "SL", ""])) for i in range(60)]
    unions = [(n, *rng.sample(range(60), 2), rng.random() < 0.2) for n in range(80)]
    vetoes = [tuple(rng.sample(range(60), 2)) for _ in range(25)]
    groups, said = pairs.restricted_components(spark.createDataFrame(records, "rec_id long, form string"), spark.createDataFrame(unions, "number long, id_l long, id_r long, human boolean"), spark.createDataFrame(vetoes, "id_l long, id_r long"))
    want, done = brute(records, unions, vetoes)
    assert {r["rec_id"]: r["group"] for r in groups.collect()} == want
    assert {r["number"]: r["accepted"] for r in said.collect()} == done


def test_pair_sets(spark):
    rows = spark.createDataFrame([(i, "hot" if i < 300 else None if i == 300 else f"g{i // 2}") for i in range(305)], "id long, label string")
    got = {(r["id_l"], r["id_r"]) for r in pairs.group_pairs(rows, "id", "label").collect()}
    assert got == {(a, b) for a in range(300) for b in range(a + 1, 300)} | {(302, 303)}
    none = rows.limit(0)
    assert pairs.group_pairs(none, "id", "label").count() == 0
    said = pairs.pair_confusion(pairs.group_pairs(rows.filter("id >= 300"), "id", "label"), pairs.group_pairs(rows.filter("id >= 298"), "id", "label")).collect()
    assert sorted(map(tuple, said)) == [(298, 299, "FP"), (302, 303, "TP")]


def test_near_spellings_against_all_pairs(spark):
    from samewise.functions import strings
    from samewise.plans import catalog

    rng = random.Random(3)
    words = ["".join(rng.choices("ab", k=n)) for n in (5, 6, 7, 8, 12, 13, 14) for _ in range(8)]
    rows = spark.createDataFrame([("x", w) for w in words], "brand string, name string")
    got = {(r["nl"], r["nr"]) for r in catalog._near_spellings(rows).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    assert got == {(a, b) for a in words for b in words if a != b and 100 * (max(len(a), len(b)) - distance(a, b)) >= 85 * max(len(a), len(b))}
    assert strings.token_set_ratio("a b", "b a") == 1


def test_oversize_blocks_have_an_exact_way(spark):
    from samewise.operators import blocking

    keyed = spark.createDataFrame([(i, "hot" if i < 40 else f"k{i // 2}") for i in range(60)], "rec_id long, key string")
    whole = {(a, b) for a in range(40) for b in range(a + 1, 40)} | {(i, i + 1) for i in range(40, 60, 2)}
    found = lambda **o: {(r["id_l"], r["id_r"]) for r in blocking.pairs_by_key(keyed, 10, **o).collect()}
    assert found(overflow="exact") == whole and len(found()) == 10 and [tuple(r) for r in blocking.dropped_blocks(keyed, 10).collect()] == [("hot", 40, 780)]
    assert len(found(overflow="connect")) == 10 + 39
    with pytest.raises(ValueError):
        found(overflow="other")


def test_star_cover_of_a_large_group(spark):
    """2100 names in one group: leaders by what they cover, as in the small case."""
    from samewise.functions import strings
    from samewise.operators import clusters

    rng = random.Random(4)
    rows = [(i, 1, f"w{i % 700} {rng.choice('abc')}{i % 350}") for i in range(2150)]
    got = {r["rec_id"]: r["group"] for r in clusters.star_cover(spark.createDataFrame(rows, "rec_id long, group long, name string"), 0.9).collect()}
    names = {}
    for i, _, n in rows:
        names.setdefault(n, []).append(i)
    ordered = sorted(names, key=lambda n: (-len(names[n]), n))
    reach = {n: {n} for n in ordered}
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if strings.token_set_ratio(a, b) >= 0.9:
                reach[a].add(b)
                reach[b].add(a)
    free, want = set(ordered), {}
    while free:
        lead = max((n for n in ordered if n in free), key=lambda n: len(reach[n] & free))
        taken = reach[lead] & free
        for n in taken:
            for r in names[n]:
                want[r] = min(min(names[m]) for m in taken)
        free -= taken
    assert got == want


def test_row_numbers_follow_from_content(spark):
    from samewise.sources.readers import consolidate

    rows = [("a", i % 3) for i in range(9)] + [("b", None)]
    one, two = (spark.createDataFrame(r, "x string, y long").repartition(n) for r, n in ((rows, 3), (rows[::-1], 7)))
    numbers = [sorted((r["x"], r["y"] or -1, r["ORIGINAL_INDEX"]) for r in consolidate({"S": df}).collect()) for df in (one, two)]
    assert numbers[0] == numbers[1] and len({n for *_, n in numbers[0]}) == 10


def test_group_pairs_of_several_labels(spark):
    rng = random.Random(7)
    rows = [(i % 40, rng.choice("abcdef")) for i in range(70)] + [(None, "a"), (41, None)]
    got = [tuple(r) for r in pairs.group_pairs(spark.createDataFrame(rows, "id long, label string"), "id", "label").collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, x in rows for b, y in rows if None not in (a, b) and x == y and x and a < b}


def test_restricted_components_of_dense_unions(spark):
    # 780000 unions in one component, of which each was a row of pandas objects before
    ids = spark.range(1250).select(F.col("id").alias("rec_id"), F.expr("element_at(array('', 'SA', 'SL', ''), cast(id % 4 + 1 AS int))").alias("form"))
    edges = pairs.group_pairs(ids.withColumn("label", F.lit(1)), "rec_id", "label")
    unions = edges.select((F.col("id_l") * 1_000_000 + F.col("id_r")).alias("number"), "id_l", "id_r", F.expr("(id_l + id_r) % 5 = 0").alias("human"))
    start = time.monotonic()
    groups, said = pairs.restricted_components(ids, unions, edges.filter("(id_r - id_l) % 50 = 0"))
    counted = {tuple(r) for r in groups.groupBy("group").count().collect()}
    assert sum(n for _, n in counted) == 1250 and time.monotonic() - start < 25
    assert said.count() == 1250 * 1249 // 2


def test_thinned_edges_keep_the_components(spark):
    rng = random.Random(1)
    nodes = spark.range(80).select(F.col("id").alias("rec_id"))
    edges = spark.createDataFrame([(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(a, b) for a in range(20) for b in range(20)], "id_l long, id_r long")
    thin = clusters.thinned(edges)
    assert sorted(clusters.components(nodes, thin).collect()) == sorted(clusters.components(nodes, edges).collect()) and thin.count() <= 100


def test_pairs_by_key_of_one_key_compares_no_pairs(spark):
    # all pairs went through a distinct before, in tasks as few as the keyed rows fill
    one = spark.range(900).selectExpr("id AS rec_id", "cast(id % 3 AS string) AS key", "cast(id % 2 AS string) AS src")
    found = blocking.pairs_by_key(one, None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and found.rdd.getNumPartitions() >= 4 and found.count() == 3 * 300 * 299 // 2
    rng = random.Random(3)
    rows = list({(rng.randrange(40), rng.choice("abc"), rng.choice("xy")) for _ in range(90)})
    want = {(a, b) for a, k, s in rows for b, l, t in rows if a < b and k == l and (s != t or s != "x")}
    for max_block in (None, 60):
        got = [tuple(r) for r in blocking.pairs_by_key(spark.createDataFrame(rows, "rec_id long, key string, src string"), max_block, trusted=("x",)).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_restricted_components_stream_their_unions(spark):
    # a component's unions stood in one worker as a whole before
    def batch(rows):
        return pa.RecordBatch.from_pylist([dict(zip(("component", "kind", "number", "id_l", "id_r", "human", "form", "text"), x)) for x in rows])

    read = []

    def batches():
        for n in range(3):
            read.append(n)
            rows = [(1, 0, 0, i, i, False, "", str(i)) for i in range(4)] + [(1, 1, 0, 0, 2, False, "", "")] if n == 0 else [(1, 2, n, 0, n, False, "", ""), (2, 0, 0, 9, 9, False, "", "9"), (2, 2, 0, 9, 9, False, "", "")][: n if n == 1 else 3]
            yield batch(rows)

    said = pairs._settled(batches(), True)
    assert next(said)["accepted"].to_pylist() == [True] and read == [0, 1]
    assert [x["reason"].to_pylist() for x in said] == [["veto"], [""]]
    assert [x.to_pylist() for x in pairs._settled(batches(), False)][1] == [{"text_id": "9", "group": "9"}]
    ids = spark.range(3).selectExpr("id AS rec_id", "'' AS form")
    edges = spark.createDataFrame([(1, 0, 1, False)], "number long, id_l long, id_r long, human boolean")
    groups, _ = pairs.restricted_components(ids, edges, edges.select("id_l", "id_r").limit(0))
    assert "CoGroup" not in groups._jdf.queryExecution().executedPlan().toString()
