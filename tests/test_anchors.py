"""Dedup of anchors and destinations, and the similarity of names without identifiers, against plain Python."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from samewise.functions import strings, text, traits
from samewise.operators import anchors, clusters, names, pairs, similar, tables

FAMILIES = {"COOP": r"\bS ?COOP\b|COOPERATIV", "SL": r"\bSL\b|\bSRL\b|\bLTDA\b", "SA": r"\bSAU?\b", "LTD": r"\bLTD\b"}
text.register_locale("LINKING", "ES", "EN", extra=("S COOP", "COOP"))
RULES = anchors.AnchorRules(families=FAMILIES, words=traits.Rules(locale="LINKING"))
CASES = [
    # names of one country, cut flags, expected groups (by place), motives of what is left to a person
    (["Zelvora Alimentos SA", "ZELVORA ALIMENTOS", "Zelvora Alimentos, S.A."], None, [0, 0, 0], []),
    (["Kra Mento Foods", "Kramento Foods"], None, [0, 0], []),
    (["Zelvora Norte 2", "Zelvora Norte 3"], None, [0, 1], ["mismas letras, pero difieren"]),
    (["Fribelia Norte S. COOP", "Fribelia Norte SL"], None, [0, 1], ["mismo nombre, forma legal distinta"]),
    (["Fribelia Norte", "Fribelia Norte SL", "Fribelia Norte S. COOP"], None, None, ["no se une sola", "forma legal distinta"]),
    (["Zelvora Alimenta", "Zelvora Alimentacion"], [True, False], [0, 0], []),
    (["Zelvora Alimenta", "Zelvora Alimentacion"], [False, False], [0, 1], None),
    (["KEV", "Kronos Empresarial Valdoria"], None, [0, 1], ["posible sigla o abreviatura"]),
    (["Pustoran Foods (Lamberto)", "Lamberto"], None, [0, 1], ["coincide con el nombre entre"]),
    (["Zelvora", "Zelvora Grupo Servicios"], None, [0, 1], ["lo que sobra es genérico"]),
    (["Grupo Servicios", "Servicios Grupo Trading"], None, [0, 1], []),
    (["Zelvora Alimentos", "Kramento Plasticos"], None, [0, 1], []),
]


def test_cases(spark):
    rows = [(f"P{i}", n, bool(cut and cut[k])) for i, (group, cut, *_) in enumerate(CASES) for k, n in enumerate(group)]
    filler = [("ZZ", f"Marca{i} Propia{i}", False) for i in range(300)]  # so that words of the cases are rare
    got = anchors.dedupe_anchors(spark.createDataFrame(rows + rows[:1] + filler, "country string, name string, cut boolean"), RULES)
    seen = got.spellings.collect()
    by, keys = {(r["country"], r["name"]): r for r in seen}, {r["rec_id"]: r["country"] for r in seen}
    assert by["P0", "Zelvora Alimentos SA"]["n_rows"] == 2 and by["P0", "Zelvora Alimentos SA"]["form"] == "SA"
    pending = {}
    for r in got.pending.collect():
        pending.setdefault(keys[r["id_l"]], []).append(r["MOTIVO"])
    for i, (group, _, want, motives) in enumerate(CASES):
        labels = [by[f"P{i}", n]["group"] for n in group]
        if want is not None:
            assert [labels.index(x) for x in labels] == [want.index(w) for w in want], (group, labels)
        if motives is not None:
            found = pending.get(f"P{i}", [])
            assert len(found) >= len(motives) and all(any(m in f for f in found) for m in motives), (group, found)
            assert motives or not found, (group, found)
    bridge = [by["P4", n]["group"] for n in CASES[4][0]]
    assert bridge[1] != bridge[2] and bridge[0] in bridge[1:]  # a name without a form joins one of the two, never both
    forms = {}
    for r in seen:
        forms.setdefault(r["group"], set()).add(r["form"])
    assert all(len(f - {""}) <= 1 for f in forms.values())


def test_decisions(spark):
    rows = [("ES", n, False) for n in ("Zelvora Alimentos", "Zelvora Alimentos SA", "Kramento", "Orbelia")]
    said = [("ES|Zelvora Alimentos", "ES|Zelvora Alimentos SA", "DISTINTA", "ana", 1), ("ES|Kramento", "ES|Orbelia", "DISTINTA", "ana", 2), ("ES|Orbelia", "ES|Kramento", "MISMA_ENTIDAD", "luis", 3), ("ES|Kramento", "ES|nobody", "MISMA_ENTIDAD", "luis", 4), ("ES|Kramento", "ES|Kramento", "DISTINTA", "luis", 5)]
    got = anchors.dedupe_anchors(spark.createDataFrame(rows, "country string, name string, cut boolean"), RULES, spark.createDataFrame(said, anchors.NO_DECISIONS))
    group = {r["name"]: r["group"] for r in got.spellings.collect()}
    assert group["Zelvora Alimentos"] != group["Zelvora Alimentos SA"] and group["Kramento"] == group["Orbelia"]
    assert [r["REGLA"] for r in got.unions.collect()] == ["decisión: luis"] and got.pending.count() == 0
    assert sorted(r["why"] for r in got.unknown.collect()) == ["consigo misma", "desconocida"]


def test_no_pair_that_a_rule_takes_is_missed(spark):
    parts = ["ZELVORA", "ZELVORAS", "KRONOS", "KRON", "EMPRESARIAL", "VALDORIA", "GRUPO", "KEV", "FOODS", "PLVK", "PELUVIKA", "NORTE", "2"]
    texts = [" ".join(p) for k in (1, 2) for p in itertools.permutations(parts, k)]
    found = anchors.spellings(spark.createDataFrame([("ES", t, i % 3 == 0) for i, t in enumerate(texts)], "country string, name string, cut boolean"), FAMILIES, "LINKING").persist()
    judged = {(r["id_l"], r["id_r"]): (r["motive"], r["automatic"]) for r in anchors.judged_pairs(found, RULES).collect()}
    weights, n = names.name_words(found, column="norm")
    side = lambda x: found.select(*[F.col(c).alias(f"{c}_{x}") for c in ("rec_id", "norm", "form", "cut")])
    every = side("l").crossJoin(side("r")).filter("rec_id_l < rec_id_r")
    scored = names.name_similarity(every.select(F.col("norm_l").alias("l"), F.col("norm_r").alias("r")).distinct(), weights, n)
    every = every.join(scored.select(F.col("l").alias("norm_l"), F.col("r").alias("norm_r"), "SCORE"), ["norm_l", "norm_r"])
    x, y, swap = F.least("norm_l", "norm_r"), F.greatest("norm_l", "norm_r"), F.col("norm_l") > F.col("norm_r")
    t = traits.pair_traits(x, y, RULES.words, F.when(swap, F.col("cut_r")).otherwise(F.col("cut_l")), F.when(swap, F.col("cut_l")).otherwise(F.col("cut_r")), True)
    useful = lambda c: F.size(text.useful_words(c, "LINKING")) > 0
    every = every.withColumn("t", t).filter((useful(x) & useful(y)) | (x == y))
    said = anchors.verdict(x == y, F.lit(False), F.col("t"), F.col("SCORE"), F.lit(True), F.col("form_l"), F.col("form_r"), RULES)
    want = {(r["rec_id_l"], r["rec_id_r"]): (r["v"]["motive"], r["v"]["automatic"]) for r in every.withColumn("v", said).filter("v.motive IS NOT NULL").collect()}
    same = {k: v for k, v in want.items() if v[0] != "mismo nombre normalizado"}  # equal names hang on one of them
    assert {k: v for k, v in judged.items() if v[0] != "mismo nombre normalizado"} == same and len(same) > 200


@pytest.mark.parametrize("by_identifier", [True, False])
def test_destinations(spark, by_identifier):
    rows = [(1, "FR12345678901234", "Zelvora", "FRA"), (2, "FR123456789", "zelvora ", "FRA"), (3, "DE99-1003", "Zelvora", "DEU"), (4, "DE99", "Otra", "DEU"), (5, "X1", "SA", "ESP"), (6, "X2", "SA", "ESP")]
    said = spark.createDataFrame([("X1", "X2", "MISMA_ENTIDAD", "ana", 1), ("DE99-1003", "DE99", "DISTINTA", "ana", 2)], anchors.NO_DECISIONS)
    df = spark.createDataFrame(rows, "rec_id bigint, key string, name string, countries string")
    plain = {r["rec_id"]: r["group"] for r in anchors.dedupe_destinations(df, by_identifier)[0].collect()}
    decided = {r["rec_id"]: r["group"] for r in anchors.dedupe_destinations(df, by_identifier, said)[0].collect()}
    assert plain == ({1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6} if by_identifier else {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6})
    assert decided == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_name_similarity_against_plain_python(spark):
    rules = names.NameRules(generic=("FOODS",), structural=("GRUPO",), distinctive=0.05)
    corpus = [" ".join(p) for k in (1, 2, 3) for p in itertools.combinations(["ZELVORA", "FOODS", "GRUPO", "KR", "123", "X", "NORTE"], k)] + [f"RELLENO{i} FOODS" for i in range(600)]
    n = len(set(corpus))
    df = {}
    for name in set(corpus):
        for w in {w for w in name.split() if len(w) >= 2}:
            df[w] = df.get(w, 0) + 1
    raw = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}
    weight = {w: min(v, 1.0) if w in rules.generic else v for w, v in raw.items()}
    telling = {w for w in df if len(w) >= 3 and w not in rules.structural and not w.isdigit()}
    floor = math.log((1 + n) / (1 + max(5, round(0.05 * n)))) + 1

    def score(a, b):
        x, y = ({w for w in t.split() if len(w) >= 2} for t in (a, b))
        w = lambda s: sum(weight[t] for t in s)
        jaccard = w(x & y) / w(x | y) if w(x | y) else 0.0
        inside = w(x & y) / min(w(x), w(y)) if min(w(x), w(y)) else 0.0
        common = x & y & telling
        gates = len((x ^ y) & telling) <= 0 and len(common) >= 1 and max(raw[t] for t in common) >= floor
        return 0.25 * (max(jaccard, inside) if gates else jaccard) + 0.75 * strings.jaro_winkler(a, b), gates

    pairs = list(itertools.combinations(sorted(set(corpus))[:70], 2))
    words, count = names.name_words(spark.createDataFrame([(t,) for t in corpus], "name string"), rules)
    assert count == n
    got = names.name_similarity(spark.createDataFrame(pairs + [("ZELVORA", "UNHEARD"), ("", "ZELVORA")], "l string, r string"), words, count, rules).collect()
    for r in got:
        if r["l"] == "":
            assert r["SCORE"] == 0.5
        elif r["r"] == "UNHEARD":
            assert r["SCORE"] == pytest.approx(0.75 * strings.jaro_winkler("ZELVORA", "UNHEARD")) and r["DIF_INFORMATIVA"] is None
        else:
            assert (r["SCORE"], r["USO_CONTENCION"]) == (pytest.approx(score(r["l"], r["r"])[0]), score(r["l"], r["r"])[1]), r
    assert sum(r["USO_CONTENCION"] for r in got) > 3


def test_no_table_passes_the_driver(spark, monkeypatch):
    # texts and their traits were broadcast before, as Parquet makes them small
    seen = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module in (anchors, clusters, pairs, similar):
        monkeypatch.setattr(module, "stored", lambda df, name="step": seen.append(plan(df)) or tables.stored(df, name))
    rows = [("ES", f"{n}{f}", False) for n in ("Zelvora Alimentos", "Zelvora Alimento", "Zel Vora Alimentos", "Kramento") for f in ("", " SA", " SL")]
    said = spark.createDataFrame([("ES|Kramento", "ES|Zelvora Alimento", "DISTINTA", "ana", 1)], anchors.NO_DECISIONS)
    got = anchors.dedupe_anchors(spark.createDataFrame(rows, "country string, name string, cut boolean"), RULES, said)
    seen += [plan(d) for d in (got.spellings, got.unions, got.pending)]
    assert got.spellings.count() == 12 and len(seen) > 15 and not any("Broadcast" in p for p in seen)


def test_traits_are_worked_out_once(spark, monkeypatch):
    # 30 countries and three legal forms of the same two texts: 540 pairs of spellings went to Python before
    rows = [(f"C{c:02d}", f"{n}{f}", False) for c in range(30) for n in ("Zelvora Alimentos", "Zelvora Alimento") for f in ("", " SA", " SL")]
    seen, real = [], anchors.text_traits
    monkeypatch.setattr(anchors, "text_traits", lambda pairs, rules: seen.append(real(pairs, rules)) or seen[-1])
    got = anchors.dedupe_anchors(spark.createDataFrame(rows, "country string, name string, cut boolean"), RULES)
    assert got.spellings.count() == 180 and [t.count() for t in seen] == [3]
