"""Fill-in-middle, language-model scoring and Merkle manifests against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from samewise.llm import fim, lm, merkle

WORDS = [" ", "\n\t", "One two", "  lead", "trail \n", "é É ß 漢字", "a<P>b c", "<M>", "<S", "x" * 3000, "a\0b c", " wide space", "😀 😀", "a\x85b\x1cc d"]
TEXTS = ["", None, *WORDS, *[" ".join(WORDS[:i] * 7) for i in (3, 5, 6)], *[f"word{i} " * i for i in range(1, 60)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS * 3)] + [(None, "no id here at all", "y"), (4, "again and again", "z"), (4, "again and again", "z"), (-7, "below zero", "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, form string").repartition(3)


def cut(doc_id, text, rate=50, spm=80, seed=42):
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_fim_against_brute_force(docs):
    rows = docs.collect()
    got = fim.transform(docs).collect()
    want = [(r["doc_id"], *cut(r["doc_id"], r["text"] or "")) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    back = fim.restore(fim.transform(docs)).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((r["doc_id"], r["text"] or "") for r in rows), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    held = sorted((tuple(r) for r in fim.digests(fim.transform(docs)).collect()), key=str)
    assert held == sorted(((d, n, f, p, m, sha(out), sha(t or "")) for (d, n, f, p, m, out), t in zip(want, [r["text"] for r in rows])), key=str)


def test_fim_other_rule_and_kept_columns(docs):
    rule = fim.Rule(seed=7, rate=100, spm=0, markers=fim.Markers("[pre]", "[suf]", "[mid]'"))
    formed = fim.transform(docs.withColumnRenamed("form", "extra col"), rule, keep=("extra col",))
    assert formed.columns[-1] == "extra col" and {r["form"] for r in formed.filter("n > 0").collect()} == {"psm"}
    assert fim.restore(formed, rule).exceptAll(docs.selectExpr("doc_id", "coalesce(text, '') AS text")).isEmpty()
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "x<P>", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P", "P>", "<M>")):
        with pytest.raises(ValueError):
            fim.Markers(*bad)


def test_fim_empty_and_long(spark):
    assert fim.digests(fim.transform(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0
    long = "".join(f"w{i}é " for i in range(1_200_000))
    df = spark.createDataFrame([(i, long if i == 3 else f"short text {i}") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    rule = fim.Rule(rate=100)
    got = {r["doc_id"]: r for r in fim.digests(fim.transform(df, rule), rule).collect()}
    n, form, a, b, out = cut(3, long, rate=100)
    assert (got[3]["n"], got[3]["form"], got[3]["prefix_chars"], got[3]["middle_chars"]) == (n, form, a, b) and n == 1_200_001
    assert got[3]["output_sha256"] == hashlib.sha256(out.encode()).hexdigest() and got[3]["restored_sha256"] == hashlib.sha256(long.encode()).hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(hashes):
    """The last node, and for each leaf its (place, siblings) from below."""
    paths, level, where = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for path, w in zip(paths, where):
            run = runs[w // 8]
            path.append((w % 8, run[: w % 8] + run[w % 8 + 1 :]))
        level, where = [sha("".join(run)) for run in runs], [w // 8 for w in where]
    return level[0], paths


def fold(leaf, path):
    for at, siblings in path:
        leaf = sha("".join(siblings[:at]) + leaf + "".join(siblings[at:]))
    return leaf


def manifest(rows):
    """rows (doc_id, source, lang, n_chars, text) -> (doc_id, leaf, subroot, root, proof digest), sorted."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, sha("".join(map(field, r)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: climb([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    root, tops = climb([low[g][0] for g in order])
    found = []
    for g, top in zip(order, tops):
        for (named, doc_id, leaf), path in zip(sorted(groups[g]), low[g][1]):
            assert fold(leaf, path + top) == root
            found.append((doc_id if named else None, leaf, low[g][0], root, sha("".join("".join(s) for _, s in path + top))))
    return sorted(found, key=str)


def test_merkle_against_brute_force(spark):
    rows = [(i * 3 % 601, "s%d" % (i % 3), "en", i, f"Text {i} é") for i in range(601)] + [(i, None, f"l{i:02d}", None, None) for i in range(11)]
    rows += [(i, "x", None, 2, "No Language") for i in range(9)] + [(None, None, "fr", None, "A"), (None, None, "fr", None, "B"), (5, "s", "fr", 1, "same"), (5, "s", "fr", 1, "same"), (5, "s", "fr", 1, "other"), (2**40, "", "", -3, "")]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, hash string").repartition(5)
    got = merkle.audit(df, F.col("doc_id") % 2 == 0).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == manifest(rows)
    texts = {r[0]: r[4] for r in rows if r[2] == "en"}
    changed = {r["doc_id"] for r in got if not r["verified"]}
    assert {d for d in texts if d % 2 == 0} <= changed and not any(r["verified"] is False and (r["doc_id"] is None or r["doc_id"] % 2) for r in got)
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in got)
    assert [r["verified"] for r in got if r["doc_id"] == 2**40] == [True]  # nothing to lower-case


def test_merkle_proofs_and_small_tables(spark):
    kinds = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    assert merkle.manifest(spark.createDataFrame([], kinds)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "s", "en", 1, "t")], kinds)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == []
    many = merkle.manifest(spark.createDataFrame([(i, "s", "en", 1, "t" * i) for i in range(70)], kinds)).collect()
    for r in many:
        assert fold(r["leaf"], [(s["at"], s["siblings"]) for s in r["proof"]]) == r["root"]
    assert sorted(len(r["proof"][0]["siblings"]) for r in many) == [5] * 6 + [7] * 64 and {len(r["proof"]) for r in many} == {3}


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


def language_model(rows, order, strength):
    """rows (doc_id, text) -> (doc_id, held out, tokens, known, N, base, score), by counting n-grams in dictionaries."""
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    grams = Counter()
    for d, text in rows:
        if not held(d):
            w = ["begin", *tokens(text)]
            grams.update(tuple(w[max(0, i - k) : i + 1]) for i in range(len(w)) for k in range(order) if i >= k)
    n, v = (f(c for g, c in grams.items() if len(g) == 1 and g != ("begin",)) for f in (sum, lambda x: len(list(x))))

    def p(history, w):
        if not history:
            return (grams[w,] + 0.1) / (n + 0.1 * (v + 1))
        return (grams[*history, w] + strength * p(history[1:], w)) / (grams[history] + strength)

    found = []
    for d, text in rows:
        w = ["begin", *tokens(text)]
        logs = [(math.log10(p((), w[i])), math.log10(p(tuple(w[max(0, i - order + 1) : i]), w[i]))) for i in range(1, len(w))]
        found.append((d, held(d), len(logs), sum(grams[x,] > 0 for x in w[1:]), n, round(sum(a for a, _ in logs), 5), round(sum(b for _, b in logs), 5)))
    return sorted(found, key=str)


def prose(seed, size=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "naïve", *[f"w{i}" for i in range(60)]]
    texts = [rng.choice([" ", "\n", "\t "]).join(rng.choices(words, k=rng.choice([1, 5, 30, 64, 65, 130]))) for _ in range(size)]
    rows = [(i, t) for i, t in enumerate(texts + ["", None, "  ", "unheard words only", texts[0]])]
    return rows + [(None, "no id"), (3, texts[3]), (3, texts[3]), (-5, texts[4].upper())]


@pytest.mark.parametrize("order,strength", [(1, 20.0), (2, 20.0), (3, 4.0)])
def test_lm_against_brute_force(spark, order, strength):
    rows = prose(order)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, block int").repartition(4)
    model = lm.fit(df, order, strength)
    model = lm.Model(model.n, model.v, 5, 3, order, strength)  # several blocks and buckets
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in lm.score_documents(df, model).collect()]
    want = language_model(rows, order, strength)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=2e-5)


def test_lm_long_texts_in_pieces(spark):
    rng = random.Random(9)
    long = " ".join(rng.choices([f"word{i}" for i in range(500)], k=200_000))
    rows = [(1, long), (2, long[:300_000] + "x" * 700_000 + long[300_000:900_000]), (3, "word1 word2"), (11, long[:1000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for order in (2, 3):
        model = lm.fit(df, order, 20.0)
        assert lm.pieces(df, model).count() > 8
        got = {r["doc_id"]: (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in lm.score_documents(df, model).collect()}
        for d, _, *rest in language_model(rows, order, 20.0):
            assert got[d] == pytest.approx(tuple(rest), rel=1e-9, abs=1e-5)


def test_lm_automaton_is_a_distribution():
    rows = [t for _, t in prose(4) if t]
    each = lambda v, kind: pa.array([v] * len(rows), kind)
    table = pa.table({"block": each(0, pa.int32()), "held_out": each(False, pa.bool_()), "piece": each(0, pa.int32()), "last": each(True, pa.bool_()), "lead": each("", pa.string()), "text": pa.array(rows)})
    block = lm.Block(table, 3)
    totals = [c.astype(float) for _, c in block.own(np.zeros(len(rows), dtype=bool))]
    words = block.word[block.counted]
    n, v = len(words), len(set(words.tolist()))
    automaton = lm.Automaton(block, totals, n, v, 20.0)
    vocabulary = np.unique(automaton.word[block.counted])
    followed = automaton.targets[(automaton.codes & np.uint64(0xFFFFFFFF)) != automaton.word[-1]]  # nothing follows the end token
    for state in [0, *np.unique(followed)[::40]]:
        s, log = state, automaton.unknown  # an unknown word goes by failure arcs to the root
        while s:
            log, s = log + automaton.back[s], automaton.fail[s]
        total = 10**log
        for w in vocabulary:
            s, log = state, 0.0
            while True:
                code = np.uint64(s) << np.uint64(32) | w
                at = np.searchsorted(automaton.codes, code)
                if at < len(automaton.codes) and automaton.codes[at] == code:
                    total += 10 ** (log + automaton.weights[at])
                    break
                assert s, "every training word has an arc at the root"
                log, s = log + automaton.back[s], automaton.fail[s]
        assert total == pytest.approx(1.0, abs=1e-9)


def test_lm_empty(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score_documents(empty).count() == 0
    none = [tuple(r) for r in lm.score_documents(spark.createDataFrame([(None, None)], "doc_id bigint, text string")).collect()]
    assert none == [(None, True, 1, 0, 0, pytest.approx(0.0), pytest.approx(0.0))]  # nothing learned from
