"""The Jaccard join against brute force over all pairs."""

import random

import pytest

from samewise.llm import ngram_join


def brute(rows, size, num, den, classes=False):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d, *([find(i)] if classes else [])) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=25))
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(rng.choice([1, 2, 6, 25])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = rng.choice(words)
            if rng.random() < 0.2:
                t.insert(rng.randrange(len(t)), passage)
            if rng.random() < 0.1:
                t = t[: rng.randint(1, len(t))]
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else "\t ".join(t))
    texts += ["", None, " \n", "One", "one", "a b", "a  b", "b a", passage, "é É", "É é"]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (None, ""), (3, texts[3]), (3, "other words here now")]


@pytest.mark.parametrize("seed,size,num", [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 2, 60)])
def test_against_brute_force(spark, seed, size, num):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, node string").repartition(4)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(df, size, num, 100).collect()), key=str)
    assert got == brute(rows, size, num, 100)


def test_near_dedup(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, __key string")
    kept = ngram_join.near_dedup(spark, df)
    assert kept.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    whole = brute(rows, 5, 80, 100, classes=True)
    assert len([1 for d, t in left if (t or "").split()]) == len({c for d, n, _, c in whole if n})
    again = [c for d, n, _, c in brute(left, 5, 80, 100, classes=True) if n]
    assert len(again) == len(set(again))


def test_near_dedup_keeps_unlinked_texts_of_one_id(spark):
    rows = [(3, "alpha beta gamma delta epsilon zeta"), (3, "one two three four five six"), (4, "q w e r t y u"), (4, "q w e r t y u"), (5, "Q W E R T Y U")]
    kept = ngram_join.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_empty(spark):
    assert ngram_join.jaccard_classes(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert ngram_join.near_dedup(spark, spark.createDataFrame([(1, None)], "doc_id bigint, text string")).count() == 1


def test_near_dedup_keeps_texts_without_ids(spark):
    rows = [(None, "a b c d e f"), (None, "g h i j k l"), (None, "a b c d e f"), (7, "g h i j k l"), (None, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in ngram_join.near_dedup(spark, df).collect()), key=str)
    assert got == sorted([(None, "a b c d e f"), (7, "g h i j k l"), (None, None), (8, "")], key=str)
