"""License scans by diagonal voting, in DataFrame functions alone.

All rolling word K-gram hashes of the texts are held against those of the templates; the hits, with their
words, are joined with the K-gram positions of the templates on hash and words. A hit votes for the diagonal (word position less template position) of its template; diagonals at most
SLACK apart are merged, so that a word more or less inside a passage does not split it, and the span is
verified: an exact template must have all its K-grams, and so all its words, at one diagonal, a loose one must have the share
MIN_COVER of its K-grams in the merged span.

Defined results: null and empty texts have no words and no labels, score 0; rows with the same doc_id
and text give the same values row by row; null doc_id is kept; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, work_dir

K, SLACK, MIN_COVER, BITS = 3, 2, 0.75, 62
#: After lower-casing A-Z, all ASCII but letters and digits stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """words with single spaces; exact templates count places, loose ones add labels of the method."""

    label: str
    words: str
    exact: bool


TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", False),
    Template("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", False),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", False),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
        False,
    ),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", False),
)


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z. The Kelvin sign is the one other character that lower() turns into ASCII; it stays apart."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ue000")))
    return F.array_remove(F.split(low, GAP), "")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spark = docs.sparkSession
    grams, heads = [], []
    for number, t in enumerate(templates):
        parts = t.words.split(" ")
        count = len(parts) - K + 1
        if count < 1:
            raise ValueError(f"template {t.words!r} has no {K} words")
        heads.append((number, t.label, t.exact, count))
        grams += [(number, i, *parts[i : i + K]) for i in range(count)]
    counts = heads
    known = spark.createDataFrame(grams, f"template int, at int, {', '.join(f'w{i} string' for i in range(K))}").withColumn("gram", F.xxhash64(*[f"w{i}" for i in range(K)]))
    heads = F.broadcast(spark.createDataFrame(heads, "template int, label string, exact boolean, count int"))
    known = F.broadcast(known.join(heads, "template"))

    # hits stand as bits, so many of a template to a number
    masks = [f"mask_{i}" for i in range(-(-max(h[3] for h in counts) // BITS))]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), words_of(F.col("text")).alias("words"))
    # only words whose hash with the K - 1 that follow is known leave the array, each with these words to be compared
    window = ["w", *[f"get(words, i + {j})" for j in range(1, K)]]
    wanted = ", ".join(sorted({str(r["gram"]) + "L" for r in known.select("gram").collect()}, key=len))
    gram = f"xxhash64({', '.join(window)})"
    record = f"named_struct('pos', i, 'gram', {gram}, {', '.join(f'{chr(39)}w{j}{chr(39)}, {x}' for j, x in enumerate(window))})"
    hits = F.expr(f"filter(transform(slice(words, 1, greatest(size(words) - {K - 1}, 0)), (w, i) -> CASE WHEN {gram} IN ({wanted}) THEN {record} END), x -> x IS NOT NULL)")
    # words are taken apart once: the rows with their hits are stored
    base = stored(base.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), hits.alias("hits")), work_dir(spark, "license-scan"))
    hits = base.select("doc_id", "key", F.explode("hits").alias("h")).select("doc_id", "key", "h.*").join(known, ["gram", *[f"w{j}" for j in range(K)]]).withColumn("diagonal", F.col("pos") - F.col("at"))
    votes = hits.groupBy("doc_id", "key", "template", "diagonal").agg(*[F.expr(f"bit_or(CASE WHEN at div {BITS} = {i} THEN shiftleft(1L, cast(at % {BITS} AS int)) ELSE 0L END)").alias(m) for i, m in enumerate(masks)], *[F.first(c).alias(c) for c in ("label", "exact", "count")])
    # with all its K-grams on one diagonal, word by word, a template stands there as a whole
    votes = votes.withColumn("stands", F.col("exact") & (F.expr(" + ".join(f"bit_count({m})" for m in masks)) == F.col("count")))
    along = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    run = F.sum(F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= SLACK, 0).otherwise(1)).over(along)
    spans = (
        votes.withColumn("run", run)
        .groupBy("doc_id", "key", "template", "run")
        .agg(
            F.first("label").alias("label"),
            (F.expr("(" + " + ".join(f"bit_count(bit_or({m}))" for m in masks) + ")") / F.first("count")).alias("cover"),
            F.sum(F.col("stands").cast("long")).alias("places"),
            F.min(F.when(F.col("stands"), F.col("diagonal"))).alias("low"),
            F.max(F.when(F.col("stands"), F.col("diagonal"))).alias("high"),
            F.first("exact").alias("exact"),
        )
    )
    found = spans.groupBy("doc_id", "key").agg(
        F.sum("places").alias("n_base"),
        F.min("low").cast("long").alias("first_word"),
        F.max("high").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when((F.col("places") > 0) | (~F.col("exact") & (F.col("cover") >= MIN_COVER)), F.col("label")))), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    rows = base.select("doc_id", "key", "n_words").alias("r")
    found = found.alias("f")
    same = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.key") == F.col("f.key"))
    return rows.join(found, same, "left").select(
        "r.doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
