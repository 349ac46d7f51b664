"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, chat, fim, license_scan, lm, merkle, mixing, mpegts, ngram_join, quality, shards, stream_dedup, url_rules
from .common import table
from .oracles import ORACLES  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.format_chats(turns.unionByName(control)))


def op2_mixing(spark, sf_dir):
    found, report = mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    # what is left of the targets, as a share of all tokens, and the domains without a model stand beside every row
    return found.drop("row_key", "u").withColumns({"residual": F.lit(float(report["residual"])), "unmodelled": F.lit(",".join(report["unmodelled"]))})


def op3_bpe(spark, sf_dir):
    path = tokenizer_path()
    return bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path, digests=True)


def op4_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), 4, 85, 100).drop("row_key")


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    voter = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, voter)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def op6_url_rules(spark, sf_dir):
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.when(bad, "block").otherwise("allow").alias("verdict"))
    return url_rules.judge(table(spark, sf_dir, "pages"), labels)


def op7_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_mpegts(spark, sf_dir):
    return mpegts.media_digests(mpegts.write_media(table(spark, sf_dir, "documents")))


def op9_shards(spark, sf_dir):
    return shards.shard_documents(table(spark, sf_dir, "documents"), 8)


def op10_exact_dedup(spark, sf_dir):
    return stream_dedup.decide(spark, table(spark, sf_dir, "documents"))


def op11_fim(spark, sf_dir):
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


def op12_lm(spark, sf_dir):
    scored = lm.score_documents(table(spark, sf_dir, "documents"))
    # sums of doubles differ in their last digits with the order of adding
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op13_merkle(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), tampered)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_ngram_join": op4_ngram_join,
    "op5_quality": op5_quality,
    "op6_url_rules": op6_url_rules,
    "op7_license_scan": op7_license_scan,
    "op8_mpegts": op8_mpegts,
    "op9_shards": op9_shards,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fim": op11_fim,
    "op12_lm": op12_lm,
    "op13_merkle": op13_merkle,
}
