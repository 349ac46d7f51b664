"""Exact dedup by a streaming query with disk-backed keyed state.

Every row leaves a small record (digest, doc_id, content locator: file and row number) in a spool folder. A streaming
query folds the spool into state kept by digest in RocksDB, without watermark or expiry: the state
holds the stable identifier (largest doc_id), its content locator and the number of rows. Spark
folds rows of a key inside each task before they are dealt out, so a digest that a third of the
rows share reaches its state as one row per task. Later files in the same spool continue the same
state.

A digest met twice is a hit. For hits the whole normalised bytes are grouped beside the digest
(again folded per task), together with the contents that earlier runs left in the state, which are read
at their locators; if one digest stands for two different byte strings the run stops with an error
instead of merging them.

What the state says of a digest is brought back to its rows by a join on the digest; digests that hold a
thousandth of the rows or more (a thousand at most) are broadcast, so that none fills a task.

Defined results: null text counts as empty; null doc_id is ignored when the largest is chosen (a
group of only nulls keeps keep_id null, and the last of its rows by locator); of repeated rows with the same
doc_id and text exactly one is kept; an empty table gives an empty result; further columns of the
input are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, by_slot, located, remove, slots, small_batches, stored, work_dir

SPOOL = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("locator", T.StringType()),
        T.StructField("ordinal", T.LongType()),
    ]
)
STATE = T.StructType([SPOOL["digest"], T.StructField("keep_id", T.LongType()), SPOOL["locator"], SPOOL["ordinal"], T.StructField("group_size", T.LongType())])
#: Hex digits of the digest that index the fixed-size bitmap of hits (16**6 bits are 2 MB).
HIT_DIGITS = 6
#: A digest with one row in so many, or more, is broadcast.
HOT_SHARE = 1000


def _state_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    for key, value in {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }.items():
        session.conf.set(key, value)
    return session


def fold_stream(spark: SparkSession, spool: str, home: str, files_per_trigger: int | None = None) -> DataFrame:
    """Runs the stream over all files that the spool holds now; returns (digest, keep_id, locator, ordinal, group_size).

    home keeps the query's checkpoint and its output, so that a restart (after more files came, or after a
    failure) goes on where it stopped.
    """
    session = _state_session(spark)
    reader = session.readStream.schema(SPOOL)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folded = (
        reader.parquet(spool)
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.max(F.struct("doc_id", "locator", "ordinal")).alias("at"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", "keep_id", "at.locator", "at.ordinal", "group_size")
    )

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/out/part_of={number}")

    query = folded.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return state(spark, home) if query.lastProgress or _exists(spark, f"{home}/out") else spark.createDataFrame([], STATE)


def state(spark: SparkSession, home: str) -> DataFrame:
    """What the stream under home has said last of each digest."""
    # keep_id and group_size only grow, so the last state of a digest is the largest
    out = spark.read.schema(STATE).parquet(f"{home}/out/part_of=*")
    return out.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), *[F.max_by(c, "group_size").alias(c) for c in ("locator", "ordinal")], F.max("group_size").alias("group_size"))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _hit_bitmap(hits: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over digest prefixes; its words (16**HIT_DIGITS / 32 at most) come to the driver."""
    slot = F.conv(F.substring(F.hex("digest"), 1, HIT_DIGITS), 16, 10).cast("long")
    words = hits.select(slot.alias("slot")).selectExpr("slot div 32 AS word", "shiftleft(1L, cast(slot % 32 AS int)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = np.zeros(16**HIT_DIGITS // 32, dtype=np.uint32)
    got = words.toArrow()
    bitmap[got["word"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return bitmap


def earlier_contents(spark: SparkSession, met: DataFrame) -> DataFrame | None:
    """The texts that earlier runs keep for digests met again (locator, ordinal), read at their locators."""
    files = [r[0] for r in met.select("locator").distinct().collect()]
    if not files:
        return None
    held = spark.read.parquet(*files)
    text = F.col("text") if "text" in held.columns else F.col("__row.text")
    rows = held.select(text.alias("text"), F.col("_metadata.file_path").alias("locator"), F.col("_metadata.row_index").alias("ordinal"))
    return rows.join(met, ["locator", "ordinal"], "left_semi").select("text")


def check_bytes(docs: DataFrame, hits: DataFrame, digest_of=lambda data: hashlib.sha256(data).digest()) -> None:
    """Compares the whole bytes of all rows whose digest was met more than once; raises on a difference.

    Rows outside the bitmap cannot be hits and are not moved; equal bytes fold inside each task.
    """
    bitmap = _hit_bitmap(hits)
    if not bitmap.any():
        return

    def candidates(batches):
        for batch in batches:
            digests, texts = [], []
            for text in batch.column(0).to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass").lower()
                digest = digest_of(data)
                slot = int(digest.hex()[:HIT_DIGITS], 16)
                if bitmap[slot >> 5] >> np.uint32(slot & 31) & np.uint32(1):
                    digests.append(digest)
                    texts.append(data)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(texts, pa.binary())], ["digest", "bytes"])

    found = docs.select("text").mapInArrow(candidates, "digest binary, bytes binary")
    variants = found.groupBy("digest", "bytes").agg(F.lit(1).alias("one")).groupBy("digest").count().filter("count > 1")
    bad = variants.limit(1).collect()
    if bad:
        raise ValueError(f"two different texts share the digest {bytes(bad[0]['digest']).hex()}")


def _decided(spark: SparkSession, docs: DataFrame, home: str | None) -> tuple[DataFrame, DataFrame]:
    """The located rows, and for each of them file, place, digest and what the state says of its group."""
    small_batches(spark)
    once = home is None
    home = home or work_dir(spark, "dedup")
    run = uuid.uuid4().hex
    source = located(docs, f"{home}/{run}")
    text, doc_id = F.col("__row").getField("text"), F.col("__row").getField("doc_id").cast("long")
    digest = F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))
    spool = stored(source.select(doc_id.alias("doc_id"), digest.alias("digest"), F.col("__file").alias("locator"), F.col("__at").alias("ordinal")), f"{home}/spool/run={run}")
    known = stored(state(spark, home), f"{home}/{run}/known") if not once and _exists(spark, f"{home}/out") else None
    groups = stored(fold_stream(spark, f"{home}/spool/*", home), f"{home}/{run}/groups")
    if once:  # nothing will be added to this state
        remove(spark, f"{home}/checkpoint")
        remove(spark, f"{home}/out")
    hits = groups.filter("group_size > 1")
    texts = source.select(text.alias("text"))
    before = None if known is None else earlier_contents(spark, known.join(spool.select("digest").distinct(), "digest", "left_semi"))
    check_bytes(texts if before is None else texts.unionAll(before), hits.select("digest"))
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    said = groups.select("digest", "keep_id", "group_size", F.col("locator").alias("at_file"), F.col("ordinal").alias("at_row"))
    hot = said.filter(F.col("group_size") * HOT_SHARE >= total)
    marked = spool.join(F.broadcast(hot), "digest", "left")
    cold = marked.filter("group_size IS NULL").select(*spool.columns).join(said.filter(F.col("group_size") * HOT_SHARE < total), "digest")
    rows = marked.filter("group_size IS NOT NULL").unionByName(cold)
    return source, rows.withColumn("kept", (F.col("locator") == F.col("at_file")) & (F.col("ordinal") == F.col("at_row")))


def decide(spark: SparkSession, docs: DataFrame, home: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; see the module's docstring.

    With a home the state goes on from earlier calls, and group_size and keep_id tell of their rows too.
    """
    return _decided(spark, docs, home)[1].select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(spark: SparkSession, docs: DataFrame, home: str | None = None) -> DataFrame:
    """The rows of docs that stay, with all their columns. Rows that are surely kept do not move; the others are tried by their place."""
    source, rows = _decided(spark, docs, home)
    place = F.xxhash64("__file", "__at")
    dropped = rows.filter("NOT kept").select(F.col("locator").alias("__file"), F.col("ordinal").alias("__at"))
    sure, others = by_slot(source, place, slots(dropped, place))
    return sure.unionAll(others.join(dropped, ["__file", "__at"], "left_anti").select(*source.columns)).select("__row.*")
