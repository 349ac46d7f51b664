"""Helpers that the corpus operators share: tables in the shared folder, text keys, small checks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the session names none (a test on one machine) a temporary folder is set.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    own = spark.conf.get("samewise.shared.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="samewise-")
        spark.conf.set("samewise.shared.dir", own)
    return own


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this run in the shared folder."""
    return f"{shared_dir(spark)}/samewise/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Writes df as Parquet under path and reads it back: cuts lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    tidy_driver(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a finished step no longer needs."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most so many rows in an Arrow batch: texts are long, and both sides of a worker's pipe hold a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Memory that this process has freed goes back to the system: a worker lives on beside the stages after its own."""
    pa.default_memory_pool().release_unused()
    if _TRIM:  # of glibc only
        _TRIM(0)


def lean(run):
    """run, a function of Arrow batches, with give_back() at the end of its task."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_driver(spark: SparkSession) -> str | None:
    """give_back() for both processes of the driver; what its JVM says of it (None: this JVM has no such command).

    The JVM's compilers and code loading free native memory in many small pieces, which malloc would keep.
    """
    give_back()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    args = gateway.new_array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    kinds = gateway.new_array(jvm.java.lang.Class, 4)
    for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = jvm.java.lang.Class.forName(kind)
    try:  # by the interface's method: the bean server's own class is not open to callers
        return jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(beans, args)
    except Py4JError:
        return None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; lower() does just that where every character is one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of fixed size (bits, a power of two) over a bigint column; its words come to the driver, bits / 32 at most."""
    slot = F.pmod(F.col(column), F.lit(bits)).cast("long")
    words = keys.select(slot.alias("slot")).selectExpr("slot div 32 AS word", "shiftleft(1L, cast(slot % 32 AS int)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(bits // 32, dtype=np.uint32)
    found[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return found


def in_bitmap(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys.astype(np.int64) & (len(found) * 32 - 1)
    return (found[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1


def located(docs: DataFrame, home: str) -> DataFrame:
    """(__row, __file, __at): each row as a struct, with the file that holds it and its place there.

    A table that is not read straight from Parquet files is written under home first, so that every row
    has a place where its content can be found again.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    place = (F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    if docs._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation") and "_metadata" not in docs.columns:
        try:
            return docs.select(row, *place)
        except AnalysisException:  # a format without row numbers
            pass
    return stored(docs.select(row), f"{home}/content").select("__row", *place)


#: Bits of the filter of slots(), by which rows that need no trial pass without a shuffle: 2**24 / 64 words at most.
SLOT_BITS = 1 << 24


def slots(keys: DataFrame, key: Column) -> DataFrame:
    """A bitmap of fixed size over hashes, as a table of words (SLOT_BITS / 64 rows at most) that may be broadcast."""
    slot = F.pmod(key, F.lit(SLOT_BITS))
    return keys.select(slot.alias("s")).selectExpr("s div 64 AS __word", "shiftleft(1L, cast(s % 64 AS int)) AS bit").groupBy("__word").agg(F.bit_or("bit").alias("__bits"))


def by_slot(rows: DataFrame, key: Column, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash is surely not among those of words, the others)."""
    slot = F.pmod(key, F.lit(SLOT_BITS))
    marked = rows.withColumns({"__word": F.expr("0L") + F.floor(slot / 64), "__bit": (slot % 64).cast("int")}).join(F.broadcast(words), "__word", "left")
    hit = F.coalesce(F.call_function("getbit", F.col("__bits"), F.col("__bit")) == 1, F.lit(False))
    return tuple(marked.filter(h).select(*rows.columns) for h in (~hit, hit))


#: A key that holds one row in so many, or more, is broadcast: at most so many keys.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, said: DataFrame, key: str, weight: str) -> DataFrame:
    """rows joined on key with said (stored; weight: the number of rows of a key, repeated on each of its rows).

    Keys that hold a share of HOT_SHARE or more are broadcast, so that no task gets a frequent key's rows.
    """
    total = said.dropDuplicates([key]).agg(F.sum(weight)).first()[0] or 0
    often = F.col(weight) * HOT_SHARE >= total
    hot = said.filter(often)
    if hot.isEmpty():
        return rows.join(said, key)
    rest = rows.join(F.broadcast(hot.select(key).distinct()), key, "left_anti").join(said.filter(~often), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)
