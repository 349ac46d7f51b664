"""Stored intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("samewise.shared.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="samewise-")
        spark.conf.set("samewise.shared.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes df as Parquet and reads it back: lineage ends there, and lost executors cost no more than a reread."""
    path = f"{shared_dir(df.sparkSession)}/samewise/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join by shuffles. Stored tables with equal values are small as files and many times that as rows, so Spark would broadcast them through the driver."""
    return df.hint("merge")


#: Rows that a task of a join is to hold of its larger side.
TASK_ROWS = 300_000


def task_parts(df: DataFrame, rows: int | None = None) -> int:
    """How many parts a shuffle of df needs so that each holds about so many rows (None: TASK_ROWS); no fewer than Spark's own setting."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // (rows or TASK_ROWS)))


#: Keys whose parts are broadcast at most; beyond, only those that hold one in so many of the dealt rows.
DEALT_KEYS, DEALT_SHARE = 100_000, 1000


def spread_join(left: DataFrame, right: DataFrame, on: list[str], rows: int = 2000, parted: bool = False) -> DataFrame:
    """The inner join on columns; right rows of a frequent key are dealt over parts of about so many rows, and left rows go to each part.

    The parts of frequent keys are broadcast (DEALT_KEYS at most), so that neither side meets on the bare key before it is dealt; the sides are not.
    parted: as many tasks as there are shuffle partitions, also where both sides are small and only their pairs are many.
    """
    counted = right.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows)
    big = stored(counted.select(*on, "__n", F.ceil(F.col("__n") / rows).cast("int").alias("__parts")), "big")
    keys, held = big.agg(F.count(F.lit(1)), F.sum("__n")).first()
    if keys > DEALT_KEYS:
        big = big.filter(F.col("__n") * DEALT_SHARE >= held)
    part, spread, dealt = [], left, right
    if keys:
        part, parts = ["__part"], F.broadcast(big.drop("__n"))
        dealt = right.join(parts, on, "left").withColumn("__part", F.pmod(F.xxhash64(*right.columns), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
        spread = left.join(parts, on, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    if parted:
        n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread, dealt = (side.repartition(n, *on, *part) for side in (spread, dealt))
    return spread.join(dealt.hint("shuffle_hash") if parted else shuffled(dealt), [*on, *part]).drop("__part")
