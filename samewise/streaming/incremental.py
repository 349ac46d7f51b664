"""Incremental crosswalk: batches of new records join the entities of earlier batches by identifier base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as ids


def fold_bases(spark: SparkSession, path: str, schema: str, nit: str, checkpoint: str, out: str) -> DataFrame:
    """Streams the Parquet files of a folder once and keeps (base, records, first) of each valid base; a restart goes on with new files."""
    base = ids.valid_base(F.col(nit))
    state = spark.readStream.schema(schema).parquet(path).withColumn("base", base).filter("base <> ''").groupBy("base").agg(F.count(F.lit(1)).alias("records"))

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/part_of={number}")

    query = state.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("base string, records bigint").parquet(f"{out}/part_of=*").groupBy("base").agg(F.max("records").alias("records"))
