"""Sinks: result folders with a manifest, neutralised CSV, data dictionary."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def neutralise(c: Column) -> Column:
    """Text that a spreadsheet would take for a formula gets an apostrophe; control characters go."""
    plain = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    return F.when(F.regexp_like(plain, F.lit(r"^\s*[=+\-@]")), F.concat(F.lit("'"), plain)).otherwise(plain)


def write_csv(df: DataFrame, path: str) -> None:
    safe = df.select(*[neutralise(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
    safe.write.option("header", True).option("lineSep", "\n").csv(path, compression="gzip")


def content_sum(df: DataFrame) -> int:
    """A sum over row hashes: equal for equal rows in any order."""
    return int(df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0] or 0)


def dictionary(tables: dict[str, DataFrame]) -> list[dict]:
    return [{"table": t, "column": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for t, df in tables.items() for f in df.schema]


def write_result(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict:
    """Tables as Parquet under a pending name, a manifest with rows and content sums, then one rename."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, pending = fs_path(folder), fs_path(folder + ".pending")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(folder)
    fs.delete(pending, True)
    manifest = {"contract": "1.0", "tables": {}}
    for name, df in tables.items():
        df.write.parquet(f"{folder}.pending/{name}.parquet")
        back = spark.read.parquet(f"{folder}.pending/{name}.parquet")
        manifest["tables"][name] = {"rows": back.count(), "content": str(content_sum(back))}
    manifest["dictionary"] = dictionary(tables)
    out = fs.create(fs_path(f"{folder}.pending/manifest.json"))
    out.write(bytearray(json.dumps(manifest, indent=1).encode()))
    out.close()
    fs.rename(pending, target)
    return manifest


def read_result(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a result folder; raises where one no longer matches the manifest."""
    text = "\n".join(r["value"] for r in spark.read.text(f"{folder}/manifest.json").collect())
    found = {}
    for name, facts in json.loads(text)["tables"].items():
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        if df.count() != facts["rows"] or str(content_sum(df)) != facts["content"]:
            raise ValueError(f"{name} does not match its manifest")
        found[name] = df
    return found
