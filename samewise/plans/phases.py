"""Phases with checkpoints: a phase is run again only where its settings, its inputs or the phase before have changed."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import sinks


def _text(spark: SparkSession, path: str) -> str | None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


class Phases:
    """Runs named phases in a shared folder; each one's tables are Parquet with a stamp written last.

    The stamp holds the phase's hash (settings, code, hash of the phase before) and the content sums of its
    tables, which are checked before a phase is taken over; an unfinished phase has no stamp and runs again.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: dict[str, DataFrame], settings: dict):
        self.spark, self.folder, self.settings = spark, folder.rstrip("/"), settings
        self.hash = self._digest({"inputs": {n: [sinks.content_sum(df), df.schema.json()] for n, df in sorted(inputs.items())}, "settings": settings})
        self.log: list[tuple[str, str]] = []

    @staticmethod
    def _digest(value) -> str:
        return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()

    def run(self, name: str, work: Callable[..., dict[str, DataFrame]], *args) -> dict[str, DataFrame]:
        """The phase's tables: read back where the stamp agrees, else from work(*args)."""
        key = self._digest([self.hash, name, inspect.getsource(work)])
        home = f"{self.folder}/{name}"
        stamp = json.loads(_text(self.spark, f"{home}/stamp") or "{}")
        self.hash = key
        if stamp.get("key") == key:
            tables = {t: self.spark.read.parquet(f"{home}/{t}") for t in stamp["sums"]}
            if all(sinks.content_sum(df) == stamp["sums"][t] for t, df in tables.items()):
                self.log.append((name, "reused"))
                return tables
        made = {}
        for t, df in work(*args).items():
            df.write.mode("overwrite").parquet(f"{home}/{t}")
            made[t] = self.spark.read.schema(df.schema).parquet(f"{home}/{t}")
        sums = {t: sinks.content_sum(df) for t, df in made.items()}
        self.spark.createDataFrame([(json.dumps({"key": key, "sums": sums}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{home}/stamp")
        self.log.append((name, "run"))
        return made
