"""Sources: declared contracts, format, encoding and delimiter detection, projection on read, consolidation."""

from __future__ import annotations

import codecs
import gzip
import zipfile
from collections import Counter
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Values that stand for null on read (fixed values).
NULLS = ("", "nan", "none", "null", "<na>")


@dataclass(frozen=True)
class ArchiveLimits:
    members: int = 100
    total_bytes: int = 10 << 30
    ratio: float = 200.0


@dataclass(frozen=True)
class SourceSpec:
    """A source: where it is, and which of its columns are which canonical ones."""

    name: str
    path: str
    columns: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)
    passthrough: tuple[str, ...] = ()
    format: str = "auto"
    encoding: str = "auto"
    delimiter: str = "auto"
    limits: ArchiveLimits = ArchiveLimits()
    sheet: str | int = 0

    def __post_init__(self):
        if "|" in self.name or not self.name:
            raise ValueError("a source's name is not empty and has no |")
        if not self.columns:
            raise ValueError("a source maps one column at least")
        if set(self.columns) & set(self.optional):
            raise ValueError("a column is either required or optional")


def detect_format(path: str) -> str:
    """csv, xlsx, parquet, zip or gzip, by magic bytes and then by the name."""
    with open(path, "rb") as f:
        head = f.read(4)
    if head == b"PAR1":
        return "parquet"
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    if head == b"PK\x03\x04":
        with zipfile.ZipFile(path) as z:
            return "xlsx" if "[Content_Types].xml" in z.namelist() else "zip"
    return "csv"


def check_archive(path: str, limits: ArchiveLimits) -> list[str]:
    """Names of the members; raises where the archive is too large, too dense, or leaves its folder."""
    with zipfile.ZipFile(path) as z:
        infos = [i for i in z.infolist() if not i.is_dir()]
    if len(infos) > limits.members or sum(i.file_size for i in infos) > limits.total_bytes:
        raise ValueError("the archive is beyond its limits")
    for i in infos:
        if i.filename.startswith("/") or ".." in Path(i.filename).parts:
            raise ValueError(f"{i.filename} leaves the archive's folder")
        if i.file_size > limits.ratio * max(1, i.compress_size):
            raise ValueError(f"{i.filename} is packed too densely")
    return [i.filename for i in infos]


def _sample(path: str, n: int = 1 << 16) -> bytes:
    with (gzip.open if detect_format(path) == "gzip" else open)(path, "rb") as f:
        return f.read(n)


def _decodes(path: str, encoding: str) -> bool:
    """Whether the whole file is strictly of the encoding; read in chunks."""
    decoder = codecs.getincrementaldecoder(encoding)("strict")
    try:
        with (gzip.open if detect_format(path) == "gzip" else open)(path, "rb") as f:
            while chunk := f.read(1 << 20):
                decoder.decode(chunk)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return False
    return True


def detect_encoding(path: str) -> str:
    """A byte order mark, else UTF-8, else CP1252, of the whole file; raises where none fits."""
    raw = _sample(path, 4)
    for mark, name in ((b"\xef\xbb\xbf", "UTF-8"), (b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE")):
        if raw.startswith(mark):
            if not _decodes(path, name):
                raise ValueError(f"the file has the mark of {name} and other bytes")
            return name
    for name in ("utf-8", "cp1252"):
        if _decodes(path, name):
            return "UTF-8" if name == "utf-8" else "windows-1252"
    raise ValueError("neither UTF-8 nor CP1252")


def detect_delimiter(path: str, encoding: str) -> str:
    """Of comma, tab, semicolon and bar the one that gives rows of one width: 2 or more, in 80 % of the sample."""
    lines = [x for x in _sample(path).decode(encoding, "replace").splitlines() if x][:200]
    scores = []
    for d in (",", "\t", ";", "|"):
        widths = [x.count(d) + 1 for x in lines]
        if widths and (common := Counter(widths).most_common(1)[0]) and common[0] >= 2:
            scores.append((common[1] / len(widths), common[0], d))
    best = max(scores, default=None)
    if not best or best[0] < 0.8:
        raise ValueError("no delimiter gives even rows")
    return best[2]


def _canonical(header: str) -> str:
    return "".join(c for c in header.strip().lower() if c.isalnum())


def column_plan(headers: list[str], spec: SourceSpec) -> dict[str, str | None]:
    """Canonical name -> header (None: an optional column that is missing); raises for required ones."""
    known = {_canonical(h): h for h in headers}
    plan: dict[str, str | None] = {}
    for canonical, source in spec.columns.items():
        if _canonical(source) not in known:
            raise ValueError(f"{spec.name} lacks the column {source}")
        plan[canonical] = known[_canonical(source)]
    plan |= {c: known.get(_canonical(s)) for c, s in spec.optional.items()}
    return plan | {c: known.get(_canonical(c)) for c in spec.passthrough}


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The mapped columns as text, null sentinels as null; only mapped columns are read."""
    kind = spec.format if spec.format != "auto" else detect_format(spec.path)
    if kind == "parquet":
        raw = spark.read.parquet(spec.path)
    elif kind in ("csv", "gzip"):
        encoding = spec.encoding if spec.encoding != "auto" else detect_encoding(spec.path)
        sep = spec.delimiter if spec.delimiter != "auto" else detect_delimiter(spec.path, encoding)
        western = encoding == "windows-1252"  # not among Spark's charsets: read as Latin-1, whose C1 codes are then those of CP1252
        raw = spark.read.option("header", True).option("sep", sep).option("encoding", "ISO-8859-1" if western else encoding).option("multiLine", True).option("escape", '"').csv(spec.path)
        if western:
            codes = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
            raw = raw.select(*[F.translate(F.col(f"`{h}`"), "".join(codes), "".join(codes.values())).alias(h.translate(str.maketrans(codes))) for h in raw.columns])
    elif kind == "zip":
        inner = check_archive(spec.path, spec.limits)
        if len(inner) != 1:
            raise ValueError("an archive holds one table")
        import tempfile

        with zipfile.ZipFile(spec.path) as z:  # unpacked beside the driver; for a cluster unpack into a shared folder first
            path = z.extract(inner[0], tempfile.mkdtemp(prefix="samewise-"))
        return read_source(spark, SourceSpec(spec.name, path, spec.columns, spec.optional, spec.passthrough, "auto", spec.encoding, spec.delimiter, spec.limits))
    elif kind == "xlsx":
        from .workbooks import read_workbook

        raw = read_workbook(spark, spec.path, spec.sheet).drop("FILA_EXCEL")
    else:
        raise ValueError(f"no reader for the format {kind}")
    plan = column_plan(raw.columns, spec)
    text = lambda h: F.when(F.lower(F.trim(F.col(f"`{h}`").cast("string"))).isin(*NULLS), None).otherwise(F.col(f"`{h}`").cast("string"))
    return raw.select(*[(text(h) if h else F.lit(None).cast("string")).alias(c) for c, h in plan.items()])


def consolidate(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources by name, with SRC and a number of the row (ORIGINAL_INDEX) that follows from its content, whatever the partitions.

    Equal rows of a source are numbered among themselves, and their number is part of what is hashed.
    """
    whole = None
    for name, df in sources.items():
        if "|" in name:
            raise ValueError("a source's name has no |")
        content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        number = F.row_number().over(Window.partitionBy("__content").orderBy(F.lit(1)))
        part = df.withColumn("__content", content).withColumn("__number", number)
        index = F.shiftrightunsigned(F.xxhash64("__content", "__number"), 1)
        part = part.withColumns({"SRC": F.lit(name), "ORIGINAL_INDEX": index}).drop("__content", "__number")
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def load_report(df: DataFrame) -> DataFrame:
    """One row per column: rows and nulls."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot(["rows"], df.columns, "column", "nulls")


def latest_decisions(files: list[DataFrame], keys: list[str]) -> DataFrame:
    """Decision rows where a later file wins over an earlier one."""


    whole = None
    for i, df in enumerate(files):
        part = df.withColumn("__order", F.lit(i))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__order"), *[c for c in whole.columns if c != "__order"]))
    return whole.withColumn("__rank", rank).filter("__rank = 1").drop("__rank", "__order")


