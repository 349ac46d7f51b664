"""Fill-in-middle transformation: DuckDB SQL on Arrow batches inside Spark's tasks.

A text is cut into units (white space and the word after it) by regexp_extract_all; two cuts come from the
sha256 of the seed and doc_id, so a document has the same cuts in any run, order or partitioning. Prefix,
middle and suffix are put in order suffix-prefix-middle (spm) or prefix-suffix-middle (psm) between markers;
the other documents stay plain, among them all whose text holds a marker. So restore() gets the exact text
back from output and form: no marker can begin inside one piece and end in the next (Markers checks that).

Each batch goes to DuckDB in slices of SLICE bytes, so memory follows the longest text, not the batch.

Defined results: null text counts as empty, and empty texts are plain with 0 units; null doc_id is hashed as
the seed alone; repeated rows give equal rows; an empty table gives an empty result; further columns are
returned as they are by transform() where they are named in keep, else not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches

UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Bytes of texts that DuckDB holds as lists of units at once (one text at least).
SLICE = 4 << 20


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        every = (self.prefix, self.suffix, self.middle)
        for i, a in enumerate(every):
            for j, b in enumerate(every):
                if not a or (i != j and a in b) or any(a.endswith(b[:n]) for n in range(1, len(b))):
                    raise ValueError("a marker must not hold another one, nor end as one begins")


@dataclass(frozen=True)
class Rule:
    """seed: of the digests; rate: percent of documents that are rearranged; spm: percent of these with the suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80
    markers: Markers = Markers()


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def transform_sql(rule: Rule, keep: tuple[str, ...] = ()) -> str:
    """DuckDB SQL over the view docs_batch (doc_id, text, kept columns)."""
    p, s, m = map(_quoted, (rule.markers.prefix, rule.markers.suffix, rule.markers.middle))
    number = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    kept = "".join(f', "{c}"' for c in keep)
    return f"""
        WITH cut AS (SELECT *, regexp_extract_all(text, '{UNITS}') AS units, sha256('{rule.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM docs_batch),
        placed AS (SELECT *, CAST(len(units) AS BIGINT) AS n, {number(0)} % (len(units) + 1) AS a, {number(1)} % (len(units) + 1) AS b,
            CASE WHEN text = '' OR contains(text, {p}) OR contains(text, {s}) OR contains(text, {m}) OR {number(2)} % 100 >= {rule.rate} THEN 'plain'
                WHEN {number(3)} % 100 < {rule.spm} THEN 'spm' ELSE 'psm' END AS form FROM cut),
        parts AS (SELECT *, array_to_string(list_slice(units, 1, least(a, b)), '') AS prefix, array_to_string(list_slice(units, least(a, b) + 1, greatest(a, b)), '') AS middle,
            array_to_string(list_slice(units, greatest(a, b) + 1, n), '') AS suffix FROM placed)
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
            CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle ELSE {s} || suffix || {p} || prefix || {m} || middle END AS output{kept}
        FROM parts"""


def restore_sql(rule: Rule, select: str) -> str:
    """DuckDB SQL over the view docs_batch (doc_id, n, form, prefix_chars, middle_chars, output, kept columns); select may name text."""
    p, s, m = map(_quoted, (rule.markers.prefix, rule.markers.suffix, rule.markers.middle))
    return f"""
        WITH held AS (SELECT *, split_part(output, {m}, 1) AS ahead, split_part(output, {m}, 2) AS middle FROM docs_batch),
        parts AS (SELECT *, CASE form WHEN 'psm' THEN split_part(substr(ahead, {len(rule.markers.prefix) + 1}), {s}, 1) ELSE split_part(ahead, {p}, 2) END AS prefix,
            CASE form WHEN 'psm' THEN split_part(ahead, {s}, 2) ELSE split_part(substr(ahead, {len(rule.markers.suffix) + 1}), {p}, 1) END AS suffix FROM held)
        SELECT {select} FROM (SELECT *, CASE WHEN form = 'plain' THEN output ELSE prefix || middle || suffix END AS text FROM parts)"""


def slices(batch: pa.RecordBatch, column: int, most: int):
    """Parts of a batch with so many bytes of a text column at most (one row at least)."""
    lo, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > lo and held + (n or 0) > most:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n or 0
    if batch.num_rows > lo:
        yield batch.slice(lo)


def in_duckdb(df: DataFrame, sql: str, text: str, schema: str) -> DataFrame:
    """df through DuckDB SQL on its view docs_batch, slice by slice of the text column's bytes."""
    at = df.columns.index(text)

    def run(batches):
        # one thread a task, as Spark deals the work; nothing is written to a local disk
        db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        try:
            for batch in batches:
                for part in slices(batch, at, SLICE):
                    db.register("docs_batch", pa.Table.from_batches([part]))
                    yield from db.sql(sql).to_arrow_table().to_batches()
                    db.unregister("docs_batch")
        finally:
            db.close()

    small_batches(df.sparkSession)
    return df.mapInArrow(lean(run), schema)


FORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def transform(docs: DataFrame, rule: Rule = Rule(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output of every row, then the columns of keep."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *[F.col(f"`{c}`") for c in keep])
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in read.schema[2:])
    return in_duckdb(read, transform_sql(rule, keep), "text", FORMED + more)


def restore(formed: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, text): the exact texts, rebuilt from output and form alone."""
    return in_duckdb(formed.select("doc_id", "form", "output"), restore_sql(rule, "doc_id, text"), "output", "doc_id bigint, text string")


def digests(formed: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of transform() with the sha256 of output and of the text rebuilt from it in place of output."""
    select = "doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256"
    names = [c.split(" ")[0] for c in FORMED.split(", ")]
    return in_duckdb(formed.select(*names), restore_sql(rule, select), "output", FORMED.replace("output string", "output_sha256 string, restored_sha256 string"))
