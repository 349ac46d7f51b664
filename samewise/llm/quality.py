"""Quality classifier: voting of the nearest labelled documents in a latent-semantic space.

Terms of a document are its words (lower-cased, marks around them taken off, digits made equal, hashed
to WORDS columns) and its texture: bigrams of byte classes (letters, digits, white space, each ASCII mark
by itself, bytes beyond ASCII) and the number of words that repeat the word before. Square roots of the
terms' shares, weighted by inverse document frequency and centred, are projected on the leading
singular vectors of a bounded sample of labelled documents (SAMPLE_PER_CLASS rows of each class, by
hash of doc_id). The sample's vectors and labels are broadcast (their number is bounded by that
parameter); every document's cosines with all of them are computed exactly, in blocks, and the
NEIGHBOURS closest vote with the powers of their similarity.

Vectors of documents stand on a grid of 1 / GRID, on which sums of products have no rounding: equal texts
get equal scores in whatever block they stand. Of equal cosines the neighbour with the smaller doc_id comes first.

Defined results: null text counts as empty and is scored like any other; where no neighbour is
similar, or no labelled row exists, the score is the balanced prior 0.5; null labels are not
learned from, and of rows with the same doc_id only the least text is; rows are scored one by one, so
repeated rows and null doc_ids keep their rows; further columns are dropped unless named in keep.
"""

from __future__ import annotations

import re
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, small_batches

SAMPLE_PER_CLASS, DIMENSIONS, NEIGHBOURS, POWER, BLOCK, WORDS, GRID = 2000, 48, 15, 8, 256, 2048, 2048
#: Words whose columns a task keeps.
WORD_CACHE = 200_000


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 small letters, 1 capitals, 2 digits, 3 space, 4 line feed, 5 other control, 6 and 7 beyond ASCII, then marks."""
    found = np.full(256, 5, dtype=np.int64)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        found[b] = 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c == " " else 4 if c == "\n" else 6 if b >= 0xC0 else 7 if b >= 0x80 else found[b]
    found[marks] = 8 + np.arange(len(marks))
    return found


CLASSES = _byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
TEXTURE = N_CLASSES * N_CLASSES
TERMS = TEXTURE + 1 + WORDS


class _Columns(dict):
    """The column of each lower-cased word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_CACHE:
            self.clear()
        self[word] = found = TEXTURE + 1 + zlib.crc32(re.sub(rb"[0-9]", b"0", word.strip(b".,;:!?\"'()[]"))) % WORDS
        return found


_COLUMNS = _Columns()


def terms(text: str | None) -> np.ndarray:
    """Square roots of the terms' shares."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(TERMS, dtype=np.float32)
    if len(data) > 1:
        kinds = CLASSES[np.frombuffer(data, dtype=np.uint8)]
        out[:TEXTURE] = np.sqrt(np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=TEXTURE) / (len(data) - 1))
    words = data.split()
    if len(words) > 1:
        out[TEXTURE] = np.sqrt(sum(map(eq, words, words[1:])) / (len(words) - 1))
    if words:
        columns = np.fromiter(map(_COLUMNS.__getitem__, data.lower().split()), dtype=np.int64, count=len(words))
        out[TEXTURE + 1 :] = np.sqrt(np.bincount(columns - TEXTURE - 1, minlength=WORDS) / len(words))
    return out


class Voter:
    """Fitted on terms x (rows) and labels y of 0 and 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
        self.mean = x.mean(axis=0, dtype=np.float64) * self.idf
        self.basis = self._singular(x)
        self.shift = (self.mean @ self.basis.astype(np.float64)).astype(np.float32)
        self.vectors = self.project(x)
        self.labels = y.astype(np.float32)
        # both classes weigh the same, whatever their shares in the sample
        share = max(1e-9, self.labels.mean())
        self.weights = np.where(self.labels > 0, 0.5 / share, 0.5 / max(1e-9, 1 - share)).astype(np.float32)

    def _singular(self, x: np.ndarray, rounds: int = 4) -> np.ndarray:
        """The leading right singular vectors, by subspace iteration over blocks of rows."""
        size = min(DIMENSIONS, x.shape[1])
        q = np.linalg.qr(np.random.default_rng(0).standard_normal((x.shape[1], min(size + 16, x.shape[1]))))[0]
        for _ in range(rounds):
            product = np.zeros_like(q)
            for lo in range(0, len(x), BLOCK):
                part = x[lo : lo + BLOCK] * self.idf - self.mean
                product += part.T @ (part @ q)
            q, weights, _ = np.linalg.svd(product, full_matrices=False)
        # directions in which the sample does not vary are no part of the space
        return np.ascontiguousarray(q[:, :size][:, weights[:size] > 1e-9 * max(weights[0], 1e-9)].astype(np.float32))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors on the grid. Each row is summed by itself, so that it does not depend on its block."""
        out = np.empty((len(x), self.basis.shape[1]), dtype=np.float32)
        for i, row in enumerate(x):
            held = np.flatnonzero(row)
            out[i] = ((row[held] * self.idf[held])[:, None] * self.basis[held]).sum(axis=0) - self.shift
        out /= np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)
        return np.rint(out * GRID) / np.float32(GRID)

    def score(self, x: np.ndarray) -> np.ndarray:
        products = (self.project(x) * GRID) @ (self.vectors * GRID).T  # whole numbers below 2**24: exact
        count = products.shape[1]
        k = min(NEIGHBOURS, count)
        order = products.astype(np.float64) * count - np.arange(count)  # no two are equal
        near = np.argpartition(-order, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(order, near, axis=1), axis=1), axis=1)
        power = np.maximum(np.take_along_axis(products, near, axis=1) / GRID**2, 0).astype(np.float64) ** POWER * self.weights[near]
        total = power.sum(axis=1)
        return np.where(total > 0, (power * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), 0.5)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Voter | None:
    """Fits on a sample bounded by SAMPLE_PER_CLASS rows of each class, by smallest hash of doc_id; a doc_id labelled both ways teaches nothing.

    A document of the sample has itself among its neighbours, so its score leans to its own label.
    """
    each = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    usable = each.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").drop("other")
    parts = [usable.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionAll(parts[1]))

    def run(batches):
        for batch in batches:
            rows = [terms(t) for t in batch.column(2).to_pylist()]
            held = [np.flatnonzero(r) for r in rows]
            packed = [pa.array([h.astype("<u2").tobytes() for h in held], pa.binary()), pa.array([r[h].tobytes() for r, h in zip(rows, held)], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *packed], ["doc_id", "y", "at", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = texts.mapInArrow(lean(run), "doc_id bigint, y int, at binary, x binary").toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    x = np.zeros((rows.num_rows, TERMS), dtype=np.float32)
    for i, (at, values) in enumerate(zip(rows["at"], rows["x"])):
        x[i, np.frombuffer(at.as_buffer(), dtype="<u2")] = np.frombuffer(values.as_buffer(), dtype=np.float32)
    return Voter(x, rows["y"].to_numpy())


def score_documents(docs: DataFrame, voter: Voter | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and score (0 to 1, higher: label 1 is likelier) of every row. The last column is named __score, whatever keep holds."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(voter)
    # names of their own inside, so that those of docs may be any
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").alias("text"))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                texts = part.column(1).to_pylist()
                scores = model.value.score(np.stack([terms(t) for t in texts])) if model.value is not None else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["kept", "score"])

    return source.mapInArrow(lean(run), T.StructType([source.schema["kept"], T.StructField("score", T.DoubleType())])).select("kept.*", F.col("score").alias("__score"))


def keep_above(docs: DataFrame, voter: Voter | None, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is least or more, with all their columns, whatever their names."""
    scored = score_documents(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), voter, keep=("row",))
    return scored.filter(F.col("__score") >= least).select("row.*")
