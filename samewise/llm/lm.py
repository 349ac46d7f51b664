"""Language-model scoring by a weighted backoff automaton.

The model. With c the counts of n-grams in the training texts, p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)) and, for a
history h that loses its oldest word to become h', p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m): Dirichlet
smoothing of strength m, a distribution for every history. As an automaton: every history seen in training is a
state, every seen n-gram hw an arc of state h, and a word that a state has no arc for is read at the state of h',
reached by the failure arc of weight log10(m / (c(h) + m)). Texts begin in the state of a begin mark and end with
an end token. Scoring is one traversal from left to right that carries the state and adds up log10 weights.

On a cluster. The automaton grows with the corpus, so nobody holds it. Texts are dealt over blocks of some
megabytes by hash. A block sends its distinct n-grams, with its own training counts, to buckets (ranges of
the n-grams' hash); a bucket sums them and answers with totals in the block's own order; the block builds the
part of the automaton that its texts can reach and runs them through it, all its strands of STRAND words side by
side (a strand starts with the words before it, which lead to its state). Blocks and buckets grow in number, not in
size. Texts longer than PIECE are cut at white space into pieces that carry the words before them. No
n-gram is left out, and what is gathered grows with the corpus.

Words and n-grams stand as 64-bit hashes: among 10^9 distinct ones some 3 in 100 runs hold one pair that shares counts.

Defined results: null and empty texts are the end token alone; null doc_id is hashed as an empty text and so held
out; without training texts every word is unknown (base: log10 1 each); repeated rows are learned from each and
give equal rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches

#: Words of a history plus one; strength of the smoothing; what the base adds to counts.
ORDER, STRENGTH, ADDED = 2, 20.0, 0.1
#: Bytes of texts in a block, of one piece of a text, of texts that are hashed at once; words of a strand; n-grams of a bucket.
BLOCK, PIECE, AT_ONCE, STRAND, BUCKET = 6 << 20, 256 << 10, 1 << 20, 64, 1 << 20
#: Distinct words that a task of the vocabulary holds before it passes them on.
HELD = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += 32
BEGIN, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC2B2AE3D27D4EB4F)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=column.offset + len(column) + 1)[column.offset :]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8), at


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words after lower-casing A-Z, and the number of each text's words."""
    found, counts, lo = [np.zeros(0, dtype=np.uint64)], np.zeros(len(at) - 1, dtype=np.int64), 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + AT_ONCE, side="right")) - 1)
        part, cuts = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        inside = ~_SPACE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = cuts[:-1][cuts[:-1] < len(part)]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        if len(starts):
            counts[lo:hi] = np.diff(np.searchsorted(starts, cuts))
            body = part[starts[0] :]
            place = np.arange(len(body)) - (starts - starts[0])[np.cumsum(first[starts[0] :]) - 1]
            inner = inside[starts[0] :]
            weights = np.random.PCG64(12).random_raw(int(place[inner].max()) + 1)  # the first ones are the same for any length
            share = np.where(inner, _LOWER[body] * weights[np.where(inner, place, 0)], np.uint64(0))
            found.append(_mixed(np.add.reduceat(share, starts - starts[0])))
        lo = hi
    return np.concatenate(found), counts


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, the like bytes of all together, which compresses well for sorted or small ones."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Block:
    """The tokens of a block's pieces in a row, each piece led by the words before it, and the n-grams that end at them."""

    def __init__(self, table: pa.Table, order: int):
        self.order = order
        words, counts = words_of(*raw(table.column("text")))
        lead, before = words_of(*raw(table.column("lead")))
        opens = table.column("piece").to_numpy() == 0
        closes = table.column("last").to_numpy(zero_copy_only=False)
        self.lead = np.where(opens, 1, before)
        self.tokens = counts + closes
        self.lengths = self.lead + self.tokens
        self.starts = np.cumsum(self.lengths) - self.lengths
        w = np.empty(int(self.lengths.sum()), dtype=np.uint64)
        w[self.starts[opens]] = BEGIN
        w[np.repeat(self.starts, before) + _runs(before)] = lead
        w[np.repeat(self.starts + self.lead, counts) + _runs(counts)] = words
        w[(self.starts + self.lengths - 1)[closes]] = END
        self.word, self.place = w, _runs(self.lengths)
        #: tokens of the texts, not the words that lead a piece
        self.counted = self.place >= np.repeat(self.lead, self.lengths)
        #: the n-gram that ends at each place, of 1 to order words; and the places that have so many words
        self.gram, self.ends = [w], [np.arange(len(w))]
        for k in range(1, order):
            at = np.flatnonzero(self.place >= k)
            gram = np.zeros(len(w), dtype=np.uint64)
            gram[at] = _mixed(self.gram[-1][at - 1] * _A + w[at])
            self.gram.append(gram)
            self.ends.append(at)

    def own(self, held_out: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each order the distinct n-grams, sorted, and how often training texts hold them."""
        learned = ~np.repeat(held_out, self.lengths) & (self.counted | (self.word == BEGIN))
        found = []
        for gram, at in zip(self.gram, self.ends):
            keys = np.sort(gram[at])
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else at
            keys, counts = keys[cuts], np.diff(np.append(cuts, len(keys)))
            others = np.sort(gram[at[~learned[at]]])
            counts -= np.bincount(np.searchsorted(keys, others), minlength=len(keys))
            found.append((keys, counts.astype(np.uint32)))
        return found


class Automaton:
    """The states and arcs that a block's texts can reach, from the totals of its n-grams."""

    def __init__(self, block: Block, totals: list[np.ndarray], n: int, v: int, strength: float = STRENGTH):
        floor = n + ADDED * (v + 1)
        self.unknown = float(np.log10(ADDED / floor))
        ordered = [np.argsort(gram[at]) for gram, at in zip(block.gram, block.ends)]
        first, index = [], []
        for k, (gram, at, order) in enumerate(zip(block.gram, block.ends, ordered)):
            keys = gram[at[order]]
            fresh = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, dtype=bool)
            first.append(at[order[fresh]])
            if k < max(1, block.order - 1):  # the place of each n-gram among the distinct ones of its order
                index.append(np.zeros(len(gram), dtype=np.int64))
                index[k][at[order]] = np.cumsum(fresh) - 1
        self.index, self.word = index[0], index[0].astype(np.uint64)
        bases = np.cumsum([1, *(len(f) for f in first[:-1])])
        states = int(bases[-1])
        self.back, self.fail = np.zeros(states), np.zeros(states, dtype=np.int64)
        codes, weights, targets = [], [], []
        for k, (at, c) in enumerate(zip(first, totals)):
            if k == 0:
                p, state, lower = (c + ADDED) / floor, np.zeros(len(c), dtype=np.int64), np.zeros(len(c), dtype=np.int64)
            else:
                above, below = index[k - 1][at - 1], index[k - 1][at]
                p = (c + strength * p[below]) / (totals[k - 1][above] + strength)
                state, lower = bases[k - 1] + above, bases[k - 1] + below
            if k < block.order - 1:
                target = bases[k] + np.arange(len(c))
                self.back[target], self.fail[target] = np.log10(strength / (c + strength)), lower
            else:
                target = lower
            seen = c > 0
            codes.append(state[seen].astype(np.uint64) << np.uint64(32) | self.word[at[seen]])
            weights.append(np.log10(p[seen]))
            targets.append(target[seen])
        codes, weights, targets = map(np.concatenate, (codes, weights, targets))
        order = np.argsort(codes)
        self.codes, self.weights, self.targets = codes[order], weights[order], targets[order]

    def run(self, starts: np.ndarray, warm: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of the tokens from starts + warm on, side by side; the warm ones before only lead to the state."""
        order = np.argsort(-lengths, kind="stable")
        starts, warm, lengths = starts[order], warm[order], lengths[order]
        state, score = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts))
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step))
            word, counts = self.word[starts[:active] + step], warm[:active] <= step
            left = np.arange(active)
            while len(left):
                code = state[left].astype(np.uint64) << np.uint64(32) | word[left]
                at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
                hit = self.codes[at] == code if len(self.codes) else np.zeros(len(left), dtype=bool)
                taken, arc = left[hit], at[hit]
                score[taken] += self.weights[arc] * counts[taken]
                state[taken] = self.targets[arc]
                left = left[~hit]
                root = left[state[left] == 0]
                score[root] += self.unknown * counts[root]
                left = left[state[left] != 0]
                score[left] += self.back[state[left]] * counts[left]
                state[left] = self.fail[state[left]]
        found = np.empty(len(score))
        found[order] = score
        return found


@dataclass(frozen=True)
class Model:
    """What a scoring run shares: training tokens and distinct ones, and how the work is dealt."""

    n: int
    v: int
    blocks: int
    bits: int
    order: int
    strength: float


def _ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that sorted keys reach: the leading bits of a key name its bucket."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    yield from zip(bucket[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(keys)])


def vocabulary(docs: DataFrame, bits: int) -> tuple[int, int]:
    """(tokens, distinct ones) of the training texts, the end token among both."""
    names = ["bucket", "tokens", "keys"]

    def pack(held: list[np.ndarray], tokens: int):
        keys = np.unique(np.concatenate(held))
        rows = [(b, planes(keys[lo:hi])) for b, lo, hi in _ranges(keys, bits)]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([tokens] + [0] * (len(rows) - 1), pa.int64()), pa.array([k for _, k in rows], pa.binary())], names)

    def words(batches):
        held, tokens, many = [], 0, 0
        for batch in batches:
            found, _ = words_of(*raw(batch.column(0)))
            tokens += len(found) + batch.num_rows
            held.append(np.unique(np.append(found, END)))
            many += len(held[-1])
            if many > HELD:
                held = [np.unique(np.concatenate(held))]
                many = len(held[0])
                if many > HELD // 2:
                    yield pack(held, tokens)
                    held, tokens, many = [], 0, 0
        if held:
            yield pack(held, tokens)

    def distinct(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([from_planes(k, np.uint64) for k in table.column("keys").to_pylist()]))
        return pa.table({"n": pa.array([int(np.sum(table.column("tokens").to_numpy()))], pa.int64()), "v": pa.array([len(keys)], pa.int64())})

    sent = docs.filter(~held_out(F.col("doc_id").cast("long"))).select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lean(words), "bucket bigint, tokens bigint, keys binary")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 4)
    n, v = sent.repartition(parts, "bucket").groupBy("bucket").applyInArrow(distinct, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first()
    return n or 0, v or 0


def fit(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> Model:
    """Counts words over all training texts and sizes blocks and buckets by the bytes of all texts."""
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a token has some six bytes; each order has about one n-gram a token
    bits = max(0, int(np.ceil(np.log2(max(1.0, size / 6 * order / BUCKET)))))
    n, v = vocabulary(docs, bits)
    return Model(n, v, max(1, -(-size // BLOCK)), bits, order, strength)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def pieces(docs: DataFrame, model: Model) -> DataFrame:
    """block, doc_id, key, held_out, piece (from 0), last, lead (the words before; of the first piece empty), text of every piece of every row."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), held_out(doc_id).alias("held_out"), F.lit(0).alias("piece"), F.lit(True).alias("last"), F.lit("").alias("lead"), text.alias("text"))
    back = model.order - 1

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                doc, key, held = (batch.column(i).slice(row, 1) for i in range(3))
                data, lo, number = batch.column(6).slice(row, 1).cast(pa.binary())[0].as_py(), 0, 0
                lead = b""
                while True:
                    gap = _GAP.search(data, lo + PIECE)
                    hi = gap.start() if gap else len(data)
                    part = data[lo:hi]
                    flat = [pa.array([number], pa.int32()), pa.array([hi == len(data)]), pa.array([lead]).cast(pa.string()), pa.array([part]).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([doc, key, held, *flat], batch.schema.names)
                    if hi == len(data):
                        break
                    lead = b" ".join((lead.split(b" ") if lead else []) + [m[0] for m in _WORD.finditer(part)][-back:]) if back else b""
                    lead = b" ".join(lead.split(b" ")[-back:]) if back else b""
                    lo, number = hi, number + 1

    long = F.octet_length("text") > 2 * PIECE
    every = rows.filter(~long).unionByName(rows.filter(long).mapInArrow(lean(cut), rows.schema))
    return every.select(F.pmod(F.xxhash64("key", "piece"), F.lit(model.blocks)).cast("int").alias("block"), *rows.columns)


def requests(table: pa.Table, model: Model) -> pa.Table:
    """A block's distinct n-grams and its own training counts, by order and bucket."""
    rows = []
    for k, (keys, own) in enumerate(Block(table, model.order).own(table.column("held_out").to_numpy(zero_copy_only=False))):
        rows += [(b, k, planes(keys[lo:hi]), planes(own[lo:hi])) for b, lo, hi in _ranges(keys, model.bits)]
    number = table.column("block")[0].as_py()
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    bucket, order, keys, own = (pa.array(c, t) for c, t in zip(zip(*rows), kinds))
    return pa.table({"bucket": bucket, "block": pa.array([number] * len(rows), pa.int32()), "k": order, "keys": keys, "own": own})


def answers(table: pa.Table) -> pa.Table:
    """The totals of a bucket's n-grams for each block, in the block's order."""
    blocks, orders, buckets = (table.column(c) for c in ("block", "k", "bucket"))
    keys, own = table.column("keys").to_pylist(), table.column("own").to_pylist()
    kinds, totals = orders.to_numpy(), [b""] * len(keys)
    for k in np.unique(kinds):
        rows = np.flatnonzero(kinds == k).tolist()
        each = [from_planes(keys[i], np.uint64) for i in rows]
        _, inverse = np.unique(np.concatenate(each), return_inverse=True)
        summed = np.bincount(inverse, weights=np.concatenate([from_planes(own[i], np.uint32) for i in rows]))[inverse].astype(np.uint64)
        for i, part in zip(rows, np.split(summed, np.cumsum([len(e) for e in each])[:-1])):
            totals[i] = planes(part)
    return pa.table({"block": blocks, "k": orders, "bucket": buckets, "totals": pa.array(totals, pa.binary())})


def scored(table: pa.Table, told: pa.Table, model: Model) -> pa.Table:
    """n_tokens, n_known, base_score and score of each piece of a block."""
    block = Block(table, model.order)
    found = told.sort_by([("k", "ascending"), ("bucket", "ascending")])
    kinds, data = found.column("k").to_numpy(), found.column("totals").to_pylist()
    totals = [np.concatenate([np.zeros(0, dtype=np.uint64), *(from_planes(data[i], np.uint64) for i in np.flatnonzero(kinds == k))]).astype(np.float64) for k in range(model.order)]
    automaton = Automaton(block, totals, model.n, model.v, model.strength)
    # strands of a piece's tokens, each led by order - 1 words where there are so many
    count = -(-block.tokens // STRAND)
    owner, number = np.repeat(np.arange(len(count)), count), _runs(count)
    begin = block.lead[owner] + number * STRAND
    warm = np.minimum(begin, model.order - 1)
    length = np.minimum(STRAND, block.tokens[owner] - number * STRAND) + warm
    logs = automaton.run(block.starts[owner] + begin - warm, warm, length)
    c = totals[0][automaton.index[block.counted]]
    piece = np.repeat(np.arange(len(count)), block.lengths)[block.counted]
    per = lambda at, values: np.bincount(at, weights=values, minlength=len(count))
    base = np.log10((c + ADDED) / (model.n + ADDED * (model.v + 1)))
    return table.select(["doc_id", "key", "held_out", "piece"]).append_column("n_tokens", pa.array(block.tokens, pa.int64())).append_column("n_known", pa.array(per(piece, c > 0).astype(np.int64))).append_column("base_score", pa.array(per(piece, base))).append_column("score", pa.array(per(owner, logs)))


PIECE_SCORES = "doc_id bigint, key bigint, held_out boolean, piece int, n_tokens bigint, n_known bigint, base_score double, score double"


def score_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    The texts are dealt over the blocks once; both the n-grams and the scores come from that exchange.
    """
    model = model or fit(docs)
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), model.blocks)
    dealt = pieces(docs, model).repartition(partitions, "block")
    asked = dealt.groupBy("block").applyInArrow(lambda t: requests(t, model), "bucket bigint, block int, k int, keys binary, own binary")
    told = asked.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(answers, "block int, k int, bucket bigint, totals binary")
    each = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda left, right: scored(left, right, model), PIECE_SCORES)
    # rows alike have alike pieces: the sums of all are those of one times their number
    rows = F.count(F.when(F.col("piece") == 0, 1))
    sums = each.groupBy("doc_id", "key", "held_out").agg(rows.alias("rows"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        "doc_id",
        "held_out",
        *[F.expr(f"{c} div rows").alias(c) for c in ("n_tokens", "n_known")],
        F.lit(model.n).cast("long").alias("train_tokens"),
        *[(F.col(c) / F.col("rows")).alias(c) for c in ("base_score", "score")],
    )
