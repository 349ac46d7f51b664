"""BPE encoding and decoding with a tokenizer file's vocabulary, by batched numpy merge rounds.

The distinct words of a batch become symbols in one flat array. A round forms the keys
left * size + right of all neighbouring symbols, finds them by binary search among the sorted keys
of the merge table, takes each word's lowest rank and merges every occurrence of that pair, left to
right, in all words at once; words without a known pair leave the array. Each merge yields a token
of its own, so a pair formed by a merge always ranks after that merge, and merging all occurrences in
one round gives the same tokens as merging them one by one.

Words of more than LONG bytes take rounds that touch only the places of the lowest rank: pairs lie in
buckets by rank, a round merges its bucket at once, and the pairs beside the merged ones are looked up in
the same way and put into later buckets. So the work grows with a word's length times its logarithm.

Defined results: null and empty texts give no tokens and decode to the empty string; doc_id may be
null or repeated, rows are handled one by one; further columns are dropped unless named in keep; a column
that is named like one of the results gives way to it; texts and words of any length are taken whole.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from .common import give_back, lean, small_batches

#: Words that a task keeps encoded; beyond it the memory is emptied and filled anew.
WORD_CACHE = 150_000
#: Bytes beyond which a word is merged by buckets, and characters beyond which a chunk is not remembered.
LONG = 256
#: Separators that str.split knows besides those of the pattern's white space.
_ODD_SPACES = re.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


@dataclass
class Bpe:
    """A tokenizer file, read: NFC, white space, lower case; a split pattern; byte symbols; merges with word ends."""

    tokens: list[str]
    special: dict[str, int]
    pattern: regex.Pattern
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    inner: np.ndarray
    final: np.ndarray
    source: str

    @classmethod
    def parse(cls, text: str) -> Bpe:
        spec = json.loads(text)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * len(tokens) + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        symbols = byte_symbols()
        return cls(
            tokens,
            special,
            regex.compile(split),
            keys[order],
            order.astype(np.int64),
            merged[order],
            np.array([vocab[s] for s in symbols], dtype=np.int64),
            np.array([vocab[s + end] for s in symbols], dtype=np.int64),
            text,
        )

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (their number where there is none) and the symbol it becomes."""
        key = left * len(self.tokens) + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys)), self.merged[at]

    def merge_long(self, words: list[bytes]) -> list[list[int]]:
        """merge() of long words: each round takes the bucket of the lowest rank."""
        none = len(self.keys)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        last = np.cumsum(lengths) - 1
        symbols = self.inner[data]
        symbols[last] = self.final[data[last]]
        # one place more than there are symbols stands for no neighbour
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data))
        after[last] = len(data)
        before[(last + 1)[:-1]] = len(data)
        before[0] = len(data)
        rank, alive = np.full(len(data), none), np.ones(len(data), dtype=bool)
        buckets: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look(places: np.ndarray) -> None:
            places = places[after[places] < len(data)]
            found, _ = self._ranks(symbols[places], symbols[after[places]])
            rank[places] = found
            places = places[found < none]
            found = found[found < none]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else []
            for start, end in zip(cuts, [*cuts[1:], len(found)]):
                r = int(found[start])
                if r not in buckets:
                    buckets[r] = []
                    heapq.heappush(heap, r)
                buckets[r].append(places[start:end])

        look(np.arange(len(data)))
        while heap:
            r = heapq.heappop(heap)
            where = np.unique(np.concatenate(buckets.pop(r)))
            where = where[alive[where] & (rank[where] == r)]
            if not len(where):
                continue
            # of pairs that overlap (aaa), every other one from the left
            new_run = np.append(True, after[where[:-1]] != where[1:])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - run_start) % 2 == 0]
            gone = after[where]
            symbols[where] = self._ranks(symbols[where], symbols[gone])[1]
            alive[gone], rank[gone], rank[where] = False, none, none
            after[where] = after[gone]
            before[after[where]] = where
            left = before[where]
            left = left[left < len(data)]
            rank[left] = none
            look(np.unique(np.concatenate([where, left])))
        kept = np.flatnonzero(alive)
        ends = np.searchsorted(kept, last, side="right")
        flat = symbols[kept].tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of non-empty words, in merge rounds over all of them."""
        if any(len(w) > LONG for w in words):
            long = [w for w in words if len(w) > LONG]
            short = [w for w in words if len(w) <= LONG]
            made = {**dict(zip(long, self.merge_long(long))), **(dict(zip(short, self.merge(short))) if short else {})}
            return [made[w] for w in words]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.final[data[last]]
        owner = np.repeat(np.arange(len(words)), lengths)
        out: list[list[int]] = [[] for _ in words]
        none, size = len(self.keys), len(self.tokens)
        while len(symbols):
            key = symbols[:-1] * size + symbols[1:]
            at = np.searchsorted(self.keys, key)
            at[at == none] = 0
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], none), none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            done = lowest == none
            if done.any():
                flat = symbols.tolist()
                for start, count in zip(starts[done].tolist(), counts[done].tolist()):
                    out[owner[start]] = flat[start : start + count]
                stay = np.repeat(~done, counts)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                at = np.append(at, 0)[stay]
                lowest, counts = lowest[~done], counts[~done]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            hit = rank == np.repeat(lowest, counts)
            where = np.flatnonzero(hit)
            # of pairs that overlap (aaa), every other one from the left
            new_run = np.append(True, np.diff(where) > 1)
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - run_start) % 2 == 0]
            symbols[where] = self.merged[at[where]]
            gone = np.ones(len(symbols), dtype=bool)
            gone[where + 1] = False
            symbols, owner = symbols[gone], owner[gone]
        return out

    def encode_chunks(self, chunks: list[str], split=None) -> list[bytes]:
        """Ids (little-endian, 32 bits) of lower-cased chunks without white space."""
        pieces = [[p.encode("utf-8", "surrogatepass") for p in (split or self.pattern.findall)(c)] for c in chunks]
        distinct = list(dict.fromkeys(p for ps in pieces for p in ps))
        if not distinct:
            return [b""] * len(chunks)
        ids = dict(zip(distinct, (np.array(x, dtype="<u4").tobytes() for x in self.merge(distinct))))
        return [b"".join([ids[p] for p in ps]) for ps in pieces]


def normalised(text: str) -> str:
    """NFC, then the lower case of each character by itself (no final sigma)."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class Encoder:
    """Encodes texts; remembers words from one batch to the next within a bound."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.memory = bpe, {}
        self.assigned: set[str] = set()
        self.special = re.compile("(" + "|".join(map(re.escape, bpe.special)) + ")") if bpe.special else None

    @functools.cached_property
    def odd(self) -> tuple:
        """For code points that only newer tables know: the file's own normaliser and split pattern, of the tokenizers library. Read when first needed."""
        steps = json.loads(self.bpe.source)
        # the normaliser does not need the vocabulary, which is most of the file's memory
        bare = tokenizers.Tokenizer.from_str(json.dumps(steps | {"model": steps["model"] | {"vocab": {}, "merges": []}, "added_tokens": []}))
        splitter = tokenizers.pre_tokenizers.Split(tokenizers.Regex(next(p["pattern"]["Regex"] for p in steps["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")), "removed", invert=True)
        return bare.normalizer.normalize_str, lambda chunk: [piece for piece, _ in splitter.pre_tokenize_str(chunk)]

    def known(self, text: str) -> bool:
        """Whether the interpreter's tables know all code points."""
        if text.isascii() or self.assigned.issuperset(text):
            return True
        self.assigned |= {c for c in set(text) if unicodedata.category(c) != "Cn"}
        return self.assigned.issuperset(text)

    def split(self, chunk: str) -> list[str]:
        return self.bpe.pattern.findall(chunk) if self.known(chunk) else self.odd[1](chunk)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        rows: list[list[str | bytes]] = []
        fresh: dict[str, None] = {}
        if len(self.memory) > WORD_CACHE:
            self.memory = {}
        memory = self.memory
        for text in texts:
            row: list = []
            for part in self.special.split(text or "") if self.special else [text or ""]:
                if part in self.bpe.special:
                    row.append(np.array([self.bpe.special[part]], dtype="<u4").tobytes())
                elif part:
                    low = normalised(part) if self.known(part) else self.odd[0](part)
                    chunks = [c for c in _SPACES.split(low) if c] if _ODD_SPACES.search(low) else low.split()
                    row.append(chunks)
                    fresh.update(dict.fromkeys(c for c in chunks if c not in memory))
            rows.append(row)
        if fresh:
            memory.update(zip(fresh, self.bpe.encode_chunks(list(fresh), self.split)))
        known = memory.__getitem__
        out = [b"".join([x if isinstance(x, bytes) else b"".join(map(known, x)) for x in row]) for row in rows]
        for chunk in fresh:
            if len(chunk) > LONG:
                del memory[chunk]
        return out


def decode(bpe: Bpe, ids: np.ndarray) -> str:
    """The file names no decoder: the tokens, special ones too, joined by spaces."""
    return " ".join(map(bpe.tokens.__getitem__, ids.tolist()))


@functools.lru_cache(1)
def _encoder(source: str) -> Encoder:
    """One for all tasks of a worker, with the words that it remembers."""
    return Encoder(Bpe.parse(source))


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


#: Bytes of text that are encoded at once.
SLICE_BYTES = 500_000


def _slices(texts: list[str | None]):
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """keep columns and ids (array of int) of each row's text. tokenizer: the file's place on the driver.

    With decoded, the ids are decoded again in the same pass, and decoded_sha256 is the digest of that text.
    """
    small_batches(docs.sparkSession)
    file = docs.sparkSession.sparkContext.broadcast(_read(tokenizer))
    keep = tuple(c for c in keep if c not in ("ids", "decoded_sha256"))
    source = docs.select(*[f"`{c}`" for c in keep], "text")
    schema = ", ".join(f"`{c}` {t}" for c, t in source.dtypes[:-1]) + ", ids array<int>" + (", decoded_sha256 string" if decoded else "")

    def run(batches):
        encoder = _encoder(file.value)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            coded = flat = column = made = None
            for lo, hi in _slices(texts):
                coded = encoder.encode(texts[lo:hi])
                offsets = np.zeros(len(coded) + 1, dtype=np.int32)
                np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
                flat = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"), pa.int32())
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                made = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))] + [column]
                if decoded:
                    made.append(pa.array([hashlib.sha256(decode(encoder.bpe, np.frombuffer(c, dtype="<u4")).encode("utf-8")).hexdigest() for c in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(made, [*keep, "ids", "decoded_sha256"][: len(made)])
            del texts, coded, flat, column, made
            give_back()

    return source.mapInArrow(lean(run), schema)


def decode_documents(coded: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """Adds decoded to rows with ids; with digests, gives n_tokens and the two SHA-256 sums in place of ids and text."""
    file = coded.sparkSession.sparkContext.broadcast(_read(tokenizer))
    keep = [c for c in coded.columns if c not in ("ids", "decoded", *(("n_tokens", "ids_sha256", "decoded_sha256") if digests else ()))]
    source = coded.select(*[f"`{c}`" for c in keep], "ids")
    head = ", ".join(f"`{c}` {t}" for c, t in source.dtypes[:-1])
    tail = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches):
        bpe = _encoder(file.value).bpe
        for batch in batches:
            ids = batch.column(len(keep))
            flat = ids.values.to_numpy(zero_copy_only=False)
            offsets = ids.offsets.to_numpy().tolist()
            parts = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
            heads = [batch.column(i) for i in range(len(keep))]
            if digests:
                found = [
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts], pa.string()),
                    pa.array([hashlib.sha256(decode(bpe, p).encode("utf-8")).hexdigest() for p in parts], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(heads + found, [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([*heads, ids, pa.array([decode(bpe, p) for p in parts], pa.string())], [*keep, "ids", "decoded"])

    return source.mapInArrow(lean(run), f"{head}, {tail}" if head else tail)
