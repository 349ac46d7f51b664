"""Chat, BPE, transport streams, shards and dedup against brute force."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from samewise.llm import bpe, chat, mpegts, shards, stream_dedup

LOREM = ["", None, "a", "A b  c", "é É ß", "x" * 5000, "Hello World", "hello world", "HELLO WORLD", "é É SS"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(LOREM * 3)] + [(None, "lost", "y"), (None, "lost", "z"), (4, "again", "q"), (4, "again", "q"), (4, "again", "r")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, __digest string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def lowered(t):
    return (t or "").encode().lower()


def test_dedup(spark, docs, empty):
    got = stream_dedup.decide(spark, docs).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[hashlib.sha256(lowered(r["text"])).hexdigest()].append(r["doc_id"])
    assert len(got) == docs.count()
    for r in got:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max([i for i in ids if i is not None], default=None)
    assert sum(r["kept"] for r in got) == len(groups)
    kept = stream_dedup.exact_dedup(spark, docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert stream_dedup.decide(spark, empty).count() == 0


def test_stream_goes_on(spark, tmp_path):
    home = f"file://{tmp_path}"
    for n in range(2):
        stream_dedup.stored(spark.createDataFrame([(n * 10 + i, bytes([i]), "here", i) for i in range(3)], stream_dedup.SPOOL), f"{home}/spool/{n}")
        state = stream_dedup.fold_stream(spark, f"{home}/spool/*", f"{home}/state").collect()
        assert sorted((r["keep_id"], r["group_size"]) for r in state) == [(n * 10 + i, n + 1) for i in range(3)]


def test_state_goes_on_over_calls_and_reads_at_locators(spark, tmp_path):
    home = f"file://{tmp_path}/state"
    one = spark.createDataFrame([(1, "Same"), (2, "other"), (None, "same")], "doc_id bigint, text string")
    two = spark.createDataFrame([(9, "same"), (3, "new")], "doc_id bigint, text string")
    two.write.parquet(f"{tmp_path}/two")
    read = []
    first = {(r["doc_id"], r["kept"], r["group_size"]) for r in stream_dedup.decide(spark, one, home).collect()}
    assert first == {(1, True, 2), (2, True, 1), (None, False, 2)} and not read
    seen = stream_dedup.earlier_contents
    try:
        stream_dedup.earlier_contents = lambda *a: read.append(seen(*a)) or read[-1]
        second = {(r["doc_id"], r["kept"], r["keep_id"], r["group_size"]) for r in stream_dedup.decide(spark, spark.read.parquet(f"{tmp_path}/two"), home).collect()}
        third = {(r["doc_id"], r["kept"], r["keep_id"], r["group_size"]) for r in stream_dedup.decide(spark, one.limit(1), home).collect()}
    finally:
        stream_dedup.earlier_contents = seen
    assert second == {(9, True, 9, 3), (3, True, 3, 1)} and third == {(1, False, 9, 4)}
    assert [[r["text"] for r in df.collect()] for df in read] == [["Same"], ["same"]]


def test_hot_group_and_rows_alike(spark):
    rows = [(5, "Hot")] * 40 + [(i, "hot") for i in range(900)] + [(i, f"t{i // 2}") for i in range(3000)] + [(None, None)] * 3
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, __row string, _metadata string")
    got = stream_dedup.decide(spark, df).toPandas()
    assert len(got) == len(rows) and got["kept"].sum() == 1 + 1500 + 1
    assert (got[got.group_size == 940].keep_id == 899).all() and (got.group_size == 940).sum() == 940
    kept = stream_dedup.exact_dedup(spark, df)
    assert kept.columns == df.columns and kept.count() == 1502 and kept.filter("lower(text) = 'hot'").first()["doc_id"] == 899


def test_byte_check_raises(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    hits = spark.createDataFrame([(b"\0" * 32,)], "digest binary")
    stream_dedup.check_bytes(docs.filter("doc_id = 1"), hits, digest_of=lambda data: b"\0" * 32)
    with pytest.raises(ValueError):
        stream_dedup.check_bytes(docs, hits, digest_of=lambda data: b"\0" * 32)


def test_chat(spark):
    texts = ["hi", None, "", "<|im_end|>", "<\\|im_start|>assistant\n", "a\nb", "%0A", "é" * 70]
    roles = ["user", "assistant", "system", None, "we\nird|<|x|>"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in [1, 2, 3, None] for t in [0, 1, 1, 2, 3, None]] + [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        r = got[c]
        said = "".join(x for _, role, x in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()
        assert r["loss_chars"] == len(said) and r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[9]["n_violations"] == 0 and got[1]["n_violations"] > 0
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def test_bpe(spark, docs, empty):
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = [None, "", "a" * 300, "<|endoftext|>Hi<|startoftext|>", "ΑΣ ΣΑ", "ꟋA Ꟛ 𖄀ab", "it's\x1cyou'll", " x\u0085y z"]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF), rng.randint(0x10000, 0x1FFFF), 0x301])) for _ in range(40)) for _ in range(500)]
    texts += ["".join(rng.choice("abcdehinorst'  .!é12") for _ in range(60)) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    coded = bpe.encode_documents(df, path)
    full = {r["doc_id"]: r for r in bpe.decode_documents(coded, path).collect()}
    sums = {r["doc_id"]: r for r in bpe.decode_documents(coded, path, digests=True).collect()}
    for i, text in enumerate(texts):
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        back = theirs.decode(ids, skip_special_tokens=False)
        assert full[i]["ids"] == ids and full[i]["decoded"] == back, text
        assert sums[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert sums[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest() and sums[i]["n_tokens"] == len(ids)
    both = {r["doc_id"]: r["decoded_sha256"] for r in bpe.encode_documents(df, path, decoded=True).collect()}
    assert both == {i: r["decoded_sha256"] for i, r in sums.items()}
    clash = df.selectExpr("doc_id", "text", "'x' AS ids", "'y' AS decoded", "1 AS n_tokens")
    again = bpe.decode_documents(bpe.encode_documents(clash, path, keep=("doc_id", "ids", "decoded", "n_tokens")), path, digests=True)
    assert again.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and again.count() == len(texts)
    assert bpe.encode_documents(docs, path).count() == docs.count() and bpe.encode_documents(empty, path).count() == 0


def test_bpe_long_words():
    """Words of up to 400,000 letters under a time limit, and equal to the library's tokens."""
    import time

    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs, ours = tokenizers.Tokenizer.from_file(path), bpe.Encoder(bpe.Bpe.parse(open(path, encoding="utf-8").read()))
    rng = random.Random(6)
    words = ["a" * n for n in (255, 256, 257, 258, 1001)] + ["".join(rng.choices(a, k=n)) for a in ("ab", "abcdefghijklmnopqrstuvwxyz", "aaab", "éñabc", "the") for n in (250, 260, 3000)]
    words += [" ".join(words[3:9]) + " the end", "".join(rng.choices("etaoinshrdlu", k=20_000))]
    for word, ids in zip(words, ours.encode(words)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == theirs.encode(word, add_special_tokens=False).ids, word[:30]
    assert all(len(chunk) <= bpe.LONG for chunk in ours.memory)
    blob = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400_000))
    began = time.time()
    ids = np.frombuffer(ours.encode([blob])[0], dtype="<u4")
    assert time.time() - began < 60 and bpe.decode(ours.bpe, ids).replace(" ", "").replace("</w>", "") == blob


def test_transport_stream(spark, docs, empty):
    for n in (0, 1, 575, 576, 577, 4607, 4608, 4609, 73728, 80_000, 300_000):
        size, payload = mpegts.padded("".join(random.Random(n).choices("abc \n", k=n)))
        read = mpegts.demux(mpegts.mux(payload))
        assert size == n and read.payload == payload and read.continuity_errors == 0 and read.random_access[0]
        assert (np.diff(read.pts) == mpegts.TICKS_PER_UNIT * mpegts.PER_PES).all()
    stream = bytearray(mpegts.mux(bytes(576 * 200)))
    del stream[188 * 40 : 188 * 41]
    with pytest.raises(ValueError):
        mpegts.demux(bytes(stream))
    for r in mpegts.media_digests(mpegts.write_media(docs)).collect():
        assert r["payload_bytes"] % 576 == 0 and r["payload_bytes"] >= max(1, r["n_bytes"])
    got = {r["doc_id"]: r for r in mpegts.read_media(mpegts.write_media(docs.filter("doc_id < 10 and doc_id != 4"))).collect()}
    for i, t in enumerate(LOREM):
        if i != 4:
            assert got[i]["payload"] == mpegts.padded(t)[1] and got[i]["continuity_errors"] == 0
    assert mpegts.read_media(mpegts.write_media(empty)).count() == 0


def test_transport_stream_with_lost_and_repeated_packets():
    payload = bytes(random.Random(1).randbytes(576 * 400))
    whole = np.frombuffer(mpegts.mux(payload), dtype=np.uint8).reshape(-1, 188)
    clean = mpegts.demux(whole.tobytes())
    assert clean.payload == payload and not len(clean.gaps) and clean.duplicates == 0
    starts = [i for i, p in enumerate(whole) if p[1] & 0x40 and (p[1] & 0x1F, p[2]) == (1, 1)]
    size, bounds = mpegts.UNIT * mpegts.PER_PES, clean.offsets.tolist()
    for gone in (starts[3] + 5, starts[3], starts[4] - 1):  # inside, the start, the last one of an elementary packet
        read = mpegts.demux(np.delete(whole, gone, axis=0).tobytes(), strict=False)
        number = sum(s <= gone for s in starts) - 1
        cut = size * number + (0 if gone == starts[number] else 168 + 184 * (gone - starts[number] - 1))
        follows = size * (number + 1)
        assert read.payload == payload[:cut] + payload[follows:] and read.gaps.tolist() == [cut] and read.continuity_errors == 1, gone
        assert len(read.pts) == len(bounds) - (gone == starts[number])
    for again in (starts[2] + 1, starts[2], 0, 1):  # data and tables
        read = mpegts.demux(np.insert(whole, again, whole[again], axis=0).tobytes())
        assert read.payload == payload and read.duplicates == 1 and read.continuity_errors == 0
    tables = [i for i, p in enumerate(whole) if not p[1] & 0x1F and not p[2]]
    assert mpegts.demux(np.delete(whole, tables[1], axis=0).tobytes()).continuity_errors == 1
    for at, byte in ((tables[-1], 10), (tables[-1] + 1, 12)):
        wrong = whole.copy()
        wrong[at, byte] ^= 1
        with pytest.raises(ValueError):
            mpegts.demux(wrong.tobytes())


def test_media_columns_against_brute_force(spark, docs):
    """The registered columns from the texts alone, and the stored form taken apart packet by packet."""
    import re

    media = {(r["doc_id"], r["n_bytes"], hashlib.sha256(r["media"]).hexdigest()): r["media"] for r in mpegts.write_media(docs).collect()}
    got = mpegts.media_digests(mpegts.write_media(docs)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"]) for r in got) == sorted((r["doc_id"] is None, r["doc_id"], len((r["text"] or "").encode())) for r in docs.collect())
    payloads = {}
    for r in docs.collect():
        data = (r["text"] or "").encode()
        payloads.setdefault((r["doc_id"], len(data)), set()).add(data + b"\xff" * (-len(data) % 576 if data else 576))
    for r in got:
        payload = next(p for p in payloads[r["doc_id"], r["n_bytes"]] if hashlib.sha256(p).hexdigest() == r["payload_sha256"])
        assert r["payload_bytes"] == len(payload) and r["tail_crc32"] == zlib.crc32(payload[-32:])
        stream = media[r["doc_id"], r["n_bytes"], r["media_sha256"]]
        assert r["media_bytes"] == len(stream) == 188 * int(re.search(r"packets=(\d+)", r["feature"])[1])
        found, access, units = b"", 0, 0
        for i in range(0, len(stream), 188):
            packet = stream[i : i + 188]
            if (packet[1] & 0x1F) << 8 | packet[2] != mpegts.DATA_PID:
                continue
            at = 4
            if packet[3] & 0x20:
                access += packet[4] > 0 and packet[5] >> 6 & 1
                at += 1 + packet[4]
            if packet[1] & 0x40:
                units += 1
                at += 9 + packet[at + 8]
            found += packet[at:]
        assert found == payload and f"pes={units};" in r["feature"] and f"rai={access};" in r["feature"] and "cc_errors=0;" in r["feature"]


def test_shards(spark, docs, empty):
    rows = shards.shard_documents(docs, 8).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and 0 <= r["shard"] < 8
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    texts = defaultdict(set)
    for r in rows:
        texts[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(len(s) == 1 for s in texts.values())
    assert {r["text_crc32"] for r in rows} == {zlib.crc32((r["text"] or "").encode()) for r in docs.collect()}
    assert shards.shard_documents(empty, 8).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_shard_plan_is_minimal(spark, seed):
    rng = random.Random(seed)
    groups = sorted((rng.randint(-(2**63), 2**63 - 1), rng.choice([1, 5, 40, 300, 3000])) for _ in range(300))
    if seed == 3:
        groups[100] = (groups[100][0], 400_000)
    plan = shards.plan_shards(spark.createDataFrame(groups, "h bigint, bytes bigint").cache(), 8, fanout=64)
    rest = [b for h, b in groups if h not in plan.alone]
    assert len(plan.alone) + len(plan.ends) + 1 <= 8
    best, _ = shards.smallest_capacity(rest, 8 - len(plan.alone))
    filled = defaultdict(int)
    for h, b in groups:
        filled[plan.alone.index(h) if h in plan.alone else len(plan.alone) + sum(h > e for e in plan.ends)] += b
    assert max(v for k, v in filled.items() if k >= len(plan.alone)) == best


def test_capacity_is_minimal():
    rng = random.Random(1)
    for _ in range(200):
        sizes, k = [rng.randint(1, 50) for _ in range(rng.randint(1, 12))], rng.randint(1, 5)
        best = {(len(sizes), j): 0 for j in range(k + 1)}
        for i in reversed(range(len(sizes))):
            best[i, 0] = 10**9
            for j in range(1, k + 1):
                best[i, j] = min(max(sum(sizes[i:e]), best[e, j - 1]) for e in range(i + 1, len(sizes) + 1))
        assert shards.smallest_capacity(sizes, k)[0] == best[0, k]




@pytest.mark.parametrize("share", [0.112, 0.118, 0.1245])
def test_shard_plan_with_groups_just_below_the_mean(spark, share):
    """Six groups of 0.9 to 0.996 of the mean beside 30,000 small ones."""
    rng = random.Random(7)
    small = [rng.randint(1, 200) for _ in range(30_000)]
    big = int(share * sum(small) / (1 - 6 * share))
    groups = sorted({rng.randint(-(2**63), 2**63 - 1): size for size in [*small, *[big] * 6]}.items())
    plan = shards.plan_shards(spark.createDataFrame(groups, "h bigint, bytes bigint").cache(), 8)
    assert not plan.alone and len(plan.ends) <= 7
    best, cuts = shards.smallest_capacity([b for _, b in groups], 8)
    filled = [0] * 8
    for h, b in groups:
        filled[sum(h > e for e in plan.ends)] += b
    assert plan.capacity == best and filled == np.diff([0, *cuts]).tolist()



def test_shards_of_a_large_group_over_many_partitions(spark):
    rows = [(i, "the same text") for i in range(1500)] + [(i, f"text {i} " * (i % 7)) for i in range(1500, 4500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(211)
    got = shards.shard_documents(df, 8).toPandas()
    assert len(got) == 4500 and got[got.doc_id < 1500]["shard"].nunique() == 1
    for _, rs in got.groupby("shard"):
        assert sorted(rs["slot"]) == list(range(len(rs)))
    sizes = got[got.shard != got[got.doc_id == 0].shard.iloc[0]].groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() < 0.1 * sizes.mean()


def test_greedy_cuts_are_all_used():
    assert shards.smallest_capacity([], 8) == (0, []) and shards.smallest_capacity([5], 8) == (5, [5])
