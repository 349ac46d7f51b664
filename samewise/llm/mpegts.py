"""MPEG transport streams as a media column: writing a payload as packets and reading it back.

The writer stores the bytes as private data (stream type 6) in packetised elementary packets of
UNIT * PER_PES bytes with a time stamp each. Every GROUP of them starts with the program tables and a
random-access point. The reader takes nothing for granted: it checks the sync bytes, parses every
program association and map table (with its CRC; all copies must agree), follows the continuity counters
of all three kinds of packets, joins the elementary packets, and returns the payload with the time stamp,
random-access flag and offset of each elementary packet.

A packet that repeats the one before it, with its counter, is a legal duplicate and left out. Where the
counter shows that data packets are missing, demux raises; unless strict, it reports the gap
(continuity_errors and gaps: the places of the payload at which bytes are missing), leaves out what comes up
to the next start of an elementary packet, and goes on there.

Defined results: null text counts as empty and is stored as one unit of 255 bytes; doc_id may be null
or repeated, rows are handled one by one; further columns are dropped; equal texts give equal streams.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

PACKET, UNIT, PER_PES, GROUP = 188, 576, 8, 16
PMT_PID, DATA_PID, STREAM_TYPE, STREAM_ID = 0x100, 0x101, 0x06, 0xBD
#: Ticks of the 90 kHz clock from one unit to the next, and the first stamp.
TICKS_PER_UNIT, FIRST_PTS = 1800, 90_000


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        value = i << 24
        for _ in range(8):
            value = (value << 1 ^ 0x04C11DB7) if value & 0x80000000 else value << 1
        table.append(value & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    """CRC-32 of the program tables: most significant bit first, all ones at the start; 0 over a table with its CRC."""
    value = 0xFFFFFFFF
    for byte in data:
        value = (value << 8 & 0xFFFFFFFF) ^ _CRC[value >> 24 ^ byte]
    return value


def _section(pid: int, body: bytes) -> np.ndarray:
    section = body + crc32_mpeg(body).to_bytes(4, "big")
    packet = bytes([0x47, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section
    return np.frombuffer(packet.ljust(PACKET, b"\xff"), dtype=np.uint8)


#: Table ids 0 and 2, transport stream 1, program 1, version 0.
PAT = _section(0, bytes([0x00, 0xB0, 13, 0, 1, 0xC1, 0, 0, 0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF]))
PMT = _section(PMT_PID, bytes([0x02, 0xB0, 18, 0, 1, 0xC1, 0, 0, 0xE0 | DATA_PID >> 8, DATA_PID & 0xFF, 0xF0, 0, STREAM_TYPE, 0xE0 | DATA_PID >> 8, DATA_PID & 0xFF, 0xF0, 0]))


def _pes(chunks: np.ndarray, pts: np.ndarray) -> np.ndarray:
    """Headers with time stamps before chunks of one length."""
    n, size = chunks.shape
    head = np.zeros((n, 14), dtype=np.uint8)
    head[:, 2], head[:, 3], head[:, 6], head[:, 7], head[:, 8] = 1, STREAM_ID, 0x80, 0x80, 5
    head[:, 4], head[:, 5] = (size + 8) >> 8, (size + 8) & 0xFF
    head[:, 9] = 0x21 | (pts >> 30 & 7) << 1
    head[:, 10], head[:, 11] = pts >> 22 & 0xFF, (pts >> 15 & 0x7F) << 1 | 1
    head[:, 12], head[:, 13] = pts >> 7 & 0xFF, (pts & 0x7F) << 1 | 1
    return np.hstack([head, chunks])


def _packets(pes: np.ndarray, random_access: np.ndarray) -> np.ndarray:
    """Packets of elementary packets of one length: a flag field in the first, stuffing in the last."""
    n, size = pes.shape
    first, rest = PACKET - 6, PACKET - 4
    count = 1 + max(0, -(-(size - first) // rest))
    out = np.full((n, count, PACKET), 0xFF, dtype=np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2], out[:, :, 3] = 0x47, DATA_PID >> 8, DATA_PID & 0xFF, 0x10
    out[:, 0, 1] |= 0x40
    out[:, 0, 3], out[:, 0, 4] = 0x30, 1
    out[:, 0, 5] = np.where(random_access, 0x40, 0)
    out[:, 0, 6:] = pes[:, :first]
    whole = (size - first) // rest
    if whole:
        out[:, 1 : 1 + whole, 4:] = pes[:, first : first + whole * rest].reshape(n, whole, rest)
    left = (size - first) - whole * rest
    if left:
        stuffing = rest - left
        out[:, -1, 3] = 0x30
        out[:, -1, 4] = stuffing - 1
        if stuffing > 1:
            out[:, -1, 5] = 0
        out[:, -1, PACKET - left :] = pes[:, -left:]
    return out.reshape(n * count, PACKET)


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload, a positive multiple of UNIT bytes."""
    data = np.frombuffer(payload, dtype=np.uint8)
    size = UNIT * PER_PES
    parts: list[np.ndarray] = []
    data_cc = 0
    for number, start in enumerate(range(0, len(data), size * GROUP)):
        block = data[start : start + size * GROUP]
        whole = len(block) // size
        stamp = FIRST_PTS + TICKS_PER_UNIT * (start // UNIT + PER_PES * np.arange(whole + 1, dtype=np.int64))
        made = []
        if whole:
            made.append(_packets(_pes(block[: whole * size].reshape(whole, size), stamp[:whole]), np.arange(whole) == 0))
        if len(block) > whole * size:
            made.append(_packets(_pes(block[None, whole * size :], stamp[whole:]), np.array([whole == 0])))
        for packets in made:
            packets[:, 3] |= ((data_cc + np.arange(len(packets))) & 15).astype(np.uint8)
            data_cc += len(packets)
        tables = np.stack([PAT, PMT])
        tables[:, 3] |= number & 15
        parts += [tables, *made]
    return np.concatenate(parts).tobytes()


@dataclass
class Stream:
    """What a transport stream holds."""

    payload: bytes
    pts: np.ndarray
    random_access: np.ndarray
    offsets: np.ndarray
    continuity_errors: int
    packets: int
    pid: int
    stream_type: int
    gaps: np.ndarray
    duplicates: int


def _tables(packets: np.ndarray, table_id: int) -> bytes:
    """The section with this table id that all the given packets repeat; raises where its CRC fails, copies differ or none is there."""
    found = None
    for raw in {p.tobytes()[4:] if not p[3] & 0x20 else p.tobytes()[5 + p[4] :] for p in packets[packets[:, 1] & 0x40 > 0]}:
        at = 1 + raw[0]
        section = raw[at : at + 3 + ((raw[at + 1] & 0x0F) << 8 | raw[at + 2])]
        if section and section[0] == table_id:
            if crc32_mpeg(section):
                raise ValueError(f"table {table_id} fails its CRC")
            if found not in (None, section):
                raise ValueError(f"table {table_id} changes within the stream")
            found = section
    if found is None:
        raise ValueError(f"no table {table_id}")
    return found


def _continuity(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the packets of one PID: which are legal duplicates, and which come after a break of the counter."""
    has_data = own[:, 3] & 0x10 > 0
    duplicate, broken = np.zeros(len(own), dtype=bool), np.zeros(len(own), dtype=bool)
    at = np.flatnonzero(has_data)
    if len(at) > 1:
        step = (own[at[1:], 3].astype(np.int64) - own[at[:-1], 3]) & 15
        same = np.zeros(len(step), dtype=bool)
        for i in np.flatnonzero(step == 0):  # rare
            same[i] = (own[at[i]] == own[at[i + 1]]).all() and not (i and same[i - 1])
        duplicate[at[1:]] = same
        # the discontinuity indicator announces a new count
        announced = (own[at[1:], 3] & 0x20 > 0) & (own[at[1:], 4] > 0) & (own[at[1:], 5] & 0x80 > 0)
        broken[at[1:]] = (step != 1) & ~same & ~announced
    return duplicate, broken


def demux(stream: bytes, strict: bool = True) -> Stream:
    """Reads a transport stream with one program; raises where its form is broken, and if strict where data is missing."""
    if len(stream) % PACKET or not stream:
        raise ValueError("not a whole number of packets")
    packets = np.frombuffer(stream, dtype=np.uint8).reshape(-1, PACKET)
    if (packets[:, 0] != 0x47).any():
        raise ValueError("a packet lacks its sync byte")
    pids = (packets[:, 1].astype(np.int64) & 0x1F) << 8 | packets[:, 2]
    pat = _tables(packets[pids == 0], 0)
    programs = [(pat[i] << 8 | pat[i + 1], (pat[i + 2] & 0x1F) << 8 | pat[i + 3]) for i in range(8, len(pat) - 4, 4)]
    pmt_pid = next((pid for number, pid in programs if number), None)
    if pmt_pid is None:
        raise ValueError("no program")
    pmt = _tables(packets[pids == pmt_pid], 2)
    at = 12 + ((pmt[10] & 0x0F) << 8 | pmt[11])
    stream_type, pid = pmt[at], (pmt[at + 1] & 0x1F) << 8 | pmt[at + 2]
    errors = duplicates = 0
    for other in (0, pmt_pid):
        twice, broken = _continuity(packets[pids == other])
        errors, duplicates = errors + int(broken.sum()), duplicates + int(twice.sum())
    own = packets[pids == pid]
    twice, broken = _continuity(own)
    errors, duplicates = errors + int(broken.sum()), duplicates + int(twice.sum())
    own, broken = own[~twice], broken[~twice]
    if strict and broken.any():
        raise ValueError(f"data packets are missing before packet {int(np.flatnonzero(broken)[0])} of PID {pid}")
    has_field, has_data = own[:, 3] & 0x20 > 0, own[:, 3] & 0x10 > 0
    field = np.where(has_field, own[:, 4].astype(np.int64) + 1, 0)
    begin = np.where(has_data, np.minimum(4 + field, PACKET), PACKET)
    access = has_field & (field > 1) & (own[:, 5] & 0x40 > 0)
    unit_start = (own[:, 1] & 0x40 > 0) & has_data
    # after a break nothing can be placed up to the next start
    order = np.arange(len(own))
    begun = np.maximum.accumulate(np.where(unit_start, order, -1))
    lost = (begun < 0) | (np.maximum.accumulate(np.where(broken & ~unit_start, order, -1)) > begun)
    begin = np.where(lost, PACKET, begin)
    body = own[np.arange(PACKET)[None, :] >= begin[:, None]]
    ends = np.cumsum(PACKET - begin)
    starts = (ends - (PACKET - begin))[unit_start]
    if not len(starts) or (body[starts + 2] != 1).any() or body[starts].any() or body[starts + 1].any():
        raise ValueError("an elementary packet lacks its start code")
    stamp = body[starts[:, None] + np.arange(9, 14)].astype(np.int64)
    pts = (stamp[:, 0] >> 1 & 7) << 30 | stamp[:, 1] << 22 | (stamp[:, 2] >> 1) << 15 | stamp[:, 3] << 7 | stamp[:, 4] >> 1
    head = 9 + body[starts + 8].astype(np.int64)
    told = (body[starts + 4].astype(np.int64) << 8 | body[starts + 5]) + 6
    length = np.diff(np.append(starts, len(body)))
    # a break inside an elementary packet, or at the start of the next one, explains that it is short
    number = np.cumsum(unit_start) - 1
    torn = np.zeros(len(starts) + 1, dtype=bool)
    torn[np.where(broken & unit_start, number - 1, np.where(lost, number, -1))] = True
    if ((length != told) & ~(torn[:-1] & (length < told))).any():
        raise ValueError("an elementary packet is not whole")
    mark = np.zeros(len(body) + 1, dtype=np.int8)
    mark[starts] += 1
    np.add.at(mark, starts + head, -1)
    payload = body[np.cumsum(mark[:-1]) == 0]
    sizes = length - head
    offsets = np.cumsum(sizes) - sizes
    # bytes of the payload before each packet: those of the bodies less the headers of the units begun
    heads = np.append(0, np.cumsum(head))[np.cumsum(unit_start) - unit_start]
    places = (ends - (PACKET - begin) - heads)[broken]
    return Stream(payload.tobytes(), pts, access[unit_start], offsets, errors, len(packets), pid, stream_type, places, duplicates)


def padded(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and these with bytes 255 up to a positive multiple of UNIT."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, b"\xff")


#: Bytes of text handled at once.
SLICE_BYTES = 8_000_000


def _slices(sizes: list[int]):
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= SLICE_BYTES:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def write_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (the transport stream) of each row's text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _slices([len(t or "") for t in texts]):
                made = [padded(t) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([n for n, _ in made], pa.int64()), pa.array([mux(p) for _, p in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, media binary")


def read_media(media: DataFrame) -> DataFrame:
    """Parses the stored streams: payload, and pts, random_access and offset of each elementary packet; gaps: payload places before which bytes are missing."""
    small_batches(media.sparkSession)

    def run(batches):
        for batch in batches:
            blobs = batch.column(2)
            for lo, hi in _slices([len(b.as_buffer()) for b in blobs]):
                found = [demux(b.as_py(), strict=False) for b in blobs.slice(lo, hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array([x.payload for x in found], pa.binary()),
                        pa.array([x.pts.tolist() for x in found], pa.list_(pa.int64())),
                        pa.array([x.random_access.tolist() for x in found], pa.list_(pa.bool_())),
                        pa.array([x.offsets.tolist() for x in found], pa.list_(pa.int64())),
                        pa.array([x.continuity_errors for x in found], pa.int64()),
                        pa.array([x.packets for x in found], pa.int64()),
                        pa.array([x.gaps.tolist() for x in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_bytes", "payload", "pts", "random_access", "offsets", "continuity_errors", "packets", "gaps"],
                )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id bigint, n_bytes bigint, payload binary, pts array<bigint>, random_access array<boolean>, offsets array<bigint>, continuity_errors bigint, packets bigint, gaps array<bigint>")


def media_digests(media: DataFrame) -> DataFrame:
    """Per row: sizes and sums of the stored stream and of what demux reads back from it, and a feature line."""
    small_batches(media.sparkSession)

    def run(batches):
        for batch in batches:
            rows = []
            for n, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                blob = blob.as_py()
                s = demux(blob)
                points = s.offsets[s.random_access]
                gap = int(points[1:].max() - points[0]) // max(1, len(points) - 1) if len(points) > 1 else 0
                feature = f"ts;pid={s.pid};type={s.stream_type};packets={s.packets};pes={len(s.pts)};cc_errors={s.continuity_errors};rai={len(points)};rai_gap={gap};pts={int(s.pts[0])}-{int(s.pts[-1])}"
                rows.append((n, len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), feature))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
