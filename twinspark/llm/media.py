"""Media columns: MPEG transport streams.

``encode`` stores a payload as one elementary stream: a program association table, a program map
table, then packetized elementary stream (PES) packets, each with a time stamp and each opening with a
transport packet that is marked as a random-access point and carries a clock reference. ``parse``
reads the stream back: it follows the tables to the elementary stream, checks sync bytes, table
checksums and continuity counters, reassembles the PES packets and lists time stamps and
random-access points. Work is done row by row where the row is; numpy fills and reads all packets of
a row at once.

``op5`` writes the streams to the shared folder and computes everything from what it reads there, time
stamps (90 kHz) and packets of random-access points included.

Edge cases: a null or empty text is one padded unit of 576 bytes; equal texts give equal streams;
damaged streams raise ValueError, but lost packets are counted; an empty table gives an empty result;
repeated rows and null ids are kept.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.shared import table

UNIT = 576
PACKET, BODY = 188, 184
PES_UNITS = 16  #: units of 576 bytes in a full PES packet
FRAME = 3600  #: 90 kHz ticks between time stamps (25 a second)
PMT_PID, ES_PID, PROGRAM = 0x100, 0x101, 1
HEAD = 14  #: bytes of a PES header with a time stamp


@cache
def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


def crc_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _crc_table()[(c >> 24) ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    out = bytes([table_id, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 0xFF, number >> 8, number & 0xFF, 0xC1, 0, 0]) + body
    return out + crc_mpeg(out).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([0x47, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section).ljust(PACKET, b"\xff")


@cache
def tables() -> bytes:
    pat = _section(0, 1, bytes([PROGRAM >> 8, PROGRAM & 0xFF, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF]))
    pmt = _section(2, PROGRAM, bytes([0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0, 6, 0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0]))
    return _table_packet(0, pat) + _table_packet(PMT_PID, pmt)


def pad(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b"\xff")


def _pes_packets(chunks: np.ndarray, first: int, counter: int) -> np.ndarray:
    """Transport packets (m, n, 188) of m PES packets of the same size; ``first`` numbers them, ``counter`` starts the continuity."""
    m, size = chunks.shape
    pts = (first + np.arange(m, dtype=np.int64)) * FRAME
    head = np.zeros((m, HEAD), np.uint8)
    head[:, :9] = [0, 0, 1, 0xBD, (size + 8) >> 8, (size + 8) & 0xFF, 0x80, 0x80, 5]
    head[:, 9:] = np.stack([0x21 | (pts >> 29) & 0x0E, pts >> 22 & 0xFF, pts >> 14 & 0xFE | 1, pts >> 7 & 0xFF, pts << 1 & 0xFE | 1], 1)
    data = np.concatenate([head, chunks], 1)
    n = 1 + max(0, -(-(data.shape[1] - (BODY - 8)) // BODY))
    rest = data.shape[1] - (BODY - 8) - (n - 1) * BODY + BODY if n > 1 else 0  # payload bytes of the last packet
    out = np.full((m, n, PACKET), 0xFF, np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2] = 0x47, ES_PID >> 8, ES_PID & 0xFF
    out[:, 0, 1] |= 0x40
    out[:, :, 3] = 0x10 | (counter + np.arange(m * n).reshape(m, n)) % 16
    out[:, 0, 3] |= 0x20
    out[:, 0, 4:6] = [7, 0x50]
    out[:, 0, 6:12] = np.stack([pts >> 25 & 0xFF, pts >> 17 & 0xFF, pts >> 9 & 0xFF, pts >> 1 & 0xFF, (pts & 1) << 7 | 0x7E, pts * 0], 1)
    out[:, 0, 12:] = data[:, : BODY - 8]
    at = BODY - 8
    if n > 2:
        out[:, 1:-1, 4:] = data[:, at : at + (n - 2) * BODY].reshape(m, n - 2, BODY)
        at += (n - 2) * BODY
    if n > 1:
        if rest < BODY:
            out[:, -1, 3] |= 0x20
            out[:, -1, 4] = BODY - rest - 1
            if BODY - rest > 1:
                out[:, -1, 5] = 0
        out[:, -1, PACKET - rest :] = data[:, at:]
    return out


def mux(payload: bytes) -> bytes:
    """A transport stream of a payload of a multiple of 576 bytes."""
    data = np.frombuffer(payload, np.uint8)
    full = len(data) // (UNIT * PES_UNITS)
    parts, counter = [tables()], 0
    if full:
        block = _pes_packets(data[: full * UNIT * PES_UNITS].reshape(full, -1), 0, 0)
        counter = block.shape[0] * block.shape[1]
        parts.append(block.tobytes())
    if len(data) > full * UNIT * PES_UNITS:
        parts.append(_pes_packets(data[full * UNIT * PES_UNITS :].reshape(1, -1), full, counter).tobytes())
    return b"".join(parts)


def _table(packets: np.ndarray, pid: np.ndarray, want: int, table_id: int) -> bytes:
    at = np.flatnonzero(pid == want)
    if not len(at):
        raise ValueError(f"no table with PID {want}")
    p = packets[at[0]].tobytes()
    section = p[5 + p[4] :]
    section = section[: 3 + ((section[1] & 0x0F) << 8 | section[2])]
    if section[0] != table_id or crc_mpeg(section):
        raise ValueError(f"damaged table with PID {want}")
    return section[8:-4]


def parse(media: bytes) -> dict:
    """Payload, time stamps, random-access points (numbers of packets) and breaks of continuity of a transport stream."""
    if len(media) % PACKET:
        raise ValueError("not whole packets")
    p = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != 0x47).any():
        raise ValueError("sync byte missing")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    pat = _table(p, pid, 0, 0)
    pmt = _table(p, pid, (pat[2] & 0x1F) << 8 | pat[3], 2)
    at = 4 + ((pmt[2] & 0x0F) << 8 | pmt[3])
    stream = (pmt[at + 1] & 0x1F) << 8 | pmt[at + 2]
    own = np.flatnonzero(pid == stream)
    p = p[own]
    counter = p[:, 3] & 15
    breaks = int((((counter[1:].astype(np.int16) - counter[:-1]) % 16) != 1).sum())
    adapted = (p[:, 3] & 0x20) != 0
    begin = np.where(adapted, 5 + p[:, 4].astype(np.int32), 4)
    access = own[adapted & (p[:, 4] > 0) & ((p[:, 5] & 0x40) != 0)]
    data = p[np.arange(PACKET) >= begin[:, None]]
    size = PACKET - begin
    starts = (np.cumsum(size) - size)[(p[:, 1] & 0x40) != 0]
    h = data[starts[:, None] + np.arange(HEAD)].astype(np.int64)
    if not len(starts) or starts[0] or (h[:, :3] != [0, 0, 1]).any():
        raise ValueError("no PES packet where one should start")
    pts = (h[:, 9] & 0x0E) << 29 | h[:, 10] << 22 | (h[:, 11] & 0xFE) << 14 | h[:, 12] << 7 | h[:, 13] >> 1
    cut = starts + 9 + h[:, 8]
    ends = np.r_[starts[1:], len(data)]
    if not breaks and (ends - starts - 6 != (h[:, 4] << 8 | h[:, 5])).any():
        raise ValueError("PES packet of another length than declared")
    payload = b"".join(data[a:b].tobytes() for a, b in zip(cut.tolist(), ends.tolist(), strict=True))
    return {"payload": payload, "pts": pts, "access": access, "breaks": breaks, "packets": len(media) // PACKET}


def encode(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, n_bytes, media)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(1).to_pylist()]
            media = pa.array([mux(pad(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), media], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) to what is read back from the stored streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for m in b.column(2).to_pylist():
                x = parse(m)
                pts, access = x["pts"], x["access"]
                what = f"packets={x['packets']};pes={len(pts)};pts={pts[0]}..{pts[-1]};access={len(access)}@{access[0]}..{access[-1]};breaks={x['breaks']}"
                rows.append((len(x["payload"]), hashlib.sha256(x["payload"]).hexdigest(), zlib.crc32(x["payload"][-32:]), len(m), hashlib.sha256(m).hexdigest(), what, pts.tolist(), access.tolist()))
            cols = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], NAMES)

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pts array<long>, access array<long>")


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pts", "access"]


def op5(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    return features(table(encode(read(spark, sf_dir, "documents")), "media"))
