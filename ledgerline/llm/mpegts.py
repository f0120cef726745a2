"""Media columns as MPEG transport streams (ISO/IEC 13818-1).

``to_transport_stream`` packs bytes into access units of a private data stream:
every unit starts with a program association table, a program map table and a
packet that carries a clock reference and the random-access flag, so a reader
can join at any unit. ``read_transport_stream`` parses the tables, checks the
continuity counters, reassembles the elementary packets and returns payload,
timestamps and random-access points from the stream alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.store import small_batches

PACKET = 188
BODY = 184
SYNC = 0x47
PAT_PID = 0x0000
PMT_PID = 0x1000
DATA_PID = 0x0100
PROGRAM = 1
PRIVATE_DATA = 0x06
PRIVATE_STREAM_1 = 0xBD
CLOCK_HZ = 90_000
CLOCK_MASK = (1 << 33) - 1
#: Samples in an access unit, and samples a second.
UNIT = 8192
SAMPLE_RATE = 8000
#: Bytes of the adaptation field that opens a unit: length, flags, clock reference.
OPENING = 8
PES_HEADER = 14


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        crc = value << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7) if crc & 0x80000000 else crc << 1
        table.append(crc & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc = ((crc << 8) & 0xFFFFFFFF) ^ _CRC[(crc >> 24) ^ byte]
    return crc


def _section(table_id: int, number: int, body: bytes) -> bytes:
    """A table section in the one packet that holds it, without the packet's first four bytes."""
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 255, number >> 8, number & 255, 0xC1, 0, 0]) + body
    section = head + crc32_mpeg(head).to_bytes(4, "big")
    return (b"\0" + section).ljust(BODY, b"\xff")


_PAT = _section(0, 1, bytes([PROGRAM >> 8, PROGRAM & 255, 0xE0 | PMT_PID >> 8, PMT_PID & 255]))
_PMT = _section(2, PROGRAM, bytes([0xE0 | DATA_PID >> 8, DATA_PID & 255, 0xF0, 0, PRIVATE_DATA, 0xE0 | DATA_PID >> 8, DATA_PID & 255, 0xF0, 0]))


def _pts_bytes(pts: int) -> bytes:
    return bytes([0x21 | (pts >> 29) & 0x0E, pts >> 22 & 255, 1 | (pts >> 14) & 0xFE, pts >> 7 & 255, 1 | (pts << 1) & 0xFE])


def _pcr_bytes(pcr: int) -> bytes:
    return (pcr << 15 | 0x7E00).to_bytes(6, "big")


def _put(packets: np.ndarray, rows, pid: int, start: int, control: int, first_cc: int) -> None:
    block = packets[rows]
    block[:, 0] = SYNC
    block[:, 1] = pid >> 8
    block[:, 2] = pid & 255
    block[0, 1] |= 0x40 * start
    block[:, 3] = control | (first_cc + np.arange(len(block))) & 15


def _unit_packets(samples: np.ndarray, pts: int, unit: int, first_cc: int) -> np.ndarray:
    """The packets of one access unit: both tables, then the elementary packet."""
    size = 8 + len(samples)
    header = bytes([0, 0, 1, PRIVATE_STREAM_1, size >> 8, size & 255, 0x84, 0x80, 5]) + _pts_bytes(pts)
    body = np.concatenate([np.frombuffer(header, np.uint8), samples])
    opening = min(len(body), BODY - OPENING)
    whole, tail = divmod(len(body) - opening, BODY)
    packets = np.full((3 + whole + (tail > 0), PACKET), 0xFF, np.uint8)
    for row, pid, table in ((0, PAT_PID, _PAT), (1, PMT_PID, _PMT)):
        _put(packets, slice(row, row + 1), pid, 1, 0x10, unit)
        packets[row, 4:] = np.frombuffer(table, np.uint8)
    _put(packets, slice(2, None), DATA_PID, 1, 0x10, first_cc)
    packets[2, 3] |= 0x20
    packets[2, 4] = BODY - 1 - opening
    packets[2, 5] = 0x50
    packets[2, 6:12] = np.frombuffer(_pcr_bytes(pts), np.uint8)
    packets[2, PACKET - opening :] = body[:opening]
    packets[3 : 3 + whole, 4:] = body[opening : opening + whole * BODY].reshape(whole, BODY)
    if tail:
        packets[-1, 3] |= 0x20
        packets[-1, 4] = BODY - 1 - tail
        if tail < BODY - 1:
            packets[-1, 5] = 0
        packets[-1, PACKET - tail :] = body[-tail:]
    return packets


def to_transport_stream(payload: bytes, unit: int = UNIT, sample_rate: int = SAMPLE_RATE) -> bytes:
    """Packs 8-bit samples; no samples give an empty stream."""
    samples = np.frombuffer(payload, np.uint8)
    parts, cc = [], 0
    for number, at in enumerate(range(0, len(samples), unit)):
        packets = _unit_packets(samples[at : at + unit], at * CLOCK_HZ // sample_rate & CLOCK_MASK, number, cc)
        cc += len(packets) - 2
        parts.append(packets)
    return b"".join(x.tobytes() for x in parts)


@dataclass
class Stream:
    """What a transport stream says of itself."""

    payload: bytes = b""
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, int] = field(default_factory=dict)
    packets: int = 0
    continuity_errors: int = 0
    duplicates: int = 0
    #: One row for each elementary packet: first packet's number, byte offset, bytes, time stamp, clock reference, random access.
    units: list[tuple[int, int, int, int | None, int | None, bool]] = field(default_factory=list)


def _tables(packets: np.ndarray, rows: np.ndarray, table_id: int) -> set[bytes]:
    """The bodies of sections of a kind, each checked against its CRC."""
    bodies = set()
    for raw in {x.tobytes() for x in packets[rows, 4:]}:
        section = raw[1 + raw[0] :]
        length = (section[1] & 15) << 8 | section[2] if len(section) > 2 else 0
        section = section[: 3 + length]
        if length < 9 or len(section) < 3 + length or section[0] != table_id or crc32_mpeg(section):
            raise ValueError("damaged table section")
        bodies.add(section[8:-4])
    return bodies


def read_transport_stream(media: bytes) -> Stream:
    """Parses a stream of whole packets; raises ValueError for lost sync, damaged tables or damaged elementary packets."""
    out = Stream()
    if len(media) % PACKET:
        raise ValueError("not whole packets")
    packets = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    out.packets = len(packets)
    if not len(packets):
        return out
    if (packets[:, 0] != SYNC).any():
        raise ValueError("lost sync")
    pids = (packets[:, 1] & 31).astype(np.int64) << 8 | packets[:, 2]
    for body in _tables(packets, pids == PAT_PID, 0):
        if len(body) % 4:
            raise ValueError("damaged program table")
        for at in range(0, len(body), 4):
            # Program 0 is the network's table, not a program.
            if number := body[at] << 8 | body[at + 1]:
                out.programs[number] = (body[at + 2] & 31) << 8 | body[at + 3]
    for pmt in out.programs.values():
        for body in _tables(packets, pids == pmt, 2):
            at = 4 + ((body[2] & 15) << 8 | body[3]) if len(body) >= 4 else len(body) + 1
            while at + 5 <= len(body):
                out.streams[(body[at + 1] & 31) << 8 | body[at + 2]] = body[at]
                at += 5 + ((body[at + 3] & 15) << 8 | body[at + 4])
            if at != len(body):
                raise ValueError("damaged stream table")
    payloads = []
    filled = (packets[:, 3] & 0x10) != 0
    for pid in [PAT_PID, *out.programs.values(), *out.streams]:
        rows = np.flatnonzero((pids == pid) & filled)
        step = np.diff(packets[rows, 3].astype(np.int64) & 15) & 15
        again = np.zeros(len(rows), bool)
        again[1:] = (step == 0) & (packets[rows[1:]] == packets[rows[:-1]]).all(axis=1)
        out.duplicates += int(again.sum())
        out.continuity_errors += int(((step != 1) & ~again[1:]).sum())
        if pid in out.streams:
            payloads.append(_elementary(packets, rows[~again], out))
    out.payload = b"".join(payloads)
    return out


def _elementary(packets: np.ndarray, rows: np.ndarray, out: Stream) -> bytes:
    """Reassembles one stream's elementary packets and notes its units."""
    own = packets[rows]
    skip = np.where(own[:, 3] & 0x20, own[:, 4].astype(np.int64) + 1, 0) + 4
    if (skip > PACKET).any():
        raise ValueError("damaged adaptation field")
    data = own[np.arange(PACKET) >= skip[:, None]].tobytes()
    ends = np.cumsum(PACKET - skip)
    starts = np.flatnonzero(own[:, 1] & 0x40)
    at = (ends - PACKET + skip)[starts].tolist()
    parts, offset = [], 0
    for k, (row, begin, end) in enumerate(zip(starts.tolist(), at, [*at[1:], len(data)], strict=True)):
        unit = data[begin:end]
        if len(unit) < 9 or unit[:3] != b"\0\0\1" or unit[4] << 8 | unit[5] != len(unit) - 6 or len(unit) < 9 + unit[8] or (unit[7] & 0x80 and unit[8] < 5):
            raise ValueError(f"damaged elementary packet {k}")
        pts = pcr = None
        if unit[7] & 0x80:
            b = unit[9:14]
            pts = (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1
        flags = int(own[row, 5]) if own[row, 3] & 0x20 and own[row, 4] else 0
        if flags & 0x10 and own[row, 4] >= 7:
            pcr = int.from_bytes(own[row, 6:12].tobytes(), "big") >> 15
        samples = unit[9 + unit[8] :]
        out.units.append((int(rows[row]), offset, len(samples), pts, pcr, bool(flags & 0x40)))
        offset += len(samples)
        parts.append(samples)
    return b"".join(parts)


MEDIA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

UNITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("packet", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("n_samples", T.LongType()),
            T.StructField("pts", T.LongType()),
            T.StructField("pcr", T.LongType()),
            T.StructField("random_access", T.BooleanType()),
        ]
    )
)


def _schema(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT, sample_rate: int = SAMPLE_RATE) -> DataFrame:
    """``doc_id, n_bytes, media``: each whole text as UTF-8 (null: no bytes), padded with 0 to a positive multiple of 64, in a transport stream.

    One output row for each input row, repeated rows and null ids included;
    an empty text is one unit of 64 zero samples; long texts are stored whole, in
    as many units as it takes. An empty table gives an empty one; other columns
    are not read.
    """
    schema = _schema(MEDIA)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for text in batch.column(1):
                raw = text.as_buffer() if text.is_valid else None
                raw = raw.to_pybytes() if raw is not None else b""
                sizes.append(len(raw))
                media.append(to_transport_stream(raw + bytes(-len(raw) % 64 if raw else 64), unit, sample_rate))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], schema=schema)

    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(pack, MEDIA)


READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("n_packets", T.LongType()),
        T.StructField("continuity_errors", T.LongType()),
        T.StructField("streams", T.StringType()),
        T.StructField("units", UNITS),
        T.StructField("sample_sum", T.LongType()),
        T.StructField("level_crossings", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def _read(stored: bytes) -> dict:
    out = {"media_bytes": len(stored), "media_sha256": hashlib.sha256(stored).hexdigest()}
    try:
        s = read_transport_stream(stored)
    except ValueError as damage:
        return out | {"error": str(damage)}
    samples = np.frombuffer(s.payload, np.uint8)
    return out | {
        "payload_bytes": len(s.payload),
        "payload_sha256": hashlib.sha256(s.payload).hexdigest(),
        "tail_crc32": zlib.crc32(s.payload[-64:]),
        "n_packets": s.packets,
        "continuity_errors": s.continuity_errors,
        "streams": ",".join(f"{pid}:{kind}" for pid, kind in sorted(s.streams.items())),
        "units": [dict(zip(("packet", "offset", "n_samples", "pts", "pcr", "random_access"), u, strict=True)) for u in s.units],
        "sample_sum": int(samples.sum(dtype=np.int64)),
        "level_crossings": int(np.count_nonzero(np.diff(samples >= 64))),
    }


def decode_media(media: DataFrame) -> DataFrame:
    """Reads every stored stream back: digests of its payload, packet and continuity counts, its streams, and ``units``, the timestamp and random-access index.

    Takes the columns of ``encode_media``; other columns are not read, repeated
    rows and null ids are rows like others, and an empty table gives an empty
    one. A null stream is read as one of no packets. A damaged stream has
    ``error``, its own size and digest, and null for all that is read from it.
    """
    schema = _schema(READ)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, n_bytes, stored in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows.append({"doc_id": doc_id, "n_bytes": n_bytes} | _read(stored or b""))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(unpack, READ)
