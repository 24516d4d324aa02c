"""MPEG transport streams as a binary column: multiplex, store, demultiplex and describe.

A payload becomes one private elementary stream.  Access units of at most `UNIT` bytes become PES packets with a presentation
timestamp; these fill 188-byte transport packets with continuity counters.  A program association table and a program map table
stand before every random-access point, whose packet carries the random-access flag.

Reading parses the tables (checking their CRC), follows the program's packets, checks continuity counters, drops
duplicates, reassembles the PES packets and returns payload, timestamps and random-access points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import crc_of, stage

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, DATA_PID = 0x0000, 0x1000, 0x0100
PRIVATE_STREAM, PRIVATE_TYPE = 0xBD, 0x06
BLOCK = 576
UNIT = 16 * BLOCK
TICKS = 3600  # of the 90 kHz clock, per access unit
GROUP = 8  # access units from one random-access point to the next


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def psi_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table: int, ident: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + psi_crc(head).to_bytes(4, "big")


_PAT = _section(0x00, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(0x02, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")


def _table_packet(pid: int, section: bytes, counter: int) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10 | counter & 15, 0]) + section).ljust(PACKET, b"\xff")


def _pts(ticks: int) -> bytes:
    return bytes([0x21 | (ticks >> 29) & 0x0E, (ticks >> 22) & 0xFF, 0x01 | (ticks >> 14) & 0xFE, (ticks >> 7) & 0xFF, 0x01 | (ticks << 1) & 0xFE])


def read_pts(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1


def mux(payload: bytes) -> bytes:
    """The payload (not empty) as a transport stream."""
    out, counter = [], 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        unit = payload[at : at + UNIT]
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _pts(k * TICKS % (1 << 33)) + unit
        access = k % GROUP == 0
        if access:
            out += [_table_packet(PAT_PID, _PAT, k // GROUP), _table_packet(PMT_PID, _PMT, k // GROUP)]
        pos, n, start = 0, len(pes), 0x40
        while pos < n:
            field_ = b"\x01\x40" if access and start else b""  # adaptation field: its length, random-access flag
            room = PACKET - 4 - len(field_)
            if n - pos < room:
                gap = room - (n - pos)
                if field_:
                    field_ = bytes([1 + gap, 0x40]) + b"\xff" * gap
                else:
                    field_ = b"\x00" if gap == 1 else bytes([gap - 1, 0]) + b"\xff" * (gap - 2)
                room = n - pos
            out.append(bytes([SYNC, start | DATA_PID >> 8, DATA_PID & 0xFF, (0x30 if field_ else 0x10) | counter]) + field_ + pes[pos : pos + room])
            counter = (counter + 1) & 15
            pos += room
            start = 0
    return b"".join(out)


@dataclass
class Stream:
    """What a transport stream held."""

    units: list[bytes] = field(default_factory=list)
    timestamps: list[int] = field(default_factory=list)
    random_access: list[int] = field(default_factory=list)
    packets: int = 0
    lost: int = 0
    repeated: int = 0
    broken: int = 0

    @property
    def payload(self) -> bytes:
        return b"".join(self.units)

    def feature(self) -> str:
        last = self.timestamps[-1] if self.timestamps else 0
        return f"packets={self.packets} units={len(self.units)} points={len(self.random_access)} last_pts={last} lost={self.lost} repeated={self.repeated} broken={self.broken}"


def _table_body(packet: bytes, offset: int) -> bytes | None:
    at = offset + 1 + packet[offset]
    end = at + 3 + ((packet[at + 1] & 0x0F) << 8 | packet[at + 2]) if at + 3 <= PACKET else PACKET + 1
    return packet[at + 8 : end - 4] if end <= PACKET and psi_crc(packet[at:end]) == 0 else None


def demux(data: bytes) -> Stream:
    """Parse a stream.  Counter gaps, duplicate packets and unreadable packets or units are counted; a damaged unit is left out."""
    s, map_pid, data_pid, counter, parts, access = Stream(), None, None, None, None, False

    def close() -> None:
        if parts is None:
            return
        pes = b"".join(parts)
        size = int.from_bytes(pes[4:6], "big")
        if pes[:3] != b"\x00\x00\x01" or len(pes) < size + 6 or size < 8 or not pes[7] & 0x80:
            s.broken += 1
            return
        if access:
            s.random_access.append(len(s.units))
        s.timestamps.append(read_pts(pes[9:14]))
        s.units.append(pes[9 + pes[8] : 6 + size])

    for at in range(0, len(data), PACKET):
        p = data[at : at + PACKET]
        if len(p) < PACKET or p[0] != SYNC or p[1] & 0x80:
            s.broken += 1
            continue
        s.packets += 1
        pid, control, begins = (p[1] & 0x1F) << 8 | p[2], p[3] >> 4 & 3, p[1] & 0x40
        body = 5 + p[4] if control & 2 else 4
        if pid == PAT_PID and begins:
            t = _table_body(p, body)
            for i in range(0, len(t or b""), 4):
                if t[i : i + 2] != b"\x00\x00":
                    map_pid = (t[i + 2] & 0x1F) << 8 | t[i + 3]
        elif pid == map_pid and begins:
            t = _table_body(p, body)
            if t:
                i = 4 + ((t[2] & 0x0F) << 8 | t[3])
                while i + 5 <= len(t):
                    if t[i] == PRIVATE_TYPE:
                        data_pid = (t[i + 1] & 0x1F) << 8 | t[i + 2]
                    i += 5 + ((t[i + 3] & 0x0F) << 8 | t[i + 4])
        elif pid == data_pid and control & 1:
            c = p[3] & 15
            if counter is not None:
                if c == counter:
                    s.repeated += 1
                    continue
                if c != (counter + 1) & 15:
                    s.lost += 1
                    if parts is not None:
                        s.broken += 1
                    parts = None
            counter = c
            if begins:
                close()
                parts, access = [p[body:]], bool(control & 2 and p[4] and p[5] & 0x40)
            elif parts is not None:
                parts.append(p[body:])
    close()
    return s


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8, then bytes 255 up to a positive multiple of BLOCK; and the length without them."""
    raw = (text or "").encode("utf-8")
    return raw.ljust(max(1, -(-len(raw) // BLOCK)) * BLOCK, b"\xff"), len(raw)


MEDIA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def encode_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the text as a transport stream (binary), for every row; null text is empty.  Extra columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [payload_of(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for _, n in made], pa.int64()), pa.array([mux(p) for p, _ in made], pa.binary())], names=MEDIA.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, MEDIA)


FEATURES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType()), T.StructField("timestamps", T.ArrayType(T.LongType())), T.StructField("random_access", T.ArrayType(T.LongType()))])


def describe_media(media: DataFrame) -> DataFrame:
    """Features of each stored stream: digests of the reassembled payload and of the stream, timestamps, random-access points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for m in b.column("media").to_pylist():
                s = demux(m or b"")
                p = s.payload
                rows.append((len(p), hashlib.sha256(p).hexdigest(), crc_of(p[-32:]), len(m or b""), hashlib.sha256(m or b"").hexdigest(), s.feature(), s.timestamps, s.random_access))
            made = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(v, k) for v, k in zip(made, kinds, strict=True))], names=FEATURES.names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)


def media_features(docs: DataFrame) -> DataFrame:
    """Encode and store in the shared folder; read the streams back, parse them, and store timestamps and random-access points beside their digests.  One row per input row."""
    return stage(describe_media(stage(encode_media(docs), "media")), "media-index")
