"""Media columns as MPEG transport streams.

Samples (8 bits each) are cut into access units of UNIT bytes. Each unit is one PES packet with a presentation time
stamp, carried in four 188-byte transport packets; every RANDOM_ACCESS-th unit is a random-access point, has a clock
reference and is preceded by the program tables. Reading back follows the program association table to the program map,
from there to the elementary stream, checks continuity counters and table checksums, and reassembles the PES packets.
Streams of other writers are read too, as long as they are whole 188-byte packets with one elementary stream.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._text import utf8

UNIT = 576
RANDOM_ACCESS = 8
#: 90 kHz ticks of a unit, 576 samples at 24 kHz.
TICKS = 2160
PACKET, PMT_PID, MEDIA_PID, PROGRAM, STREAM_TYPE, STREAM_ID = 188, 0x1000, 0x0100, 1, 0x06, 0xBD
_HEAD = 14  # of a PES packet with a time stamp


def crc32_mpeg(data: bytes) -> int:
    """The checksum of program tables: polynomial 0x04C11DB7, most significant bit first, no final inversion."""
    flip = lambda x, n: int(f"{x:0{n}b}"[::-1], 2)
    return flip(zlib.crc32(bytes(flip(b, 8) for b in data)) ^ 0xFFFFFFFF, 32)


def _section(table_id: int, ext: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big") + ext.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> np.ndarray:
    head = bytes([0x47]) + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00"
    return np.frombuffer((head + section).ljust(PACKET, b"\xff"), np.uint8)


_PAT = _table_packet(0, _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
_PMT = _table_packet(PMT_PID, _section(2, PROGRAM, (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00"))


def write_stream(samples: np.ndarray) -> bytes:
    """The transport stream of a positive multiple of UNIT samples."""
    n = len(samples) // UNIT
    if n < 1 or n * UNIT != len(samples):
        raise ValueError(f"samples must be a positive multiple of {UNIT}")
    ticks = np.arange(n, dtype=np.int64) * TICKS % (1 << 33)
    pes = np.empty((n, _HEAD + UNIT), np.uint8)
    pes[:, :9] = [0, 0, 1, STREAM_ID, (UNIT + 8) >> 8, (UNIT + 8) & 255, 0x80, 0x80, 5]
    pes[:, 9] = 0x21 | (ticks >> 29) & 0x0E
    pes[:, 10] = ticks >> 22 & 255
    pes[:, 11] = 1 | (ticks >> 14) & 0xFE
    pes[:, 12] = ticks >> 7 & 255
    pes[:, 13] = 1 | (ticks << 1) & 0xFE
    pes[:, _HEAD:] = samples.reshape(n, UNIT)

    out = np.full((n, 4, PACKET), 0xFF, np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2] = 0x47, MEDIA_PID >> 8, MEDIA_PID & 255
    out[:, 0, 1] |= 0x40
    out[:, :, 3] = 0x10 | np.arange(4 * n).reshape(n, 4) % 16
    rap = np.arange(n) % RANDOM_ACCESS == 0
    for mine, before in ((np.flatnonzero(~rap), 0), (np.flatnonzero(rap), 8)):  # bytes of the first packet's adaptation field
        x = out[mine]
        if before:
            clock = ticks[mine]
            x[:, 0, 3] |= 0x20
            x[:, 0, 4], x[:, 0, 5] = 7, 0x50  # random access, clock reference
            for i, shift in enumerate((25, 17, 9, 1)):
                x[:, 0, 6 + i] = clock >> shift & 255
            x[:, 0, 10], x[:, 0, 11] = (clock & 1) << 7 | 0x7E, 0
        cut = [0, 184 - before, 368 - before, 552 - before, _HEAD + UNIT]
        rest = cut[4] - cut[3]
        x[:, 3, 3] |= 0x20
        x[:, 3, 4], x[:, 3, 5] = 183 - rest, 0
        for i in range(4):
            x[:, i, PACKET - (cut[i + 1] - cut[i]) :] = pes[mine, cut[i] : cut[i + 1]]
        out[mine] = x
    flat = out.reshape(-1, PACKET)
    groups = -(-n // RANDOM_ACCESS)
    tables = np.empty((groups, 2, PACKET), np.uint8)
    tables[:, 0], tables[:, 1] = _PAT, _PMT
    tables[:, :, 3] = 0x10 | (np.arange(groups) % 16)[:, None]
    return np.insert(flat, np.repeat(np.arange(groups) * 4 * RANDOM_ACCESS, 2), tables.reshape(-1, PACKET), axis=0).tobytes()


def _tables(packets: np.ndarray, pid: np.ndarray, at: np.ndarray, want: int, table_id: int) -> bytes | None:
    """The first section of that table with a right checksum; sections may go on over packets, and several may share one."""
    mine = np.flatnonzero((pid == want) & (at < PACKET))
    payloads = [packets[i, at[i] :].tobytes() for i in mine]
    begins = (packets[mine, 1] & 0x40 > 0).tolist()
    for j, raw in enumerate(payloads):
        if not begins[j]:
            continue
        rest, follow = raw[1 + raw[0] :], j + 1
        while rest[:1] not in (b"", b"\xff"):
            size = lambda s: 3 + (int.from_bytes(s[1:3], "big") & 0xFFF)
            while (len(rest) < 3 or len(rest) < size(rest)) and follow < len(payloads):
                more = payloads[follow]
                rest += more[1 : 1 + more[0]] if begins[follow] else more
                follow = len(payloads) if begins[follow] else follow + 1
            n = size(rest)
            if len(rest) < n or n <= 12:
                break
            if rest[0] == table_id and crc32_mpeg(rest[: n - 4]) == int.from_bytes(rest[n - 4 : n], "big"):
                return rest[:n]
            rest = rest[n:]
    return None


def read_stream(media: bytes | memoryview) -> dict | None:
    """samples, pts and random_access (an entry per PES packet), lost (continuity errors); None if it isn't a stream.

    Of several programs or streams the first is read. A packet that repeats the one before is left out, as the standard allows it.
    """
    if not len(media) or len(media) % PACKET:
        return None
    p = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != 0x47).any():
        return None
    pid = (p[:, 1].astype(np.int64) & 31) << 8 | p[:, 2]
    control = p[:, 3] >> 4 & 3
    size = np.where(control >= 2, p[:, 4].astype(np.int64) + 1, 0)
    at = np.where(control & 1, np.minimum(4 + size, PACKET), PACKET)
    pat = _tables(p, pid, at, 0, 0)
    programs = [int.from_bytes(pat[i + 2 : i + 4], "big") & 0x1FFF for i in range(8, len(pat) - 4, 4) if pat[i : i + 2] != b"\0\0"] if pat else []
    pmt = _tables(p, pid, at, programs[0], 2) if programs else None
    if pmt is None or len(pmt) < 21:
        return None
    stream = 12 + (int.from_bytes(pmt[10:12], "big") & 0xFFF)
    mine = np.flatnonzero(pid == int.from_bytes(pmt[stream + 1 : stream + 3], "big") & 0x1FFF)
    p, at, size = p[mine], at[mine], size[mine]
    if not len(p):
        return None
    again = np.flatnonzero((p[1:, 3] == p[:-1, 3]) & (at[1:] < PACKET)) + 1
    again = again[(p[again] == p[again - 1]).all(axis=1)]
    p, at, size = (np.delete(x, again, axis=0) for x in (p, at, size))
    counts = np.cumsum(at < PACKET)  # the counter goes up with payloads only
    lost = int(np.count_nonzero((np.diff(p[:, 3].astype(np.int64) & 15) - np.diff(counts)) % 16))
    data = p[np.arange(PACKET) >= at[:, None]]
    ends = np.cumsum(PACKET - at)
    unit = np.flatnonzero(p[:, 1] & 0x40)
    start = ends[unit] - (PACKET - at[unit])
    d = np.concatenate([data, np.zeros(_HEAD, np.uint8)]).astype(np.int64)
    if len(start) == 0 or (d[start[:, None] + [0, 1, 2]] != [0, 0, 1]).any():
        return None
    stop = np.append(start[1:], len(data))
    length = d[start + 4] << 8 | d[start + 5]
    stop = np.where(length > 0, np.minimum(stop, start + 6 + length), stop)
    first = start + 9 + d[start + 8]
    pts = (d[start + 9] >> 1 & 7) << 30 | d[start + 10] << 22 | (d[start + 11] >> 1) << 15 | d[start + 12] << 7 | d[start + 13] >> 1
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, np.minimum(first, stop), 1)
    np.add.at(edge, stop, -1)
    return {
        "samples": data[np.cumsum(edge[:-1]) > 0], "pts": np.where(d[start + 7] & 0x80, pts, -1),
        "random_access": (size[unit] > 1) & (p[unit, 5] & 0x40 > 0), "lost": lost,
    }


def features(samples: np.ndarray, pts: np.ndarray, random_access: np.ndarray, lost: int) -> str:
    """Units, random-access points, last time stamp, continuity errors, mean and mean square in 1/1000, histogram of 16 levels."""
    x = samples.astype(np.int64)
    n = max(1, len(x))
    levels = ",".join(map(str, np.bincount(samples >> 4, minlength=16).tolist()))
    return f"units={len(pts)} access={int(random_access.sum())} last_pts={int(pts[-1])} lost={lost} mean={int(x.sum()) * 1000 // n} square={int((x * x).sum()) * 1000 // n} levels={levels}"


def payload(data: np.ndarray) -> np.ndarray:
    """The bytes, filled up with 255 to a positive multiple of UNIT."""
    size = max(1, -(-len(data) // UNIT)) * UNIT
    out = np.full(size, 255, np.uint8)
    out[: len(data)] = data
    return out


def to_media(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, n_bytes (of the UTF-8 text) and media, the transport stream of its padded bytes.

    Null and empty texts give one unit of 255s. Equal texts give equal streams. Repeated rows stay; other columns go.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            media = [write_stream(payload(data[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(media, pa.large_binary())], names=["id", "n_bytes", "media"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id)


def read_media(rows: DataFrame, *, id: str = "doc_id", media: str = "media", keep: tuple[str, ...] = ("n_bytes",)) -> DataFrame:
    """One row per row: id, kept columns, payload_bytes, payload_sha256, tail_crc32 (of the last 32 bytes), media_bytes,
    media_sha256, lost, random_access (their time stamps) and feature; all but the media's are null where it isn't a stream."""
    rows = rows.select(F.col(id).alias("id"), *keep, F.col(media).alias("media"))
    new = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, lost long, random_access array<long>, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.columns[-1]:
                raw = raw.as_buffer() if raw.is_valid else b""
                own = {"media_bytes": len(memoryview(raw)), "media_sha256": hashlib.sha256(raw).hexdigest()}
                if got := read_stream(memoryview(raw)):
                    back = got["samples"].tobytes()
                    own |= {
                        "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-32:]), "lost": got["lost"],
                        "random_access": got["pts"][got["random_access"]].tolist(), "feature": features(**got),
                    }
                out.append(own)
            own = pa.RecordBatch.from_pylist(out, schema=_READ)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own.columns], names=[*batch.schema.names[:-1], *_READ.names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, {new}").withColumnRenamed("id", id)


_READ = pa.schema(
    [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("lost", pa.int64()), ("random_access", pa.list_(pa.int64())), ("feature", pa.string())]
)
