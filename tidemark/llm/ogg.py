"""Media columns in Ogg: texts stored as 8-bit samples in paged, checksummed streams, and read back.

A stored file holds two logical streams, interleaved by page: one of unsigned 8-bit samples (header packet ``PCM     ``,
then packets of sixteen 576-sample frames) and one that tells the length before padding.  Packets are cut into segments
by lacing values and run on over page ends; a page's granule position is the number of samples of the packets that
end by it, or -1 if none ends on it.

The reader walks the pages, verifies each one's checksum and number, deals them out by serial number, joins the packets
by their lacing values and derives timestamps from the granule positions.  ``decode`` raises on anything amiss; ``probe`` gives such a
file a row without figures whose ``error`` says what is wrong, and goes on.

The page checksum is an unreflected CRC-32 of zero start; it equals the bit-reversed reflected CRC-32 of bit-reversed
bytes, so ``zlib.crc32`` and a translation table compute it.

Defined cases: a null text counts as empty (one frame of padding); serial numbers come from the payload, so equal texts
give equal files; every row gives a row, repeated ones too; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

FRAME = 576
PACKET = 16 * FRAME
RATE = 8000
CONTINUED, FIRST, LAST = 1, 2, 4
HEAD = struct.Struct("<4sBBqIIIB")

_FLIPPED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(data: bytes) -> int:
    """The page checksum: polynomial 04C11DB7, not reflected, starting from and ending with zero."""
    low = zlib.crc32(data.translate(_FLIPPED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(low.to_bytes(4, "little").translate(_FLIPPED), "big")


def padded(data: bytes) -> bytes:
    return data + b"\xff" * (-len(data) % FRAME if data else FRAME)


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    crc = checksum(b"".join((head, lacing, body)))
    return b"".join((head[:22], crc.to_bytes(4, "little"), head[26:], lacing, body))


def _laced(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes((size % 255,))


def _data_pages(payload: bytes, serial: int, number: int) -> Iterator[bytes]:
    whole, rest = divmod(len(payload), PACKET)
    lacing = _laced(PACKET) * whole + (_laced(rest) if rest else b"")
    at, ended, runs_on = 0, 0, False
    for i in range(0, len(lacing), 255):
        part = lacing[i : i + 255]
        size, ends = sum(part), len(part) - part.count(255)
        ended += ends
        last = i + 255 >= len(lacing)
        yield page(CONTINUED * runs_on | LAST * last, min(ended * PACKET, len(payload)) if ends else -1, serial, number, part, payload[at : at + size])
        at, number, runs_on = at + size, number + 1, part[-1] == 255


def encode(payload: bytes, n_bytes: int) -> bytes:
    """A padded payload as an Ogg file."""
    serial = zlib.crc32(payload)
    other = serial ^ 0xFFFFFFFF
    header = b"PCM     " + struct.pack("<HHIIBBHI", 0, 0, 1, RATE, 8, 1, FRAME, 0)
    pages = [page(FIRST, 0, serial, 0, _laced(len(header)), header), page(FIRST, 0, other, 0, _laced(8), b"LENGTH\0\0")]
    pages += _data_pages(payload, serial, 1)
    pages.insert(3, page(LAST, 1, other, 1, _laced(8), struct.pack("<Q", n_bytes)))
    return b"".join(pages)


def decode(media: bytes) -> dict:
    """Pages, packets by stream, timestamps: payload, n_bytes, pages, packets, streams, first_ms, last_ms."""
    streams: dict[int, dict] = {}
    at, pages = 0, 0
    view = memoryview(media)
    while at < len(media):
        magic, version, flags, granule, serial, number, crc, segments = HEAD.unpack_from(media, at)
        if magic != b"OggS" or version:
            raise ValueError("not an Ogg page")
        lacing = media[at + HEAD.size : at + HEAD.size + segments]
        body = at + HEAD.size + segments
        end = body + sum(lacing)
        if end > len(media):
            raise ValueError("a page is cut off")
        if checksum(b"".join((view[at : at + 22], b"\0\0\0\0", view[at + 26 : end]))) != crc:
            raise ValueError("a page's checksum doesn't hold")
        if flags & FIRST:
            if serial in streams:
                raise ValueError("a stream begins twice")
            streams[serial] = {"packets": [], "open": [], "next": 0, "granules": [], "over": False}
        s = streams[serial]
        if s["next"] != number or s["over"] or bool(s["open"]) != bool(flags & CONTINUED):
            raise ValueError("a page is missing")
        s["next"], s["over"] = number + 1, bool(flags & LAST)
        if granule >= 0:
            s["granules"].append(granule)
        start, size = body, 0
        for value in lacing:
            size += value
            if value < 255:
                s["open"].append(view[start : start + size])
                s["packets"].append(b"".join(s["open"]))
                s["open"], start, size = [], start + size, 0
        if size:
            s["open"].append(view[start : start + size])
        at, pages = end, pages + 1
    if not all(s["over"] and not s["open"] for s in streams.values()):
        raise ValueError("a stream has no end")
    sound = next(s for s in streams.values() if s["packets"][0].startswith(b"PCM     "))
    told = next(s for s in streams.values() if s["packets"][0].startswith(b"LENGTH"))
    rate = struct.unpack_from("<I", sound["packets"][0], 16)[0]
    payload = b"".join(sound["packets"][1:])
    times = [g * 1000 // rate for g in sound["granules"][1:]]
    if sound["granules"][-1] != len(payload) or times != sorted(times):
        raise ValueError("the granule positions don't fit the samples")
    return {"payload": payload, "n_bytes": struct.unpack("<Q", told["packets"][1])[0], "pages": pages, "packets": sum(len(s["packets"]) for s in streams.values()), "streams": len(streams), "first_ms": times[0], "last_ms": times[-1]}


def store(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media): each text as an Ogg file in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            media = [encode(padded(x or b""), len(x or b"")) for x in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(media, pa.binary())], names=["id", "media"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("raw")).mapInArrow(run, "id long, media binary")


PROBED = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def probe(stored: DataFrame) -> DataFrame:
    """Read a media column back: payload figures and a line of features for each file, or what is wrong with it."""
    fields = [x.split() for x in PROBED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}

    def row(media: bytes | None) -> tuple:
        try:
            got = decode(media or b"")
        except (ValueError, KeyError, IndexError, StopIteration, struct.error) as e:
            return None, None, None, None, len(media or b""), None, None, f"{type(e).__name__}: {e}"[:200]
        payload = got["payload"]
        samples = np.frombuffer(payload, np.uint8)
        peak, mean = int(samples.max()), int(samples.sum(dtype=np.int64)) / len(samples)
        feature = f"ogg;u8;rate={RATE};streams={got['streams']};pages={got['pages']};packets={got['packets']};first_ms={got['first_ms']};last_ms={got['last_ms']};peak={peak};mean={mean:.3f}"
        return got["n_bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = [row(x) for x in batch.column("media").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields[1:]))], names=[n for n, _ in fields])

    return stored.mapInArrow(run, PROBED)
