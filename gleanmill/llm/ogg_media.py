"""Ogg as a media column: write, verify, reassemble, demultiplex, and time.

A text's bytes are stored as 8-bit samples of one logical stream, multiplexed
with a second logical stream of marks that keeps the unpadded length and the
sample number of each packet. Reading goes the way of any Ogg file: pages are
found by their capture pattern, checked by their CRC, and dealt to logical
streams by serial number; packets are put together from lacing values, also
across pages; times come from granule positions, which count samples. A granule is
that of the last packet that a page ends; a packet's start is found by counting the
samples of the packets after it back from there, or, after the last granule, on.

Defined results: a null or empty text is stored as 576 padding bytes; a page
whose checksum is wrong is left out and counted, with the packets that it
touches, and so is a page whose sequence number leaves a gap; bytes between pages
are skipped; media without pages give no streams and an empty payload. Every row
is handled on its own, so repeated rows, ties and hot texts need no care, and
the plan has no shuffle.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release, slices
from gleanmill.session import table

UNIT = 576
PAD = 255
RATE = 8000
PACKET = 8 * UNIT
#: Bytes of text or media handled at a time, or one longer row.
SLICE = 1 << 20
SAMPLES, MARKS = 0x53414D50, 0x4D41524B
CONTINUED, FIRST, LAST = 1, 2, 4
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC (polynomial 04C11DB7, plain bit order) by zlib's mirrored one."""
    crc = zlib.crc32(page.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_MIRROR), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqIII", b"OggS", 0, flags, granule, serial, number, 0) + bytes([len(lacing)]) + lacing
    return head[:22] + struct.pack("<I", checksum(head + body)) + head[26:] + body


def _stream(serial: int, packets: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """(granule, page) of one logical stream; the first packet has a page of its own."""
    number, lacing, body, ended, carried = 0, bytearray(), bytearray(), -1, False
    for i, (granule, packet) in enumerate(packets):
        values = bytes([255]) * (len(packet) // 255) + bytes([len(packet) % 255])
        at = 0
        while values:
            room = 255 - len(lacing)
            now, values = values[:room], values[room:]
            size = sum(now)
            lacing += now
            body += packet[at : at + size]
            at += size
            if not values:
                ended = granule
            final = i == len(packets) - 1 and not values
            if len(lacing) == 255 or final or i == 0:
                flags = CONTINUED * carried | FIRST * (number == 0) | LAST * final
                yield max(granule, 0), _page(flags, ended, serial, number, bytes(lacing), bytes(body))
                number, ended, carried = number + 1, -1, bool(values)
                lacing, body = bytearray(), bytearray()


def write(data: bytes) -> bytes:
    """The Ogg file of one text's bytes."""
    payload = data + bytes([PAD]) * (-len(data) % UNIT or UNIT * (not data))
    sound = [(0, struct.pack("<8sIHH", b"PCM8\0\0\0\0", RATE, 1, 8))]
    marks = [(0, struct.pack("<8sQ", b"MARKS\0\0\0", len(data)))]
    for at in range(0, len(payload), PACKET):
        part = payload[at : at + PACKET]
        sound.append((at + len(part), part))
        marks.append((at + len(part), struct.pack("<Q", at)))
    pages = sorted(
        ((i > 0, granule, order, i, page) for order, s in enumerate((_stream(SAMPLES, sound), _stream(MARKS, marks))) for i, (granule, page) in enumerate(s)),
        key=lambda x: x[:4],
    )
    return b"".join(x[4] for x in pages)


@dataclass
class Stream:
    """One logical stream: whole packets, with the granule position where a page gives one."""

    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    pages: int = 0
    lost: int = 0
    next_number: int = 0
    partial: bytearray | None = None
    ended: bool = False


def read(media: bytes) -> tuple[dict[int, Stream], int]:
    """(logical streams by serial number, pages with a wrong checksum)."""
    streams: dict[int, Stream] = {}
    at, bad = media.find(b"OggS"), 0
    while at >= 0:
        head = media[at : at + 27]
        if len(head) < 27:
            break
        _, version, flags, granule, serial, number, crc = struct.unpack("<4sBBqIII", head[:26])
        lacing = media[at + 27 : at + 27 + head[26]]
        start = at + 27 + head[26]
        end = start + sum(lacing)
        if version or len(lacing) < head[26] or end > len(media) or checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            bad += 1
            at = media.find(b"OggS", at + 4)
            continue
        _take(streams.setdefault(serial, Stream()), flags, granule, number, lacing, media[start:end])
        at = media.find(b"OggS", end)
    return streams, bad


def _take(stream: Stream, flags: int, granule: int, number: int, lacing: bytes, body: bytes) -> None:
    if number != stream.next_number:
        stream.lost += 1
        stream.partial = None
    skip = False
    if flags & CONTINUED:
        skip = stream.partial is None  # its beginning is missing
    elif stream.partial is not None:
        stream.partial, stream.lost = None, stream.lost + 1
    stream.pages, stream.next_number, stream.ended = stream.pages + 1, number + 1, bool(flags & LAST)
    at, last = 0, len(stream.packets)
    size = 0
    for value in lacing:
        size += value
        if value < 255:
            if skip:
                skip = False
            else:
                stream.packets.append(bytes(stream.partial or b"") + body[at : at + size])
                stream.granules.append(-1)
            stream.partial = None
            at, size = at + size, 0
    if size and not skip:
        stream.partial = (stream.partial or bytearray()) + body[at : at + size]
    if granule >= 0 and len(stream.packets) > last:
        stream.granules[-1] = granule


def times(stream: Stream, sizes: list[int]) -> list[int]:
    """The first sample of each packet, from the granule positions; ``sizes`` are samples per packet, 0 for headers."""
    starts = [0] * len(sizes)
    last, at = 0, 0  # packets told so far, and the granule after them
    for i, granule in enumerate(stream.granules):
        if granule < 0:
            continue
        at = granule
        for j in range(i, last - 1, -1):
            at -= sizes[j]
            starts[j] = at
        last, at = i + 1, granule
    for j in range(last, len(sizes)):
        starts[j] = at
        at += sizes[j]
    return starts


def features(streams: dict[int, Stream], bad: int) -> tuple[int, bytes, str]:
    """(unpadded length, payload, feature string) of what was read."""
    sound, marks = streams.get(SAMPLES, Stream()), streams.get(MARKS, Stream())
    rate = struct.unpack("<I", sound.packets[0][8:12])[0] if sound.packets and len(sound.packets[0]) >= 12 else RATE
    size = struct.unpack("<Q", marks.packets[0][8:16])[0] if marks.packets and len(marks.packets[0]) >= 16 else -1
    payload = b"".join(sound.packets[1:])
    wave = np.frombuffer(payload, np.uint8).astype(np.int32) - 128
    last = max([0, *sound.granules])
    starts = times(sound, [0, *map(len, sound.packets[1:])][: len(sound.packets)])[1:]
    told_at = [struct.unpack("<Q", p)[0] for p in marks.packets[1:] if len(p) == 8]
    crossings = int(np.count_nonzero((wave[1:] < 0) != (wave[:-1] < 0))) if len(wave) else 0
    told = {
        "streams": len(streams), "pages": sum(s.pages for s in streams.values()), "bad": bad, "lost": sum(s.lost for s in streams.values()),
        "packets": max(0, len(sound.packets) - 1), "marks": max(0, len(marks.packets) - 1), "rate": rate, "duration_us": last * 1_000_000 // max(rate, 1),
        "starts_us": hashlib.md5(",".join(str(s * 1_000_000 // max(rate, 1)) for s in starts).encode()).hexdigest()[:16], "on_marks": int(starts == told_at),
        "peak": int(np.abs(wave).max()) if len(wave) else 0, "sum": int(wave.sum()), "energy": int((wave.astype(np.int64) ** 2).sum()), "crossings": crossings,
    }
    return size, payload, ";".join(f"{k}={v}" for k, v in told.items())


def store(docs: DataFrame) -> DataFrame:
    """doc_id, media: each text as an Ogg file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in slices(batches, "text", SLICE):
            data = raw.tobytes()
            media = [write(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(media, pa.binary())], ["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, media binary")


def load(stored: DataFrame) -> DataFrame:
    """doc_id, media, n_bytes, payload, feature: what the stored files give when read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in slices(batches, "media", SLICE, binary=True):
            data = raw.tobytes()
            found = [features(*read(data[a:b])) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            more = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *more], ["doc_id", "media", "n_bytes", "payload", "feature"])
        release()

    return stored.select("doc_id", "media").mapInArrow(run, "doc_id long, media binary, n_bytes long, payload binary, feature string")


def op1_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and features of every document's Ogg file, read back from its bytes."""
    return load(store(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
