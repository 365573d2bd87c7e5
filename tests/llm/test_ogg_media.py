import hashlib
import random
import zlib

from gleanmill.llm import ogg_media as ogg
from tests.llm.conftest import rows


def plain_crc(page):
    crc = 0
    for byte in page:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if crc & 0x80000000 else (crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum():
    for n in (0, 1, 27, 300):
        data = random.Random(n).randbytes(n)
        assert ogg.checksum(data) == plain_crc(data)


def test_round_trip_and_times():
    for n in (0, 1, 575, 576, 577, 4608, 70000, 300001):
        data = random.Random(n).randbytes(n)
        streams, bad = ogg.read(b"noise" + ogg.write(data) + b"tail")
        size, payload, feature = ogg.features(streams, bad)
        assert (size, bad, len(payload) % 576) == (n, 0, 0) and payload[:n] == data and set(payload[n:]) <= {255} and payload
        sound = streams[ogg.SAMPLES]
        assert sound.ended and max(sound.granules) == len(payload) and f"duration_us={len(payload) * 1_000_000 // ogg.RATE};" in feature
        known = [g for g in sound.granules if g >= 0]
        assert known == sorted(known)


def test_damage_is_counted_and_left_out():
    media = bytearray(ogg.write(random.Random(5).randbytes(200000)))
    media[100000] ^= 1
    streams, bad = ogg.read(bytes(media))
    assert bad == 1 and streams[ogg.SAMPLES].lost >= 1 and 0 < len(streams[ogg.SAMPLES].packets) < 45
    assert ogg.features(*ogg.read(b""))[:2] == (-1, b"") and ogg.read(b"OggS")[0] == {}
    cut = ogg.write(b"x" * 100000)[:50000]
    assert ogg.read(cut)[1] == 1


def test_documents(edge, empty):
    got = {(r.doc_id, r.n_bytes): r for r in ogg.load(ogg.store(edge)).collect()}
    for r in rows():
        data = (r[1] or "").encode()
        found = got[(r[0], len(data))]
        padded = data + b"\xff" * (-len(data) % 576 or 576 * (not data))
        assert bytes(found.payload) == padded and zlib.crc32(bytes(found.payload)[-32:]) == zlib.crc32(padded[-32:])
    assert ogg.load(ogg.store(empty)).count() == 0
    assert len({hashlib.sha256(bytes(r.media)).hexdigest() for k, r in got.items() if k[0] in (1, 2)}) == 1


def test_start_of_every_packet():
    """Starts counted back from granules equal the sample numbers that the second stream carries, and plain sums."""
    for size in (0, 1, 576, 5000, 300_000):
        streams, bad = ogg.read(ogg.write(bytes(i * 7 % 251 for i in range(size))))
        sound, marks = streams[ogg.SAMPLES], streams[ogg.MARKS]
        sizes = [0, *map(len, sound.packets[1:])]
        starts = ogg.times(sound, sizes)
        assert starts[1:] == [sum(sizes[:i]) for i in range(1, len(sizes))]
        assert starts[1:] == [int.from_bytes(p, "little") for p in marks.packets[1:]]
        assert any(g < 0 for g in sound.granules) == (len(sound.granules) > sound.pages)
        assert "on_marks=1" in ogg.features(streams, bad)[2]


def test_starts_after_a_lost_page():
    """The packets after a damaged page keep their times, for these come from their own granules."""
    media = bytearray(ogg.write(bytes(300_000)))
    whole, _ = ogg.read(bytes(media))
    at = media.find(b"OggS", media.find(b"OggS", media.find(b"OggS", 200) + 4) + 4)
    media[at + 60] ^= 1
    streams, bad = ogg.read(bytes(media))
    sound = streams[ogg.SAMPLES]
    assert bad == 1 and len(sound.packets) < len(whole[ogg.SAMPLES].packets)
    every = ogg.times(whole[ogg.SAMPLES], [0, *map(len, whole[ogg.SAMPLES].packets[1:])])
    assert ogg.times(sound, [0, *map(len, sound.packets[1:])])[-1] == every[-1]
