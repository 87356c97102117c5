import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from stayspark.llm import media

KINDS = [media.PLAIN, media.LZW, media.DEFLATE, media.OLD_DEFLATE, media.PACKBITS]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("tile", [None, (16, 32)])
@pytest.mark.parametrize("predictor", [1, 2])
def test_round_trip_of_pages(kind, order, tile, predictor):
    r = np.random.default_rng(1)
    images = [r.integers(0, 256, (h, w, s), np.uint8) // k * k for h, w, s, k in [(1, 1, 1, 1), (37, 50, 1, 64), (20, 33, 3, 1), (70, 64, 1, 200)]]
    data = media.write_tiff(images, kind, predictor, tile, order, strip_rows=13, description="é 12")
    got = list(media.read_pages(data))
    assert [p.pixels for p in got] == [i.tobytes() for i in images]
    assert [(p.page, p.width, p.height, p.samples, p.tiled) for p in got] == [(k, i.shape[1], i.shape[0], i.shape[2], tile is not None) for k, i in enumerate(images)]
    assert got[0].description == "é 12"


def test_codes_round_trip():
    r = random.Random(2)
    for _ in range(60):
        data = bytes(r.choices(range(r.choice([2, 5, 256])), k=r.choice([0, 1, 2, 127, 128, 129, 700, 9000])))
        assert media.unpack_bits(media.pack_bits(data)) == data
        assert media.lzw_decode(media.lzw_encode(data)) == data
    assert media.unpack_bits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


def test_loops_and_damage():
    data = bytearray(media.write_tiff([np.zeros((4, 4), np.uint8)]))
    struct.pack_into("<I", data, len(data) - 4, struct.unpack_from("<I", data, 4)[0])
    assert len(list(media.read_pages(bytes(data)))) == 1
    for bad in (b"", b"II", b"GIF89a..", bytes(data[:60])):
        with pytest.raises((ValueError, KeyError, struct.error, zlib.error)):
            list(media.read_pages(bad))


def packed(codes):
    bits = "".join(f"{c:09b}" for c in codes)
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))


def test_lzw_codes_of_the_format():
    assert media.lzw_decode(packed([256, 7, 258, 8, 8, 258, 6, 6, 257])) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert media.lzw_decode(packed([256, 65, 66, 258, 260, 259, 257])) == b"ABABABABA"
    for bad in ([256, 300, 257], [256, 65, 400, 257], [65, 66]):
        with pytest.raises((ValueError, IndexError)):
            media.lzw_decode(packed(bad))


def test_damage_never_ends_a_walk():
    r = random.Random(5)
    images = [np.arange(35, dtype=np.uint8).reshape(5, 7), np.full((9, 4, 3), 7, np.uint8), np.zeros((20, 20), np.uint8)]
    for kind in KINDS:
        for tile in (None, (16, 16)):
            whole = media.write_tiff(images, kind, 2, tile, strip_rows=4)
            for _ in range(150):
                data = bytearray(whole)
                for _ in range(r.choice([1, 1, 3])):
                    data[r.randrange(8 if r.random() < 0.5 else 0, len(data))] = r.choice([0, 255, r.randrange(256)])
                got = list(media.walked(bytes(data[: r.choice([len(data), len(data), r.randrange(len(data))])]), 1 << 20))
                assert all(isinstance(p, str) or len(p.pixels) == p.width * p.height * p.samples for p in got)


def test_other_pages_stay_and_sizes_are_checked():
    images = [np.full((4, 4), 1, np.uint8), np.full((4, 4), 2, np.uint8), np.full((4, 4), 3, np.uint8)]
    whole = media.write_tiff(images, media.PLAIN, 1)
    first = struct.unpack_from("<I", whole, 4)[0]
    second = struct.unpack_from("<I", whole, first + 2 + 12 * struct.unpack_from("<H", whole, first)[0])[0]
    for tag, value in ((media.WIDTH, 0), (media.LENGTH, 0), (media.LENGTH, 0xFFFFFFF0), (media.SAMPLES, 0), (media.ROWS_PER_STRIP, 0), (media.COMPRESSION, 77), (media.PREDICTOR, 3)):
        data = bytearray(whole)
        for k in range(struct.unpack_from("<H", data, second)[0]):
            at = second + 2 + 12 * k
            own, kind = struct.unpack_from("<HH", data, at)
            if own == tag:
                struct.pack_into("<H" if kind == 3 else "<I", data, at + 8, value)
        got = list(media.walked(bytes(data)))
        assert [p if isinstance(p, str) else p.pixels[0] for p in got][::2] == [1, 3]
        assert isinstance(got[1], str), tag


def test_texts_come_back(spark):
    rows = [(1, "a"), (2, None), (3, ""), (4, "é" * 40), (5, "x" * 64), (6, "ends in zeros\0\0"), (7, "long text " * 30000), (1, "a"), (None, "b")]
    df = spark.createDataFrame([(*r, b"m") for r in rows], "doc_id long, text string, media binary")
    got = media.text_digests(media.pages(media.store_texts(df))).collect()
    want = []
    for d, t in rows:
        b = (t or "").encode()
        p = b + b"\0" * (-len(b) % 64 or (64 if not b else 0))
        want.append((d, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    ones = {tuple(r)[1:] for r in got if r["doc_id"] == 1}
    assert len(ones) == 1
    assert media.pages(media.store_texts(df.limit(0))).count() == 0


def test_pages_column(spark):
    two = media.write_tiff([np.ones((3, 5), np.uint8), np.full((2, 2, 3), 9, np.uint8)], media.LZW)
    df = spark.createDataFrame([(1, bytearray(two)), (2, None), (3, bytearray(b"junk"))], "doc_id long, media binary")
    got = sorted((r["doc_id"], r["page"], r["width"], r["height"], r["error"] is None) for r in media.pages(df).collect())
    assert got == [(1, 0, 5, 3, True), (1, 1, 2, 2, True), (3, -1, None, None, False)]


def test_long_texts_go_over_several_pages(spark):
    rows = [(k, "é1" * n) for k, n in enumerate([0, 10, 64, 65, 500, 4321])] + [(9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    read = media.pages(media.store_texts(df, most=1000), most=1000).persist()
    assert read.where("page < 0").count() == 0 and read.groupBy("doc_id").count().agg({"count": "max"}).first()[0] == 14
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")
    digests = lambda d: sorted(tuple(r[c] for c in columns) for r in media.text_digests(d).collect())
    assert digests(read) == digests(media.pages(media.store_texts(df)))
    assert len(digests(read)) == len(rows)


def test_parts_stop_at_their_size():
    assert len(media.lzw_decode(media.lzw_encode(bytes(3_000_000)), 1000)) < 8000
    assert len(media.unpack_bits(media.pack_bits(bytes(100_000)), 1000)) < 1200
    assert media.restored(media.lzw_encode(b"abc" * 99), media.LZW, 100) == (b"abc" * 99)[:100]
