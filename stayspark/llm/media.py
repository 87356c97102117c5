"""TIFF columns: a reader that walks image directories and a writer for lossless 8-bit pages.

`read_pages` yields one page for each directory of a file, of either byte order, in strips or tiles, stored plain or under
PackBits, LZW or deflate, with no predictor or horizontal differencing. `pages` does that to a binary column, one row a page.

Defined results: a null file has no page; a file or page that can't be read (damage, a size of zero, parts that lack or run over, more
than MOST_SAMPLES) gives one row with page -1 and the reason in `error`, and the file's other pages stay;
null and empty texts are stored as one block of 64 zero bytes; repeated rows give repeated pages; other columns are dropped,
but for the id; an empty table gives no page.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, slices, table, texts

BLOCK = 64
STRIP_ROWS = 1024
MOST_SAMPLES = 1 << 28  # of one page
HELD = 32 << 20  # bytes of pages that a task holds before it hands them on
# TIFF 6.0 fixed values: bytes of each field type, and the tags used here.
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_BYTES = (
    256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325,
)
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773


@dataclass
class Page:
    page: int
    width: int
    height: int
    samples: int
    compression: int
    predictor: int
    tiled: bool
    pixels: bytes
    description: str | None = None


def unpack_bits(data: bytes, most: int | None = None) -> bytes:
    """The bytes of a PackBits part; it stops once there are `most`."""
    out, i = bytearray(), 0
    while i < len(data) and (most is None or len(out) < most):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    out, i, literal = bytearray(), 0, bytearray()

    def flush() -> None:
        for k in range(0, len(literal), 128):
            part = literal[k : k + 128]
            out.append(len(part) - 1)
            out.extend(part)
        literal.clear()

    while i < len(data):
        n = 1
        while n < 128 and i + n < len(data) and data[i + n] == data[i]:
            n += 1
        if n > 2:
            flush()
            out += bytes([257 - n, data[i]])
        else:
            literal += data[i : i + n]
        i += n
    flush()
    return bytes(out)


def lzw_decode(data: bytes, most: int | None = None) -> bytes:
    """TIFF's LZW: codes from the high bit on, 9 to 12 bits, widths change one code early; 256 clears, 257 ends.

    A reader knows one word fewer than the writer, so its widths change at 511 words where the writer's do at 512. It stops
    once there are `most` bytes: a word is a few thousand bytes at most, whatever a damaged part asks for."""
    out, names = bytearray(), []
    last, width, held, bits = None, 9, 0, 0
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 256:
            names, last, width = [bytes([k]) for k in range(256)] + [b"", b""], None, 9
            continue
        if code == 257:
            break
        if code > len(names) or (last is None and code > 255):
            raise ValueError("an LZW code that is not known yet")
        if last is None:
            word = names[code]
        else:
            word = names[code] if code < len(names) else last + last[:1]
            names.append(last + word[:1])
        out += word
        if most is not None and len(out) >= most:
            break
        last = word
        width = 9 if len(names) < 511 else 10 if len(names) < 1023 else 11 if len(names) < 2047 else 12
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append((held >> bits) & 255)
            held &= (1 << bits) - 1

    fresh = {bytes([k]): k for k in range(256)}
    codes, size, width, word = dict(fresh), 258, 9, b""
    put(256, width)
    for k in range(len(data)):
        longer = word + data[k : k + 1]
        if longer in codes:
            word = longer
            continue
        put(codes[word], width)
        codes[longer] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        word = data[k : k + 1]
        if size == 4093:
            put(codes[word], width)
            put(256, width)
            codes, size, width, word = dict(fresh), 258, 9, b""
    if word:
        put(codes[word], width)
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257, width)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


def stored(data: bytes, compression: int) -> bytes:
    if compression == PLAIN:
        return data
    return {LZW: lzw_encode, PACKBITS: pack_bits}.get(compression, lambda x: zlib.compress(x, 1))(data)


def restored(data: bytes, compression: int, most: int | None = None) -> bytes:
    """The bytes of a part; no more than about `most` are made."""
    if compression == PLAIN:
        return data
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, most or 0)
    if compression in (LZW, PACKBITS):
        return (lzw_decode if compression == LZW else unpack_bits)(data, most)[:most]
    raise ValueError(f"compression {compression}")


def differenced(block: np.ndarray) -> np.ndarray:
    """Horizontal differences of (rows, columns, samples), modulo 256."""
    out = block.copy()
    out[:, 1:] -= block[:, :-1]
    return out


def write_tiff(images: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, tile: tuple[int, int] | None = None, order: str = "<", strip_rows: int = STRIP_ROWS, description: str | None = None) -> bytes:
    """A file of 8-bit pages, each of shape (rows, columns) or (rows, columns, samples)."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 0))
    link = 4
    for image in images:
        image = image.reshape(*image.shape[:2], -1)
        height, width, samples = image.shape
        if tile:
            th, tw = tile
            parts = [np.pad(x := image[y : y + th, c : c + tw], ((0, th - x.shape[0]), (0, tw - x.shape[1]), (0, 0))) for y in range(0, height, th) for c in range(0, width, tw)]
        else:
            parts = [image[y : y + strip_rows] for y in range(0, height, strip_rows)]
        offsets, counts = [], []
        for part in parts:
            data = stored((differenced(part) if predictor == 2 else part).tobytes(), compression)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        fields = {WIDTH: (4, [width]), LENGTH: (4, [height]), BITS: (3, [8] * samples), COMPRESSION: (3, [compression]), PHOTOMETRIC: (3, [2 if samples >= 3 else 1]), SAMPLES: (3, [samples]), PLANAR: (3, [1]), PREDICTOR: (3, [predictor])}
        fields |= {TILE_WIDTH: (4, [tw]), TILE_LENGTH: (4, [th]), TILE_OFFSETS: (4, offsets), TILE_BYTES: (4, counts)} if tile else {STRIP_OFFSETS: (4, offsets), ROWS_PER_STRIP: (4, [strip_rows]), STRIP_BYTES: (4, counts)}
        if description is not None:
            fields[DESCRIPTION] = (2, description.encode() + b"\0")
        entries = bytearray()
        for tag, (kind, values) in sorted(fields.items()):
            data = values if kind == 2 else struct.pack(f"{order}{len(values)}{'HI'[kind == 4]}", *values)
            if len(data) > 4:
                out += b"\0" * (len(out) % 2)
                at = len(out)
                out += data
                data = struct.pack(f"{order}I", at)
            entries += struct.pack(f"{order}HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(fields)) + entries
        link = len(out)
        out += b"\0" * 4
    return bytes(out)


def _fields(data: bytes, at: int, order: str) -> tuple[dict[int, list], int]:
    (n,) = struct.unpack_from(f"{order}H", data, at)
    out = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        size = TYPE_SIZE.get(kind, 0) * count
        where = at + 10 + 12 * k
        if size > 4:
            (where,) = struct.unpack_from(f"{order}I", data, where)
        if kind == 2:
            out[tag] = [data[where : where + count].split(b"\0")[0].decode("utf-8", "replace")]
        elif kind in (1, 3, 4):
            out[tag] = list(struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", data, where))
    (following,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
    return out, following


def _page(data: bytes, tags: dict[int, list], number: int, most: int) -> Page:
    """One page's pixels. What its directory says is checked before anything of that size is made: ValueError."""

    def one(tag: int, default: int | None = None) -> int:
        value = (tags.get(tag) or [default])[0]
        if not isinstance(value, int):
            raise ValueError(f"no tag {tag}")
        return value

    width, height, samples, compression, predictor = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, 1), one(PREDICTOR, 1)
    if set(tags.get(BITS, [1])) != {8} or one(PLANAR, 1) != 1 or predictor not in (1, 2):
        raise ValueError("only interleaved 8-bit samples, with no predictor or differences")
    tiled = TILE_OFFSETS in tags
    rows, columns = (one(TILE_LENGTH), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    if min(width, height, samples, rows, columns) < 1:
        raise ValueError("a size of zero")
    across, down = -(-width // columns), -(-height // rows)
    if width * height * samples > most or across * columns * down * rows * samples > 4 * most:
        raise ValueError(f"more than {most} samples")
    offsets, counts = (tags.get(k, []) for k in ((TILE_OFFSETS, TILE_BYTES) if tiled else (STRIP_OFFSETS, STRIP_BYTES)))
    if len(offsets) != across * down or len(counts) != len(offsets):
        raise ValueError(f"{len(offsets)} parts and {len(counts)} sizes in place of {across * down}")
    image = np.zeros((height, width, samples), np.uint8)
    for k, (offset, count) in enumerate(zip(offsets, counts, strict=True)):
        y, x = k // across * rows, k % across * columns
        here = rows if tiled else min(rows, height - y)
        if offset + count > len(data):
            raise ValueError("a part lies beyond the end")
        raw = restored(data[offset : offset + count], compression, here * columns * samples)
        if len(raw) < here * columns * samples:
            raise ValueError("a part is too short")
        block = np.frombuffer(raw, np.uint8, here * columns * samples).reshape(here, columns, samples)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        image[y : y + rows, x : x + columns] = block[: height - y, : width - x]
    return Page(number, width, height, samples, compression, predictor, tiled, image.tobytes(), tags.get(DESCRIPTION, [None])[0])


def walked(data: bytes, most: int = MOST_SAMPLES) -> Iterator[Page | str]:
    """Each page, or what is wrong with it. A page that can't be read doesn't end the walk: its directory still names the next
    one. A directory that can't be read does. Directories in a loop are read once."""
    try:
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None or len(data) < 8 or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
            raise ValueError("not a TIFF")
        (at,) = struct.unpack_from(f"{order}I", data, 4)
        if not at:
            raise ValueError("no page")
    except (ValueError, struct.error) as e:
        yield str(e)
        return
    seen: set[int] = set()
    while at and at not in seen:
        seen.add(at)
        try:
            tags, following = _fields(data, at, order)
        except (ValueError, KeyError, IndexError, OverflowError, struct.error) as e:
            yield f"directory at {at}: {e}"
            return
        try:
            yield _page(data, tags, len(seen) - 1, most)
        except (ValueError, KeyError, IndexError, TypeError, ArithmeticError, MemoryError, struct.error, zlib.error) as e:
            yield f"page {len(seen) - 1}: {e or type(e).__name__}"
        at = following


def read_pages(data: bytes, most: int = MOST_SAMPLES) -> Iterator[Page]:
    """All pages; ValueError at the first thing that is wrong."""
    for page in walked(data, most):
        if isinstance(page, str):
            raise ValueError(page)
        yield page


_PAGES = pa.schema([("doc_id", pa.int64()), ("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("pixels", pa.binary()), ("media", pa.binary()), ("description", pa.string()), ("error", pa.string())])
PAGES = "doc_id long, page int, width int, height int, samples int, compression int, predictor int, tiled boolean, pixels binary, media binary, description string, error string"


def pages(files: DataFrame, id_col: str = "doc_id", media_col: str = "media", most: int = MOST_SAMPLES) -> DataFrame:
    """One row for each page of each file; `media` is the file itself, on its first row only. What can't be read is a row with
    page -1 and an error: a damaged page, a page of more than `most` samples (the bound of a task's memory), a file that is no TIFF."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return arrow_rows(_PAGES, **dict(zip(_PAGES.names, zip(*rows, strict=True), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "media"):
                rows: list[tuple] = []
                held = 0
                for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                    if data is None:
                        continue
                    media = data  # only once, on the file's first row
                    for p in walked(data, most):
                        if isinstance(p, str):
                            rows.append((doc, -1, *[None] * 7, media, None, p))
                        else:
                            rows.append((doc, p.page, p.width, p.height, p.samples, p.compression, p.predictor, p.tiled, p.pixels, media, p.description, None))
                        held += len(rows[-1][8] or b"") + len(media or b"")
                        media = None
                        if held > HELD:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)

    return files.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media")).mapInArrow(run, PAGES)


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", compression: int = DEFLATE, most: int = MOST_SAMPLES) -> DataFrame:
    """(doc_id, media): each text's bytes as grey pages, 64 wide, ended with zeros; the description says how many bytes it has. A
    text goes over as many pages of at most `most` samples as it needs."""
    a_page = max(most // BLOCK, 1)
    schema = pa.schema([("doc_id", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                media = []
                for text in texts(batch):
                    padded = text.ljust(max(BLOCK, -(-len(text) // BLOCK) * BLOCK), b"\0")
                    lines = np.frombuffer(padded, np.uint8).reshape(-1, BLOCK)
                    media.append(write_tiff([lines[k : k + a_page] for k in range(0, len(lines), a_page)], compression, description=str(len(text))))
                yield arrow_rows(schema, doc_id=batch.column("doc_id"), media=media)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, media binary")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class _Digest:
    """What is known of a file from its pages so far."""

    def __init__(self, doc: int | None, media: bytes, description: str) -> None:
        self.head = (doc, int(description))
        self.media = (len(media), hashlib.sha256(media).hexdigest())
        self.sha, self.seen, self.rows, self.tail = hashlib.sha256(), np.zeros(256, np.int64), 0, b""

    def add(self, pixels: bytes, height: int) -> None:
        self.sha.update(pixels)
        self.seen += np.bincount(np.frombuffer(pixels, np.uint8), minlength=256)
        self.rows, self.tail = self.rows + height, pixels[-BLOCK:]

    def row(self) -> tuple:
        seen = [int(x) for x in self.seen]
        n, total, squares = sum(seen), sum(k * x for k, x in enumerate(seen)), sum(k * k * x for k, x in enumerate(seen))
        feature = f"rows={self.rows};mean={total * 1000 // n};var={(n * squares - total * total) // (n * n)};values={sum(x > 0 for x in seen)}"
        return (*self.head, n, self.sha.hexdigest(), zlib.crc32(self.tail), *self.media, feature)


def text_digests(read: DataFrame) -> DataFrame:
    """Digests and a feature of each file of store_texts over all its pages: rows, mean (in thousandths) and variance of samples, and
    distinct values. Pages come in the order in which `pages` makes them; a file begins where its media is."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            rows = []
            for doc, pixels, media, height, description in zip(*[batch.column(k).to_pylist() for k in ("doc_id", "pixels", "media", "height", "description")], strict=True):
                if media is not None:
                    if now is not None:
                        rows.append(now.row())
                    now = _Digest(doc, media, description)
                now.add(pixels, height)
            if rows:
                yield arrow_rows(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))
        if now is not None:
            yield arrow_rows(schema, **dict(zip(schema.names, ([x] for x in now.row()), strict=True)))

    return read.where("page >= 0").select("doc_id", "pixels", "media", "height", "description").mapInArrow(run, DIGEST)


def op7_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_digests(pages(store_texts(table(spark, sf_dir, "documents"))))
