"""Tagged image files: the first directory, tiles or strips, their codecs and predictors."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

# Numbers of the format; fixed values.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
CODES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, BANDS, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SAMPLE_FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, TRANSFORM, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113
MODEL_KEY, RASTER_KEY, GEOGRAPHIC_KEY, PROJECTED_KEY = 1024, 1025, 2048, 3072
KINDS = {1: "u", 2: "i", 3: "f"}
CODECS = {"none": 1, "lzw": 5, "deflate": 8, "zstd": 50000}
OLD_DEFLATE = 32946


@dataclass
class Raster:
    """What the directory of a file says; ``offsets`` and ``sizes`` are where its arrays are, (position, bytes an entry)."""

    width: int
    height: int
    bands: int
    dtype: str
    block_w: int
    block_h: int
    compression: int
    predictor: int
    planar: int
    order: str
    nodata: float | None
    transform: tuple[float, float, float, float]
    srid: int | None
    offsets: tuple[int, int] = field(repr=False)
    sizes: tuple[int, int] = field(repr=False)
    tiled: bool = True

    @property
    def across(self) -> int:
        return -(-self.width // self.block_w)

    @property
    def blocks(self) -> int:
        """Of one band."""
        return self.across * -(-self.height // self.block_h)


def read_directory(path: str) -> Raster:
    with open(path, "rb") as f:
        head = f.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None or len(head) < 8:
            raise ValueError(f"{path}: not a tagged image file")
        big = struct.unpack(order + "H", head[2:4])[0] == 43
        at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
        f.seek(at)
        (n,) = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))
        base, step, inline = at + (8 if big else 2), 20 if big else 12, 8 if big else 4
        entries = f.read(n * step)
        tags, where = {}, {}
        for k in range(n):
            tag, kind, count = struct.unpack(order + ("HHQ" if big else "HHI"), entries[k * step : k * step + (12 if big else 8)])
            place = base + k * step + (12 if big else 8)
            if kind not in SIZES:
                continue
            if SIZES[kind] * count > inline:
                f.seek(place)
                place = struct.unpack(order + ("Q" if big else "I"), f.read(inline))[0]
            where[tag] = (place, SIZES[kind])
            if tag in (STRIPS, STRIP_BYTES, TILES, TILE_BYTES) or kind not in CODES:
                continue  # as long as the raster has blocks: tasks read their stretch of it
            f.seek(place)
            raw = f.read(SIZES[kind] * count)
            tags[tag] = raw.rstrip(b"\0").decode("latin-1") if kind == 2 else struct.unpack(f"{order}{count}{CODES[kind]}", raw)
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    if len(set(tags.get(BITS, (1,)))) > 1 or one(BITS, 1) < 8:
        raise ValueError(f"{path}: bands of {tags.get(BITS)} bits can't be read")
    tiled = TILES in where
    dtype = f"{KINDS[one(SAMPLE_FORMAT, 1)]}{one(BITS) // 8}"
    block_w, block_h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (one(WIDTH), min(one(STRIP_ROWS, one(HEIGHT)), one(HEIGHT)))
    nodata = float(tags[NODATA]) if tags.get(NODATA, "").strip() else None
    return Raster(
        one(WIDTH), one(HEIGHT), one(BANDS, 1), dtype, block_w, block_h, one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1), order,
        nodata, placed(path, tags), system_in(tags), where[TILES if tiled else STRIPS], where[TILE_BYTES if tiled else STRIP_BYTES], tiled,
    )


def placed(path: str, tags: dict) -> tuple[float, float, float, float]:
    """(x0, y0, dx, dy) of the outer corner of the first pixel; rotated rasters are refused."""
    if TRANSFORM in tags:
        m = tags[TRANSFORM]
        if m[1] or m[4]:
            raise ValueError(f"{path}: the raster is rotated")
        return m[3], m[7], m[0], m[5]
    if PIXEL_SCALE in tags and TIE_POINT in tags:
        (i, j, _, x, y, _), (dx, dy, _) = tags[TIE_POINT][:6], tags[PIXEL_SCALE][:3]
        return x - i * dx, y + j * dy, dx, -dy
    return 0.0, 0.0, 1.0, 1.0


def system_in(tags: dict) -> int | None:
    keys = tags.get(GEO_KEYS, ())
    told = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    srid = told.get(PROJECTED_KEY) or told.get(GEOGRAPHIC_KEY)
    return srid if srid and srid != 32767 else None


def entries(f, where: tuple[int, int], order: str, first: int, n: int) -> np.ndarray:
    """A stretch of an array of offsets or sizes."""
    f.seek(where[0] + first * where[1])
    return np.frombuffer(f.read(n * where[1]), f"{order}u{where[1]}").astype(np.int64)


def unlzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the most significant bit first; 256 clears the table, 257 ends."""
    table: list[bytes] = []
    out: list[bytes] = []
    bits, n, width, last = 0, 0, 9, b""
    for byte in data:
        bits, n = (bits << 8) | byte, n + 8
        if n < width:
            continue
        n -= width
        code, bits = bits >> n, bits & ((1 << n) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        if not last:
            last = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
            last = entry
        out.append(last)
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    out, bits, n = bytearray(), 0, 0
    fresh = {bytes([k]): k for k in range(256)}
    table, free, width, word = dict(fresh), 258, 9, b""

    def put(code: int, width: int) -> None:
        nonlocal bits, n
        bits, n = (bits << width) | code, n + width
        while n >= 8:
            n -= 8
            out.append(bits >> n)
            bits &= (1 << n) - 1

    put(256, 9)
    for k in range(len(data)):
        longer = word + data[k : k + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer], word = free, data[k : k + 1]
        free += 1
        if free == 4095:
            put(table[word], 12)
            put(256, 12)
            table, free, width, word = dict(fresh), 258, 9, b""
        else:
            width = 9 if free < 512 else 10 if free < 1024 else 11 if free < 2048 else 12
    if word:
        put(table[word], width)
        free += 1
        width = 9 if free < 512 else 10 if free < 1024 else 11 if free < 2048 else 12
    put(257, width)
    if n:
        out.append((bits << (8 - n)) & 255)
    return bytes(out)


def inflated(data: bytes, compression: int) -> bytes:
    if compression == CODECS["none"]:
        return data
    if compression in (CODECS["deflate"], OLD_DEFLATE):
        return zlib.decompress(data)
    if compression == CODECS["lzw"]:
        return unlzw(data)
    if compression == CODECS["zstd"]:
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"no reader for the compression {compression}")


def deflated(data: bytes, compression: int, level: int) -> bytes:
    if compression == CODECS["deflate"]:
        return zlib.compress(data, level)
    if compression == CODECS["lzw"]:
        return lzw(data)
    if compression == CODECS["zstd"]:
        import zstandard

        return zstandard.ZstdCompressor(level=level).compress(data)
    return data


def block_of(data: bytes, r: Raster, rows: int, band: int) -> np.ndarray:
    """(rows, block_w) samples of one band of a stored block."""
    deep, kind = (r.bands if r.planar == 1 else 1), np.dtype(r.order + r.dtype)
    raw = inflated(data, r.compression)
    width = r.block_w * deep
    if r.predictor == 3:  # the bytes of a row by significance, as differences
        rows_of = np.frombuffer(raw, np.uint8, rows * width * kind.itemsize).reshape(rows, -1)
        parts = np.cumsum(rows_of.reshape(rows, -1, deep), axis=1, dtype=np.uint8).reshape(rows, kind.itemsize, width)
        values = np.ascontiguousarray(parts.transpose(0, 2, 1)).view(f">{r.dtype}").reshape(rows, width)
    else:
        values = np.frombuffer(raw, kind, rows * width).reshape(rows, width)
        if r.predictor == 2:
            values = np.cumsum(values.reshape(rows, r.block_w, deep), axis=1, dtype=kind.newbyteorder("=")).reshape(rows, width)
    return values.reshape(rows, r.block_w, deep)[:, :, band if deep > 1 else 0].astype(kind.newbyteorder("="))


def encoded(block: np.ndarray, compression: int, predictor: int, level: int) -> bytes:
    """A block of one band, little-endian."""
    rows, width = block.shape
    if predictor == 2:
        block = np.diff(block, axis=1, prepend=np.zeros((rows, 1), block.dtype))
    elif predictor == 3:
        parts = block.astype(block.dtype.newbyteorder(">")).view(np.uint8).reshape(rows, width, -1).transpose(0, 2, 1).reshape(rows, -1)
        block = np.diff(parts, axis=1, prepend=np.zeros((rows, 1), np.uint8))
    return deflated(block.astype(block.dtype.newbyteorder("<")).tobytes(), compression, level)


def directory(r: Raster, total: int) -> tuple[bytes, int, int, int]:
    """(header, place of the tile offsets, place of the tile sizes, bytes an entry) of a file of one band, its tiles after the header; ``total`` is their bytes."""
    big = total + r.blocks * 16 + 4096 > 1 << 32
    entry, inline = (8, 8) if big else (4, 4)
    long = 16 if big else 4
    kind, bits = {"u": 1, "i": 2, "f": 3}[r.dtype[0]], 8 * int(r.dtype[1:])
    x0, y0, dx, dy = r.transform
    short = lambda *v: (3, v)
    tags = {
        WIDTH: (4, (r.width,)), HEIGHT: (4, (r.height,)), BITS: short(bits), COMPRESSION: short(r.compression), PHOTOMETRIC: short(1), BANDS: short(1), PLANAR: short(1), PREDICTOR: short(r.predictor),
        TILE_WIDTH: (4, (r.block_w,)), TILE_HEIGHT: (4, (r.block_h,)), TILES: (long, r.blocks), TILE_BYTES: (long, r.blocks), SAMPLE_FORMAT: short(kind),
    }
    if dy < 0:
        tags |= {PIXEL_SCALE: (12, (dx, -dy, 0.0)), TIE_POINT: (12, (0.0, 0.0, 0.0, x0, y0, 0.0))}
    else:
        tags[TRANSFORM] = (12, (dx, 0.0, 0.0, x0, 0.0, dy, 0.0, y0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0))
    if r.srid:
        degrees = 4000 <= r.srid < 5000
        tags[GEO_KEYS] = short(1, 1, 0, 3, MODEL_KEY, 0, 1, 2 if degrees else 1, RASTER_KEY, 0, 1, 1, GEOGRAPHIC_KEY if degrees else PROJECTED_KEY, 0, 1, r.srid)
    if r.nodata is not None:
        text = f"{r.nodata:.17g}".encode() + b"\0"
        tags[NODATA] = (2, text)
    base = 16 if big else 8
    at = base + (8 if big else 2) + len(tags) * (20 if big else 12) + (8 if big else 4)
    rows, rest, places = [], b"", {}
    for k, (tag, (kind, values)) in enumerate(sorted(tags.items())):
        count = values if isinstance(values, int) else len(values)
        data = None if isinstance(values, int) else values if kind == 2 else struct.pack(f"<{count}{CODES[kind]}", *values)
        size = SIZES[kind] * count
        place = base + (8 if big else 2) + k * (20 if big else 12) + (12 if big else 8)
        if size <= inline:
            body = (data or b"").ljust(inline, b"\0")
        else:
            place = at + len(rest)
            body = struct.pack("<Q" if big else "<I", place)
            rest += (data if data is not None else bytes(size)).ljust(size + size % 2, b"\0")
        places[tag] = place
        rows.append(struct.pack("<HHQ" if big else "<HHI", tag, kind, count) + body)
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16) if big else struct.pack("<2sHI", b"II", 42, 8)
    whole = head + struct.pack("<Q" if big else "<H", len(tags)) + b"".join(rows) + bytes(8 if big else 4) + rest
    return whole, places[TILES], places[TILE_BYTES], entry
