"""Overlays: the shapes of a page drawn on its prepared image, read and written as PNG by the task that has the page."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import folder_uid
from gridloom.sources.files import content, joined, write_file

# The file's signature, channels by colour type, the colours of shapes, the largest overlay.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
COLOURS = {"blue": (0, 0, 255), "red": (255, 0, 0), "green": (0, 128, 0), "orange": (255, 165, 0)}
LARGEST = (2200, 3000)
#: Pixels of an image at most; a larger one is an error in its row.
PIXELS = 1 << 27


def _unfiltered(data: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """Rows of bytes from filtered ones; ``step`` bytes back lies the same channel of the pixel before."""
    rows = np.frombuffer(data, np.uint8, height * (stride + 1)).reshape(height, stride + 1)
    out = np.zeros((height, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(height):
        kind, row = rows[y, 0], rows[y, 1:]
        if kind == 0:
            out[y] = row
        elif kind == 1:
            for c in range(step):
                out[y, c::step] = np.cumsum(row[c::step], dtype=np.uint8)
        elif kind == 2:
            out[y] = row + above
        elif kind in (3, 4):
            now, up, raw = [0] * (stride + step), [0] * step + above.tolist(), row.tolist()
            for i in range(stride):
                left, top, corner = now[i], up[i + step], up[i]
                if kind == 3:
                    guess = (left + top) // 2
                else:
                    a, b, c = abs(top - corner), abs(left - corner), abs(left + top - 2 * corner)
                    guess = left if a <= b and a <= c else top if b <= c else corner
                now[i + step] = (raw[i] + guess) & 255
            out[y] = now[step:]
        else:
            raise ValueError("unknown filter")
        above = out[y]
    return out


def read_png(data: bytes) -> np.ndarray:
    """Red, green and blue of each pixel, whatever the file's colour type and depth; transparency is left out."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, parts, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            break
        at += size + 12
    if head is None or not parts:
        raise ValueError("the file has no image")
    width, height, depth, colour, _, _, interlaced = head
    if interlaced or colour not in CHANNELS or depth not in (1, 2, 4, 8, 16) or width * height > PIXELS:
        raise ValueError("this kind or size of PNG isn't read")
    bits = depth * CHANNELS[colour]
    stride = -(-width * bits // 8)
    need = height * (stride + 1)
    raw = zlib.decompressobj().decompress(b"".join(parts), need)
    if len(raw) < need:
        raise ValueError("the image is cut off")
    rows = _unfiltered(raw, height, stride, max(1, bits // 8))
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        rows = np.unpackbits(rows, axis=1).reshape(height, -1, depth) @ (1 << np.arange(depth)[::-1])
        rows = rows[:, :width]
        rows = (rows if colour == 3 else rows * 255 // ((1 << depth) - 1)).astype(np.uint8)
    pixels = rows.reshape(height, width, CHANNELS[colour])
    if colour == 3:
        if palette is None or pixels.max(initial=0) >= len(palette):
            raise ValueError("the palette is too short")
        return palette[pixels[..., 0]]
    return np.ascontiguousarray(np.repeat(pixels[..., :1], 3, axis=2) if colour in (0, 4) else pixels[..., :3])


def write_png(pixels: np.ndarray) -> bytes:
    """An 8-bit RGB file; rows are kept as their differences from the row above."""
    height, width, _ = pixels.shape
    rows = pixels.reshape(height, -1)
    lines = np.concatenate([np.full((height, 1), 2, np.uint8), rows - np.concatenate([np.zeros((1, rows.shape[1]), np.uint8), rows[:-1]])], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _fill(pixels: np.ndarray, x0: float, y0: float, x1: float, y1: float, colour: tuple[int, int, int]) -> None:
    """All pixels from (x0, y0) to (x1, y1), both inside, as far as they lie in the image."""
    a, b, c, d = (int(np.floor(v)) for v in (x0, y0, x1, y1))
    if c >= 0 and d >= 0:
        pixels[max(0, b) : d + 1, max(0, a) : c + 1] = colour


def draw(pixels: np.ndarray, shapes: Sequence[tuple[str, int, float, float, float, float]]) -> None:
    """Shapes (colour, width, x0, y0, x1, y1) in order: boxes with their edges inside, upright and level lines around their middle."""
    for colour, width, x0, y0, x1, y1 in shapes:
        own, back, on = COLOURS[colour], (width - 1) // 2, width // 2
        if x0 == x1:
            _fill(pixels, x0 - back, y0, x0 + on, y1, own)
        elif y0 == y1:
            _fill(pixels, x0, y0 - back, x1, y0 + on, own)
        else:
            w = width - 1
            for box in ((x0, y0, x1, min(y1, y0 + w)), (x0, max(y0, y1 - w), x1, y1), (x0, y0, min(x1, x0 + w), y1), (max(x0, x1 - w), y0, x1, y1)):
                _fill(pixels, *box, own)


def shrunk(pixels: np.ndarray, largest: tuple[int, int] = LARGEST) -> np.ndarray:
    """No larger than (width, height), in the same shape: each new pixel is the mean of those it covers."""
    height, width, _ = pixels.shape
    scale = min(1.0, largest[0] / width, largest[1] / height)
    if scale == 1.0:
        return pixels
    w, h = max(1, round(width * scale)), max(1, round(height * scale))
    for axis, new in ((0, h), (1, w)):
        bounds = np.arange(new + 1) * pixels.shape[axis] // new
        sums = np.add.reduceat(pixels.astype(np.uint32), bounds[:-1], axis=axis)
        counts = np.diff(bounds).reshape((-1, 1, 1) if axis == 0 else (1, -1, 1))
        pixels = ((sums + counts // 2) // counts).astype(np.uint8)
    return pixels


def write_overlays(shapes: DataFrame, images: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Draw each page that has an image and write ``<out>/<folder_uid>/page<number>_overlay.png``: keys and error (null: written).

    ``shapes`` as in ``sinks.overlay_shapes``, of the page's own size; ``images`` has folder, page and image (its path).  A page's shapes are
    drawn by one task.  A picture that can't be read or written is an error in its row; pages without one have no row.
    """
    kinds = dict(shapes.dtypes)
    order = F.array_position(F.array(*[F.lit(c) for c in COLOURS]), F.col("colour"))
    drawn = shapes.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "x0", "y0", "x1", "y1", "width", "colour"))).alias("_s"))
    place = images.select(folder_uid(F.col("folder")).alias("folder_uid"), "page", "image").groupBy("folder_uid", "page").agg(F.min("image").alias("image"))

    def paint(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            errors = []
            for row in batch.to_pylist():
                error = None
                try:
                    data = content(row["image"])
                    if data is None:
                        raise FileNotFoundError(row["image"])
                    pixels = read_png(data).copy()
                    draw(pixels, [(s["colour"], s["width"], s["x0"], s["y0"], s["x1"], s["y1"]) for s in row["_s"] or []])
                    write_file(joined(joined(out, row["folder_uid"]), f"page{row['page']:04d}_overlay.png"), write_png(shrunk(pixels)))
                except Exception as e:
                    error = str(e) or type(e).__name__
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], pa.array(errors, pa.string())], [*keys, "error"])

    return drawn.join(place, ["folder_uid", "page"]).select(*keys, "image", "_s").mapInArrow(paint, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", error string")
