"""Media columns: lossless WebP (VP8L) files in binary columns, read into pixel arrays and written from samples."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format: the order in which code length code lengths are stored, and the (x, y) offsets
# that the 120 shortest distance codes stand for.
_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
_NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3),
    (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3),
    (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5),
    (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7),
    (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7),
    (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6),
    (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
_NEAR_X, _NEAR_Y = (np.array([p[i] for p in _NEAR]) for i in (0, 1))
_CACHE_FACTOR = 0x1E35A7BD
_OPAQUE = 0xFF000000
MAX_SIDE = 16384


class Bits:
    """Reads numbers of up to 32 bits, lowest bit first; beyond the end bits are 0."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def __call__(self, n: int) -> int:
        byte, shift = self.at >> 3, self.at & 7
        self.at += n
        return (int.from_bytes(self.data[byte : byte + 8], "little") >> shift) & ((1 << n) - 1)


class PrefixCode:
    """A canonical prefix code as a table over its longest code's bits."""

    def __init__(self, lengths: np.ndarray) -> None:
        used = lengths.nonzero()[0]
        self.single = int(used[0]) if len(used) == 1 else 0 if not len(used) else None
        if self.single is not None:
            self.top = 0
            return
        sizes = lengths[used]
        self.top = max(sizes.tolist())
        self.mask = (1 << self.top) - 1
        if len(used) <= 24 and used[-1] < 256:  # few steps
            symbols, taken, code, reverse = bytearray(1 << self.top), bytearray(1 << self.top), 0, _reversals()
            for n, symbol in sorted(zip(sizes.tolist(), used.tolist(), strict=True)):
                if code == 1 << 15:
                    raise ValueError("the prefix code isn't complete")
                at, room = reverse[code], 1 << (self.top - n)
                code += 1 << (15 - n)
                symbols[at :: 1 << n], taken[at :: 1 << n] = bytes((symbol,)) * room, bytes((n,)) * room
            if code != 1 << 15:
                raise ValueError("the prefix code isn't complete")
            self.symbols, self.lengths = np.frombuffer(symbols, np.uint8), np.frombuffer(taken, np.uint8)
            return
        order = sizes.argsort(kind="stable")
        sizes = sizes[order].astype(np.int64)
        room = np.int64(1) << (self.top - sizes)
        if (1 << self.top) != room.sum():
            raise ValueError("the prefix code isn't complete")
        both = ((used[order] << 4) | sizes).astype(np.uint16).repeat(room).take(_reversal(self.top))
        self.symbols, self.lengths = (both >> np.uint16(4)).view(np.int16), both.astype(np.uint8) & np.uint8(15)

    def read(self, bits: Bits) -> int:
        if self.single is not None:
            return self.single
        byte = bits.at >> 3
        i = (int.from_bytes(bits.data[byte : byte + 4], "little") >> (bits.at & 7)) & ((1 << self.top) - 1)
        bits.at += int(self.lengths[i])
        return int(self.symbols[i])


def reversed_bits(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    for i in range(n):
        out |= ((x >> i) & 1) << (n - 1 - i)
    return out


@cache
def _reversal(n: int) -> np.ndarray:
    """All numbers of ``n`` bits, 15 at most, with their bits in reverse."""
    return reversed_bits(np.arange(1 << n), n)


class LengthSteps(dict):
    """By the 12 bits that follow: the code lengths that whole signs in them give, their bits, and how many signs they are.

    It ends before a sign that repeats the last length, and before one whose bits aren't all there.
    """

    def __init__(self, code: PrefixCode) -> None:
        super().__init__()
        self.code = code

    def sign(self, ahead: int) -> tuple[int, int, int]:
        """The first sign, how often it stands and its bits."""
        code = self.code
        i = ahead & ((1 << code.top) - 1)
        s, n = (code.single, 0) if code.single is not None else (int(code.symbols[i]), int(code.lengths[i]))
        if s < 16:
            return s, 1, n
        extra, least = ((2, 3), (3, 3), (7, 11))[s - 16]
        return s, least + ((ahead >> n) & ((1 << extra) - 1)), n + extra

    def __missing__(self, ahead: int) -> tuple[bytes, int, int]:
        out, used, signs = b"", 0, 0
        while self.code.single is None:
            s, times, n = self.sign(ahead >> used)
            if s == 16 or used + n > 12:
                break
            out, used, signs = out + (bytes((s,)) if s < 16 else bytes(times)), used + n, signs + 1
        self[ahead] = out, used, signs
        return self[ahead]


@lru_cache(maxsize=16)
def _length_code(lengths: bytes) -> LengthSteps:
    return LengthSteps(PrefixCode(np.frombuffer(lengths, np.uint8)))


@cache
def _reversals() -> list[int]:
    return _reversal(15).tolist()


@lru_cache(maxsize=256)
def _code_of_one(symbol: int) -> PrefixCode:
    return PrefixCode(np.bincount([symbol]))


def read_code(bits: Bits, size: int) -> PrefixCode:
    data = bits.data
    ahead = int.from_bytes(data[bits.at >> 3 : (bits.at >> 3) + 9], "little") >> (bits.at & 7)
    if ahead & 7 == 5:  # one symbol of 8 bits
        bits.at += 11
        return _code_of_one(ahead >> 3 & 255)
    if ahead & 1:
        wide = 8 if ahead & 4 else 1
        first = ahead >> 3 & ((1 << wide) - 1)
        bits.at += 3 + wide
        if not ahead & 2:
            return _code_of_one(first)
        lengths = np.zeros(size, dtype=np.uint8)
        lengths[first] = lengths[bits(8)] = 1
        return PrefixCode(lengths)
    stored = 4 + (ahead >> 1 & 15)
    of_lengths = bytearray(19)
    for i, s in enumerate(_LENGTH_ORDER[:stored]):
        of_lengths[s] = ahead >> (5 + 3 * i) & 7
    bits.at += 5 + 3 * stored
    steps = _length_code(bytes(of_lengths))
    left = size
    if bits(1):
        left = 2 + bits(2 + 2 * bits(3))
    out, at = bytearray(), bits.at
    while len(out) < size and left:
        ahead = int.from_bytes(data[at >> 3 : (at >> 3) + 25], "little") >> (at & 7)
        for _ in range(15):  # 15 steps have 14 bits at most
            part, n, signs = steps[ahead & 4095]
            if not signs or signs > left or len(out) + len(part) > size:
                s, times, n = steps.sign(ahead)
                signs, part = 1, bytes((s if s < 16 else 0 if s > 16 else next((x for x in reversed(out) if x), 8),)) * times
            out += part
            left -= signs
            ahead >>= n
            at += n
            if len(out) >= size or not left:
                break
    bits.at = at
    if len(out) > size:
        raise ValueError("too many code lengths")
    return PrefixCode(np.frombuffer(bytes(out).ljust(size, b"\0"), np.uint8))


def _prefixed(symbol: int, bits: Bits) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits(extra) + 1


#: Extra bits of the length and distance symbols, and the value that each begins with.
_EXTRA = np.array([0, 0, 0, 0, *[(s - 2) >> 1 for s in range(4, 40)]], dtype=np.int64)
_BASE = np.array([1, 2, 3, 4, *[((2 + (s & 1)) << ((s - 2) >> 1)) + 1 for s in range(4, 40)]], dtype=np.int64)


_EIGHT = np.resize(np.arange(8, dtype=np.uint32), 1 << 17)


@lru_cache(maxsize=256)
def _near_distances(width: int) -> np.ndarray:
    """The distances of the 120 shortest distance codes."""
    return np.maximum(1, _NEAR_X + _NEAR_Y * width)


def _followed(src: np.ndarray) -> np.ndarray:
    """Where each place of ``src`` leads to in the end; places lead back or to themselves."""
    while True:
        after = src.take(src)
        if (after == src).all():
            return src
        src = after


def _run(bits: Bits, codes: list[PrefixCode], n: int, width: int, cache_bits: int) -> np.ndarray | None:
    """``n`` pixels of one group of codes, all at once; None for what is left to the plain loop.

    What a token at each bit would be is looked up for all bits; from the first, one token leads to the next.  Each
    pixel that is a copy or a cache entry points to an earlier one, and all pointers are followed together.
    """
    g, r, b, a, d = codes
    begin = bits.at >> 3
    data = bits.data[begin : begin + n * 8 + 8]
    window = np.ndarray(len(data), "<u4", data + b"\0\0\0", 0, 1)  # 32 bits from every byte
    ahead = window.repeat(8)
    ahead >>= _EIGHT[: len(ahead)] if len(ahead) <= len(_EIGHT) else np.resize(_EIGHT, len(ahead))  # 25 bits from every bit
    total = len(ahead)
    inside = lambda p: np.minimum(p, total - 1)

    def look(code: PrefixCode, p: np.ndarray | slice) -> tuple[np.ndarray | int, np.ndarray | int]:
        if code.single is not None:
            return code.single, 0
        i = (ahead[p] & np.uint32(code.mask)).astype(np.intp)
        return code.symbols.take(i), code.lengths.take(i)

    index = (ahead & np.uint32(g.mask)).astype(np.intp)
    literals = g.symbols.max() < 256
    size = (g.lengths if literals else g.lengths | ((g.symbols > 255) & ((g.symbols < 280) if cache_bits else True)).view(np.uint8) << np.uint8(4)).take(index)  # 16 more for a copy
    copies = np.zeros(0, np.int64) if literals else (size > 15).nonzero()[0]
    size[copies] &= np.uint8(15)
    step, place = size, np.arange(total)
    if any(c.single is None for c in (r, b, a)):
        at = place + size
        for c in (r, b, a):
            if c.single is None:
                at = at + c.lengths.take(ahead.take(at, mode="clip") & np.uint32(c.mask))
        step = np.where(g.symbols.take(index) < 256, at - place, size)
    following = np.arange(total + 64)  # places past the end lead to themselves; no token has more bits than 4 * 15, or 15 + 10 + 15 + 18
    np.add(place, step, out=following[:total])
    if len(copies):
        sort = g.symbols.take(index[copies]).astype(np.int64) - 256
        lengths_at = copies + size[copies]
        distance_at = inside(lengths_at + _EXTRA[sort])
        s, taken = look(d, distance_at)
        s = s.astype(np.int64) if d.single is None else np.full(len(copies), s)
        distance_at = distance_at + taken
        following[copies] = distance_at + _EXTRA[s]
    far = following
    for _ in range(3):
        far = far.take(far)
    tokens = np.full((8, -(-n // 8)), total)
    leads, walk, p = memoryview(far), memoryview(tokens[0]), bits.at & 7
    for i in range(len(walk)):
        walk[i] = p
        p = leads[p]
        if p >= total:
            break
    for i in range(1, 8):
        tokens[i] = following.take(tokens[i - 1])
    tokens = tokens.T.ravel()
    tokens = tokens[: int(tokens.searchsorted(total))]  # the others are past the end
    kinds = g.symbols.take(index.take(tokens))
    copied = (kinds >= 256) & (kinds < 280) if cache_bits else kinds > 255
    long = np.ones(len(tokens), dtype=np.int64)
    field = lambda at, extra: ahead.take(at, mode="clip") & ((np.int64(1) << extra) - 1)
    if copied.any():
        met = copies.searchsorted(tokens[copied])
        sort, s = sort[met], s[met]
        long[copied] = _BASE[sort] + field(lengths_at[met], _EXTRA[sort])
        back = _BASE[s] + field(distance_at[met], _EXTRA[s])
    ends = long.cumsum()
    used = int(ends.searchsorted(n)) + 1
    if used > len(ends) or ends[used - 1] != n:
        raise ValueError("the pixels end early or a back-reference leaves the image")
    tokens, kinds, copied, long, ends = tokens[:used], kinds[:used], copied[:used], long[:used], ends[:used]
    end = int(following[tokens[-1]])
    first = ends - long

    out = np.zeros(n, dtype=np.uint32)
    plain = kinds < 256
    at = tokens[plain]
    colour = kinds[plain].astype(np.uint32) << np.uint32(8)
    colour |= np.uint32(sum((c.single or 0) << shift for c, shift in ((r, 16), (b, 0), (a, 24))))
    if any(c.single is None for c in (r, b, a)):
        at = at + size[at]
        for c, shift in ((r, 16), (b, 0), (a, 24)):
            if c.single is None:
                s, taken = look(c, inside(at))
                colour |= s.astype(np.uint32) << np.uint32(shift)
                at = at + taken
    out[first[plain]] = colour
    if copied.any():
        back = back[: int(copied.sum())]
        near = _near_distances(width)
        back = np.where(back > 120, back - 120, near[np.minimum(back, 120) - 1])
        if (back > first[copied]).any():
            raise ValueError("a back-reference leaves the image")
        if not cache_bits:  # nothing else is looked up, so copies are made one by one
            made = memoryview(out).cast("B")
            for at, times, far_back in zip((4 * first[copied]).tolist(), (4 * long[copied]).tolist(), (4 * back).tolist(), strict=True):
                if far_back >= times:
                    made[at : at + times] = made[at - far_back : at - far_back + times]
                else:
                    made[at : at + times] = (bytes(made[at - far_back : at]) * -(-times // far_back))[:times]
            bits.at += end - (bits.at & 7)
            return out
        src = np.arange(n)
        times = long[copied]
        places = (first[copied] - times.cumsum() + times).repeat(times) + np.arange(times.sum())
        src[places] = places - back.repeat(times)
    else:
        src = np.arange(n)
    cached = kinds >= 280
    if cached.any():
        slot = np.zeros(n, dtype=np.uint16)  # which sorts fast
        slot[first[plain]] = (colour * np.uint32(_CACHE_FACTOR)) >> np.uint32(32 - cache_bits)
        asked = first[cached]
        slot[asked] = kinds[cached] - 280
        slot = slot[_followed(src)] if copied.any() else slot
        order = slot.argsort(kind="stable")
        before = np.full(n, -1)
        same = slot[order[1:]] == slot[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        if (before[asked] < 0).any():  # an entry that nothing has set yet
            return None
        src[asked] = before[asked]
    bits.at += end - (bits.at & 7)
    return out[_followed(src)] if copied.any() or cached.any() else out


def _greens(bits: Bits, codes: list[PrefixCode], n: int, width: int) -> np.ndarray:
    """The green samples of ``n`` pixels whose other channels never change, token by token: faster than ``_run`` for small images."""
    g, d = codes[0], codes[4]
    data, mask = bits.data, (1 << g.top) - 1
    # a copy has 16 added to the size of its code, and its symbol less 256
    symbols, sizes = g.symbols.astype(np.uint8).tobytes(), (g.lengths + ((g.symbols > 255) << 4).astype(np.uint8)).tobytes()
    out = bytearray()
    while len(out) < n:
        ahead = int.from_bytes(data[bits.at >> 3 : (bits.at >> 3) + 48], "little") >> (bits.at & 7)
        used = 0
        for _ in range(min(24, n - len(out))):  # 24 codes have 360 bits at most
            i = ahead & mask
            size = sizes[i]
            if size > 15:
                bits.at += used + size - 16
                used = 0
                length, back = _prefixed(symbols[i], bits), _prefixed(d.read(bits), bits)
                if back > 120:
                    back -= 120
                else:
                    x, y = _NEAR[back - 1]
                    back = max(1, x + y * width)
                begin = len(out) - back
                if begin < 0 or len(out) + length > n:
                    raise ValueError("a back-reference leaves the image")
                out += out[begin : begin + length] if back >= length else (out[begin:] * (length // back + 1))[:length]
                break
            out.append(symbols[i])
            ahead >>= size
            used += size
        bits.at += used
    return np.frombuffer(bytes(out), np.uint8)


#: An image without a cache whose five codes have one symbol of 8 bits each, and the bits that say so.
_ALL_ONES = 1 | sum(7 << (1 + 11 * i) for i in range(5))
_ONE_COLOUR = sum(5 << (1 + 11 * i) for i in range(5))


def _pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image: literals, back-references and colour cache entries, as a flat array of ARGB."""
    byte = bits.at >> 3
    ahead = int.from_bytes(bits.data[byte : byte + 8], "little") >> (bits.at & 7)
    if not main and ahead & _ALL_ONES == _ONE_COLOUR:  # five codes of one symbol and no cache
        g, r, b, a = (ahead >> i & 255 for i in (4, 15, 26, 37))
        bits.at += 56
        return np.full(width * height, (a << 24) | (r << 16) | (g << 8) | b, dtype=np.uint32)
    cache_bits = bits(4) if bits(1) else 0
    cache = [0] * (1 << cache_bits) if cache_bits else []
    groups, meta, meta_bits, across = 1, None, 0, 0
    if main and bits(1):
        meta_bits = bits(3) + 2
        across = -(-width >> meta_bits)
        meta = ((_pixels(bits, across, -(-height >> meta_bits), False) >> 8) & 0xFFFF).tolist()
        groups = max(meta) + 1
    sizes = (256 + 24 + len(cache), 256, 256, 256, 40)
    codes = [[read_code(bits, s) for s in sizes] for _ in range(groups)]
    n = width * height
    g, r, b, a, _ = codes[0]
    if meta is None and g.single is not None and g.single < 256 and r.single is not None and b.single is not None and a.single is not None:
        return np.full(n, (a.single << 24) | (r.single << 16) | (g.single << 8) | b.single, dtype=np.uint32)
    if meta is None and g.single is None and n < 1024 and not cache and r.single is not None and b.single is not None and a.single is not None:
        return (_greens(bits, codes[0], n, width).astype(np.uint32) << np.uint32(8)) | np.uint32((a.single << 24) | (r.single << 16) | b.single)
    if meta is None and g.single is None and n >= 64:
        found = _run(bits, codes[0], n, width, cache_bits)
        if found is not None:
            return found
    out: list[int] = []
    cached = 0
    while len(out) < n:
        at = len(out)
        if meta is not None:
            g, r, b, a, d = codes[meta[(at // width >> meta_bits) * across + (at % width >> meta_bits)]]
        else:
            g, r, b, a, d = codes[0]
        s = g.read(bits)
        if s < 256:
            red, blue = r.read(bits), b.read(bits)
            out.append((a.read(bits) << 24) | (red << 16) | (s << 8) | blue)
        elif s < 280:
            length, back = _prefixed(s - 256, bits), _prefixed(d.read(bits), bits)
            if back > 120:
                back -= 120
            else:
                x, y = _NEAR[back - 1]
                back = max(1, x + y * width)
            if back > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            for i in range(length):
                out.append(out[at - back + i])
        else:
            if s - 280 >= len(cache):
                raise ValueError("no such cache entry")
            for p in out[cached:]:
                cache[((_CACHE_FACTOR * p) & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            cached = len(out)
            out.append(cache[s - 280])
    return np.array(out, dtype=np.uint32)


def _channels(x: np.ndarray) -> np.ndarray:
    """ARGB numbers as rows of alpha, red, green, blue."""
    return np.stack([(x >> s) & 0xFF for s in (24, 16, 8, 0)], axis=-1).astype(np.int32)


def _packed(c: np.ndarray) -> np.ndarray:
    c = c.astype(np.uint32)
    return (c[..., 0] << 24) | (c[..., 1] << 16) | (c[..., 2] << 8) | c[..., 3]


def _guess(mode: int, l: list[int], t: list[int], tr: list[int], tl: list[int]) -> list[int]:  # noqa: E741
    mean = lambda p, q: [(x + y) >> 1 for x, y in zip(p, q, strict=True)]
    clamp = lambda v: 0 if v < 0 else 255 if v > 255 else v
    if mode in (1, 2, 3, 4):
        return (l, t, tr, tl)[mode - 1]
    if mode == 5:
        return mean(mean(l, tr), t)
    if mode in (6, 7, 8, 9):
        return mean(*((l, tl), (l, t), (tl, t), (t, tr))[mode - 6])
    if mode == 10:
        return mean(mean(l, tl), mean(t, tr))
    if mode == 11:
        return l if sum(abs(x - y) for x, y in zip(t, tl, strict=True)) < sum(abs(x - y) for x, y in zip(l, tl, strict=True)) else t
    if mode == 12:
        return [clamp(x + y - z) for x, y, z in zip(l, t, tl, strict=True)]
    if mode == 13:
        return [clamp(m + int((m - z) / 2)) for m, z in zip(mean(l, t), tl, strict=True)]
    return [255, 0, 0, 0]


_8, _255 = np.uint32(8), np.uint32(255)
_LOW, _HIGH = np.uint32(0x00FF00FF), np.uint32(0xFF00FF00)


def _plus(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of ARGB numbers, each channel by itself modulo 256."""
    return (((x & _LOW) + (y & _LOW)) & _LOW) | (((x & _HIGH) + (y & _HIGH)) & _HIGH)


def _minus(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (((x | _HIGH) - (y & _LOW)) & _LOW) | (((x | _LOW) - (y & _HIGH)) & _HIGH)


def _differences(x: np.ndarray) -> np.ndarray:
    """ARGB numbers, each but the first less the one before, channel by channel."""
    samples = np.ascontiguousarray(x).view(np.uint8)
    return (samples[4:] - samples[:-4]).view(np.uint32)


def _summed(x: np.ndarray) -> np.ndarray:
    """Running sums of ARGB numbers."""
    return np.add.accumulate(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 4), axis=0, dtype=np.uint8).view(np.uint32).ravel()


def predicted(image: np.ndarray, modes: np.ndarray, size_bits: int, invert: bool) -> np.ndarray:
    """Undo (or do) the predictor transform on an array of height x width ARGB numbers."""
    height, width = image.shape
    kinds = (modes >> _8) & np.uint32(0xF)
    kinds[kinds > 13] = 0
    if not kinds.any():  # only borders have neighbours for their prediction
        if invert:
            out = image + np.uint32(_OPAQUE)  # alpha has the highest bits, so nothing is carried
            out[0, 1:], out[1:, 0] = image[0, 1:], image[1:, 0]
            out[0], out[:, 0] = _summed(out[0]), _summed(out[:, 0])
        else:
            out = image - np.uint32(_OPAQUE)
            out[0, 1:], out[1:, 0] = _differences(image[0]), _differences(image[:, 0])
        return out
    if kinds.max() > 4:
        return _predicted_one_by_one(image, kinds, size_bits, invert)
    # each pixel is predicted by one other, or by none
    back = np.array([0, 1, width, width - 1, width + 1])[np.repeat(np.repeat(kinds, 1 << size_bits, axis=0)[:height], 1 << size_bits, axis=1)[:, :width]]
    back[0], back[1:, 0], back[0, 0] = 1, width, 0
    src = np.arange(height * width) - back.ravel()
    alone, flat = back.ravel() == 0, image.ravel()
    if not invert:
        return _minus(flat, np.where(alone, np.uint32(_OPAQUE), flat[src])).reshape(height, width)
    # sums along the ways to the pixels that none predicts: ways are doubled until all have ended
    out = np.where(alone, _plus(flat, np.uint32(_OPAQUE)), flat)
    end = height * width
    src, out = np.append(np.where(alone, end, src), end), np.append(out, np.uint32(0))
    while (src != end).any():
        out, src = _plus(out, out[src]), src[src]
    return out[:-1].reshape(height, width)


def _predicted_one_by_one(image: np.ndarray, kinds: np.ndarray, size_bits: int, invert: bool) -> np.ndarray:
    height, width = image.shape
    given = _channels(image).reshape(-1, 4).tolist()
    full = [list(p) for p in given]
    out = full if invert else [list(p) for p in given]
    wanted = kinds.tolist()
    for i in range(height * width):
        x, y = i % width, i // width
        if not i:
            guess = [255, 0, 0, 0]
        elif not y:
            guess = full[i - 1]
        elif not x:
            guess = full[i - width]
        else:
            guess = _guess(wanted[y >> size_bits][x >> size_bits], full[i - 1], full[i - width], full[i - width + 1], full[i - width - 1])
        out[i] = [(p + q if invert else p - q) & 0xFF for p, q in zip(given[i], guess, strict=True)]
    return _packed(np.array(out)).reshape(height, width)


def cross_coloured(image: np.ndarray, factors: np.ndarray, size_bits: int, invert: bool) -> np.ndarray:
    """Undo (or do) the cross-colour transform."""
    if not (factors & np.uint32(0xFFFFFF)).any():
        return image
    c = _channels(image)
    y, x = np.indices(image.shape)
    f = _channels(factors[y >> size_bits, x >> size_bits])
    signed = lambda v: (v & 0xFF) - ((v & 0x80) << 1)
    delta = lambda a, b: (signed(a) * signed(b)) >> 5
    sign, green, red = 1 if invert else -1, c[..., 2], c[..., 1]
    after = (red + sign * delta(f[..., 3], green)) & 0xFF
    blue = c[..., 3] + sign * (delta(f[..., 2], green) + delta(f[..., 1], after if invert else red))
    return _packed(np.stack([c[..., 0], after, green, blue & 0xFF], axis=-1))


def decode(file: bytes) -> np.ndarray:
    """The pixels of a lossless WebP file: height x width x (alpha, red, green, blue), 8 bits each."""
    if file[:4] != b"RIFF" or file[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at = 12
    while file[at : at + 4] != b"VP8L":
        size = int.from_bytes(file[at + 4 : at + 8], "little")
        if at + 8 >= len(file):
            raise ValueError("no lossless image in the file")
        at += 8 + size + (size & 1)
    bits = Bits(file[at + 8 : at + 8 + int.from_bytes(file[at + 4 : at + 8], "little")])
    if bits(8) != 0x2F:
        raise ValueError("not a lossless image")
    width, height, alpha, version = bits(14) + 1, bits(14) + 1, bits(1), bits(3)
    if version:
        raise ValueError("unknown version")
    transforms, inner = [], width
    while bits(1):
        kind = bits(2)
        if kind in (0, 1):
            size_bits = bits(3) + 2
            w, h = -(-inner >> size_bits), -(-height >> size_bits)
            transforms.append((kind, size_bits, _pixels(bits, w, h, False).reshape(h, w), inner))
        elif kind == 2:
            transforms.append((kind, 0, None, inner))
        else:
            n = bits(8) + 1
            palette = _summed(_pixels(bits, n, 1, False))
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            transforms.append((kind, pack, palette, inner))
            inner = -(-inner >> pack)
    image = _pixels(bits, inner, height, True).reshape(height, inner)
    if bits.at > 8 * len(bits.data):
        raise ValueError("the file ends early")
    for kind, size_bits, data, before in reversed(transforms):
        if kind == 0:
            image = predicted(image, data, size_bits, True)
        elif kind == 1:
            image = cross_coloured(image, data, size_bits, True)
        elif kind == 2:
            green = (image >> 8) & 0xFF
            image = (image & np.uint32(0xFF00FF00)) | ((((image >> 16) + green) & 0xFF) << 16) | ((image + green) & 0xFF)
        else:
            index = (image >> np.uint32(8)) & np.uint32(0xFF)
            if size_bits:
                x, each = np.arange(before), 8 >> size_bits
                index = index[:, x >> size_bits] >> ((x & ((1 << size_bits) - 1)) * each).astype(np.uint32) & np.uint32((1 << each) - 1)
            table = np.zeros(256, dtype=np.uint32)
            table[: len(data)] = data
            image = table[index]
    out = image.astype(">u4", order="C").view(np.uint8).reshape(height, width, 4)
    if not alpha:
        out[..., 0] = 255
    return out


def _depths(weights: list[int], most: int) -> list[int]:
    """Lengths of a complete prefix code for two symbols or more; rare symbols weigh more until none is too long."""
    n = len(weights)
    while True:
        order = sorted(range(n), key=weights.__getitem__)
        ranked = [weights[i] for i in order]
        most_of_all = sum(ranked) + 1  # marks where leaves and joined ones end
        leaves, inner, above = [*ranked, most_of_all], [most_of_all] * n, [0] * (2 * n - 1)  # leaves by weight, then what joins two, in the order of making
        i = j = 0
        for k in range(n - 1):
            if leaves[i] <= inner[j]:
                total, above[i] = leaves[i], n + k
                i += 1
            else:
                total, above[n + j] = inner[j], n + k
                j += 1
            if leaves[i] <= inner[j]:
                inner[k], above[i] = total + leaves[i], n + k
                i += 1
            else:
                inner[k], above[n + j] = total + inner[j], n + k
                j += 1
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[above[k]] + 1
        if max(depth[:n]) <= most:
            out = [0] * n
            for i, d in zip(order, depth, strict=False):
                out[i] = d
            return out
        weights = [(x >> 1) + 1 for x in weights]


def code_lengths(counts: np.ndarray, most: int = 15) -> np.ndarray:
    """Lengths of a complete prefix code for the symbols that occur, two at least."""
    out = np.zeros(len(counts), dtype=np.uint8)
    used = counts.nonzero()[0]
    if len(used) <= 1:
        used = np.array([0, 1 if not len(used) else max(1, int(used[0]))]) if not len(used) or used[0] else np.array([0, 1])
    out[used] = _depths(counts[used].tolist(), most)
    return out


def _canonical(sizes: list[int]) -> list[int]:
    """The canonical codes of symbols in order, by their lengths, in the order in which their bits are stored."""
    out, code, reverse = [0] * len(sizes), 0, _reversals()
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        out[i] = reverse[code]
        code += 1 << (15 - sizes[i])  # each code's share of the 15-bit space, whose start is the code
    return out


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """The canonical codes in the order in which their bits are stored."""
    used = lengths.nonzero()[0]
    out = np.zeros(len(lengths), dtype=np.int64)
    out[used] = _canonical(lengths[used].tolist())
    return out


class BitWriter:
    def __init__(self) -> None:
        self.value, self.size = 0, 0

    def __call__(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def lengths(self, lengths: np.ndarray) -> None:
        """A normal code.  Lengths up to 12 take four bits; the others and the signs for 3 or more zeros take five."""
        used = lengths.nonzero()[0]
        self.signs(used.tolist(), lengths[used].tolist(), len(lengths))

    def signs(self, used: list[int], sizes: list[int], symbols: int) -> None:
        """The same for ``symbols`` symbols, of which ``used`` have lengths other than 0."""
        self(*_LENGTHS_HEAD)
        gaps = [i - j - 1 for i, j in zip([*used, symbols], [-1, *used], strict=True)]
        bits = "".join(reversed(list(map(_sign_after, gaps, [*sizes, 0]))))
        self(int(bits or "0", 2), len(bits))


#: A normal code, and the lengths of its code of lengths; as many signs as there are symbols.
_LENGTHS_HEAD = 15 << 1 | sum((4 if s < 13 else 5) << (5 + 3 * i) for i, s in enumerate(_LENGTH_ORDER)), 63
#: The codes of the lengths and signs in ``BitWriter.lengths``, last bit first: 0000 to 1100, then 11010 to 11111.
_SIGNS = tuple((f"{i:04b}" if i < 13 else f"{i + 13:05b}")[::-1] for i in range(19))


@cache
def _sign_after(zeros: int, n: int) -> str:
    """The bits of ``zeros`` lengths of 0, then of a length (0: none), last bit first."""
    parts = []
    while zeros >= 3:
        part = min(zeros, 138)
        parts.append(f"{part - 11:07b}{_SIGNS[18]}" if part >= 11 else f"{part - 3:03b}{_SIGNS[17]}")
        zeros -= part
    return (_SIGNS[n] if n else "") + "0000" * zeros + "".join(reversed(parts))


def _prefix_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, extra bits and their values of lengths or distance codes from 1."""
    symbol = np.searchsorted(_BASE, v, side="right") - 1
    return symbol, _EXTRA[symbol], v - _BASE[symbol]


def _matches(px: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place, pixels, distance) of copies of earlier pixels, from left to right, none overlapping the next."""
    n, wide = len(px) - least + 1, 1
    if n < 2:
        return []
    alone = px & np.uint32(0xFFFF00FF)
    if least == 8 and (alone == alone[0]).all():  # only green changes, so 8 pixels are a number, and its product a hash that none shares
        h = np.ndarray(n, "<u8", np.ascontiguousarray(px).view(np.uint8)[1::4].tobytes(), 0, 1) * np.uint64(0x9E3779B97F4A7C15)
        wide = least
    else:
        h = px.astype(np.uint64)
    while wide < least:  # a hash of ``least`` pixels, a power of two, from each place
        h = h[:-wide] * np.uint64(0x9E3779B97F4A7C15) + h[wide:] * np.uint64(0xD6E8FEB86659FD93) + (h[wide:] >> np.uint64(29))
        wide *= 2
    # few pixels are sorted by a part of the hash, which is faster and may miss a copy, but finds no wrong one
    order = ((h >> np.uint64(48)).astype(np.uint16) if n < 1 << 14 else h).argsort(kind="stable")
    ranked = h[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return []
    back, later = np.zeros(n + 1, dtype=np.int64), order[1:][same]
    back[later] = later - order[:-1][same]
    turns = (back[1:] != back[:-1]).nonzero()[0] + 1  # stretches of one distance; the first pixel is no copy
    places, distances, found, at = turns.tolist(), back[turns].tolist(), [], 0
    for begin, end, distance in zip(places, places[1:], distances, strict=False):
        if distance:
            end += least - 1
            if begin < at:
                begin = at
            if end - begin >= least:
                found.append((begin, end - begin, distance))
                at = end
    return found


_NOTHING = np.zeros(280 + (1 << 11), np.uint64), np.zeros(280 + (1 << 11), np.int64)


def _write_image(w: BitWriter, px: np.ndarray, width: int, main: bool, cache_bits: int = 0, least: int = 0) -> bytes:
    """Append an entropy-coded image: literals, cache entries and back-references of ``least`` pixels or more.

    Returns all bytes of ``w`` with the image, of which ``w`` itself gets the codes alone if it is the main one.
    """
    n = len(px)
    if not main and (n == 1 or (px == px[0]).all()):
        p = int(px[0])
        w(_ONE_COLOUR | (p >> 8 & 255) << 4 | (p >> 16 & 255) << 15 | (p & 255) << 26 | (p >> 24) << 37, 56)
        return b""
    found = _matches(px, least) if least else []
    literal = np.ones(n, dtype=bool)
    if found:
        raw = px.tobytes()
        if any(raw[4 * i : 4 * (i + k)] != raw[4 * (i - d) : 4 * (i - d + k)] for i, k, d in found):  # two hashes met
            found = []
    if found:
        for i, k, _ in found:
            literal[i : i + k] = False
        at, length, back = np.array(found, dtype=np.int64).T
        if length.max() > 4096:  # no copy is longer than that
            parts = -(-length // 4096)
            number = np.arange(parts.sum()) - (parts.cumsum() - parts).repeat(parts)
            at, back, length = at.repeat(parts) + 4096 * number, back.repeat(parts), np.minimum(4096, length.repeat(parts) - 4096 * number)
    slot = hit = None
    if cache_bits:
        slot = ((px * np.uint32(_CACHE_FACTOR)) >> np.uint32(32 - cache_bits)).astype(np.uint16)  # which sorts fast
        order = np.argsort(slot, kind="stable")
        hit = np.zeros(n, dtype=bool)
        hit[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (px[order[1:]] == px[order[:-1]])
    where = literal.nonzero()[0]
    value = px[where]
    green = ((value >> _8) & _255).astype(np.int64)
    plain: np.ndarray | slice = slice(None)
    if hit is not None:
        plain = ~hit[where]
        green = np.where(plain, green, 280 + slot[where].astype(np.int64))
    alone = px & np.uint32(0xFFFF00FF)
    rest: list[np.ndarray] = []
    # how often each symbol occurs, or the only one
    alphabets: list[np.ndarray | int] = [np.bincount(green, minlength=280 + (1 << cache_bits if cache_bits else 0))]
    if (alone == alone[0]).all():  # only green changes
        alphabets += [int(alone[0]) >> s & 255 for s in (16, 0, 24)]
    else:
        rest = [((value >> np.uint32(s)) & np.uint32(255)).astype(np.int64) for s in (16, 0, 24)]
        alphabets += [np.bincount(x[plain], minlength=256) for x in rest]
    alphabets.append(0)
    if found:
        near = _near_codes(width)
        distances = np.where(back < len(near), near[np.minimum(back, len(near) - 1)], back + 120)
        ls, lx, lv = _prefix_of(length)
        ds, dx, dv = _prefix_of(distances)
        alphabets[0] = alphabets[0] + np.bincount(256 + ls, minlength=len(alphabets[0]))
        alphabets[4] = np.bincount(ds, minlength=40)
    w(1 if cache_bits else 0, 1)
    if cache_bits:
        w(cache_bits, 4)
    if main:
        w(0, 1)  # one group of codes
    made = []
    for counts in alphabets:
        used = counts if isinstance(counts, int) else counts.nonzero()[0]
        if isinstance(used, int) or len(used) <= 1 and (not len(used) or used[0] < 256):  # one symbol, which takes no bits
            w(0b101 | (used if isinstance(used, int) else int(used[0]) if len(used) else 0) << 3, 11)
            made.append(_NOTHING)
            continue
        if len(used) == 1:
            used = np.append(0, used)
        sizes = _depths(counts[used].tolist(), 12 if main and len(made) < 4 else 9)  # short codes keep the reader's tables small
        w.signs(used.tolist(), sizes, len(counts))
        codes, lengths = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.int64)
        codes[used], lengths[used] = np.array(_canonical(sizes), np.uint64), np.array(sizes, np.int64)
        made.append((codes, lengths))
    token, size = made[0][0][green], made[0][1][green]
    for (code, length_of), x in zip(made[1:4], rest, strict=False):
        if length_of.any():
            token[plain] |= code[x[plain]] << size[plain].astype(np.uint64)
            size[plain] += length_of[x[plain]]
    if found:
        (gc, gl), (dc, dl) = made[0], made[4]
        copy, wide = gc[256 + ls], gl[256 + ls]
        for code, bits in ((lv.astype(np.uint64), lx), (dc[ds], dl[ds]), (dv.astype(np.uint64), dx)):
            copy = copy | (code << wide.astype(np.uint64))
            wide = wide + bits
        order = np.concatenate([where, at]).argsort(kind="stable")
        token, size = np.concatenate([token, copy])[order], np.concatenate([size, wide])[order]
    if not main:
        value, bits = 0, 0
        for v, k in zip(token.tolist(), size.tolist(), strict=True):
            value |= v << bits
            bits += k
        w(value, bits)
        return b""
    return _joined(w, token, size)


@cache
def _near_codes(width: int) -> np.ndarray:
    """By distance, the shortest distance code for it."""
    reach = _near_distances(width)
    out = np.arange(reach.max() + 1) + 120
    for code in range(120, 0, -1):
        out[reach[code - 1]] = code
    return out


def _joined(w: BitWriter, token: np.ndarray, size: np.ndarray) -> bytes:
    """The bits of ``w``, then tokens of up to 60 bits, as bytes."""
    ends = size.cumsum()
    at = ends - size + w.size
    total, word, shift = w.size + int(ends[-1]), at >> 6, (at & 63).astype(np.uint64)
    new = np.ones(len(word), dtype=bool)
    np.not_equal(word[1:], word[:-1], out=new[1:])
    firsts = new.nonzero()[0]  # of each word of 64 bits, none of which a token can skip
    lasts = np.append(firsts[1:], len(word)) - 1
    begin, n = w.size >> 6, len(firsts)
    out = np.zeros(begin + n + 1, dtype="<u8")
    out[begin : begin + n] = np.bitwise_or.reduceat(token << shift, firsts)
    out[begin + 1 :] |= (token[lasts] >> np.uint64(1)) >> (np.uint64(63) - shift[lasts])  # what the next word has of it
    out[: begin + 1] |= np.frombuffer(w.value.to_bytes(8 * begin + 8, "little"), "<u8")
    return out.tobytes()[: -(-total // 8)]


def _by_tile(on: np.ndarray, size_bits: int) -> np.ndarray:
    """In which tiles more than half of all places are set."""
    height, width = on.shape
    tile = 1 << size_bits
    least = ((height - 1) % tile + 1) * ((width - 1) % tile + 1)
    if 2 * np.count_nonzero(on) <= least:  # too few even for the smallest tile
        return np.zeros((-(-height >> size_bits), -(-width >> size_bits)), dtype=bool)
    rows, columns = np.arange(0, height, 1 << size_bits), np.arange(0, width, 1 << size_bits)
    count = np.add.reduceat(np.add.reduceat(on.astype(np.int32), rows, axis=0), columns, axis=1)
    return 2 * count > (np.minimum(rows + tile, height) - rows)[:, None] * (np.minimum(columns + tile, width) - columns)


def encode_pixels(image: np.ndarray, palette: bool, size_bits: int = 4, cache_bits: int = 0, least: int = 8) -> bytes:
    """A lossless WebP file of height x width ARGB numbers.

    With ``palette`` (256 colours at most), pixels become indices, several in one if there are few colours (the
    palette of an opaque image has no alpha, as nothing reads it); else
    red and blue lose green in the tiles where they mostly equal it.  Then pixels lose their left or upper
    neighbour in the tiles where most equal it.  What remains is written as literals, entries of a cache of
    2 ** ``cache_bits`` colours, and back-references of ``least`` pixels (a power of two) or more.
    """
    height, width = image.shape
    w = BitWriter()
    greens = palette and bool((image & np.uint32(0xFFFF00FF) == np.uint32(_OPAQUE)).all())
    alpha = not greens and bool((image < np.uint32(_OPAQUE)).any())
    w(0x2F | (width - 1) << 8 | (height - 1) << 22 | alpha << 36, 40)
    if palette:
        if greens:
            green = ((image >> _8) & _255).astype(np.int64)
            colours = np.bincount(green.ravel(), minlength=256).nonzero()[0]
            rank = np.zeros(256, np.uint32)
            rank[colours] = np.arange(len(colours))
            colours, index = colours.astype(np.uint32) << _8, rank.take(green)
        else:
            colours, index = np.unique(image, return_inverse=True)
            index = index.reshape(height, width).astype(np.uint32)
        n = len(colours)
        pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
        w(0b111, 3)
        w(n - 1, 8)
        _write_image(w, np.concatenate([colours[:1], _differences(colours)]), n, False)
        if pack:
            each, inner = 8 >> pack, -(-width >> pack)
            index = np.pad(index, ((0, 0), (0, (inner << pack) - width))).reshape(height, inner, 1 << pack)
            index = np.bitwise_or.reduce(index << (np.arange(1 << pack, dtype=np.uint32) * np.uint32(each)), axis=2)
        image = (index << np.uint32(8)) | np.uint32(_OPAQUE)
    else:
        red, green, blue = ((image >> np.uint32(s)) & np.uint32(255) for s in (16, 8, 0))
        factors = np.where(_by_tile(red == green, size_bits), np.uint32(32), np.uint32(0)) | np.where(_by_tile(blue == green, size_bits), np.uint32(32 << 8), np.uint32(0)) | np.uint32(_OPAQUE)
        w(0b011, 3)
        w(size_bits - 2, 3)
        _write_image(w, factors.ravel(), factors.shape[1], False)
        image = cross_coloured(image, factors, size_bits, False)
    left, top = np.zeros(image.shape, bool), np.zeros(image.shape, bool)
    np.equal(image[:, 1:], image[:, :-1], out=left[:, 1:])
    np.equal(image[1:], image[:-1], out=top[1:])
    up, back = _by_tile(top, size_bits), _by_tile(left, size_bits)
    modes = np.full(up.shape, np.uint32(_OPAQUE))
    if up.any() or back.any():
        modes |= np.where(up, np.uint32(2 << 8), np.where(back, np.uint32(1 << 8), np.uint32(0)))
    w(0b001, 3)
    w(size_bits - 2, 3)
    _write_image(w, modes.ravel(), modes.shape[1], False)
    image = predicted(image, modes, size_bits, False)
    w(0, 1)
    data = _write_image(w, image.ravel(), image.shape[1], True, cache_bits, least)
    chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) & 1)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


#: Payloads below this size are stored a byte a pixel.
LARGE = 8192


def store_bytes(payload: bytes) -> bytes:
    """Bytes, a positive multiple of 64, as lossless images, one file after another.

    A small payload is one image of 64 columns, a byte a pixel in its green channel, with a palette of the bytes
    that occur.  A large one has four bytes a pixel, alpha to blue, in images of 16 columns, with a colour cache.
    """
    samples = np.frombuffer(payload, np.uint8)
    if len(samples) < LARGE:
        return encode_pixels((samples.astype(np.uint32) << np.uint32(8) | np.uint32(_OPAQUE)).reshape(-1, 64), True, 6)
    piece = 64 * MAX_SIDE
    return b"".join(encode_pixels(samples[i : i + piece].view(">u4").astype(np.uint32).reshape(-1, 16), False, 4, 9, 4) for i in range(0, len(samples), piece))


def stored_images(media: bytes) -> Iterator[np.ndarray]:
    """The pixels of each file of ``store_bytes``."""
    at = 0
    while at < len(media):
        end = at + 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        if end > len(media):
            raise ValueError("the file ends early")
        yield decode(media[at:end])
        at = end


def stored_samples(image: np.ndarray) -> np.ndarray:
    """The bytes of a payload in the pixels of one of its images."""
    return image[..., 2].ravel() if image.shape[1] == 64 else image.ravel()


def padded(text: bytes) -> bytes:
    return text + b"\0" * (max(64, -(-len(text) // 64) * 64) - len(text))


def to_media(docs: DataFrame) -> DataFrame:
    """Add media (binary) and n_bytes to every row of ``docs``: the text's UTF-8 as lossless WebP.

    A null text is an empty one; each payload is padded with zero bytes to a positive multiple of 64.  Equal
    texts have equal media; texts of any length are stored whole.  Columns of those names are replaced; others stay.
    An empty table gives an empty one.
    """

    @F.pandas_udf("media binary, n_bytes long")
    def write(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            raw = [b"" if t is None else t.encode() for t in texts]
            yield pd.DataFrame({"media": [store_bytes(padded(t)) for t in raw], "n_bytes": [len(t) for t in raw]})

    rest = [c for c in docs.columns if c not in ("media", "n_bytes")]
    return docs.withColumn("_m", write("text")).select(*rest, "_m.*")


def read_media(rows: DataFrame) -> DataFrame:
    """Features of a media column, from the stored bytes alone; ``rows`` keeps its columns, without media.

    Adds payload_bytes, payload_sha256, tail_crc32 (last 64 bytes), media_bytes, media_sha256, feature (columns,
    rows, mean and variance of the samples and the share of each quarter of their range) and error.  A null media
    has nulls; one that can't be read has null features and its error.  Repeated rows are read each, columns of
    those names are replaced, and an empty table gives an empty one.
    """
    kinds = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"

    def features(m: bytes) -> tuple:
        try:
            images = list(stored_images(m))
            samples = np.concatenate([stored_samples(i) for i in images])
        except (ValueError, IndexError) as e:
            return None, None, None, len(m), hashlib.sha256(m).hexdigest(), None, str(e) or type(e).__name__
        payload = samples.tobytes()
        counts = np.bincount(samples, minlength=256)
        n, total, squares = len(samples), int(counts @ np.arange(256)), int(counts @ np.arange(256) ** 2)
        quarters = ",".join(f"{x / n:.4f}" for x in counts.reshape(4, 64).sum(axis=1))
        feature = f"w={images[0].shape[1]};h={sum(i.shape[0] for i in images)};mean={total / n:.4f};var={squares / n - (total / n) ** 2:.4f};q={quarters}"
        return n, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature, None

    @F.pandas_udf(kinds)
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in kinds.split(", ")]
        for media in parts:
            out = [(None,) * 7 if m is None else features(bytes(m)) for m in media]
            yield pd.DataFrame(out, columns=names).astype({"payload_bytes": "Int64", "tail_crc32": "Int64", "media_bytes": "Int64"})

    added = [x.split()[0] for x in kinds.split(", ")]
    rest = [c for c in rows.columns if c not in (*added, "media")]
    return rows.withColumn("_r", read("media")).select(*rest, "_r.*")


def read_pixels(rows: DataFrame, media: str = "media") -> DataFrame:
    """Add width, height, argb (array<long>, row by row) and error of the WebP file in a binary column.

    All are null where it is null; what can't be read has its error and nulls.  Columns of those names are replaced.
    """
    added = ("width", "height", "argb", "error")

    def opened(m: bytes | None) -> tuple[np.ndarray | None, str | None]:
        try:
            return (None if m is None else decode(m)), None
        except (ValueError, IndexError) as e:
            return None, str(e) or type(e).__name__

    def pixels(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [opened(m) for m in batch.column(media).to_pylist()]
            own = [
                pa.array([None if i is None else i.shape[1] for i, _ in found], pa.int32()),
                pa.array([None if i is None else i.shape[0] for i, _ in found], pa.int32()),
                pa.array([None if i is None else _packed(i.reshape(-1, 4)).astype(np.int64) for i, _ in found], pa.list_(pa.int64())),
                pa.array([e for _, e in found], pa.string()),
            ]
            kept = [n for n in batch.schema.names if n not in added]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + own, [*kept, *added])

    schema = rows.drop(*added).schema.add("width", T.IntegerType()).add("height", T.IntegerType()).add("argb", T.ArrayType(T.LongType())).add("error", T.StringType())
    return rows.mapInArrow(pixels, schema)
