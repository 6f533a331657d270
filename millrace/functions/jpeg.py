"""Baseline JPEG of a raster by numpy: no colour is thinned out, and the entropy codes are fitted to each image."""

from __future__ import annotations

import heapq
import struct

import numpy as np

# The example quantisation tables of the standard, for brightness and for colour, row by row.
BRIGHTNESS_STEPS = [
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]
COLOUR_STEPS = [
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
] + [99] * 32
# Red, green and blue to brightness and two colour differences.
TO_YCC = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])

#: Places of a block along its diagonals, the direction turning each time.
_ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p // 8 if (p // 8 + p % 8) % 2 else p % 8)))
_COSINES = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def steps(base: list[int], quality: int) -> np.ndarray:
    """A table's steps at a quality from 1 to 100."""
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(base) * scale + 50) // 100, 1, 255)


def _coefficients(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Quantised coefficients of each block, along the diagonals."""
    h, w = plane.shape
    plane = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge")
    blocks = plane.reshape(plane.shape[0] // 8, 8, -1, 8).swapaxes(1, 2).reshape(-1, 8, 8)
    found = (_COSINES @ blocks @ _COSINES.T).reshape(-1, 64) / table
    return np.rint(found).astype(np.int64)[:, _ZIGZAG]


def _code_lengths(counts: np.ndarray) -> np.ndarray:
    """Bits of each symbol's code, 16 at most; one more symbol takes the longest code, so that none is all ones."""
    while True:
        heap = [(int(c), k, (k,)) for k, c in enumerate(counts) if c] + [(0, len(counts), (len(counts),))]
        heapq.heapify(heap)
        lengths = np.zeros(len(counts) + 1, dtype=np.int64)
        lengths[len(counts)] = len(heap) == 1
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for k in a[2] + b[2]:
                lengths[k] += 1
            heapq.heappush(heap, (a[0] + b[0], max(a[1], b[1]), a[2] + b[2]))
        if lengths.max() <= 16:
            return lengths
        # Rarer symbols count for more until no code is too long.
        counts = np.where(counts > 0, counts // 2 + 1, 0)


def _codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(code of each symbol, its length, the table as a file states it)."""
    lengths = _code_lengths(np.bincount(symbols, minlength=256))
    # The symbol in excess comes last among the longest codes.
    order = sorted((int(n), k) for k, n in enumerate(lengths) if n)
    longest = order[-1][0]
    if lengths[256] < longest:
        # Swapping it with a symbol of the longest code only shortens that one.
        swap = order[-1][1]
        lengths[swap], lengths[256] = lengths[256], longest
        order = sorted((int(n), k) for k, n in enumerate(lengths) if n)
    code, last, codes = 0, order[0][0], np.zeros(257, dtype=np.int64)
    for n, k in order:
        code <<= n - last
        codes[k], code, last = code, code + 1, n
    listed = [(n, k) for n, k in order if k < 256]
    per_length = bytes(sum(n == size for n, _ in listed) for size in range(1, 17))
    return codes[:256], lengths[:256], per_length + bytes(k for _, k in listed)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.abs(values) + 1)).astype(np.int64)


def encode_jpeg(image: np.ndarray, quality: int = 95) -> bytes:
    """The bytes of a file with an image of unsigned bytes, gray (h, w) or red, green and blue (h, w, 3)."""
    h, w = image.shape[:2]
    if not (0 < h < 65536 and 0 < w < 65536):
        raise ValueError("an image has from 1 to 65535 rows and columns")
    planes = [image - 128.0] if image.ndim == 2 else list(np.moveaxis(image.astype(np.float64) @ TO_YCC.T, 2, 0) - np.array([128, 0, 0])[:, None, None])
    tables = [steps(BRIGHTNESS_STEPS, quality), steps(COLOUR_STEPS, quality)][: min(2, len(planes))]
    grids = [_coefficients(p, tables[min(k, len(tables) - 1)]) for k, p in enumerate(planes)]
    for grid in grids:
        grid[1:, 0] -= grid[:-1, 0].copy()
    blocks = np.stack(grids, axis=1).reshape(-1, 64)
    n = len(blocks)
    # Tokens: (place in the stream, whether of the first coefficient, symbol, value).
    at, k = np.nonzero(blocks[:, 1:])
    k += 1
    first = np.ones(len(at), dtype=bool)
    first[1:] = at[1:] != at[:-1]
    run = k - np.where(first, 0, np.concatenate([[0], k[:-1]])) - 1
    value = blocks[at, k]
    skips = np.repeat(np.arange(len(at)), run // 16)
    last = np.zeros(n, dtype=np.int64)
    np.maximum.at(last, at, k)
    open_blocks = np.flatnonzero(last < 63)
    stride = 65 * 2
    place = np.concatenate([np.arange(n) * stride, at[skips] * stride + k[skips] * 2 - 1, at * stride + k * 2, open_blocks * stride + 64 * 2])
    direct = np.concatenate([np.ones(n, dtype=bool), np.zeros(len(place) - n, dtype=bool)])
    symbol = np.concatenate([_bit_lengths(blocks[:, 0]), np.full(len(skips), 0xF0), (run % 16) * 16 + _bit_lengths(value), np.zeros(len(open_blocks), dtype=np.int64)])
    values = np.concatenate([blocks[:, 0], np.zeros(len(skips), dtype=np.int64), value, np.zeros(len(open_blocks), dtype=np.int64)])
    order = np.argsort(place, kind="stable")
    direct, symbol, values = direct[order], symbol[order], values[order]
    coded = [_codes(symbol[direct]), _codes(symbol[~direct])]
    extra = symbol % 16
    codes = np.where(direct, coded[0][0][symbol], coded[1][0][symbol])
    lengths = np.where(direct, coded[0][1][symbol], coded[1][1][symbol]) + extra
    words = (codes << extra) | np.where(values < 0, values + (1 << extra) - 1, values)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    bits = (words[owner] >> (ends[owner] - 1 - np.arange(ends[-1]))) & 1
    data = np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, dtype=np.int64)]).astype(np.uint8))
    data = np.insert(data, np.flatnonzero(data == 0xFF) + 1, 0).tobytes()

    segment = lambda mark, body: struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body
    parts = [b"\xff\xd8", segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
    parts += [segment(0xDB, bytes([k]) + bytes(t[_ZIGZAG].tolist())) for k, t in enumerate(tables)]
    parts.append(segment(0xC0, struct.pack(">BHHB", 8, h, w, len(planes)) + b"".join(bytes([c + 1, 0x11, min(c, len(tables) - 1)]) for c in range(len(planes)))))
    parts += [segment(0xC4, bytes([kind << 4]) + coded[kind][2]) for kind in (0, 1)]
    parts.append(segment(0xDA, bytes([len(planes)]) + b"".join(bytes([c + 1, 0]) for c in range(len(planes))) + b"\0\x3f\0"))
    return b"".join([*parts, data, b"\xff\xd9"])


def image_size(content: bytes) -> tuple[int, int] | None:
    """(height, width) from the head of a JPEG, PNG or BMP file, or null if it is none or broken off."""
    try:
        if content[:8] == b"\x89PNG\r\n\x1a\n":
            w, h = struct.unpack(">II", content[16:24])
            return h, w
        if content[:2] == b"BM":
            w, h = struct.unpack("<ii", content[18:26])
            return abs(h), w
        if content[:2] == b"\xff\xd8":
            at = 2
            while content[at] == 0xFF:
                mark, size = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    return struct.unpack(">HH", content[at + 5 : at + 9])
                at += 2 + size
    except (IndexError, struct.error):
        pass
    return None
