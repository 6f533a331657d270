"""Distortions of rasters: warps that are fields of source coordinates, wear, and changes of light, tone and detail."""

from __future__ import annotations

import numpy as np

from .jpeg import BRIGHTNESS_STEPS, steps
from .rasters import as_bytes, gaussian_blur, gray, resize_bilinear

def take(image: np.ndarray, cover: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pixels and cover at fractional source coordinates, by two weights each way; nothing comes from outside."""
    h, w = cover.shape
    inside = (y > -1) & (y < h) & (x > -1) & (x < w)
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1, fy, fx = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1), y - y0, x - x0

    def at(data: np.ndarray) -> np.ndarray:
        wide = (lambda f: f[..., None]) if data.ndim == 3 else (lambda f: f)
        top = data[y0, x0] * wide(1 - fx) + data[y0, x1] * wide(fx)
        low = data[y1, x0] * wide(1 - fx) + data[y1, x1] * wide(fx)
        return (top * wide(1 - fy) + low * wide(fy)) * wide(inside)

    return as_bytes(at(image)), at(cover).astype(np.float32)


def _grid(cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.mgrid[: cover.shape[0], : cover.shape[1]].astype(np.float64))


def perspective(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, reach: float = 0.10) -> tuple[np.ndarray, np.ndarray]:
    """The projection that moves each corner by up to a share of the sides."""
    h, w = cover.shape
    corners = np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], dtype=np.float64)
    moved = corners + rng.uniform(-reach, reach, (4, 2)) * [w, h]
    # From the new place (u, v) of a corner to its old one (x, y): eight linear equations.
    rows, right = [], []
    for (u, v), (x, y) in zip(moved, corners):
        rows += [[u, v, 1, 0, 0, 0, -u * x, -v * x], [0, 0, 0, u, v, 1, -u * y, -v * y]]
        right += [x, y]
    a, b, c, d, e, f, g, i = np.linalg.solve(np.array(rows), np.array(right))
    yy, xx = _grid(cover)
    scale = g * xx + i * yy + 1
    return take(image, cover, (d * xx + e * yy + f) / scale, (a * xx + b * yy + c) / scale)


def elastic(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, strength: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Every pixel moves a little, neighbours alike."""
    yy, xx = _grid(cover)
    push = [gaussian_blur(rng.uniform(-1, 1, cover.shape), 0.04 * max(cover.shape)) for _ in range(2)]
    push = [p / max(1e-9, np.abs(p).max()) * strength * max(cover.shape) for p in push]
    return take(image, cover, yy + push[0], xx + push[1])


def grid_bend(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, cells: int = 5, reach: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of cells are stretched and squeezed."""
    axes = []
    for n in cover.shape:
        steps = 1 + rng.uniform(-reach, reach, cells)
        knots = np.concatenate([[0], np.cumsum(steps / steps.sum())]) * (n - 1)
        axes.append(np.interp(np.arange(n), np.linspace(0, n - 1, cells + 1), knots))
    return take(image, cover, *np.meshgrid(*axes, indexing="ij"))


def optical(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, reach: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Barrel or pincushion: the distance from the middle is scaled by its square."""
    yy, xx = _grid(cover)
    cy, cx = (np.array(cover.shape) - 1) / 2
    bend = 1 + rng.uniform(-reach, reach) * (((yy - cy) / max(cy, 1)) ** 2 + ((xx - cx) / max(cx, 1)) ** 2)
    return take(image, cover, cy + (yy - cy) * bend, cx + (xx - cx) * bend)


def turned(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, angle: float = 180.0) -> tuple[np.ndarray, np.ndarray]:
    """A rotation with some shear about the middle."""
    a, shear = np.deg2rad(rng.uniform(-angle, angle)), rng.uniform(-0.15, 0.15)
    back = np.linalg.inv(np.array([[np.cos(a), shear - np.sin(a)], [np.sin(a), np.cos(a)]]))
    yy, xx = _grid(cover)
    cy, cx = np.array(cover.shape) / 2
    x, y = np.tensordot(back, np.stack([xx - cx, yy - cy]), axes=1)
    return take(image, cover, y + cy, x + cx)


def holes(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, most: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Some rectangles become empty, and aren't covered any more."""
    image, cover = image.copy(), cover.copy()
    for _ in range(rng.integers(1, most + 1)):
        at = tuple(slice(k, k + max(1, n // 10)) for k, n in ((rng.integers(0, n), n) for n in cover.shape))
        image[at], cover[at] = 0, 0
    return image, cover


def crumple(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A relief that shades the sheet and moves its pixels down the slope."""
    h, w = image.shape[:2]
    relief = resize_bilinear(rng.normal(0, 1, (int(rng.integers(4, 9)), int(rng.integers(4, 9)))), h, w)
    relief /= max(1e-9, np.abs(relief).max())
    down, across = np.gradient(relief) if min(h, w) > 1 else (np.zeros((h, w)), np.zeros((h, w)))
    slope = max(1e-9, np.abs(down).max(), np.abs(across).max())
    yy, xx = np.mgrid[:h, :w].astype(np.float64)
    reach = 0.01 * max(h, w)
    moved, _ = take(image, np.ones((h, w)), np.clip(yy + reach * down / slope, 0, h - 1), np.clip(xx + reach * across / slope, 0, w - 1))
    light = 1 + 0.18 * relief
    return as_bytes(moved * (light[..., None] if image.ndim == 3 else light))


def crease(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A few straight folds, dark with a bright edge."""
    yy, xx = np.mgrid[: image.shape[0], : image.shape[1]]
    out, width = image.astype(np.float64), max(1.0, 0.01 * max(image.shape[:2]))
    for _ in range(rng.integers(1, 4)):
        a = rng.uniform(0, np.pi)
        off = ((xx - rng.uniform(0, image.shape[1])) * np.cos(a) + (yy - rng.uniform(0, image.shape[0])) * np.sin(a)) / width
        fold = rng.uniform(10, 30) * np.exp(-((off - 2) ** 2)) - rng.uniform(15, 45) * np.exp(-(off**2))
        out += fold[..., None] if image.ndim == 3 else fold
    return as_bytes(out)


def marks(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A pen's line, a stamp's ring or a stain, in one colour that lets some of the sheet through."""
    h, w = image.shape[:2]
    yy, xx = np.mgrid[:h, :w]
    cy, cx, size = rng.uniform(0, h), rng.uniform(0, w), rng.uniform(0.08, 0.2) * max(h, w)
    kind = rng.integers(0, 3)
    if kind == 0:
        path = np.cumsum(rng.normal(0, 0.01 * max(h, w), (int(rng.integers(60, 240)), 2)), axis=0) + [cy, cx]
        weight = np.zeros((h, w))
        at = np.clip(path, 0, [h - 1, w - 1]).astype(int)
        for dy in (-1, 0, 1):
            weight[np.clip(at[:, 0] + dy, 0, h - 1), at[:, 1]] = 0.9
    else:
        far = np.hypot(yy - cy, xx - cx) / size
        weight = 0.7 * np.exp(-(((far - 1) / 0.08) ** 2)) if kind == 1 else 0.35 / (1 + np.exp((far - 1) / 0.1))
    ink = rng.integers(0, 110, image.shape[2:] or None)
    weight = weight[..., None] if image.ndim == 3 else weight
    return as_bytes(image * (1 - weight) + ink * weight)


def wear(image: np.ndarray, rng: np.random.Generator, crumples: float = 0.55, creases: float = 0.55, marked: float = 0.30) -> np.ndarray:
    """Crumples, then folds, then marks, each by its own chance."""
    for chance, step in ((crumples, crumple), (creases, crease), (marked, marks)):
        if rng.random() < chance:
            image = step(image, rng)
    return image


def hue_shift(image: np.ndarray, rng: np.random.Generator, degrees: float = 8.0, share: float = 0.12) -> np.ndarray:
    """Colours turn about the gray axis and gain or lose saturation."""
    turn, keep = np.deg2rad(rng.uniform(-degrees, degrees)), 1 + rng.uniform(-share, share)
    cross = np.array([[0, -1, 1], [1, 0, -1], [-1, 1, 0]]) / np.sqrt(3)
    spin = np.cos(turn) * np.eye(3) + np.sin(turn) * cross + (1 - np.cos(turn)) / 3
    g = gray(image)[..., None]
    return as_bytes(g + keep * (image @ spin.T - g))


def tone_curve(image: np.ndarray, rng: np.random.Generator, reach: float = 0.1) -> np.ndarray:
    """Tones follow a smooth rising curve through two moved points."""
    low, high = 0.25 + rng.uniform(-reach, reach), 0.75 + rng.uniform(-reach, reach)
    table = np.interp(np.linspace(0, 1, 256), [0, 0.25, 0.75, 1], [0, low, high, 1])
    return as_bytes(255 * gaussian_blur(table[None, :], 6.0)[0])[image]


def shadow(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One side of a soft edge is darker."""
    h, w = image.shape[:2]
    yy, xx = np.mgrid[:h, :w]
    a = rng.uniform(0, 2 * np.pi)
    side = (xx - rng.uniform(0.2, 0.8) * w) * np.cos(a) + (yy - rng.uniform(0.2, 0.8) * h) * np.sin(a)
    dark = 1 - rng.uniform(0.2, 0.55) / (1 + np.exp(-side / (0.03 * max(h, w) + 1)))
    return as_bytes(image * (dark[..., None] if image.ndim == 3 else dark))


def _convolved(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    r = kernel.shape[0] // 2
    wide = np.pad(image.astype(np.float64), ((r, r), (r, r), *[(0, 0)] * (image.ndim - 2)), mode="edge")
    h, w = image.shape[:2]
    return as_bytes(sum(kernel[i, j] * wide[i : i + h, j : j + w] for i, j in zip(*np.nonzero(kernel))) / kernel.sum())


def motion_blur(image: np.ndarray, rng: np.random.Generator, least: int = 1, most: int = 3) -> np.ndarray:
    """The mean along a short line, of one pixel and ``least`` to ``most`` on both sides."""
    r, a = int(rng.integers(least, most + 1)), rng.uniform(0, np.pi)
    kernel, along = np.zeros((2 * r + 1, 2 * r + 1)), np.linspace(-r, r, 4 * r + 1)
    kernel[np.rint(r + along * np.sin(a)).astype(int), np.rint(r + along * np.cos(a)).astype(int)] = 1
    return _convolved(image, kernel)


def defocus(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The mean over a small disc."""
    r = int(rng.integers(1, 4))
    yy, xx = np.mgrid[-r : r + 1, -r : r + 1]
    return _convolved(image, (yy**2 + xx**2 <= r * r + 0.5).astype(np.float64))


def sensor_noise(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Noise that grows with the light, and blotches of colour."""
    shot = rng.normal(0, 1, image.shape[:2]) * rng.uniform(0.2, 0.7)
    shot = shot[..., None] if image.ndim == 3 else shot
    colour = rng.normal(0, rng.uniform(1, 4), image.shape)
    return as_bytes(image + shot * np.sqrt(image.astype(np.float64) + 1) + colour)


def jpeg_blocks(image: np.ndarray, quality: int) -> np.ndarray:
    """What rounding the cosine coefficients of 8 x 8 blocks leaves of an image."""
    table = steps(BRIGHTNESS_STEPS, quality).reshape(8, 8)
    k = np.arange(8)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 16) * np.where(k[:, None] == 0, np.sqrt(1 / 8), 0.5)
    h, w = image.shape[:2]
    data = image.reshape(h, w, -1).astype(np.float64) - 128
    data = np.pad(data, ((0, -h % 8), (0, -w % 8), (0, 0)), mode="edge")
    blocks = data.reshape(data.shape[0] // 8, 8, data.shape[1] // 8, 8, -1).transpose(0, 2, 4, 1, 3)
    coded = np.rint(basis @ blocks @ basis.T / table) * table
    back = (basis.T @ coded @ basis).transpose(0, 3, 1, 4, 2).reshape(data.shape)
    return as_bytes(back[:h, :w].reshape(image.shape) + 128)


def local_contrast(image: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Histogram equalisation of tiles with clipped counts, blended between their middles; all channels follow the gray."""
    g = np.clip(np.rint(gray(image)), 0, 255).astype(int)
    h, w = g.shape
    tiles = max(1, min(tiles, h, w))
    rows, columns = (np.linspace(0, n, tiles + 1).astype(int) for n in (h, w))
    maps = np.empty((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            counts = np.bincount(g[rows[i] : rows[i + 1], columns[j] : columns[j + 1]].ravel(), minlength=256).astype(np.float64)
            limit = clip * counts.sum() / 256
            counts = np.minimum(counts, limit) + np.maximum(counts - limit, 0).sum() / 256
            maps[i, j] = 255 * np.cumsum(counts) / max(1e-9, counts.sum())
    # Between the middles of four tiles their maps are mixed.
    fy = np.clip((np.arange(h) + 0.5) / h * tiles - 0.5, 0, tiles - 1)
    fx = np.clip((np.arange(w) + 0.5) / w * tiles - 0.5, 0, tiles - 1)
    y0, x0 = np.floor(fy).astype(int)[:, None], np.floor(fx).astype(int)[None, :]
    y1, x1, ty, tx = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1), fy[:, None] - y0, fx[None, :] - x0
    new = (maps[y0, x0, g] * (1 - tx) + maps[y0, x1, g] * tx) * (1 - ty) + (maps[y1, x0, g] * (1 - tx) + maps[y1, x1, g] * tx) * ty
    gain = (new + 1) / (g + 1.0)
    return as_bytes(image * (gain[..., None] if image.ndim == 3 else gain))
