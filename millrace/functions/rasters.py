"""Pixel work on numpy rasters (height x width x channels, unsigned bytes), one image at a time.

Random choices come from a generator that the caller seeds for each row, so a row looks the same
whichever task makes it.
"""

from __future__ import annotations

import hashlib

import numpy as np

# Probabilities of the augmentation stages by strength.
PRESETS = {
    "light": {"geo": 0.35, "wear": 0.35, "light": 0.45, "optic": 0.45, "decolor": 0.15},
    "medium": {"geo": 0.60, "wear": 0.65, "light": 0.75, "optic": 0.75, "decolor": 0.28},
    "heavy": {"geo": 0.80, "wear": 0.85, "light": 0.90, "optic": 0.85, "decolor": 0.38},
}
# Weights of red, green and blue in a gray image.
GRAY = np.array([0.299, 0.587, 0.114])


def generator(*key) -> np.random.Generator:
    """A generator seeded by the values of a key."""
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little"))


def gray(image: np.ndarray, order: str = "rgb") -> np.ndarray:
    if image.ndim == 2:
        return image.astype(np.float64)
    return image[..., :3].astype(np.float64) @ (GRAY if order == "rgb" else GRAY[::-1])


def _spread(n: int, m: int) -> np.ndarray:
    """Share of each of ``n`` old cells in each of ``m`` new ones, rows adding up to 1."""
    edges = np.linspace(0, n, m + 1)
    low, high = edges[:-1, None], edges[1:, None]
    cells = np.arange(n)[None, :]
    share = np.clip(np.minimum(high, cells + 1) - np.maximum(low, cells), 0, None)
    return share / share.sum(axis=1, keepdims=True)


def resize_area(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Each new pixel is the mean of the area that it covers."""
    down, across = _spread(image.shape[0], height), _spread(image.shape[1], width)
    rows = np.tensordot(down, image.astype(np.float64), axes=1)
    return np.moveaxis(np.tensordot(across, rows, axes=(1, 1)), 0, 1)


def _taps(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, n - 1), at - low


def resize_bilinear(image: np.ndarray, height: int, width: int) -> np.ndarray:
    # Rows that aren't taken needn't be numbers of 64 bits first.
    data = image if height < image.shape[0] else image.astype(np.float64)
    y0, y1, fy = _taps(image.shape[0], height)
    x0, x1, fx = _taps(image.shape[1], width)
    fy = fy.reshape(-1, *[1] * (image.ndim - 1))
    rows = data[y0] * (1 - fy) + data[y1] * fy
    fx = fx.reshape(1, -1, *[1] * (image.ndim - 2))
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def as_bytes(image: np.ndarray) -> np.ndarray:
    out = np.rint(image)
    return np.clip(out, 0, 255, out=out).astype(np.uint8)


def grays(images: np.ndarray, order: str = "rgb") -> np.ndarray:
    """Gray images (n, h, w) of a stack of equal size, gray (n, h, w) or coloured (n, h, w, channels)."""
    return images.astype(np.float64) if images.ndim == 3 else images[..., :3].astype(np.float64) @ (GRAY if order == "rgb" else GRAY[::-1])


#: Rows of the cosine transform of 32 values that a hash uses.
_LOW = np.sqrt(2 / 32) * np.cos(np.pi * (2 * np.arange(32)[None, :] + 1) * np.arange(8)[:, None] / 64) * np.where(np.arange(8)[:, None] == 0, np.sqrt(0.5), 1)


def perceptual_hashes(gray_images: np.ndarray) -> np.ndarray:
    """64 bits each, signed: the low 8 x 8 cosine coefficients over the median of those without first row and column.

    Shrinking to 32 x 32 by areas and the transform are both linear, so each side is one matrix for the whole stack.
    """
    down, across = (_LOW @ _spread(n, 32) for n in gray_images.shape[1:])
    low = down @ gray_images @ across.T
    middle = np.median(low[:, 1:, 1:].reshape(len(low), -1), axis=1)
    bits = np.packbits((low > middle[:, None, None]).reshape(len(low), -1), axis=1)
    return np.ascontiguousarray(bits).view(">i8").ravel().astype(np.int64)


def blur_scores(gray_images: np.ndarray) -> np.ndarray:
    """Variance of the Laplacian of each; the border is mirrored without its edge pixel."""
    g = np.pad(gray_images, ((0, 0), (1, 1), (1, 1)), mode="reflect" if min(gray_images.shape[1:]) > 1 else "edge")
    return (g[:, :-2, 1:-1] + g[:, 2:, 1:-1] + g[:, 1:-1, :-2] + g[:, 1:-1, 2:] - 4 * g[:, 1:-1, 1:-1]).var(axis=(1, 2))


def perceptual_hash(image: np.ndarray, order: str = "rgb") -> int:
    """:func:`perceptual_hashes` of one image."""
    return int(perceptual_hashes(gray(image, order)[None])[0])


def blur_score(image: np.ndarray, order: str = "rgb") -> float:
    """:func:`blur_scores` of one image."""
    return float(blur_scores(gray(image, order)[None])[0])


def brightness(image: np.ndarray) -> tuple[float, float]:
    """Mean and deviation of the largest channel."""
    top = image.max(axis=2) if image.ndim == 3 else image
    return float(top.mean()), float(top.std())


def letterbox(image: np.ndarray, size: int = 224, fill: int = 0) -> np.ndarray:
    """The whole image within a square, centred, the rest filled."""
    h, w = image.shape[:2]
    f = size / max(h, w)
    nh, nw = max(1, int(round(h * f))), max(1, int(round(w * f)))
    out = np.full((size, size, *image.shape[2:]), fill, dtype=np.uint8)
    top, left = (size - nh) // 2, (size - nw) // 2
    out[top : top + nh, left : left + nw] = as_bytes(resize_bilinear(image, nh, nw))
    return out


def normalize(image: np.ndarray) -> np.ndarray:
    """Bytes to the range -1 to 1."""
    return np.clip(image.astype(np.float32) / 127.5 - 1, -1, 1)


def gaussian_blur(image: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian blur with mirrored borders."""
    radius = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    kernel /= kernel.sum()
    out = image.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0)] * out.ndim
        pad[axis] = (radius, radius)
        wide, n = np.pad(out, pad, mode="edge"), out.shape[axis]
        shifted = (wide[i : i + n] if axis == 0 else wide[:, i : i + n] for i in range(len(kernel)))
        out = sum(k * part for k, part in zip(kernel, shifted))
    return out


def decolor(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Gray, less saturated, or with channels turned, one of the three."""
    g = gray(image)[..., None]
    kind = rng.integers(0, 3)
    if kind == 0:
        return as_bytes(np.repeat(g, 3, axis=2))
    if kind == 1:
        keep = rng.uniform(0, 0.4)
        return as_bytes(image * keep + g * (1 - keep))
    turn = rng.uniform(-30, 30) * np.pi / 180
    axis = np.full((3, 3), 1 / 3)
    cross = np.array([[0, -1, 1], [1, 0, -1], [-1, 1, 0]]) / np.sqrt(3)
    return as_bytes(image @ (np.cos(turn) * np.eye(3) + np.sin(turn) * cross + (1 - np.cos(turn)) * axis).T)


def gray_stress(image: np.ndarray) -> np.ndarray:
    return as_bytes(np.repeat(gray(image)[..., None], 3, axis=2))
