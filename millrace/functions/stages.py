"""Augmentation stages: which kernels an image goes through, by chance and strength."""

from __future__ import annotations

import numpy as np

from . import distortions as d
from . import scenes
from .rasters import PRESETS, as_bytes, decolor, gaussian_blur, generator, letterbox, resize_area, resize_bilinear


def geometric(image: np.ndarray, cover: np.ndarray, rng: np.random.Generator, strength: str = "medium") -> tuple[np.ndarray, np.ndarray]:
    """Turns, projections, bends, wear and holes; the cover moves with the image."""
    preset = PRESETS[strength]
    if rng.random() < 0.35:
        turns = int(rng.integers(0, 4))
        image, cover = np.rot90(image, turns), np.rot90(cover, turns)
    if rng.random() < 0.90:
        image, cover = d.turned(image, cover, rng)
    if rng.random() < preset["geo"]:
        image, cover = d.perspective(image, cover, rng)
    if rng.random() < preset["geo"] / 2:
        image, cover = (d.elastic, d.grid_bend, d.optical)[rng.integers(0, 3)](image, cover, rng)
    if rng.random() < preset["wear"]:
        image = d.wear(image, rng)
    return d.holes(image, cover, rng) if rng.random() < 0.30 else (image, cover)


def photometric(image: np.ndarray, rng: np.random.Generator, strength: str = "medium") -> np.ndarray:
    """Light, tone, blur, noise, a loss of detail, artefacts of compression and a loss of colour, each by chance."""
    preset, colour, tones = PRESETS[strength], image.ndim == 3, np.arange(256.0)
    # What depends on a byte alone is worked out for the 256 bytes.
    if rng.random() < preset["light"]:
        image = as_bytes((tones - 128) * rng.uniform(0.7, 1.3) + 128 + rng.uniform(-40, 40))[image]
    if rng.random() < preset["light"]:
        image = as_bytes(255 * (tones / 255.0) ** rng.uniform(0.7, 1.4))[image]
    if colour and rng.random() < preset["light"]:
        image = d.hue_shift(image, rng)
    if rng.random() < preset["light"] / 2:
        image = d.tone_curve(image, rng)
    if rng.random() < preset["light"] / 2:
        image = d.shadow(image, rng)
    if rng.random() < preset["optic"]:
        kind = rng.integers(0, 3)
        image = as_bytes(gaussian_blur(image, rng.uniform(0.4, 1.8))) if kind == 0 else (d.motion_blur, d.defocus)[kind - 1](image, rng)
    if rng.random() < preset["optic"]:
        image = as_bytes(image + rng.normal(0, rng.uniform(2, 12), image.shape)) if rng.random() < 0.5 else d.sensor_noise(image, rng)
    if rng.random() < 0.50:
        h, w = image.shape[:2]
        f = rng.uniform(0.25, 0.8)
        image = as_bytes(resize_bilinear(resize_area(image, max(2, int(h * f)), max(2, int(w * f))), h, w))
    if rng.random() < 0.55:
        image = d.jpeg_blocks(image, int(rng.integers(35, 95)))
    if rng.random() < 0.15:
        image = d.local_contrast(image, rng.uniform(1.0, 3.0))
    return decolor(image, rng) if colour and rng.random() < preset["decolor"] else image


def scene_augment(image: np.ndarray, rng: np.random.Generator, strength: str = "medium", frame: float = 0.75, framer: scenes.Framer | None = None) -> np.ndarray:
    """Both stages around a scene; a quarter of the images fill their frame instead."""
    framer = framer or scenes.Framer()
    low, high = (framer.low, framer.high) if rng.random() < frame else (0.90, 1.0)
    moved = geometric(*scenes.with_margins(image, framer.margin), rng, strength)
    return photometric(framer.compose(*moved, rng, low, high), rng, strength)


def one_stage_augment(image: np.ndarray, rng: np.random.Generator, strength: str = "medium", size: int = 224) -> np.ndarray:
    """All kernels on the image alone, without a scene, in a square of the given side."""
    moved, _ = geometric(image, np.ones(image.shape[:2], dtype=np.float32), rng, strength)
    return letterbox(photometric(moved, rng, strength), size)


def scene_evaluation(image: np.ndarray, scale: float = 0.38) -> np.ndarray:
    """A scene for evaluation: its choices depend on the pixels alone."""
    return scenes.Framer().compose(*scenes.with_margins(image), generator("scene", int(image.sum())), scale, scale)


# The light fallback's reach of brightness, contrast, saturation and hue (in degrees), and its least crop.
QUICK = {"brightness": 45.0, "contrast": (0.65, 1.35), "saturation": (0.7, 1.3), "hue": 8.0, "crop": 0.8}
# Chances of the hard degrade's steps, the reach of its light and contrast, and of its artefacts of compression.
HARD = {"perspective": 0.8, "wear": (0.8, 0.8, 0.4), "light": 0.9, "colour": 0.7, "motion": 0.6, "jpeg": 0.7, "darker": (-0.40, -0.10), "flatter": (-0.25, 0.0), "quality": (25, 55)}


def hard_stress(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A clean image as a worn note in a dark room: tilted, worn, darker and paler, shaken and compressed, each but the wear by chance."""
    cover = np.ones(image.shape[:2], dtype=np.float32)
    if rng.random() < HARD["perspective"]:
        image, _ = d.perspective(image, cover, rng)
    image = d.wear(image, rng, *HARD["wear"])
    if rng.random() < HARD["light"]:
        image = as_bytes((image.astype(np.float64) - 128) * (1 + rng.uniform(*HARD["flatter"])) + 128 + 255 * rng.uniform(*HARD["darker"]))
    if image.ndim == 3 and rng.random() < HARD["colour"]:
        image = as_bytes(d.hue_shift(image, rng, share=0.08) * 0.94)
    if rng.random() < HARD["motion"]:
        image = d.motion_blur(image, rng, 2, 5)
    return d.jpeg_blocks(image, int(rng.integers(HARD["quality"][0], HARD["quality"][1] + 1))) if rng.random() < HARD["jpeg"] else image


def quick_augment(image: np.ndarray, rng: np.random.Generator, size: int = 224) -> np.ndarray:
    """The light augmentation, without warps or wear: half a turn, brightness, contrast, saturation and hue, a square, and a zoomed crop of it."""
    if rng.random() < 0.5:
        image = image[::-1, ::-1]
    moved = image.astype(np.float64) + rng.uniform(-QUICK["brightness"], QUICK["brightness"])
    middle = moved.mean(axis=(0, 1))
    moved = middle + (moved - middle) * rng.uniform(*QUICK["contrast"])
    if image.ndim == 3:
        low, high = QUICK["saturation"]
        moved = d.hue_shift(as_bytes(moved), rng, QUICK["hue"], (high - low) / 2)
    image = letterbox(as_bytes(moved), size)
    if rng.random() < 0.5:
        side = int(rng.integers(int(size * QUICK["crop"]), size + 1))
        y, x = rng.integers(0, size - side + 1, 2)
        image = as_bytes(resize_bilinear(image[y : y + side, x : x + side], size, size))
    return image
