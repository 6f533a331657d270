"""Hand-made cases of the scalar functions, and kernels against plain definitions."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import distortions, hashing, rasters, scenes, scores, stages
from millrace.operators import augment
from millrace.sources.images import parse_class_names


def test_band_layout():
    assert hashing.band_layout(5) == [(0, 12), (12, 13), (25, 13), (38, 13), (51, 13)]
    assert all(sum(w for _, w in hashing.band_layout(n)) == 64 for n in range(1, 65))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(-(2**63), 2**63 - 1)), min_size=1, max_size=20))
def test_hamming_and_bands(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    rows = df.select("a", "b", hashing.hamming(F.col("a"), F.col("b")).alias("d"), hashing.bands(F.col("a"), 5).alias("bands"), hashing.probe_keys(F.col("a")).alias("keys")).collect()
    for r in rows:
        a, b = r.a % 2**64, r.b % 2**64
        assert r.d == (a ^ b).bit_count()
        assert [x.key for x in r.bands] == [a >> s & ((1 << w) - 1) for s, w in hashing.band_layout(5)]
        assert list(r["keys"]) == [a >> 52] + [(a >> 52) ^ (1 << k) for k in range(12)]


def test_softmax_argmax_entropy(spark):
    z = [1.0, 3.0, 3.0, -700.0]
    r = spark.createDataFrame([(z,)], "z array<double>").select(scores.softmax(F.col("z"), 2.0).alias("p"), scores.argmax(F.col("z")).alias("k")).first()
    e = np.exp((np.array(z) - 3) / 2)
    assert np.allclose(r.p, e / e.sum()) and r.k == 1
    assert abs(sum(r.p) - 1) < 1e-12


@pytest.mark.parametrize(
    "text, names",
    [
        ("names: ['a', \"b\"]\nnc: 2", {0: "a", 1: "b"}),
        ("names:\n- a\n- b c\nother: 1", {0: "a", 1: "b c"}),
        ("names:\n  0: a\n  3: 'b'\n", {0: "a", 3: "b"}),
        ("names: {0: a, 2: b}", {0: "a", 2: "b"}),
        ("nc: 3", {0: "20000", 1: "2000", 2: "50000", 3: "5000", 4: "10000", 5: "100000", 6: "1000"}),
    ],
)
def test_class_names(text, names):
    assert parse_class_names(text) == names


def test_kernels():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (40, 60, 3), dtype=np.uint8)
    assert rasters.letterbox(image).shape == (224, 224, 3)
    assert np.allclose(rasters.resize_area(image, 20, 30), image.reshape(20, 2, 30, 2, 3).mean(axis=(1, 3)))
    padded, cover = scenes.with_margins(image)
    assert scenes.extent(cover) == (slice(17, 57), slice(25, 85)) and padded.shape[:2] == cover.shape and np.array_equal(padded[scenes.extent(cover)], image)
    assert scenes.extent(np.zeros((3, 3))) is None
    g = image[..., 0].astype(float)
    lap = np.array([[np.roll(g, 1, 0)[y, x] + np.roll(g, -1, 0)[y, x] + np.roll(g, 1, 1)[y, x] + np.roll(g, -1, 1)[y, x] - 4 * g[y, x] for x in range(1, 59)] for y in range(1, 39)])
    assert abs(rasters.blur_score(image[..., 0]) - lap.var()) / lap.var() < 0.1
    near = rasters.as_bytes(image + rng.normal(0, 2, image.shape))
    h = [rasters.perceptual_hash(x) % 2**64 for x in (image, near, 255 - image)]
    assert (h[0] ^ h[1]).bit_count() <= 6 < (h[0] ^ h[2]).bit_count()


@pytest.mark.parametrize("strength", ["light", "medium", "heavy"])
def test_augmentation_depends_on_its_key_alone(strength):
    image = np.random.default_rng(1).integers(0, 256, (50, 90, 3), dtype=np.uint8)
    for stage in (stages.scene_augment, stages.one_stage_augment):
        one, two = (stage(image.copy(), rasters.generator("a", 1), strength) for _ in range(2))
        assert np.array_equal(one, two) and one.dtype == np.uint8
        assert not np.array_equal(one, stage(image.copy(), rasters.generator("b", 1), strength))
    assert np.array_equal(stages.scene_evaluation(image), stages.scene_evaluation(image.copy()))


def test_grounds_are_made_in_single_precision(monkeypatch):
    """A ground has normal grain over smooth light, and is neither drawn nor blended in numbers of 64 bits, which took most of a scene's time."""
    noise = scenes.grain(rasters.generator("noise"), (400, 500, 3), 5.0)
    assert noise.dtype == np.float32 and abs(noise.mean()) < 0.05 and abs(noise.std() - 5) < 0.05 and 20 < np.abs(noise).max() < 25
    assert abs(np.corrcoef(noise[:, :-1].ravel(), noise[:, 1:].ravel())[0, 1]) < 0.01
    where, kinds = scenes.Plan(500, 640, 0.4, 0.5, 0.5), []
    monkeypatch.setattr(scenes, "as_bytes", lambda image: kinds.append((image.dtype, image.size)) or rasters.as_bytes(image))
    ground = scenes.made_ground(where, rasters.generator("ground"))
    assert ground.shape == (640, 500, 3) and ground.dtype == np.uint8
    image = np.random.default_rng(4).integers(0, 256, (30, 40, 3), dtype=np.uint8)
    out = scenes.lay(image, np.ones((30, 40), dtype=np.float32), where, ground)
    changed = (out != ground).any(axis=2)
    assert changed.any() and not changed[:100].any() and not changed[-100:].any()
    assert all(kind == np.float32 or size < ground.size / 4 for kind, size in kinds)


def test_every_kernel_keeps_shapes():
    for shape in ((50, 90, 3), (40, 30), (9, 7, 3)):
        image, cover = np.random.default_rng(2).integers(0, 256, shape, dtype=np.uint8), np.ones(shape[:2], dtype=np.float32)
        for kernel in (distortions.perspective, distortions.elastic, distortions.grid_bend, distortions.optical, distortions.turned, distortions.holes):
            out, moved = kernel(image, cover, rasters.generator(kernel.__name__))
            assert out.shape == shape and out.dtype == np.uint8 and moved.shape == shape[:2] and 0 <= moved.min() <= moved.max() <= 1.0001
        kernels = [distortions.crumple, distortions.crease, distortions.marks, distortions.wear, distortions.tone_curve, distortions.shadow, distortions.motion_blur, distortions.defocus, distortions.sensor_noise]
        for kernel in kernels + ([distortions.hue_shift] if len(shape) == 3 else []):
            out = kernel(image, rasters.generator(kernel.__name__))
            assert out.shape == shape and out.dtype == np.uint8
        assert distortions.local_contrast(image).shape == shape


def test_kernels_by_definition():
    flat = np.full((16, 24, 3), 77, dtype=np.uint8)
    assert np.array_equal(distortions.jpeg_blocks(flat, 95), flat) and np.array_equal(distortions.defocus(flat, rasters.generator(1)), flat)
    image = np.random.default_rng(3).integers(0, 256, (24, 40), dtype=np.uint8)
    errors = [np.abs(distortions.jpeg_blocks(image, q).astype(int) - image).mean() for q in (95, 60, 20)]
    assert errors[0] < errors[1] < errors[2]
    y, x = np.mgrid[:24, :40].astype(float)
    same, cover = distortions.take(image, np.ones((24, 40)), y, x)
    assert np.array_equal(same, image) and cover.min() == 1
    dim = np.clip(image // 8 + 100, 0, 255).astype(np.uint8)
    assert distortions.local_contrast(dim, 40.0).std() > dim.std()


def test_scene_plans_agree(spark):
    """The plan of a column is that of the same numbers in numpy, and scenes keep what they lay."""
    rng = np.random.default_rng(4)
    draws = rng.random((200, scenes.DRAWS))
    rows = spark.createDataFrame([(u.tolist(),) for u in draws], "u array<double>").select(scenes.plan_columns(F.col("u")).alias("p")).collect()
    expected = [scenes.plan(u) for u in draws]
    assert all((r.p.width, r.p.height) == e[:2] and np.allclose([r.p.share, r.p.across, r.p.down], e[2:]) for r, e in zip(rows, expected))
    assert min(min(e[:2]) for e in expected) >= 64 and {(e.width > e.height) for e in expected} == {True, False}
    red = np.zeros((30, 60, 3), dtype=np.uint8)
    red[..., 0] = 255
    where = scenes.Plan(200, 100, 0.5, 0.5, 0.5)
    scene = scenes.lay(*scenes.with_margins(red), where, np.zeros((100, 200, 3), dtype=np.uint8), 0)
    assert scene.shape == (100, 200, 3) and scene[50, 100].tolist() == [255, 0, 0] and abs(int((scene[..., 0] > 127).sum()) - 100 * 50) < 400
    ground = scenes.ground_from(np.random.default_rng(5).integers(0, 256, (300, 90, 3), dtype=np.uint8), where, np.array([0.3, 0.9, 0.5]))
    assert ground.shape == (100, 200, 3)


def test_beta_quantiles():
    for alpha, half, spread in ((0.2, 0.5, 0.1786), (1.0, 0.5, 1 / 12), (3.0, 0.5, 1 / 28)):
        q = np.array(augment.beta_quantiles(alpha, 4001))
        assert abs(q.mean() - half) < 1e-3 and abs(q.var() - spread) < 2e-3 and abs(np.median(q) - 0.5) < 1e-3
    shares = np.maximum(q := np.array(augment.beta_quantiles(0.2, 20001)), 1 - q)
    assert abs(shares.mean() - 0.899) < 2e-3


def test_warmup_cosine_ends(spark):
    r = spark.range(3).select(scores.warmup_cosine(F.col("id") * 50, 1.0, 100, 50).alias("v")).collect()
    assert [round(x.v, 6) for x in r] == [0.0, 1.0, 0.0] and math.isclose(r[2].v, 1e-7, rel_tol=1e-3)
