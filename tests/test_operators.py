"""Invariants and differential tests of the curation operators."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import rasters, stages
from millrace.functions.jpeg import encode_jpeg, image_size
from millrace.operators import augment, calibration, curation, dedup, metrics, numbering, quantiles, splitting
from millrace.plans.bindings import document_records, hashes, logits, order_records, scored
from millrace.sources import folders
from millrace.sources import images as sources
from millrace.streaming import curation as streams

DATA = "/root/testdata/sf0.001"


def test_greedy_is_the_sequential_rule(spark):
    rows = sorted((r.ordinal, r.h % 2**64) for r in hashes(spark, DATA).collect())
    kept = []
    for o, h in rows:
        if all((h ^ k).bit_count() > 4 for _, k in kept):
            kept.append((o, h))
    assert {r.ordinal for r in dedup.greedy_dedup(hashes(spark, DATA), 4).collect()} == {o for o, _ in kept}
    assert dedup.greedy_dedup(hashes(spark, DATA), -1).count() == len(rows) > len(kept)


def test_equal_hashes_make_no_pairs(spark):
    items = spark.createDataFrame([(i, 5) for i in range(200)] + [(200, 7)], "ordinal long, h long")
    assert [r.ordinal for r in dedup.greedy_dedup(items, 4).collect()] == [0]
    assert dedup.exact_duplicates(items).where("kept").count() == 2


def in_order(rows, most):
    """The sequential rule, item by item."""
    kept = []
    for o, h in rows:
        if all((h ^ k).bit_count() > most for _, k in kept):
            kept.append((o, h))
    return {o for o, _ in kept}


def hash_table(spark, rows):
    return spark.createDataFrame([(o, h - 2**64 if h >> 63 else h) for o, h in rows], "ordinal long, h long")


def test_a_chain_of_5000_near_hashes(spark):
    rng = np.random.default_rng(3)
    h, rows = 5, []
    for i in range(5000):
        rows.append((i, h))
        for b in rng.choice(64, 4, replace=False).tolist():
            h ^= 1 << b
    rows = sorted({h: (o, h) for o, h in reversed(rows)}.values())
    assert {r.ordinal for r in dedup.greedy_dedup(hash_table(spark, rows), 4).collect()} == in_order(rows, 4)


@pytest.mark.parametrize("hot, task_edges", [(20_000, 40), (6, 40), (6, 10_000)])
def test_components_blocks_and_stretches_give_the_sequential_answer(spark, hot, task_edges):
    rng = np.random.default_rng(7)
    walk = [(i, 1 << 40 | ((1 << 3 * i) - 1)) for i in range(12)]
    crowd = [(100 + i, 0xABC << 52 | int(x)) for i, x in enumerate(rng.integers(0, 1 << 14, 150))]
    rows = sorted({h: (o, h) for o, h in reversed(walk + crowd)}.values())
    items = hash_table(spark, rows)
    assert {r.ordinal for r in dedup.greedy_dedup(items, 4, hot=hot, task_edges=task_edges).collect()} == in_order(rows, 4)
    for mode in ("exact", "prefix"):
        found = sorted(tuple(r) for r in dedup.hamming_pairs(items, 4, mode, hot=hot).collect())
        near = lambda a, b: (a ^ b).bit_count() <= 4 and (mode == "exact" or (a >> 52 ^ b >> 52).bit_count() <= 1)
        assert found == [(o, p, (a ^ b).bit_count()) for i, (o, a) in enumerate(rows) for p, b in rows[i + 1 :] if near(a, b)]


def test_numbers_and_percentiles_by_class(spark):
    rng = np.random.default_rng(1)
    data = [(i, [None, "a", "b", "b", "b"][i % 5], float(rng.integers(0, 9)) if i % 7 else None) for i in range(300)]
    rows = spark.createDataFrame(data, "id long, class string, v double")
    nth = {r.id: (r["class"], r.n) for r in numbering.dense_numbers(rows, ["id"], "n", by=["class"]).collect()}
    expected, seen = {}, {}
    for i, c, _ in data:
        expected[i] = (c, seen.setdefault(c, 0))
        seen[c] += 1
    assert nth == expected
    assert [r.n for r in numbering.dense_numbers(rows, [F.desc("id")], "n").orderBy("id").collect()] == list(range(299, -1, -1))
    found = {r["class"]: (r.low, r.mid) for r in quantiles.percentiles_by(rows, ["class"], F.col("v"), [0.1, 0.5], ["low", "mid"]).collect()}
    for c in (None, "a", "b"):
        assert np.allclose(found[c], np.percentile([v for _, k, v in data if k == c and v is not None], [10, 50]))
    empty = quantiles.percentiles_by(rows.withColumn("v", F.lit(None).cast("double")), ["class"], F.col("v"), [0.5], ["mid"]).collect()
    assert {(r["class"], r.mid) for r in empty} == {(None, None), ("a", None), ("b", None)}
    assert numbering.dense_numbers(rows.where("false"), ["id"], "n").count() == 0 == quantiles.percentiles_by(rows.where("false"), ["class"], F.col("v"), [0.5], ["mid"]).count()


@pytest.mark.parametrize("n, expected", [(1, (0, 0)), (2, (0, 0)), (3, (0, 0)), (9, (1, 1)), (10, (1, 2)), (11, (1, 2)), (100, (10, 15))])
def test_split_sizes(spark, n, expected):
    t, v = splitting.split_sizes(F.lit(n).cast("long"), 0.15, 0.10)
    assert tuple(spark.range(1).select(t, v).first()) == expected


def test_a_group_is_in_one_split(spark):
    records = order_records(spark, DATA)
    assigned = splitting.assign(records, splitting.group_split(records))
    assert assigned.count() == records.count()
    assert assigned.groupBy("grp").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_balanced_draws(spark):
    drawn = splitting.balanced_draws(document_records(spark, DATA), 4000).groupBy("class").count().collect()
    assert sum(r["count"] for r in drawn) == 4000
    assert max(r["count"] for r in drawn) / min(r["count"] for r in drawn) < 1.3


def test_temperature_leaves_predictions(spark):
    a = {r.id: r.pred for r in scored(spark, DATA).collect()}
    assert a == {r.id: r.pred for r in scored(spark, DATA, 4.0).collect()}
    t = calibration.fit_temperature(logits(spark, DATA))
    best = {r.temperature: r.nll for r in calibration.temperature_nlls(logits(spark, DATA), [t, max(0.05, t - 0.05), min(10.0, t + 0.05)]).collect()}
    assert best[t] <= min(best.values()) + 1e-9


def test_coverage_falls_with_the_threshold(spark):
    rows = calibration.sweep(scored(spark, DATA)).orderBy("threshold").collect()
    assert len(rows) == 95
    assert all(a.coverage >= b.coverage for a, b in zip(rows, rows[1:]))
    none = calibration.sweep(scored(spark, DATA), [1.5]).first()
    assert (none.n_accepted, none.selective_accuracy) == (0, 1.0)


def test_threshold_tiers(spark):
    def pick(rows):
        return calibration.pick_threshold(spark.createDataFrame(rows, "threshold double, coverage double, selective_accuracy double, n_accepted long, n_wrong_accepted long"), 0.9, 0.5).first()

    assert pick([(0.3, 0.8, 0.95, 8, 0), (0.2, 0.9, 0.92, 9, 0), (0.1, 1.0, 0.5, 10, 5)]).threshold == 0.2
    assert pick([(0.3, 0.4, 0.95, 4, 0), (0.1, 1.0, 0.5, 10, 5)]).tier == 2
    assert pick([(0.3, 0.4, 0.7, 4, 1), (0.1, 1.0, 0.5, 10, 5)]).threshold == 0.3


def test_a_perfect_model_is_cut_to_half_its_entropies(spark):
    rows = [(0, [1 - i / 1000, i / 1000]) for i in range(1, 101)]
    p = metrics.with_predictions(spark.createDataFrame(rows, "label int, probs array<double>"))
    limit = calibration.entropy_threshold(p, 0.5, 0.995, 2).first()[0]
    assert calibration.accepted_rows(p, 0.5, limit).count() == 50


def test_calibration_error_ignores_confidence_zero(spark):
    p = spark.createDataFrame([(0.0, False), (1.0, True)], "conf double, correct boolean")
    assert metrics.calibration_error(p).first().ece == 0.0


def test_empty_inputs(spark):
    none = scored(spark, DATA).where("false")
    assert metrics.calibration_error(none).first().ece == 0.0
    assert metrics.confusion_matrix(none).agg(F.sum("n")).first()[0] == 0
    assert calibration.sweep(none).where("selective_accuracy <> 1").count() == 0
    assert dedup.greedy_dedup(hashes(spark, DATA).where("false"), 4).count() == 0


def test_mixed_targets_sum_to_one(spark):
    rows = spark.createDataFrame([(i // 8, i, [float(i)] * 16, [1.0 if k == i % 3 else 0.0 for k in range(3)]) for i in range(64)], "batch long, id long, pixels array<double>, target array<double>")
    out = augment.mix_batches(rows, 4, 4, chance=0.8).collect()
    assert sorted(r.id for r in out) == list(range(64))
    assert all(abs(sum(r.target) - 1) < 1e-9 and len(r.pixels) == 16 for r in out)
    assert all(r.share >= 0.5 for r in augment.mixup(rows).collect())


@pytest.fixture(scope="module")
def dataset(tmp_path_factory, spark):
    """Two images with label files, one without, one that can't be read."""
    import struct
    import zlib

    root = tmp_path_factory.mktemp("set")
    for d in ("images", "labels"):
        (root / "train" / d).mkdir(parents=True)

    def png(path, h, w, seed):
        data = np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)
        raw = b"".join(b"\0" + row.tobytes() for row in data)
        chunk = lambda t, x: struct.pack(">I", len(x)) + t + x + struct.pack(">I", zlib.crc32(t + x))
        path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
        return data

    pixels = png(root / "train/images/a.png", 200, 300, 1)
    png(root / "train/images/b.png", 200, 200, 2)
    png(root / "train/images/c.png", 50, 50, 3)
    (root / "train/images/d.jpg").write_bytes(b"no image")
    (root / "train/labels/a.txt").write_text("0 0.5 0.5 0.6 0.6\n1 0.5 0.5 0.05 0.05\nnot a label\n9 0.5 0.5 0.5 0.5\n")
    (root / "train/labels/b.txt").write_text("1 0.1 0.1 0.9 0.1 0.9 0.8 0.1 0.8\n")
    (root / "data.yaml").write_text("names: [lima ribu, koin]\n")
    return root, pixels


def test_curation_end_to_end(spark, dataset):
    root, pixels = dataset
    images, labels = sources.read_detection_set(spark, str(root), "set", ["train"])
    rows = curation.label_rows(images, labels, sources.class_maps(spark, {"set": str(root / "data.yaml")}))
    found = {(r.stem, r.line_no): r.reason for r in rows.withColumn("reason", curation.reason()).collect()}
    assert found == {("a", 0): None, ("a", 1): "unknown_class", ("a", 3): "unknown_class", ("b", 0): "unknown_class", ("c", None): "no_label", ("d", None): "no_label"}
    one = images.where("stem = 'a'").first()
    assert np.array_equal(sources.to_raster(one.data, one.height, one.width, one.n_channels), pixels)
    assert images.where("stem = 'd'").first().height == -1
    features = {r.path.rsplit("/", 1)[-1]: r for r in augment.image_features(images).collect()}
    assert features["a.png"].blur > 100 and features["d.jpg"].h is None
    done = augment.transform_images(images, lambda image, rng: 1 / 0, size=8)
    ratio = augment.failure_ratio(done).first()
    assert (ratio.n, ratio.failed, ratio.warn) == (4, 4, True)


def test_logits_of_an_archive(spark, tmp_path):
    rng = np.random.default_rng(0)
    parts = {"logits": rng.normal(size=(5, 7)), "labels": np.arange(5) % 7, "val_logits": rng.normal(size=(3, 7)).astype(np.float32), "val_labels": np.array([6, 0, 1])}
    np.savez(tmp_path / "scores.npz", **parts)
    rows = {(r.split, r.id): r for r in sources.logits_from_npz(spark, str(tmp_path / "scores.npz")).collect()}
    assert len(rows) == 8 and rows["val", 0].label == 6 and np.allclose(rows["test", 4].logits, parts["logits"][4]) and np.allclose(rows["val", 2].logits, parts["val_logits"][2])
    sources.write_table(spark.createDataFrame(list(rows.values())), str(tmp_path / "t"), ("split",))
    assert sources.read_logits(spark, str(tmp_path / "t")).where("split = 'val'").count() == 3


def test_background_pool(spark, dataset):
    root, pixels = dataset
    pool = sources.read_backgrounds(spark, str(root / "train/images"), most=2, side=100)
    rows = {r.slot: r for r in pool.collect()}
    assert {k: (r.height, r.width, len(r.pixels)) for k, r in rows.items()} == {0: (66, 100, 66 * 100 * 3), 1: (100, 100, 100 * 100 * 3)}
    drawn = sources.with_background(spark.range(6), pool, F.col("id")).collect()
    assert sorted((r.id, r.background.height) for r in drawn) == [(i, 66 if i % 2 == 0 else 100) for i in range(6)]
    none = sources.with_background(spark.range(2), pool.where("false"), F.col("id")).collect()
    assert [r.background for r in none] == [None, None]


def test_folders_and_splits(spark, dataset, tmp_path):
    import shutil

    root, _ = dataset
    for split, label in (("train", "1000"), ("train", "5000"), ("val", "1000"), ("train", "other")):
        (tmp_path / "set" / split / label).mkdir(parents=True, exist_ok=True)
        shutil.copy(root / "train/images/a.png", tmp_path / "set" / split / label / f"{label}.png")
    found = sorted((r["class"], r.label) for r in sources.read_splits(spark, str(tmp_path / "set"), "train").collect())
    assert found == [("1000", 0), ("5000", 2)]
    assert {(r["class"], r.place, r.path.rsplit("/", 1)[-1]) for r in sources.paths_by_class(sources.read_splits(spark, str(tmp_path / "set"), "train")).collect()} == {("1000", 0, "1000.png"), ("5000", 0, "5000.png")}
    extra = sources.read_class_folders(spark, str(tmp_path / "set" / "train")).collect()
    assert sorted((r["class"], r.grp) for r in extra) == [("1000", "extra::manual::1000"), ("5000", "extra::manual::5000"), ("other", "extra::manual::other")]
    assert [p.rsplit("/", 1)[-1] for p in sources.discover_sets(spark, str(tmp_path / "set" / "*"))] == ["train", "val"]
    assert sources.list_images(spark, str(root / "train/images")).count() == 4


def test_manifest_and_summary(spark, tmp_path):
    rows = document_records(spark, DATA).select("class", "split", "grp", F.col("id").alias("ordinal"), F.lit("o").alias("origin"), F.lit("s").alias("source"), F.lit(900).alias("w"), F.lit(300).alias("h"))
    made = curation.manifest(rows)
    sources.write_json(made, str(tmp_path / "m"))
    again = sources.read_manifest(spark, str(tmp_path / "m"))
    assert again.count() == rows.count() and again.select("file").distinct().count() == rows.count()
    assert (again.first().w, again.first().h) == (640, 213)
    one = curation.summary(rows, spark.createDataFrame([("kept", 3)], "reason string, n long")).first()
    assert one.n_images == rows.count() and sum(one.split_counts.values()) == one.n_images
    assert sum(n for m in one.class_counts.values() for n in m.values()) == one.n_images


def test_stream_dedup(spark, tmp_path):
    spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:01:00"), (2, "b", "2024-01-01 00:02:00")], "h long, class string, t string").select("h", "class", F.to_timestamp("t").alias("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("h long, class string, ts timestamp").parquet(str(tmp_path / "in"))
    q = streams.exact_dedup(stream).writeStream.format("memory").queryName("deduped").outputMode("append").start()
    try:
        q.processAllAvailable()
        assert spark.table("deduped").count() == 2
    finally:
        q.stop()


def test_scenes_of_many_images_on_few_grounds(spark):
    rng = np.random.default_rng(2)
    rows = [(f"p{i}", 20, 30, 3, bytearray(rng.integers(0, 256, (20, 30, 3), dtype=np.uint8).tobytes())) for i in range(40)] + [("gray", 9, 9, 1, bytearray(range(81))), ("bad", -1, -1, 0, None)]
    images = spark.createDataFrame(rows, "path string, height int, width int, n_channels int, data binary")
    grounds = spark.createDataFrame([(k, 50, 40, bytearray([10 + 200 * k]) * 6000) for k in range(2)], "slot int, height int, width int, pixels binary")
    planned = {r.path: r for r in augment.scene_plans(images, F.col("path"), 2, base=100).collect()}
    one, other = (sorted(map(tuple, augment.compose_scenes(images, grounds, base=100, per_group=n).collect()), key=lambda r: r[0]) for n in (3, 1000))
    assert one == other and len(one) == 42
    for path, w, h, pixels, error in one:
        plan = planned[path].plan
        if path == "bad":
            assert (w, h, pixels) == (None, None, None) and "unreadable" in error
        else:
            assert (w, h, error) == (plan.width, plan.height, None) and len(pixels) == w * h * 3
            corner = np.frombuffer(bytes(pixels), np.uint8).reshape(h, w, 3)
            assert 10 + 200 * planned[path].slot in corner
    made = augment.compose_scenes(images.limit(3), grounds.where("false"), base=80).collect()
    assert len(made) == 3 and all(r.error is None for r in made)


def test_stacks_and_single_images_agree(spark):
    rng = np.random.default_rng(6)
    rows = [(str(i), int(h), int(w), c, bytearray(rng.integers(0, 256, (h, w, c), dtype=np.uint8).tobytes())) for i, (h, w, c) in enumerate([(40, 50, 3), (40, 50, 3), (8, 8, 1), (70, 20, 4), (8, 8, 1), (1, 1, 3)] * 3)]
    found = {r.path: r for r in augment.image_features(spark.createDataFrame(rows, "path string, height int, width int, n_channels int, data binary")).collect()}
    for path, h, w, c, data in rows:
        image = sources.to_raster(bytes(data), h, w, c)
        assert (found[path].h, round(found[path].blur, 6)) == (rasters.perceptual_hash(image), round(rasters.blur_score(image), 6))


def test_stages_keep_the_size_and_follow_the_generator():
    image = np.random.default_rng(0).integers(0, 256, (40, 60, 3), dtype=np.uint8)
    for stage, shape in ((stages.hard_stress, (40, 60, 3)), (stages.quick_augment, (224, 224, 3))):
        a, b, c = (stage(image, rasters.generator("k", seed)) for seed in (1, 1, 2))
        assert a.shape == shape and a.dtype == np.uint8 and np.array_equal(a, b) and not np.array_equal(a, c)
    assert stages.hard_stress(image[..., 0], rasters.generator(3)).shape == (40, 60)
    darker = [stages.hard_stress(image, rasters.generator("d", k)).mean() for k in range(20)]
    assert np.mean(darker) < image.mean() - 20


def smooth_rows():
    y, x = np.mgrid[0:37, 0:53]
    colour = np.stack([np.sin(x / 9) * 100 + 128, y * 6, (x + y) * 2], axis=2).astype(np.uint8)
    rasters = [colour, colour[..., 0], np.full((1, 1, 3), 200, np.uint8), np.zeros((8, 8), np.uint8), np.random.default_rng(1).integers(0, 256, (16, 24), dtype=np.uint8)]
    return [(f"i{k}.jpg", ["train", "val", None][k % 3], "a", r.shape[0], r.shape[1], bytearray(r.tobytes()), None if k % 2 else "0 0.5 0.5 0.6 0.6\n") for k, r in enumerate(rasters)]


def test_jpeg_files_are_read_by_spark(spark, tmp_path):
    rows = [*smooth_rows(), ("none.jpg", "train", "a", 1, 1, None, None)]
    records = spark.createDataFrame(rows, "file string, split string, class string, height int, width int, pixels binary, label string")
    path = f"{tmp_path}/set"
    folders.write_jpeg_files(records, path)
    found = {r.stem: r for r in sources.read_images(spark, path, recursive=True).collect()}
    assert len(found) == 5
    for file, _, _, h, w, pixels, _ in rows[:4]:
        r = found[file[:-4]]
        raster = sources.to_raster(r.data, r.height, r.width, r.n_channels)
        assert np.abs(raster.astype(int) - np.frombuffer(bytes(pixels), np.uint8).reshape(raster.shape)).max() <= 6
    assert "5 files, 1 rows" in (tmp_path / "set/_SUCCESS").read_text() and not list((tmp_path / "set").glob("_temporary*"))
    read = folders.with_sizes(folders.read_image_folders(spark, path, splits=["train", "gone"]))
    assert {(r.split, r["class"], r.stem, r.height, r.width) for r in read.collect()} == {("train", "a", f[:-4], h, w) for f, s, _, h, w, p, _ in rows if s == "train" and p}
    assert folders.read_image_folders(spark, path, classes=["b"]).count() == 0 == folders.read_image_folders(spark, f"{path}/none").count()
    every = folders.read_image_folders(spark, path, "classes", shards=3)
    # Filters don't change what the table is.
    assert every.where("class = 'val'").count() == 2 and every.count() == 5 and every.where("class = 'train'").count() == 2
    folders.write_jpeg_files(records.where("split = 'train'"), path, layout="detection")
    detection = folders.read_image_folders(spark, path, "detection", dataset="d", contents=False)
    assert sorted((r.dataset, r.split, r.stem, r.label) for r in detection.collect()) == [("d", "train", "i0", "0 0.5 0.5 0.6 0.6\n"), ("d", "train", "i3", None)]
    assert [tuple(r) for r in folders.label_lines(detection).collect()] == [("d", "train", "i0", 0, "0 0.5 0.5 0.6 0.6")]
    with pytest.raises(Exception, match="not the name"):
        folders.write_jpeg_files(records.withColumn("file", F.lit("../x.jpg")), path)


def test_a_task_that_runs_again_leaves_one_file_per_row(tmp_path):
    names = ["file", "split", "class", "height", "width", "pixels", "label"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in smooth_rows()])
    writer = folders.JpegWriter({"path": f"{tmp_path}/out"}, overwrite=True)

    def broken():
        yield batch.slice(0, 3)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(broken())
    first = writer.write(iter([batch]))
    again = writer.write(iter([batch]))
    assert first == again == folders.WrittenFiles(5, 0)
    writer.commit([again, None])
    files = [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    assert sorted(p.name for p in files) == ["_SUCCESS", *(f"i{k}.jpg" for k in range(5))]
    assert all(image_size(p.read_bytes()) == (r[3], r[4]) for p, r in zip(sorted(p for p in files if p.suffix), sorted(smooth_rows(), key=lambda r: (r[1] or "")) ) if p.name == r[0])
    folders.JpegWriter({"path": f"{tmp_path}/out"}, overwrite=True).abort([])
    assert not any((tmp_path / "out").iterdir())


def test_heads_of_files():
    assert image_size(b"") is None and image_size(b"\xff\xd8\xff") is None and image_size(b"no image") is None
    assert image_size(encode_jpeg(np.zeros((3, 5), np.uint8))) == (3, 5)
    with pytest.raises(ValueError):
        encode_jpeg(np.zeros((0, 5), np.uint8))


def test_stream_of_near_hashes(spark, tmp_path):
    rows = hashes(spark, DATA).orderBy("ordinal").collect()
    for k in range(3):
        part = rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3]
        spark.createDataFrame([(r.ordinal, r.h) for r in part], "ordinal long, h long").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("ordinal long, h long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    q = streams.near_dedup(stream, f"{tmp_path}/kept").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination(120)
    kept = {r.ordinal for r in spark.read.parquet(f"{tmp_path}/kept").collect()}
    batches = [r.n for r in spark.read.parquet(f"{tmp_path}/kept").groupBy("batch").agg(F.count("*").alias("n")).collect()]
    assert len(batches) == 3 and len(kept) < len(rows)
    # Files may come in any order; what is kept is near nothing that is kept, and what is dropped is near something.
    h = {r.ordinal: r.h % 2**64 for r in rows}
    near = lambda a, b: (h[a] ^ h[b]).bit_count() <= 4
    assert not any(near(a, b) for a in kept for b in kept if a < b) and all(any(near(a, b) for b in kept) for a in h if a not in kept)
