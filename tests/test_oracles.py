"""Every registered query of the curation operators against its SQL, at the smallest scale."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    a = sorted((tuple(map(plain, r)) for r in found.select(*columns).collect()), key=repr)
    b = sorted((tuple(map(plain, r)) for r in duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({ORACLES[name]})").fetchall()), key=repr)
    assert a == b


def test_augmented_images_are_dealt_to_all_cores(spark, tmp_path):
    spark.createDataFrame([(k, [0.1 * (k % 7)] * 64, 0) for k in range(400)], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = QUERIES["augmented_images"](spark, str(tmp_path)).where("stage = 'light_fallback'")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= spark.sparkContext.defaultParallelism


def test_mixed_pixels_keep_the_sign_of_zero(spark, tmp_path):
    rows = [(k, [(-1e-7, 1e-7, -0.0, 0.25)[(k + i) % 4] for i in range(64)], k % 10) for k in range(320)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = {r.id: str(r.pixels) for r in QUERIES["batch_mixing"](spark, str(tmp_path)).collect()}
    expected = {i: str(p) for i, p in con.sql(f"SELECT id, pixels FROM ({ORACLES['batch_mixing']})").fetchall()}
    assert found == expected and any("-0.0" in p for p in found.values())
