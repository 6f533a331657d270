"""How the curation operators are bound to the driver's tables, which hold no images, boxes or logits.

These are stand-ins: embeddings give logits (the first seven entries times 20), hashes (a bit per entry over
the median) and 8 x 8 rasters; orders give groups (customer) and classes (priority).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import median_hash
from ..functions.scores import softmax
from ..operators.metrics import with_predictions


#: Bits that are turned in the near copies, none to five.
TURNED = [0, 1 << 63, 1 << 5 | 1 << 40, 7 << 51, 15 << 11, 1 << 2 | 1 << 15 | 1 << 30 | 1 << 45 | 1 << 60]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, id, label, logits)."""
    x = F.transform(F.slice("embedding", 1, 7), lambda v: v.cast("double") * 20)
    split = F.when(F.col("vec_id") % 2 == 0, "val").otherwise("test")
    return table(spark, sf_dir, "embeddings").select(split.alias("split"), F.col("vec_id").alias("id"), (F.col("label") % 7).alias("label"), x.alias("logits"))


def scored(spark: SparkSession, sf_dir: str, temperature: float = 1.0) -> DataFrame:
    """Logits with probs, pred, conf and correct."""
    return with_predictions(logits(spark, sf_dir).withColumn("probs", softmax(F.col("logits"), temperature)))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, h, class): a hash of each embedding, and for a quarter of them a near copy with up to five bits turned."""
    plain = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ordinal"), median_hash(F.transform("embedding", lambda v: v.cast("double"))).alias("h"), F.col("label").alias("class"))
    turned = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in TURNED])
    near = plain.where("ordinal % 4 = 0").select((F.col("ordinal") + 1_000_001).alias("ordinal"), F.col("h").bitwiseXOR(turned[(F.col("ordinal") % len(TURNED)).cast("int")]).alias("h"), "class")
    return plain.unionByName(near)


#: Links of a chain of near hashes: each step turns three bits more.
LINKS = 6


def chain_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, h): of each embedding's hash a chain, whose neighbours are three bits apart and others six or more."""
    plain = hashes(spark, sf_dir).where("ordinal < 1000000")
    step = F.explode(F.sequence(F.lit(0), F.lit(LINKS - 1))).alias("k")
    return plain.select("ordinal", "h", step).select((F.col("ordinal") * LINKS + F.col("k")).alias("ordinal"), F.expr("h ^ (shiftleft(1L, 3 * k) - 1)").alias("h"))


def crowded_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, h): hashes of which a third have the same lowest band."""
    low = (1 << 12) - 1
    return hashes(spark, sf_dir).select("ordinal", F.when(F.col("ordinal") % 3 == 0, F.col("h").bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(1911))).otherwise(F.col("h")).alias("h"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ordinal, grp, class)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("ordinal"), F.col("o_custkey").alias("grp"), F.col("o_orderpriority").alias("class"))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, class, split, grp, n_chars); documents are split by their id, and three in a row are a group, so groups leak."""
    split = F.when(F.col("doc_id") % 10 < 7, "train").when(F.col("doc_id") % 10 < 9, "val").otherwise("test")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("class"), split.alias("split"), F.floor(F.col("doc_id") / 3).alias("grp"), "n_chars")


#: The same in DuckDB's SQL, as common table expressions.
SQL_LOGITS = """logits AS (
  SELECT CASE WHEN vec_id % 2 = 0 THEN 'val' ELSE 'test' END AS split, vec_id AS id, label % 7 AS label,
    list_transform(embedding[1:7], lambda x: x::DOUBLE * 20) AS z FROM embeddings)"""


def sql_scored(temperature: str = "1.0") -> str:
    return SQL_LOGITS + f""",
powers AS (SELECT *, list_transform(z, lambda x: exp((x - list_max(z)) / {temperature})) AS e FROM logits),
probs AS (SELECT split, id, label, list_transform(e, lambda x: x / list_sum(e)) AS p FROM powers),
scored AS (SELECT *, list_max(p) AS conf, list_position(p, list_max(p)) - 1 AS pred, list_position(p, list_max(p)) - 1 = label AS correct FROM probs)"""


SQL_HASHES = """ordered AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e, list_sort(list_transform(embedding, lambda x: x::DOUBLE)) AS s FROM embeddings),
bits AS (SELECT vec_id, label, unnest(e) AS v, generate_subscripts(e, 1) AS i, (s[32] + s[33]) / 2 AS m FROM ordered),
plain AS (SELECT vec_id AS ordinal, label AS class, sum(CASE WHEN v > m THEN (1::HUGEINT << (64 - i)::INT) ELSE 0::HUGEINT END)::HUGEINT AS h FROM bits GROUP BY ALL),
hashes AS (SELECT ordinal, class, h FROM plain UNION ALL SELECT ordinal + 1000001, class, xor(h, ([""" + ", ".join(f"{m}::HUGEINT" for m in TURNED) + f"""])[ordinal % {len(TURNED)} + 1]) FROM plain WHERE ordinal % 4 = 0)"""

SQL_CHAINS = SQL_HASHES.rsplit("hashes AS (", 1)[0] + f"hashes AS (SELECT ordinal * {LINKS} + k AS ordinal, xor(h, (1::HUGEINT << (3 * k)::INT) - 1) AS h FROM plain CROSS JOIN range({LINKS}) r(k))"
SQL_CROWDED = SQL_HASHES.replace("hashes AS (", "before AS (", 1) + ", hashes AS (SELECT ordinal, CASE WHEN ordinal % 3 = 0 THEN ((h >> 12) << 12) + 1911 ELSE h END AS h FROM before)"

SQL_RECORDS = """records AS (SELECT o_orderkey AS id, o_custkey AS grp, o_orderpriority AS class FROM orders),
composed AS (SELECT grp, class, count(*) AS n, min(id) AS first FROM records GROUP BY ALL),
dominant AS (SELECT grp, class FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, first) AS r FROM composed) WHERE r = 1)"""

SQL_SPLIT = SQL_RECORDS + """,
ranked AS (SELECT grp, class, row_number() OVER (PARTITION BY class ORDER BY md5(grp::VARCHAR || ':42'), grp) AS r, count(*) OVER (PARTITION BY class) AS n FROM dominant),
one AS (SELECT *, CASE WHEN n >= 10 THEN greatest(1, round_even(n * 0.1, 0)::BIGINT) ELSE round_even(n * 0.1, 0)::BIGINT END AS t,
  CASE WHEN n >= 10 THEN greatest(1, round_even(n * 0.15, 0)::BIGINT) ELSE round_even(n * 0.15, 0)::BIGINT END AS v FROM ranked),
two AS (SELECT *, least(t, greatest(0, n - 2)) AS nt FROM one),
three AS (SELECT *, least(v, greatest(0, n - nt - 1)) AS nv FROM two),
splits AS (SELECT grp, class, CASE WHEN r <= nt THEN 'test' WHEN r <= nt + nv THEN 'val' ELSE 'train' END AS split FROM three)"""

SQL_DOCS = """recs AS (SELECT doc_id AS id, lang AS class, doc_id // 3 AS grp, n_chars,
  CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM documents)"""
