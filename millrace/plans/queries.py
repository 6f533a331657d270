"""Registered queries of the curation and evaluation operators, each with SQL that must give the same rows."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..durable import materialise, shared_dir
from ..functions import geometry, hashing, labels, scenes, scores
from ..operators import audit, augment, calibration, curation, dedup, metrics, numbering, quantiles, splitting
from ..sources import folders, images
from .bindings import SQL_CHAINS, SQL_CROWDED, SQL_DOCS, SQL_HASHES, SQL_LOGITS, SQL_RECORDS, SQL_SPLIT, chain_hashes, crowded_hashes, document_records, hashes, logits, order_records, scored, sql_scored, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its SQL if it has one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits of the columns that come out of exponentials and logarithms, whose last bit differs by engine."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


CELLS = "cells AS (SELECT a.k AS label, b.k AS pred, coalesce(c.n, 0) AS n FROM range(7) a(k) CROSS JOIN range(7) b(k) LEFT JOIN (SELECT label, pred, count(*) AS n FROM scored GROUP BY ALL) c ON c.label = a.k AND c.pred = b.k)"
SQL_REPORT = CELLS + """,
by_row AS (SELECT label AS class, sum(n) AS support, sum(CASE WHEN label = pred THEN n ELSE 0 END) AS hits FROM cells GROUP BY 1),
by_column AS (SELECT pred AS class, sum(n) AS claimed FROM cells GROUP BY 1),
pr AS (SELECT class, support, CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed END AS p, CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r FROM by_row JOIN by_column USING (class))"""


@query(f"WITH {sql_scored()}, {CELLS} SELECT label, pred, n FROM cells")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(scored(spark, d))


@query(f"WITH {sql_scored()}, {SQL_REPORT} SELECT class, support::BIGINT AS support, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM pr")
def class_prf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.class_report(scored(spark, d)), "precision", "recall", "f1")


@query(f"WITH {sql_scored()} SELECT round(avg(correct::INT), 6) AS accuracy, count(*) AS n FROM scored")
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.accuracy(scored(spark, d)), "accuracy")


@query(f"WITH {sql_scored()}, b AS (SELECT ceil(conf * 15) AS bin, count(*) AS n, avg(conf) AS c, avg(correct::INT) AS a FROM scored GROUP BY 1) SELECT round(sum(CASE WHEN bin >= 1 THEN n * abs(a - c) ELSE 0 END) / sum(n), 6) AS ece FROM b")
def ece15(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.calibration_error(scored(spark, d)), "ece")


@query(f"WITH {sql_scored()} SELECT ceil(conf * 15)::BIGINT AS bin, count(*) AS n, round(avg(conf), 6) AS confidence, round(avg(correct::INT), 6) AS accuracy FROM scored WHERE conf > 0 GROUP BY 1 HAVING count(*) >= 5")
def reliability_bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.reliability(scored(spark, d)), "confidence", "accuracy")


GRID = [0.25 * i for i in range(1, 41)]
SQL_NLLS = f"""WITH {SQL_LOGITS}, g AS (SELECT i * 0.25 AS temperature FROM range(1, 41) r(i)),
e AS (SELECT temperature, label, list_transform(z, lambda x: exp((x - list_max(z)) / temperature)) AS e FROM logits CROSS JOIN g WHERE split = 'val'),
n AS (SELECT temperature, avg(-ln(e[label + 1] / list_sum(e) + 1e-12)) AS nll FROM e GROUP BY 1)"""


@query(SQL_NLLS + " SELECT temperature::DOUBLE AS temperature, round(nll, 6) AS nll FROM n")
def nll_by_temperature(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibration.temperature_nlls(logits(spark, d).where("split = 'val'"), GRID), "nll")


@query(SQL_NLLS + " SELECT temperature::DOUBLE AS temperature, round(nll, 6) AS nll FROM n ORDER BY nll, temperature LIMIT 1")
def temperature_grid_best(spark: SparkSession, d: str) -> DataFrame:
    found = calibration.temperature_nlls(logits(spark, d).where("split = 'val'"), GRID)
    return rounded(found.orderBy("nll", "temperature").limit(1), "nll")


def sql_temperature(rounds: int = 6, points: int = 16) -> str:
    """The same grids within grids."""
    parts = [SQL_LOGITS, f"r0 AS (SELECT {calibration.LOW}::DOUBLE AS low, {calibration.HIGH}::DOUBLE AS high)"]
    for k in range(1, rounds + 1):
        parts += [
            f"t{k} AS (SELECT low + i * ((high - low) / {points - 1}) AS t, (high - low) / {points - 1} AS step FROM r{k - 1}, range({points}) g(i))",
            f"e{k} AS (SELECT t, step, label, list_transform(z, lambda x: exp((x - list_max(z)) / t)) AS e FROM logits CROSS JOIN t{k} WHERE split = 'val')",
            f"b{k} AS (SELECT t, step FROM (SELECT t, step, avg(-ln(e[label + 1] / list_sum(e) + 1e-12)) AS nll FROM e{k} GROUP BY ALL) ORDER BY nll, t LIMIT 1)",
            f"r{k} AS (SELECT greatest({calibration.LOW}, t - step) AS low, least({calibration.HIGH}, t + step) AS high FROM b{k})",
        ]
    return f"WITH {', '.join(parts)} SELECT round(t, 3) AS temperature FROM b{rounds}"


@query(sql_temperature())
def temperature_fit(spark: SparkSession, d: str) -> DataFrame:
    """The fitted temperature to three digits."""
    t = calibration.fit_temperature(logits(spark, d).where("split = 'val'"))
    return spark.createDataFrame([(round(t, 3),)], "temperature double")


@query(f"WITH {sql_scored()} SELECT id, pred::INT AS pred, round(conf, 6) AS conf, round(-list_sum(list_transform(p, lambda x: x * ln(x + 1e-12))), 6) AS entropy FROM scored")
def softmax_entropy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scored(spark, d).select("id", "pred", "conf", scores.entropy(F.col("probs")).alias("entropy")), "conf", "entropy")


SQL_SWEEP = """grid AS (SELECT DISTINCT t AS threshold FROM (SELECT 0.20::DOUBLE + i * 0.70::DOUBLE / 35 AS t FROM range(35) r(i) UNION ALL SELECT 0.90::DOUBLE + i * 0.099::DOUBLE / 59 FROM range(60) r(i))),
hit AS (SELECT threshold, count(conf) FILTER (conf >= threshold) AS n_accepted, count(conf) FILTER (conf >= threshold AND NOT correct) AS n_wrong_accepted, count(*) AS total FROM grid CROSS JOIN test GROUP BY 1),
swept AS (SELECT threshold, n_accepted / total AS coverage, CASE WHEN n_accepted > 0 THEN 1 - n_wrong_accepted / n_accepted ELSE 1.0 END AS selective_accuracy, n_accepted, n_wrong_accepted FROM hit)"""
SQL_TEST = f"{sql_scored()}, test AS (SELECT * FROM scored WHERE split = 'test')"
SWEEP_COLUMNS = "round(threshold, 6) AS threshold, round(coverage, 6) AS coverage, round(selective_accuracy, 6) AS selective_accuracy, n_accepted, n_wrong_accepted"


def test_rows(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).where("split = 'test'")


@query(f"WITH {SQL_TEST}, {SQL_SWEEP} SELECT {SWEEP_COLUMNS} FROM swept")
def risk_coverage(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibration.sweep(test_rows(spark, d)), "threshold", "coverage", "selective_accuracy")


@query(f"""WITH {SQL_TEST}, {SQL_SWEEP}, t AS (SELECT *, CASE WHEN selective_accuracy >= 0.3 AND coverage >= 0.5 THEN 1 WHEN selective_accuracy >= 0.3 THEN 2 ELSE 3 END AS tier FROM swept)
SELECT {SWEEP_COLUMNS}, tier FROM t ORDER BY tier, CASE WHEN tier < 3 THEN threshold END NULLS LAST, selective_accuracy DESC, coverage DESC, threshold LIMIT 1""")
def pick_threshold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibration.pick_threshold(calibration.sweep(test_rows(spark, d)), 0.3, 0.5), "threshold", "coverage", "selective_accuracy")


@query(f"""WITH {SQL_TEST}, acc AS (SELECT -list_sum(list_transform(p, lambda x: x * ln(x + 1e-12))) AS ent, correct FROM test WHERE conf >= 0.3),
qs AS (SELECT quantile_cont(ent, [{', '.join(repr(0.5 + 0.5 * i / 39) for i in range(40))}]::DOUBLE[]) AS l FROM acc),
q AS (SELECT unnest(range(40)) AS i, unnest(l) AS threshold FROM qs),
tried AS (SELECT i, threshold, avg(correct::INT) FILTER (ent <= threshold) AS a FROM q CROSS JOIN acc GROUP BY ALL),
down AS (SELECT *, min((a >= 0.1)::INT) OVER (ORDER BY threshold DESC, i DESC ROWS UNBOUNDED PRECEDING) AS ok FROM tried WHERE a IS NOT NULL)
SELECT round(coalesce(min(threshold), ln(7)), 5) AS entropy_threshold FROM down WHERE ok = 1""")
def entropy_threshold(spark: SparkSession, d: str) -> DataFrame:
    found = calibration.entropy_threshold(test_rows(spark, d), 0.3, 0.1)
    return found.select(F.round("entropy_threshold", 5).alias("entropy_threshold"))


SQL_FITTED = sql_temperature().removeprefix("WITH ").rsplit(" SELECT ", 1)[0]


@query(f"""WITH {SQL_FITTED}, {sql_scored('tt').removeprefix(SQL_LOGITS + ",").replace('FROM logits)', 'FROM logits, (SELECT t AS tt FROM b6))')}, test AS (SELECT * FROM scored WHERE split = 'test'), {SQL_SWEEP},
picked AS (SELECT threshold FROM (SELECT *, CASE WHEN selective_accuracy >= 0.3 AND coverage >= 0.5 THEN 1 WHEN selective_accuracy >= 0.3 THEN 2 ELSE 3 END AS tier FROM swept)
  ORDER BY tier, CASE WHEN tier < 3 THEN threshold END NULLS LAST, selective_accuracy DESC, coverage DESC, threshold LIMIT 1),
acc AS (SELECT -list_sum(list_transform(p, lambda x: x * ln(x + 1e-12))) AS ent, correct FROM test WHERE conf >= (SELECT threshold FROM picked)),
qs AS (SELECT quantile_cont(ent, [{', '.join(repr(0.5 + 0.5 * i / 39) for i in range(40))}]::DOUBLE[]) AS l FROM acc), q AS (SELECT unnest(range(40)) AS i, unnest(l) AS threshold FROM qs),
tried AS (SELECT i, threshold, avg(correct::INT) FILTER (ent <= threshold) AS a FROM q CROSS JOIN acc GROUP BY ALL),
down AS (SELECT *, min((a >= 0.3)::INT) OVER (ORDER BY threshold DESC, i DESC ROWS UNBOUNDED PRECEDING) AS ok FROM tried WHERE a IS NOT NULL),
lim AS (SELECT coalesce(min(threshold), ln(7)) AS e FROM down WHERE ok = 1), taken AS (SELECT * FROM acc WHERE ent <= (SELECT e FROM lim))
SELECT round((SELECT t FROM b6), 3) AS temperature, round((SELECT threshold FROM picked), 6) AS confidence_threshold, round((SELECT e FROM lim), 4) AS entropy_threshold, round(ln(7), 6) AS max_entropy, 0.3::DOUBLE AS target_precision,
  count(*) AS n_accepted, round(count(*) / (SELECT count(*) FROM test), 6) AS coverage, round(coalesce(avg(correct::INT), 1), 6) AS selective_accuracy FROM taken""")
def calibration_report(spark: SparkSession, d: str) -> DataFrame:
    """The whole calibration in one row; the wrong pairs that are left have a query of their own."""
    found = calibration.calibrate(logits(spark, d), 0.3, 0.5)
    rounds = {"temperature": 3, "confidence_threshold": 6, "entropy_threshold": 4, "max_entropy": 6}
    plain = found.select(*[F.round(c, n).alias(c) for c, n in rounds.items()], "target_precision", "measured.n_accepted", "measured.coverage", "measured.selective_accuracy")
    return rounded(plain, "coverage", "selective_accuracy")


@query(f"WITH {SQL_TEST} SELECT label::INT AS label, pred::INT AS pred, count(*) AS n FROM test WHERE conf >= 0.4 AND NOT correct GROUP BY ALL ORDER BY n DESC, label, pred LIMIT 8")
def residual_pairs(spark: SparkSession, d: str) -> DataFrame:
    return calibration.residual_errors(calibration.accepted_rows(test_rows(spark, d), 0.4, math.log(7) + 1))


@query(f"WITH {sql_scored()} SELECT label::VARCHAR AS label, pred::VARCHAR AS pred, count(*) AS n FROM scored WHERE NOT correct GROUP BY ALL ORDER BY n DESC, label DESC, pred DESC LIMIT 5")
def top_confusions(spark: SparkSession, d: str) -> DataFrame:
    return metrics.top_confusions(scored(spark, d))


@query(f"""WITH {sql_scored()}, b AS (SELECT ceil(conf * 15) AS bin, count(*) AS n, avg(conf) AS c, avg(correct::INT) AS a FROM scored GROUP BY 1),
{sql_scored('3.0').replace('logits AS', 'logits3 AS').replace('FROM logits)', 'FROM logits3)').replace('powers AS', 'powers3 AS').replace('FROM powers)', 'FROM powers3)').replace('probs AS', 'probs3 AS').replace('FROM probs)', 'FROM probs3)').replace('scored AS', 'scored3 AS')},
b3 AS (SELECT ceil(conf * 15) AS bin, count(*) AS n, avg(conf) AS c, avg(correct::INT) AS a FROM scored3 GROUP BY 1)
SELECT 'before' AS stage, (SELECT round(avg(correct::INT), 6) FROM scored) AS accuracy, round(sum(n * abs(a - c)) / sum(n), 6) AS ece FROM b
UNION ALL SELECT 'after', (SELECT round(avg(correct::INT), 6) FROM scored3), round(sum(n * abs(a - c)) / sum(n), 6) FROM b3""")
def temperature_before_after(spark: SparkSession, d: str) -> DataFrame:
    return rounded(calibration.before_after(logits(spark, d), 3.0), "accuracy", "ece")


@query(f"""WITH {sql_scored()}, g AS (SELECT avg((label = 0)::INT) AS stressed, (SELECT avg(correct::INT) FROM scored) AS clean FROM scored)
SELECT round(clean, 6) AS clean, round(stressed, 6) AS stressed, round(clean - stressed, 6) AS gap, CASE WHEN clean - stressed > 0.15 THEN 'large' WHEN clean - stressed > 0.07 THEN 'moderate' ELSE 'small' END AS level FROM g""")
def robustness_gap(spark: SparkSession, d: str) -> DataFrame:
    """Against a stand-in for a stressed model that always says the first class."""
    rows = scored(spark, d)
    return rounded(metrics.robustness_gap(rows, rows.withColumn("correct", F.col("label") == 0)), "clean", "stressed", "gap")


@query(f"""WITH {sql_scored()}, q AS (SELECT label, correct, list_position(list_transform(z, lambda x: round_even(x / 2, 0)), list_max(list_transform(z, lambda x: round_even(x / 2, 0)))) - 1 = label AS other FROM scored JOIN logits USING (id, label)),
r AS (SELECT label AS class, avg(correct::INT) AS base, avg(other::INT) AS other FROM q GROUP BY 1),
a AS (SELECT k AS class, coalesce(base, 0) AS base, coalesce(other, 0) AS other FROM range(7) c(k) LEFT JOIN r ON k = class)
SELECT class, round(base, 6) AS base, round(other, 6) AS other, round(other - base, 6) AS change, other - base < -0.05 AS worse FROM a""")
def quantized_recall_drop(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d)
    coarse = metrics.with_predictions(rows.withColumn("probs", F.transform("logits", lambda v: F.bround(v / 2, 0))))
    return rounded(metrics.recall_drop(rows, coarse), "base", "other", "change")


@query(f"WITH {SQL_SPLIT} SELECT grp, class, split FROM splits")
def group_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_split(order_records(spark, d))


@query(f"WITH {SQL_SPLIT} SELECT class, split, count(*) AS n FROM splits GROUP BY ALL")
def group_split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_split(order_records(spark, d)).groupBy("class", "split").agg(F.count("*").alias("n"))


@query(f"WITH {SQL_RECORDS} SELECT grp, class FROM dominant")
def dominant_class(spark: SparkSession, d: str) -> DataFrame:
    return splitting.dominant_class(order_records(spark, d))


@query(f"WITH {SQL_SPLIT} SELECT id, grp, records.class, coalesce(split, 'train') AS split FROM records LEFT JOIN splits USING (grp)")
def split_assignment(spark: SparkSession, d: str) -> DataFrame:
    records = order_records(spark, d)
    return splitting.assign(records, splitting.group_split(records)).select("id", "grp", "class", "split")


@query(f"WITH {SQL_DOCS} SELECT grp, list_sort(list(DISTINCT split)) AS splits FROM recs GROUP BY 1 HAVING count(DISTINCT split) > 1")
def group_leakage(spark: SparkSession, d: str) -> DataFrame:
    return audit.split_groups(document_records(spark, d))


@query(f"WITH {SQL_DOCS} SELECT grp FROM recs WHERE split = 'train' INTERSECT SELECT grp FROM recs WHERE split <> 'train'")
def group_intersection(spark: SparkSession, d: str) -> DataFrame:
    r = document_records(spark, d)
    return r.where("split = 'train'").select("grp").intersect(r.where("split <> 'train'").select("grp"))


@query(f"WITH {SQL_DOCS}, c AS (SELECT class, count(*) AS n FROM recs GROUP BY 1) SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / min(n), 6) AS ratio FROM c")
def imbalance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(audit.imbalance(document_records(spark, d)), "ratio")


@query(f"WITH {SQL_DOCS} SELECT class, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM recs GROUP BY 1")
def class_split_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return audit.class_split_counts(document_records(spark, d))


@query("SELECT lang, source, count(*) AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY CUBE (lang, source)")
def crosstab_margins(spark: SparkSession, d: str) -> DataFrame:
    return audit.counts_with_margins(table(spark, d, "documents").where("lang IS NOT NULL AND source IS NOT NULL"), "lang", "source")


@query(f"WITH {SQL_DOCS} SELECT count(DISTINCT grp) AS n_groups, round(count(*) / count(DISTINCT grp), 6) AS mean_size FROM recs")
def group_counts(spark: SparkSession, d: str) -> DataFrame:
    r = document_records(spark, d).agg(F.count_distinct("grp").alias("n_groups"), (F.count("*") / F.count_distinct("grp")).alias("mean_size"))
    return rounded(r, "mean_size")


@query("SELECT round(quantile_cont(n_chars, 0.1), 6) AS p10, round(quantile_cont(n_chars, 0.5), 6) AS p50, round(quantile_cont(n_chars, 0.9), 6) AS p90, round(stddev_pop(n_chars), 4) AS std FROM documents")
def percentile_stats(spark: SparkSession, d: str) -> DataFrame:
    found = audit.distribution(document_records(spark, d), "n_chars")
    return rounded(found, "p10", "p50", "p90").withColumn("std", F.round("std", 4))


@query("SELECT p_brand AS class, round(quantile_cont(greatest(p_size, p_retailprice / 100) / greatest(1, least(p_size, p_retailprice / 100)), 0.5), 6) AS median FROM part GROUP BY 1")
def median_ratio_check(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(F.col("p_brand").alias("class"), F.col("p_size").alias("w"), (F.col("p_retailprice") / 100).alias("h"))
    return rounded(audit.median_aspect(parts), "median")


@query("""SELECT 'all' AS class, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem
UNION ALL SELECT l_returnflag, round(quantile_cont(l_quantity, 0.1), 6), round(quantile_cont(l_quantity, 0.5), 6), round(quantile_cont(l_quantity, 0.9), 6) FROM lineitem GROUP BY 1""")
def class_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles by class: one class that holds all rows with many values, and a few with repeated ones."""
    lines, names = table(spark, d, "lineitem"), ["p10", "p50", "p90"]
    one = quantiles.percentiles_by(lines.withColumn("class", F.lit("all")), ["class"], F.col("l_extendedprice"), [0.1, 0.5, 0.9], names)
    some = quantiles.percentiles_by(lines.withColumnRenamed("l_returnflag", "class"), ["class"], F.col("l_quantity"), [0.1, 0.5, 0.9], names)
    return rounded(one.unionByName(some), *names)


@query("SELECT l_orderkey AS o, l_linenumber AS l, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS number, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS within FROM lineitem")
def dense_numbering(spark: SparkSession, d: str) -> DataFrame:
    """Places in an order, in the whole table and within a flag."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    both = numbering.dense_numbers(numbering.dense_numbers(lines, order, "number"), order, "within", by=["l_returnflag"])
    return both.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), "number", "within")


@query("SELECT doc_id AS ordinal, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"), F.sha2("text", 256).alias("h"))
    return dedup.exact_duplicates(docs).select("ordinal", "kept")


SQL_UNIQUE = SQL_HASHES + ", uniques AS (SELECT h, min(ordinal) AS ordinal FROM hashes GROUP BY 1)"
HAMMING = "(bit_count((xor(a.h, b.h) & 9223372036854775807::HUGEINT)::BIGINT) + (xor(a.h, b.h) >> 63)::BIGINT)"


@query(f"WITH {SQL_UNIQUE} SELECT a.ordinal AS a, b.ordinal AS b, {HAMMING}::INT AS distance FROM uniques a JOIN uniques b ON a.ordinal < b.ordinal AND a.h <> b.h WHERE {HAMMING} <= 4")
def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.hamming_pairs(dedup.distinct_hashes(hashes(spark, d)), 4)


@query(f"""WITH {SQL_UNIQUE} SELECT a.ordinal AS a, b.ordinal AS b, {HAMMING}::INT AS distance FROM uniques a JOIN uniques b
ON a.ordinal < b.ordinal AND bit_count((xor(a.h >> 52, b.h >> 52))::BIGINT) <= 1 WHERE {HAMMING} <= 4""")
def prefix_bucket_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.hamming_pairs(dedup.distinct_hashes(hashes(spark, d)), 4, mode="prefix")


@query(f"WITH {SQL_HASHES} SELECT a.ordinal AS id FROM hashes a WHERE a.ordinal % 5 = 0 AND EXISTS (SELECT 1 FROM hashes b WHERE b.ordinal % 5 <> 0 AND {HAMMING} <= 4)")
def leak_semi_join(spark: SparkSession, d: str) -> DataFrame:
    h = hashes(spark, d).withColumnRenamed("ordinal", "id")
    return dedup.leaked(h.where("id % 5 = 0"), h.where("id % 5 <> 0"), 4)


@query(f"""WITH {SQL_HASHES}, e AS (SELECT * FROM hashes WHERE ordinal % 5 = 0), l AS (SELECT count(*) AS leaked FROM e a WHERE EXISTS (SELECT 1 FROM hashes b WHERE b.ordinal % 5 <> 0 AND {HAMMING} <= 4))
SELECT (SELECT count(*) FROM e) AS evaluated, leaked, round(100.0 * leaked / (SELECT count(*) FROM e), 6) AS percent FROM l""")
def perceptual_leak_pct(spark: SparkSession, d: str) -> DataFrame:
    rows = hashes(spark, d).select(F.col("ordinal").alias("id"), "h", "class", F.when(F.col("ordinal") % 5 == 0, "test").otherwise("train").alias("split"))
    return rounded(audit.leak_percentage(rows, 4, per_class=None), "percent")


def sql_greedy(near: str) -> str:
    """Item by item: it stays if no kept hash is near; ``near`` is a condition on x, a kept hash, and s.h."""
    return f"""WITH RECURSIVE {SQL_UNIQUE}, seq AS (SELECT ordinal, h, row_number() OVER (ORDER BY ordinal) AS rn FROM uniques),
g AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS ids, []::HUGEINT[] AS hs UNION ALL
  SELECT s.rn, CASE WHEN free THEN list_append(ids, s.ordinal) ELSE ids END, CASE WHEN free THEN list_append(hs, s.h) ELSE hs END
  FROM (SELECT seq.*, g.ids, g.hs, len(list_filter(g.hs, lambda x: {near})) = 0 AS free FROM g JOIN seq ON seq.rn = g.rn + 1) s)
SELECT unnest(ids) AS ordinal FROM g WHERE rn = (SELECT max(rn) FROM seq)"""


NEAR = HAMMING.replace("a.h", "x").replace("b.h", "seq.h") + " <= 4"


@query(sql_greedy(NEAR))
def greedy_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.greedy_dedup(hashes(spark, d), 4)


@query(sql_greedy(NEAR + " AND bit_count((xor(x >> 52, seq.h >> 52))::BIGINT) <= 1"))
def greedy_dedup_prefix(spark: SparkSession, d: str) -> DataFrame:
    return dedup.greedy_dedup(hashes(spark, d), 4, mode="prefix")


@query(sql_greedy(NEAR).replace(SQL_UNIQUE, SQL_CHAINS + ", uniques AS (SELECT h, min(ordinal) AS ordinal FROM hashes GROUP BY 1)"))
def greedy_chains(spark: SparkSession, d: str) -> DataFrame:
    """Removal where near hashes form chains, in which every other one stays, by components of more pairs than a task is given."""
    return dedup.greedy_dedup(chain_hashes(spark, d), 4, task_edges=500)


@query(f"WITH {SQL_CROWDED}, uniques AS (SELECT h, min(ordinal) AS ordinal FROM hashes GROUP BY 1) SELECT a.ordinal AS a, b.ordinal AS b, {HAMMING}::INT AS distance FROM uniques a JOIN uniques b ON a.ordinal < b.ordinal WHERE {HAMMING} <= 4")
def crowded_band_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Near pairs where a third of the hashes have one band in common, with a limit that makes such bands be cut."""
    return dedup.hamming_pairs(dedup.distinct_hashes(crowded_hashes(spark, d)), 4, hot=100)


@query(f"WITH {SQL_DOCS} SELECT id, class, rank FROM (SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(id::VARCHAR || ':1234'), id) AS rank FROM recs) WHERE rank <= 60")
def sample_per_class(spark: SparkSession, d: str) -> DataFrame:
    return splitting.sample_per_class(document_records(spark, d), 60, 1234).select("id", "class", "rank")


@query(f"""WITH {SQL_DOCS}, few AS (SELECT id, class FROM (SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(id::VARCHAR || ':0'), id) AS rank FROM recs) WHERE rank <= 25)
SELECT id, class FROM few ORDER BY md5(id::VARCHAR || ':1'), id LIMIT 100""")
def representative_set(spark: SparkSession, d: str) -> DataFrame:
    return splitting.representative_set(document_records(spark, d), 100, 4).select("id", "class")


@query(f"WITH {SQL_DOCS} SELECT id FROM recs ORDER BY md5(id::VARCHAR || ':0'), id LIMIT 400")
def evaluation_subset(spark: SparkSession, d: str) -> DataFrame:
    return splitting.evaluation_subset(document_records(spark, d)).select("id")


def sql_number(*key: str, seed: int) -> str:
    return "('0x' || md5(" + " || ':' || ".join([*(f"({k})::VARCHAR" for k in key), f"'{seed}'"]) + ")[1:15])::BIGINT"


@query(f"""WITH {SQL_DOCS}, ranked AS (SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(id::VARCHAR || ':42'), id) - 1 AS rank, count(*) OVER (PARTITION BY class) AS size FROM recs WHERE class IS NOT NULL),
classes AS (SELECT class, max(size) AS size, row_number() OVER (ORDER BY class) - 1 AS k FROM ranked GROUP BY class),
draws AS (SELECT i AS draw, {sql_number('i', seed=42)} % (SELECT count(*) FROM classes) AS k FROM range(800) r(i)),
picked AS (SELECT draw, class, size, row_number() OVER (PARTITION BY class ORDER BY draw) - 1 AS nth FROM draws JOIN classes USING (k))
SELECT draw, picked.class, id FROM picked JOIN ranked ON ranked.class = picked.class AND ranked.rank = (nth + {sql_number('nth // picked.size', seed=42)} % picked.size) % picked.size""")
def balanced_draws(spark: SparkSession, d: str) -> DataFrame:
    return splitting.balanced_draws(document_records(spark, d), 800).select("draw", "class", "id")


@query(f"WITH {SQL_DOCS} SELECT id, row_number() OVER (ORDER BY md5(id::VARCHAR || ':3'), id) AS place FROM recs ORDER BY place LIMIT 200")
def epoch_order(spark: SparkSession, d: str) -> DataFrame:
    """The first records of an epoch, which a reader would take from the sorted table."""
    first = splitting.epoch_order(document_records(spark, d), 3).limit(200)
    return first.withColumn("place", F.row_number().over(Window.orderBy(splitting.seeded_order(F.col("id"), 3), "id")).cast("long")).select("id", "place")


@query("WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1) SELECT greatest(1, floor(floor(avg(n)) * count(*) / 64))::BIGINT AS steps FROM c WHERE n > 0")
def balanced_epoch_size(spark: SparkSession, d: str) -> DataFrame:
    return splitting.balanced_epoch_size(document_records(spark, d).groupBy("class").agg(F.count("*").alias("n")), 64)


@query(f"WITH {SQL_DOCS} SELECT id, format('{{}}_{{}}_{{:05d}}.jpg', class, split, row_number() OVER (PARTITION BY class, split ORDER BY id) - 1) AS file FROM recs")
def numbered_outputs(spark: SparkSession, d: str) -> DataFrame:
    return curation.numbered(document_records(spark, d).withColumn("ordinal", F.col("id"))).select("id", "file")


#: Label lines made of order lines: boxes, polygons, odd numbers of values, ids that are none, boxes that are too thin.
DECIMAL = "concat('0.', lpad(cast(({}) % 1000 AS STRING), 3, '0'))"
LINE_PARTS = [
    "concat_ws(' ', cast(l_suppkey % 9 AS STRING), {a}, {b}, {c}, {d})", "concat_ws('  ', cast(l_suppkey % 9 AS STRING), {a}, {b}, {c}, {d}, {e}, {f}) || ' '",
    "concat_ws(' ', 'x', {a}, {b}, {c}, {d})", "concat_ws(' ', '3', {a}, {b})", "concat_ws(' ', '4', {a}, {b}, {c}, {d}, {e})", "concat_ws(' ', '+5', {a}, {b}, '0.00001', {d})", "concat_ws(' ', '6', {a}, 'y', {c}, {d})",
]


def label_line(kind: str = "STRING") -> str:
    """SQL of a label line; both engines understand it."""
    numbers = {k: DECIMAL.format(f"l_orderkey * {m} + l_linenumber * {p}") for k, m, p in (("a", 7, 131), ("b", 11, 57), ("c", 13, 211), ("d", 3, 97), ("e", 17, 31), ("f", 19, 71))}
    cases = " ".join(f"WHEN {i} THEN {part.format(**numbers)}" for i, part in enumerate(LINE_PARTS))
    return f"CASE (l_orderkey + l_linenumber) % {len(LINE_PARTS)} {cases} END".replace("STRING", kind)


SQL_BOXES = f"""lines AS (SELECT l_orderkey AS o, l_linenumber AS l, {label_line('VARCHAR')} AS line FROM lineitem),
parts AS (SELECT o, l, string_split_regex(trim(line), '\\s+') AS p FROM lines),
vals AS (SELECT o, l, CASE WHEN regexp_full_match(p[1], '[+-]?\\d+') THEN try_cast(p[1] AS INT) END AS cls, list_transform(p[2:], lambda x: try_cast(x AS DOUBLE)) AS v FROM parts),
sane AS (SELECT * FROM vals WHERE cls IS NOT NULL AND len(v) >= 4 AND len(list_filter(v, lambda x: x IS NULL)) = 0 AND len(v) % 2 = 0),
ends AS (SELECT o, l, cls, CASE WHEN len(v) = 4 THEN [v[1] - v[3] / 2, v[2] - v[4] / 2, v[1] + v[3] / 2, v[2] + v[4] / 2]
  ELSE [list_min(list_filter(v, lambda x, i: i % 2 = 1)), list_min(list_filter(v, lambda x, i: i % 2 = 0)), list_max(list_filter(v, lambda x, i: i % 2 = 1)), list_max(list_filter(v, lambda x, i: i % 2 = 0))] END AS e FROM sane),
boxes AS (SELECT o, l, cls, least(greatest(e[1], 0), 1) AS x0, least(greatest(e[2], 0), 1) AS y0, least(greatest(e[3], 0), 1) AS x1, least(greatest(e[4], 0), 1) AS y1 FROM ends),
parsed AS (SELECT * FROM boxes WHERE x1 - x0 >= 1e-4 AND y1 - y0 >= 1e-4)"""


@query(f"WITH {SQL_BOXES} SELECT o, l, cls, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM parsed")
def parse_labels(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.expr(label_line()).alias("line"))
    return rounded(lines.withColumn("b", labels.parse_label_line(F.col("line"))).where("b IS NOT NULL").select("o", "l", "b.*"), "x0", "y0", "x1", "y1")


#: Class names made of orders: a beginning, an amount and an end.
NAME_PIECES = (
    ["", "koin ", "uang ", "RP. ", "class", "Background ", "dua "],
    ["1000", "2", "50k", "20,000", "seribu", "Lima Puluh ribu", "15", "100.000", "", "10rb", "3000", "2022", "dollar", "500"],
    ["", " belakang", " IDR", "_2", " logam"],
)
NAME_SQL = " || ".join(f"list_element([{', '.join(repr(x) for x in xs)}], (o_orderkey // {m}) % {len(xs)} + 1)" for xs, m in zip(NAME_PIECES, (1, 7, 98)))
SQL_HOLDS = lambda parts: "(" + " OR ".join(f"contains(s, '{p}')" for p in parts) + ")"
SQL_CLASS = (
    f"CASE WHEN name = '' OR ({SQL_HOLDS(labels.NOT_NOTES)} AND NOT {SQL_HOLDS([c for c, *_ in labels.CLASSES] + [f'{int(c) // 1000}k' for c, *_ in labels.CLASSES])}) THEN NULL "
    + " ".join(f"WHEN {SQL_HOLDS(parts)} THEN '{c}'" for c, parts in labels.NAME_PARTS)
    + " "
    + " ".join(f"WHEN digits IN ('{c}', '{int(c) // 1000}') THEN '{c}'" for c, *_ in labels.CLASSES)
    + " END"
)


@query(f"WITH n AS (SELECT o_orderkey AS id, {NAME_SQL} AS name FROM orders), p AS (SELECT *, trim(lower(name)) AS s, regexp_replace(trim(lower(name)), '[^0-9]', '', 'g') AS digits FROM n) SELECT id, name, {SQL_CLASS} AS class FROM p")
def normalize_class(spark: SparkSession, d: str) -> DataFrame:
    pieces = [F.array(*map(F.lit, xs))[F.pmod(F.floor(F.col("o_orderkey") / m), F.lit(len(xs))).cast("int")] for xs, m in zip(NAME_PIECES, (1, 7, 98))]
    names = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(*pieces).alias("name"))
    return names.select("id", "name", labels.normalize_class(F.col("name")).alias("class"))


@query(f"""WITH {SQL_BOXES}, i AS (SELECT doc_id AS stem, CASE WHEN n_chars % 11 = 0 THEN -1 ELSE 480 END AS height FROM documents),
f AS (SELECT DISTINCT o AS stem FROM lines), j AS (SELECT i.stem, height, f.stem IS NOT NULL AS has_label, l, cls FROM i LEFT JOIN f USING (stem) LEFT JOIN parsed ON parsed.o = i.stem),
k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY l NULLS FIRST) AS nth FROM j WHERE NOT has_label OR height < 0 OR l IS NOT NULL),
r AS (SELECT CASE WHEN NOT has_label THEN 'no_label' WHEN height < 0 THEN 'unreadable' WHEN cls IS NULL OR cls NOT IN (0, 2, 4) THEN 'unknown_class' ELSE 'gated' END AS reason FROM k WHERE (has_label AND height >= 0) OR nth = 1)
SELECT reason, count(*) AS n FROM r GROUP BY 1""")
def label_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Images met with their label lines and class names; documents stand for images, order lines for label lines."""
    keys = [F.lit("set").alias("dataset"), F.lit("train").alias("split")]
    height = F.when(F.col("n_chars") % 11 == 0, -1).otherwise(480)
    pictures = table(spark, d, "documents").select(*keys, F.col("doc_id").cast("string").alias("stem"), F.lit(640).alias("width"), height.alias("height"))
    lines = table(spark, d, "lineitem").select(*keys, F.col("l_orderkey").cast("string").alias("stem"), F.col("l_linenumber").alias("line_no"), F.expr(label_line()).alias("line"))
    names = spark.createDataFrame([("set", 0, "1000"), ("set", 1, "koin"), ("set", 2, "5k"), ("set", 4, "seratus")], "dataset string, cls int, name string")
    found = curation.reason()
    gated = F.when(found.isNull() | (found == "too_small"), "gated").otherwise(found)
    return curation.label_rows(pictures, lines, names).select(gated.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT p_partkey AS id, p_size * 10.0::DOUBLE AS w, p_retailprice / 4 AS h FROM part), s AS (SELECT *, least(greatest(300 / greatest(1.0, least(w, h)), 1.0), 2.5) AS f FROM b)
SELECT id, round(greatest(0.06 * f, 6 / greatest(w, 1.0)), 6) AS pad_w, round(greatest(0.06 * f, 6 / greatest(h, 1.0)), 6) AS pad_h FROM s""")
def adaptive_padding(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 10.0).alias("w"), (F.col("p_retailprice") / 4).alias("h"))
    w, h = geometry.adaptive_padding(F.col("w"), F.col("h"))
    return rounded(boxes.select("id", w.alias("pad_w"), h.alias("pad_h")), "pad_w", "pad_h")


@query("""WITH b AS (SELECT l_orderkey AS o, l_linenumber AS l, l_discount AS x0, l_tax AS y0, l_discount + l_quantity / 100 AS x1, l_tax + l_quantity / 100 AS y1, 640.0 AS w, 480.0 AS h FROM lineitem),
s AS (SELECT *, least(greatest(300 / greatest(1.0, least((x1 - x0) * w, (y1 - y0) * h)), 1.0), 2.5) AS f FROM b),
p AS (SELECT *, (x1 - x0) * greatest(0.06::DOUBLE * f, 6 / greatest((x1 - x0) * w, 1.0)) AS pw, (y1 - y0) * greatest(0.06::DOUBLE * f, 6 / greatest((y1 - y0) * h, 1.0)) AS ph FROM s)
SELECT o, l, greatest(0, round_even((x0 - pw) * w, 0))::INT AS x1, greatest(0, round_even((y0 - ph) * h, 0))::INT AS y1, least(w, round_even((p.x1 + pw) * w, 0))::INT AS x2, least(h, round_even((p.y1 + ph) * h, 0))::INT AS y2 FROM p""")
def crop_rectangles(spark: SparkSession, d: str) -> DataFrame:
    box = table(spark, d, "lineitem").selectExpr("l_orderkey AS o", "l_linenumber AS l", "l_discount AS x0", "l_tax AS y0", "l_discount + l_quantity / 100 AS x1", "l_tax + l_quantity / 100 AS y1")
    rect = geometry.crop_rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(640.0), F.lit(480.0))
    return box.select("o", "l", rect.alias("r")).select("o", "l", "r.*")


@query("""SELECT CASE WHEN n_chars % 50 = 0 THEN 'no_label' WHEN n_chars % 50 = 1 THEN 'unreadable' WHEN lang = 'es' THEN 'unknown_class' WHEN n_chars < 300 THEN 'too_small' WHEN n_chars % 7 < 2 THEN 'too_blurry' ELSE 'kept' END AS reason, count(*) AS n FROM documents GROUP BY 1""")
def reason_counters(spark: SparkSession, d: str) -> DataFrame:
    """The gates in order, over documents as stand-ins for crops."""
    n = F.col("n_chars")
    side = F.when(n < 300, 20).otherwise(100)
    rows = table(spark, d, "documents").select(
        F.when(n % 50 != 0, True).alias("has_label"), F.when(n % 50 == 1, -1).otherwise(100).alias("height"), F.when(F.col("lang") != "es", F.col("lang")).alias("class"),
        F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), side.alias("x2"), side.alias("y2")).alias("rect"), F.when(n % 7 < 2, 5.0).otherwise(90.0).alias("blur"),
    )
    return curation.reason_counts(rows.select(F.coalesce(curation.reason(F.col("blur")), F.lit("kept")).alias("reason")))


@query("""SELECT event_id AS id, event_id % 1100 AS step, round(CASE WHEN event_id % 1100 < 80 THEN 1e-3 * (event_id % 1100 / 80.0) ELSE 1e-7 + 0.5 * (1e-3 - 1e-7) * (1 + cos(pi() * least(greatest((event_id % 1100 - 80) / 920.0, 0), 1))) END, 10) AS rate FROM events""")
def warmup_cosine(spark: SparkSession, d: str) -> DataFrame:
    """The learning rate of every event's step."""
    steps = table(spark, d, "events").select(F.col("event_id").alias("id"), (F.col("event_id") % 1100).alias("step"))
    return steps.select("id", "step", F.round(scores.warmup_cosine(F.col("step"), 1e-3, 1000, 80), 10).alias("rate"))


@query("SELECT vec_id AS id, i, round_even(v::DOUBLE / 0.05 + 3, 0)::INT AS q, round((round_even(v::DOUBLE / 0.05 + 3, 0) - 3) * 0.05, 6) AS back FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)")
def quantize_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("i", "v"))
    q = scores.quantize(F.col("v").cast("double"), 0.05, 3)
    return v.select("id", F.col("i").cast("long").alias("i"), q.alias("q"), F.round(scores.dequantize(q, 0.05, 3), 6).alias("back"))


@query("""WITH t AS (SELECT vec_id AS id, vec_id // 32 AS batch, list_transform(range(7), lambda k: (k = label % 7)::INT::DOUBLE) AS y FROM embeddings), n AS (SELECT id, y, coalesce(lead(y) OVER w, first_value(y) OVER w) AS o FROM t WINDOW w AS (PARTITION BY batch ORDER BY id))
SELECT id, list_transform(range(7), lambda k: round(y[k + 1] * 0.7 + o[k + 1] * (1 - 0.7), 6)) AS target FROM n""")
def mixup_labels(spark: SparkSession, d: str) -> DataFrame:
    """Targets mixed with the next row of a batch at a fixed share."""
    w = Window.partitionBy("batch").orderBy("id")
    y = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 32).alias("batch"), scores.one_hot(F.col("label") % 7, 7).alias("y"))
    other = F.coalesce(F.lead("y").over(w), F.first("y").over(w))
    return y.select("id", F.transform(augment.mix(F.col("y"), other, F.lit(0.7)), lambda v: F.round(v, 6)).alias("target"))


def sql_uniform(*key: str, seed: int = 0) -> str:
    return f"(({sql_number(*key, seed=seed)} % 1073741824 + 0.5::DOUBLE) / 1073741824)"


def sql_beta(u: str, alpha: float) -> str:
    q = "[" + ", ".join(f"{v!r}::DOUBLE" for v in augment.beta_quantiles(alpha)) + "]"
    return f"(SELECT q[i + 1] + (q[i + 2] - q[i + 1]) * (p - i) FROM (SELECT {q} AS q, {u} * 1000 AS p, floor({u} * 1000)::INT AS i))"


@query(f"""WITH rows_ AS (SELECT vec_id AS id, vec_id // 32 AS batch, list_transform(embedding, lambda x: x::DOUBLE) AS px, list_transform(range(7), lambda k: (k = label % 7)::INT::DOUBLE) AS y FROM embeddings),
paired AS (SELECT *, coalesce(lead(px) OVER w, first_value(px) OVER w) AS opx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS oy, {sql_uniform('batch', seed=17)} AS u0 FROM rows_ WINDOW w AS (PARTITION BY batch ORDER BY md5(id::VARCHAR || ':0'), id)),
kinds AS (SELECT *, {sql_uniform('batch', "'17'")} AS u FROM paired),
draws AS (SELECT *, CASE WHEN u >= 0.9 THEN 'none' WHEN u < 0.45 THEN 'mixup' ELSE 'cutmix' END AS kind, {sql_uniform('id')} AS um, {sql_uniform('batch', "'9'")} AS uc, {sql_uniform('batch', "'0'")} AS uy, {sql_uniform('batch', "'1'")} AS ux FROM kinds),
betas AS (SELECT *, {sql_beta('um', 0.2)} AS bm, {sql_beta('uc', 1.0)} AS bc FROM draws),
shares AS (SELECT *, greatest(bm, 1 - bm) AS sm, floor(floor(8 * sqrt(1 - greatest(bc, 1 - bc))) / 2) AS half, floor(uy * 8) AS cy, floor(ux * 8) AS cx FROM betas),
boxes AS (SELECT *, greatest(0, least(8, cy - half)) AS y1, greatest(0, least(8, cy + half)) AS y2, greatest(0, least(8, cx - half)) AS x1, greatest(0, least(8, cx + half)) AS x2 FROM shares),
final AS (SELECT *, CASE kind WHEN 'none' THEN 1.0 WHEN 'mixup' THEN sm ELSE 1 - (y2 - y1) * (x2 - x1) / 64 END AS share FROM boxes)
SELECT batch, id, round(share, 6) AS share, list_transform(range(7), lambda k: round(y[k + 1] * share + oy[k + 1] * (1 - share), 6)) AS target,
  list_transform(range(64), lambda i: round(CASE WHEN kind = 'none' THEN px[i + 1] WHEN kind = 'mixup' THEN px[i + 1] * share + opx[i + 1] * (1 - share)
    WHEN i // 8 >= y1 AND i // 8 < y2 AND i % 8 >= x1 AND i % 8 < x2 THEN opx[i + 1] ELSE px[i + 1] END, 6)) AS pixels FROM final""")
def batch_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Mixed batches of 8 x 8 rasters; what is rounded to zero keeps its sign, as in SQL."""
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 32).alias("batch"), F.transform("embedding", lambda v: v.cast("double")).alias("pixels"), scores.one_hot(F.col("label") % 7, 7).alias("target")
    )
    six = lambda c: F.transform(c, lambda v: F.when(F.round(v, 6) == 0, v * 0.0).otherwise(F.round(v, 6))).alias(c)
    return augment.mix_batches(rows, 8, 8, chance=0.9).select("batch", "id", F.round("share", 6).alias("share"), six("target"), six("pixels"))


@query("""WITH c AS (SELECT vec_id AS id, i // 8 AS y, i % 8 AS x, embedding[i + 1]::DOUBLE AS v, embedding AS e FROM embeddings CROSS JOIN range(64) r(i)),
l AS (SELECT id, e[(y - 1) * 8 + x + 1]::DOUBLE + e[(y + 1) * 8 + x + 1]::DOUBLE + e[y * 8 + x]::DOUBLE + e[y * 8 + x + 2]::DOUBLE - 4 * v AS d FROM c WHERE x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6)
SELECT id, round(var_pop(d), 5) AS blur FROM l GROUP BY 1""")
def laplacian_blur_8x8(spark: SparkSession, d: str) -> DataFrame:
    """Variance of the Laplacian inside 8 x 8 rasters, by expressions alone."""
    inside = [y * 8 + x for y in range(1, 7) for x in range(1, 7)]
    e = lambda i: F.col("e")[i]
    lap = F.array(*[e(i - 8) + e(i + 8) + e(i - 1) + e(i + 1) - 4 * e(i) for i in inside])
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    values = rows.select("id", F.explode(lap).alias("d"))
    return values.groupBy("id").agg(F.round(F.var_pop("d"), 5).alias("blur"))


@query(f"""WITH {SQL_HASHES}, recs AS (SELECT ordinal AS id, 'c' || class % 3 AS class, ordinal // 3 AS grp, h, ordinal % 40 AS brightness, 100 + ordinal % 50 AS w, 100 AS hh,
  CASE WHEN ordinal % 10 < 7 THEN 'train' WHEN ordinal % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM hashes),
n AS (SELECT split, class, count(*) AS n FROM recs GROUP BY ALL), t AS (SELECT max(n) / min(n) AS r FROM n WHERE split = 'train'),
e AS (SELECT * FROM recs WHERE split <> 'train'), leak AS (SELECT 100.0 * count(*) FILTER (EXISTS (SELECT 1 FROM recs b WHERE b.split = 'train' AND {HAMMING} <= 4)) / count(*) AS p FROM e a),
asp AS (SELECT class, abs(quantile_cont(greatest(w, hh) / least(w, hh), 0.5) - 2.0) AS off FROM recs GROUP BY 1)
SELECT 'imbalance' AS "check", 'warning' AS severity, 'train' AS metric, round(r::DOUBLE, 6) AS value, 8.0::DOUBLE AS threshold, 'classes are uneven' AS message FROM t WHERE r > 8
UNION ALL SELECT 'minimum', 'warning', split || '/' || class, n, 0.0, 'few records' FROM n WHERE n < CASE WHEN split = 'train' THEN 150 ELSE 25 END
UNION ALL SELECT 'group_leakage', 'error', 'groups', count(*), 0.0, 'groups in more than one split' FROM (SELECT grp FROM recs GROUP BY 1 HAVING count(DISTINCT split) > 1) HAVING count(*) > 0
UNION ALL SELECT 'perceptual_leakage', CASE WHEN p > 10 THEN 'error' ELSE 'warning' END, 'percent', round(p, 6), 3.0, 'evaluation resembles training' FROM leak WHERE p > 3
UNION ALL SELECT 'image_stats', 'warning', 'brightness_std', round(stddev_pop(brightness), 6), 22.0, 'brightness hardly varies' FROM recs HAVING stddev_pop(brightness) < 22
UNION ALL SELECT 'aspect', 'warning', class, round(off, 6), 0.45, 'median ratio is off the class''s' FROM asp WHERE off > 0.45""")
def audit_report(spark: SparkSession, d: str) -> DataFrame:
    """All checks of the audit, over hashes with made-up splits, groups, brightness and sides."""
    o = F.col("ordinal")
    split = F.when(o % 10 < 7, "train").when(o % 10 < 9, "val").otherwise("test")
    columns = [o.alias("id"), F.concat(F.lit("c"), F.col("class") % 3).alias("class"), F.floor(o / 3).alias("grp"), F.col("h").alias("h64"), (o % 40).alias("brightness"), (100 + o % 50).alias("w"), F.lit(100).alias("h"), split.alias("split")]
    ideals = spark.createDataFrame([(f"c{k}", 2.0) for k in range(3)], "class string, aspect double")
    return rounded(audit.audit(hashes(spark, d).select(*columns), ["c0", "c1", "c2"], per_class=None, ideals=ideals), "value")


@query(f"""WITH {SQL_SPLIT}, r AS (SELECT records.id, records.grp, records.class, coalesce(split, 'train') AS split FROM records LEFT JOIN splits USING (grp))
SELECT split, count(*) AS n, count(DISTINCT grp) AS n_groups FROM r GROUP BY 1""")
def split_summary(spark: SparkSession, d: str) -> DataFrame:
    records = order_records(spark, d)
    return splitting.assign(records, splitting.group_split(records)).groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("grp").alias("n_groups"))


@query("SELECT doc_id AS id, CASE WHEN greatest(n_chars, 480) <= 640 THEN n_chars ELSE round_even(n_chars * (640.0::DOUBLE / greatest(n_chars, 480)), 0) END::INT AS w, CASE WHEN greatest(n_chars, 480) <= 640 THEN 480 ELSE round_even(480 * (640.0::DOUBLE / greatest(n_chars, 480)), 0) END::INT AS h FROM documents")
def capped_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), geometry.capped_size(F.col("n_chars"), F.lit(480)).alias("s")).select("id", "s.*")


@query(f"WITH {SQL_HASHES} SELECT ordinal, (h >> 52)::BIGINT AS prefix, [(h & 4095)::BIGINT, ((h >> 12) & 8191)::BIGINT, ((h >> 25) & 8191)::BIGINT, ((h >> 38) & 8191)::BIGINT, ((h >> 51) & 8191)::BIGINT] AS bands FROM hashes")
def hash_bands(spark: SparkSession, d: str) -> DataFrame:
    return hashes(spark, d).select("ordinal", hashing.prefix(F.col("h")).alias("prefix"), F.transform(hashing.bands(F.col("h"), 5), lambda b: b["key"]).alias("bands"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: least(greatest(floor((v::DOUBLE + 1) * 127.5), 0), 255)) AS g FROM embeddings),
m AS (SELECT k, i, sum(sqrt(2 / 32.0::DOUBLE) * cos(pi() * (2 * (4 * i + s) + 1) * k / 64) * CASE WHEN k = 0 THEN 1 / sqrt(2) ELSE 1 END) AS w FROM range(8) a(k), range(8) b(i), range(4) c(s) GROUP BY ALL),
cells AS (SELECT vec_id, p // 8 AS y, p % 8 AS x, g[p + 1] AS v FROM e, range(64) r(p)),
half AS (SELECT vec_id, m.k, x, sum(w * v) AS v FROM cells JOIN m ON m.i = y GROUP BY ALL),
coef AS (SELECT vec_id, half.k AS k, m.k AS l, sum(w * v) AS c FROM half JOIN m ON m.i = x GROUP BY ALL),
middle AS (SELECT vec_id, median(c) AS c FROM coef WHERE k > 0 AND l > 0 GROUP BY 1),
hash AS (SELECT vec_id, sum(CASE WHEN coef.c > middle.c THEN 1::HUGEINT << (63 - 8 * k - l)::INT ELSE 0 END)::HUGEINT AS h FROM coef JOIN middle USING (vec_id) GROUP BY 1),
lap AS (SELECT vec_id, g[8 * abs(y - 1) + x + 1] + g[8 * (7 - abs(6 - y)) + x + 1] + g[8 * y + abs(x - 1) + 1] + g[8 * y + 7 - abs(6 - x) + 1] - 4 * v AS d FROM cells JOIN e USING (vec_id)),
blur AS (SELECT vec_id, var_pop(d) AS blur FROM lap GROUP BY 1)
SELECT vec_id::VARCHAR AS path, CASE WHEN h >= 9223372036854775808::HUGEINT THEN h - 18446744073709551616::HUGEINT ELSE h END::BIGINT AS h, round(blur * 4096, 0) AS blur_4096, round(list_avg(g) * 64, 0) AS brightness_64
FROM e JOIN hash USING (vec_id) JOIN blur USING (vec_id)""")
def image_features(spark: SparkSession, d: str) -> DataFrame:
    """Perceptual hash, sharpness and brightness of the embeddings drawn as 8 x 8 gray images; the last two as whole multiples of their unit."""
    pixels = F.transform("embedding", lambda v: F.least(F.greatest(F.floor((v.cast("double") + 1) * 127.5), F.lit(0)), F.lit(255)).cast("int"))
    data = F.unhex(F.array_join(F.transform(pixels, lambda p: F.lpad(F.hex(p), 2, "0")), ""))
    drawn = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("path"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"), data.alias("data"))
    return augment.image_features(drawn).select("path", "h", F.round(F.col("blur") * 4096, 0).alias("blur_4096"), F.round(F.col("brightness") * 64, 0).alias("brightness_64"))


SQL_UNIFORMS = ", ".join(sql_uniform("vec_id", f"'{k}'") for k in range(8))
SQL_SHAPE = lambda k: "CASE " + " ".join(f"WHEN u[1] * {sum(w for *_, w in scenes.CANVAS_ASPECTS)!r} < {sum(w for *_, w in scenes.CANVAS_ASPECTS[: i + 1])!r} THEN {a[k] / max(a[:2])!r}::DOUBLE" for i, a in enumerate(scenes.CANVAS_ASPECTS[:-1])) + f" ELSE {scenes.CANVAS_ASPECTS[-1][k] / max(scenes.CANVAS_ASPECTS[-1][:2])!r}::DOUBLE END"


@query(f"""WITH d AS (SELECT vec_id AS id, [{SQL_UNIFORMS}] AS u, {sql_number('vec_id', "'ground'", seed=0)} % 40 AS slot FROM embeddings),
p AS (SELECT *, 640 * (0.85::DOUBLE + 0.3::DOUBLE * u[2]) AS longer, sqrt(-2 * ln(greatest(u[4], 1e-12))) AS r FROM d)
SELECT id, greatest(64, round_even(longer * ({SQL_SHAPE(0)}), 0))::INT AS width, greatest(64, round_even(longer * ({SQL_SHAPE(1)}), 0))::INT AS height, round(0.28::DOUBLE + 0.72::DOUBLE * u[3], 6) AS share,
  round(least(greatest(0.5 + 0.2 * r * cos(2 * pi() * u[5]), 0), 1), 6) AS across, round(least(greatest(0.5 + 0.2 * r * sin(2 * pi() * u[5]), 0), 1), 6) AS down, slot::INT AS slot FROM p""")
def scene_plans(spark: SparkSession, d: str) -> DataFrame:
    """What is laid where, and which of 40 backgrounds is drawn, for every embedding."""
    planned = augment.scene_plans(table(spark, d, "embeddings"), F.col("vec_id"), 40)
    return rounded(planned.select(F.col("vec_id").alias("id"), "plan.*", "slot"), "share", "across", "down")


#: The embeddings as 64 x 64 gray images: each pixel is the product of two entries.
SQL_DRAWN = """drawn AS (SELECT vec_id, list_transform(range(4096), lambda p: least(greatest(floor((embedding[p // 64 + 1]::DOUBLE * embedding[(7 * (p % 64) + 3) % 64 + 1]::DOUBLE * 16 + 1) * 127.5), 0), 255)) AS g FROM embeddings)"""


@query(f"""WITH {SQL_DRAWN},
m AS (SELECT k, i, sqrt(2 / 32.0::DOUBLE) * cos(pi() * (2 * i + 1) * k / 64) * CASE WHEN k = 0 THEN 1 / sqrt(2) ELSE 1 END AS w FROM range(8) a(k), range(32) b(i)),
cells AS (SELECT vec_id, c // 32 AS y, c % 32 AS x, (g[128 * (c // 32) + 2 * (c % 32) + 1] + g[128 * (c // 32) + 2 * (c % 32) + 2] + g[128 * (c // 32) + 2 * (c % 32) + 65] + g[128 * (c // 32) + 2 * (c % 32) + 66]) / 4 AS v FROM drawn, range(1024) r(c)),
half AS (SELECT vec_id, m.k, x, sum(w * v) AS v FROM cells JOIN m ON m.i = y GROUP BY ALL),
coef AS (SELECT vec_id, half.k AS k, m.k AS l, sum(w * v) AS c FROM half JOIN m ON m.i = x GROUP BY ALL),
middle AS (SELECT vec_id, median(c) AS c FROM coef WHERE k > 0 AND l > 0 GROUP BY 1),
hash AS (SELECT vec_id, sum(CASE WHEN coef.c > middle.c THEN 1::HUGEINT << (63 - 8 * k - l)::INT ELSE 0 END)::HUGEINT AS h FROM coef JOIN middle USING (vec_id) GROUP BY 1)
SELECT vec_id::VARCHAR AS path, CASE WHEN h >= 9223372036854775808::HUGEINT THEN h - 18446744073709551616::HUGEINT ELSE h END::BIGINT AS h, round(list_avg(g) * 4096, 0) AS brightness_4096 FROM drawn JOIN hash USING (vec_id)""")
def image_features_64(spark: SparkSession, d: str) -> DataFrame:
    """Hashes and brightness of images that are shrunk for it, in stacks of one size."""
    e, p = F.transform("embedding", lambda v: v.cast("double")), F.sequence(F.lit(0), F.lit(4095))
    gray = F.transform(p, lambda i: F.least(F.greatest(F.floor((F.col("e")[F.floor(i / 64).cast("int")] * F.col("e")[(7 * (i % 64) + 3) % 64] * 16 + 1) * 127.5), F.lit(0)), F.lit(255)).cast("int"))
    data = F.unhex(F.array_join(F.transform(gray, lambda g: F.lpad(F.hex(g), 2, "0")), ""))
    drawn = table(spark, d, "embeddings").select("vec_id", e.alias("e")).select(F.col("vec_id").cast("string").alias("path"), F.lit(64).alias("height"), F.lit(64).alias("width"), F.lit(1).alias("n_channels"), data.alias("data"))
    return augment.image_features(drawn).select("path", "h", F.round(F.col("brightness") * 4096, 0).alias("brightness_4096"))


MANIFEST_ROWS = "SELECT doc_id AS id, lang AS class, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, doc_id // 3 AS grp, n_chars AS w FROM documents WHERE lang IS NOT NULL"


@query(f"""WITH r AS ({MANIFEST_ROWS}), n AS (SELECT *, greatest(w, 300) AS m, row_number() OVER (PARTITION BY class, split ORDER BY id) - 1 AS k FROM r)
SELECT format('{{}}_{{}}_{{:05d}}.jpg', class, split, k) AS file, class, split, grp::VARCHAR AS group, 'origin' AS origin, 'table' AS source,
  CASE WHEN m <= 640 THEN 300 ELSE round_even(300 * (640.0::DOUBLE / m), 0) END::INT AS h, CASE WHEN m <= 640 THEN w ELSE round_even(w * (640.0::DOUBLE / m), 0) END::INT AS w FROM n""")
def manifest_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as its sink wrote it and its source read it."""
    records = document_records(spark, d).where("class IS NOT NULL").withColumns({"ordinal": F.col("id"), "origin": F.lit("origin"), "source": F.lit("table"), "w": F.col("n_chars").cast("int"), "h": F.lit(300), "grp": F.col("grp").cast("string")})
    path = fresh_path(spark, "manifest")
    images.write_json(curation.manifest(records), path)
    return images.read_manifest(spark, path)


@query(f"SELECT id, label, list_transform(z, lambda x: round(x, 6)) AS logits FROM ({'WITH ' + SQL_LOGITS + ' SELECT * FROM logits'}) WHERE split = 'test'")
def logits_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Logits as written and read; the reader takes one split's folder only."""
    path = fresh_path(spark, "logits")
    images.write_table(logits(spark, d), path, ("split",))
    rows = images.read_logits(spark, path).where("split = 'test'")
    return rows.select("id", "label", F.transform("logits", lambda x: F.round(x, 6)).alias("logits"))


def drawn_rasters(spark: SparkSession, d: str) -> DataFrame:
    """(id, class, split, height, width, pixels): the embeddings as 8 x 8 gray images of few, smooth grays, which a JPEG keeps nearly as they are."""
    gray = F.transform("embedding", lambda v: F.least(F.greatest(F.floor((v.cast("double") + 1) * 8) * 16, F.lit(0)), F.lit(255)).cast("int"))
    pixels = F.unhex(F.array_join(F.transform(gray, lambda p: F.lpad(F.hex(p), 2, "0")), ""))
    split = F.when(F.col("vec_id") % 10 < 7, "train").when(F.col("vec_id") % 10 < 9, "val").otherwise("test")
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("c"), F.col("label")).alias("class"), split.alias("split"), F.lit(8).alias("height"), F.lit(8).alias("width"), pixels.alias("pixels"), gray.alias("gray"))


SQL_RASTERS = """rasters AS (SELECT vec_id AS id, 'c' || label AS class, CASE WHEN vec_id % 10 < 7 THEN 'train' WHEN vec_id % 10 < 9 THEN 'val' ELSE 'test' END AS split,
  list_transform(embedding, lambda v: least(greatest(floor((v::DOUBLE + 1) * 8) * 16, 0), 255)::INT) AS gray FROM embeddings),
files AS (SELECT *, format('{}_{}_{:05d}', class, split, row_number() OVER (PARTITION BY class, split ORDER BY id) - 1) AS stem FROM rasters)"""


@query(f"WITH {SQL_RASTERS} SELECT id, stem, split, class, 8 AS height, 8 AS width, true AS close FROM files")
def jpeg_files(spark: SparkSession, d: str) -> DataFrame:
    """Numbered JPEG files as the sink wrote them, decoded by Spark's own reader and held against the rasters that they were made of."""
    records = curation.numbered(drawn_rasters(spark, d).withColumn("ordinal", F.col("id")))
    path = fresh_path(spark, "jpeg")
    folders.write_jpeg_files(records, path)
    read = images.read_images(spark, path, recursive=True).select("stem", F.regexp_extract("path", r"/([^/]+)/[^/]+/[^/]+$", 1).alias("split"), F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("class"), "height", "width", "data")
    byte = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.conv(F.hex(F.substring(F.col("data"), i, F.lit(1))), 16, 10).cast("int"))
    both = read.join(records.select(F.expr("substring_index(file, '.', 1)").alias("stem"), "id", "gray"), "stem")
    off = F.aggregate(F.zip_with(byte, F.col("gray"), lambda x, y: F.abs(x - y)), F.lit(0), lambda m, x: F.greatest(m, x))
    return both.select("id", "stem", "split", "class", "height", "width", (off <= 12).alias("close"))


@query(f"WITH {SQL_RASTERS}, known AS (SELECT DISTINCT class FROM rasters) SELECT stem, split, files.class, 8 AS height, 8 AS width, dense_rank() OVER (ORDER BY files.class) - 1 AS label FROM files WHERE split = 'val'")
def labelled_split(spark: SparkSession, d: str) -> DataFrame:
    """One split of a folder of classes, by the data source that lists only that split's folders, with labels in class order and sizes from the files' heads."""
    path = fresh_path(spark, "folders")
    folders.write_jpeg_files(curation.numbered(drawn_rasters(spark, d).withColumn("ordinal", F.col("id"))), path)
    found = folders.with_sizes(folders.read_image_folders(spark, path, splits=["val"])).drop("label", "content")
    names = numbering.dense_numbers(found.select("class").distinct(), ["class"], "label")
    return found.join(names, "class").select("stem", "split", "class", "height", "width", "label")


#: Label texts of a detection set made of order lines, one line for each of an order's first lines.
DETECTION_LINES = "array_join(transform(array_sort(collect_list(struct(l_linenumber AS n, {line} AS line))), x -> x.line), chr(10))"


@query(f"""WITH {SQL_BOXES}, i AS (SELECT doc_id AS stem FROM documents WHERE doc_id % 3 > 0),
f AS (SELECT DISTINCT o AS stem FROM lines), j AS (SELECT i.stem, f.stem IS NOT NULL AS has_label, l, cls FROM i LEFT JOIN f USING (stem) LEFT JOIN parsed ON parsed.o = i.stem),
r AS (SELECT CASE WHEN NOT has_label THEN 'no_label' WHEN cls NOT IN (0, 2, 4) THEN 'unknown_class' ELSE 'gated' END AS reason FROM j WHERE NOT has_label OR l IS NOT NULL)
SELECT reason, count(*) AS n FROM r GROUP BY 1""")
def detection_set(spark: SparkSession, d: str) -> DataFrame:
    """A detection set written as files, read by the data source and met with its class map: reasons of its label lines."""
    texts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.expr(DETECTION_LINES.format(line=label_line())).alias("label"))
    pictures = table(spark, d, "documents").where("doc_id % 3 > 0").select("doc_id").join(texts, "doc_id", "left")
    split = F.when(F.col("doc_id") % 10 < 8, "train").otherwise("valid")
    gray = F.unhex(F.repeat(F.lpad(F.hex(F.col("doc_id") % 256), 2, "0"), 64))
    path = fresh_path(spark, "detection")
    folders.write_jpeg_files(pictures.select(F.format_string("%d.jpg", "doc_id").alias("file"), split.alias("split"), F.lit(8).alias("height"), F.lit(8).alias("width"), gray.alias("pixels"), "label"), path, layout="detection")
    read = materialise(folders.with_sizes(folders.read_image_folders(spark, path, "detection", dataset="set")), "detection")
    names = spark.createDataFrame([("set", 0, "1000"), ("set", 1, "koin"), ("set", 2, "5k"), ("set", 4, "seratus")], "dataset string, cls int, name string")
    found = curation.reason()
    gated = F.when(found.isNull() | (found == "too_small"), "gated").otherwise(found)
    return curation.label_rows(read.select("dataset", "split", "stem", "height", "width"), folders.label_lines(read), names).select(gated.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT vec_id AS id, (label % 7)::VARCHAR AS class, length(embedding) AS n FROM embeddings WHERE vec_id % 2 = 1 AND label % 7 = 3")
def crops_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Crops in folders by split and class, of which a reader opens one."""
    path = fresh_path(spark, "crops")
    rows = logits(spark, d).select("id", "split", (F.col("label") % 7).cast("string").alias("class"))
    pixels = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda v: F.floor((v + 1) * 127)).alias("data"))
    images.write_crops(rows.join(pixels, "id"), path)
    read = spark.read.schema("id long, data array<long>, split string, class string").parquet(path).where("split = 'test' AND class = '3'")
    return read.select("id", "class", F.size("data").cast("long").alias("n"))


@query(f"""WITH r AS (SELECT p_brand AS class, quantile_cont(greatest(p_size, p_retailprice / 100) / greatest(1, least(p_size, p_retailprice / 100)), 0.5) AS median FROM part GROUP BY 1)
SELECT 'aspect' AS "check", 'warning' AS severity, class AS metric, round(abs(median - 1.5), 6) AS value, 0.45::DOUBLE AS threshold, 'median ratio is off the class''s' AS message FROM r WHERE abs(median - 1.5) > 0.45""")
def aspect_findings(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(F.col("p_brand").alias("class"), F.col("p_size").alias("w"), (F.col("p_retailprice") / 100).alias("h"))
    ideals = parts.select("class").distinct().withColumn("aspect", F.lit(1.5))
    return rounded(audit.check_aspect(parts, ideals), "value")


@query(f"""WITH {SQL_TEST}, {SQL_SWEEP}, {sql_scored('3.0').replace('logits AS', 'logits3 AS').replace('FROM logits)', 'FROM logits3)').replace('powers AS', 'powers3 AS').replace('FROM powers)', 'FROM powers3)').replace('probs AS', 'probs3 AS').replace('FROM probs)', 'FROM probs3)').replace('scored AS', 'scored3 AS')},
test3 AS (SELECT * FROM scored3 WHERE split = 'test'), {SQL_SWEEP.replace('grid AS', 'grid3 AS').replace('FROM grid ', 'FROM grid3 ').replace('JOIN test', 'JOIN test3').replace('hit AS', 'hit3 AS').replace('FROM hit)', 'FROM hit3)').replace('swept AS', 'swept3 AS')}
SELECT 'raw' AS curve, round(threshold, 6) AS threshold, round(coverage, 6) AS coverage, round(1 - selective_accuracy, 6) AS risk FROM swept
UNION ALL SELECT 'calibrated', round(threshold, 6), round(coverage, 6), round(1 - selective_accuracy, 6) FROM swept3""")
def risk_curves(spark: SparkSession, d: str) -> DataFrame:
    both = calibration.risk_coverage(test_rows(spark, d), scored(spark, d, 3.0).where("split = 'test'"))
    return rounded(both, "threshold", "coverage", "risk")


@query("SELECT count(*) AS n, count(*) FILTER (n_chars % 40 = 0) AS failed, round(count(*) FILTER (n_chars % 40 = 0) / count(*), 6) AS ratio, count(*) FILTER (n_chars % 40 = 0) / count(*) >= 0.02 AS warn FROM documents")
def failure_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.when(F.col("n_chars") % 40 == 0, F.lit("failed")).alias("error"))
    return rounded(augment.failure_ratio(rows), "ratio")


@query(f"WITH {sql_scored()}, a AS (SELECT avg(correct::INT) AS a FROM scored) SELECT round(a, 6) AS accuracy, CASE WHEN a < 1.6 / 7 THEN 'poor' WHEN a < 0.55 THEN 'fair' ELSE 'good' END AS level FROM a")
def gray_level(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.gray_level(scored(spark, d)), "accuracy")


@query(f"""WITH {sql_scored()}, q AS (SELECT label, correct, list_position(list_transform(z, lambda x: round_even(x / 2, 0)), list_max(list_transform(z, lambda x: round_even(x / 2, 0)))) - 1 = label AS other FROM scored JOIN logits USING (id, label)),
r AS (SELECT label AS class, avg(other::INT) - avg(correct::INT) AS change FROM q GROUP BY 1), c AS (SELECT k AS class, coalesce(change, 0) AS change FROM range(7) c(k) LEFT JOIN r ON k = class),
w AS (SELECT class, change FROM c ORDER BY round(change, 12), class LIMIT 1), t AS (SELECT avg(correct::INT) AS base, avg(other::INT) AS other FROM q)
SELECT round(base, 6) AS base, round(other, 6) AS other, round(base - other, 6) AS fall, class AS worst_class, round(change, 6) AS worst_change, base - other > 0.02 AS total_worse, change < -0.05 AS class_worse FROM t, w""")
def quantized_drop(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d)
    coarse = metrics.with_predictions(rows.withColumn("probs", F.transform("logits", lambda v: F.bround(v / 2, 0))))
    return rounded(metrics.variant_drop(rows, coarse), "base", "other", "fall", "worst_change")


@query(f"""WITH {sql_scored()}, q AS (SELECT label, correct, list_position(list_transform(z, lambda x: round_even(x / 2, 0)), list_max(list_transform(z, lambda x: round_even(x / 2, 0)))) - 1 = label AS other FROM scored JOIN logits USING (id, label)),
v AS (SELECT 'fp32' AS variant, label, correct FROM q UNION ALL SELECT 'int8', label, other FROM q), n AS (SELECT count(*) AS n FROM q)
SELECT x.variant, round(n * 7 * x.bytes / 1e6, 6) AS size_mb, round(coalesce((SELECT avg(correct::INT) FROM v WHERE v.variant = x.variant), -1.0), 6) AS accuracy, round(coalesce((SELECT avg(correct::INT) FROM v WHERE v.variant = x.variant AND label = 3), -1.0), 6) AS recall_of_3,
  'RGB' AS channel_order, 7 AS n_classes FROM n, (VALUES ('fp32', 8), ('fp16', 4), ('int8', 1)) x(variant, bytes)""")
def export_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of a model's variants as its sink wrote it and as it is read, by look-ups in its maps; half precision has no evaluation."""
    rows = scored(spark, d)
    coarse = metrics.with_predictions(rows.withColumn("probs", F.transform("logits", lambda v: F.bround(v / 2, 0))))
    both = rows.select(F.lit("fp32").alias("variant"), "label", "correct").unionByName(coarse.select(F.lit("int8").alias("variant"), "label", "correct"))
    width = F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), F.lit(b).alias("bytes")) for n, b in (("fp32", 8), ("fp16", 4), ("int8", 1))])).alias("w")
    sizes = rows.agg(F.count("*").alias("n")).select("n", width).select("w.variant", (F.col("n") * 7 * F.col("w.bytes") / 1e6).alias("size_mb"))
    path, made = fresh_path(spark, "export"), metrics.export_summary(sizes, both, [f"c{k}" for k in range(7)])
    images.write_json(made, path)
    read = spark.read.schema(made.schema).json(path).select("*", F.explode(F.map_keys("sizes_mb")).alias("variant"))
    found = labels.lookup(F.col("evaluation"), F.col("variant"), F.lit(None))
    recall = labels.lookup(found["recall"], F.lit("3"), F.lit(-1.0))
    size = labels.lookup(F.col("sizes_mb"), F.col("variant"), F.lit(0.0))
    read = read.select("variant", size.alias("size_mb"), F.coalesce(found["accuracy"], F.lit(-1.0)).alias("accuracy"), recall.alias("recall_of_3"), labels.lookup(F.col("preprocessing_contract"), F.lit("channel_order"), F.lit("")).alias("channel_order"), F.size("classes").alias("n_classes"))
    return rounded(read, "size_mb", "accuracy", "recall_of_3")


@query(f"""WITH {sql_scored()}, g AS (SELECT avg((label = 0)::INT) AS stressed, (SELECT avg(correct::INT) FROM scored) AS clean FROM scored)
SELECT round(clean, 6) AS clean, round(stressed, 6) AS stressed, round(clean - stressed, 6) AS gap, CASE WHEN clean - stressed > 0.20 THEN 'large' WHEN clean - stressed > 0.10 THEN 'moderate' ELSE 'small' END AS level FROM g""")
def framing_gap(spark: SparkSession, d: str) -> DataFrame:
    """The fall of accuracy on scenes, with the cut-offs for framing."""
    rows = scored(spark, d)
    return rounded(metrics.robustness_gap(rows, rows.withColumn("correct", F.col("label") == 0), "framing"), "clean", "stressed", "gap")


@query(f"""WITH {SQL_HASHES}, r AS (SELECT ordinal AS id, h, class, ordinal % 5 = 0 AS held FROM hashes), s AS (SELECT *, row_number() OVER (PARTITION BY class, held ORDER BY md5(id::VARCHAR || ':1234'), id) AS rank FROM r),
e AS (SELECT * FROM s WHERE held AND rank <= 60), l AS (SELECT count(*) AS leaked FROM e a WHERE EXISTS (SELECT 1 FROM s b WHERE NOT b.held AND b.rank <= 60 AND {HAMMING} <= 4))
SELECT (SELECT count(*) FROM e) AS evaluated, leaked, round(100.0 * leaked / (SELECT count(*) FROM e), 6) AS percent FROM l""")
def sampled_leakage(spark: SparkSession, d: str) -> DataFrame:
    """Leakage of at most 60 records of each class, the sample that the audit compares by default."""
    rows = hashes(spark, d).select(F.col("ordinal").alias("id"), "h", "class", F.when(F.col("ordinal") % 5 == 0, "test").otherwise("train").alias("split"))
    return rounded(audit.leak_percentage(rows, 4), "percent")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Calibration error, accuracy and the risk-coverage curve of the scores, in one table."""
    rows = scored(spark, d)
    return metrics.accuracy(rows).crossJoin(metrics.calibration_error(rows)).crossJoin(calibration.sweep(rows))
