"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, context_mixing, decontaminate, jaccard_join, language_id, license_scan, packing, phrases, piece_codec, pu_quality, quality_rules, token_blocks, word_runs
from .common import table


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under the mixed model and under word frequencies."""
    return context_mixing.score(table(spark, sf_dir, "documents"), followers=True)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of one made of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    records = chat_format.records_from_rows(rows.unionByName(extra))
    return chat_format.digests(chat_format.format_records(records))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    weights, _ = pu_quality.train(docs, table(spark, sf_dir, "labels"))
    return pu_quality.score(docs, weights)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.identify(docs, model)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence paragraph of every document."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(docs))


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the stream of token ids, as the written files have it."""
    return token_blocks.read_shards(token_blocks.write_shards(table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measurements and the cascade's verdict on every document."""
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of which are made to repeat themselves."""
    return word_runs.digests(word_runs.periodic_runs(word_runs.with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text that they are decoded to."""
    return piece_codec.digests(piece_codec.encode(table(spark, sf_dir, "documents"), decoded=True))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2),
grams AS (SELECT rid, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g FROM pos),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams),
covered AS (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1),
repeats AS (SELECT rid, count(*) AS n_repeat_words FROM covered GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, len(w.w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN repeats USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 20 * n_symbols > word_chars OR 2 * n_dup_lines > n_lines
    OR word_chars > 15 * n_words OR 2 * word_chars < 3 * n_words OR (n_upper > 0 AND n_upper > n_lower)) AS kept
FROM base
"""

CONTROL_PATTERN = "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in chat_format.CONTROL_STRINGS).replace("'", "''")
OP2_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
t AS (SELECT *, length(role) + len(regexp_extract_all(role, '{CONTROL_PATTERN}')) + length(text) + len(regexp_extract_all(text, '{CONTROL_PATTERN}')) + {len(chat_format.TURN + chat_format.TEXT + chat_format.END)} AS chars FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
  UNION SELECT doc_id, list_aggregate(w, 'string_agg', ' ') FROM w WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS least FROM documents UNION SELECT edges.b, reach.least FROM reach JOIN edges ON edges.a = reach.doc_id WHERE reach.least < edges.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(least) FROM reach WHERE reach.doc_id = d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id)
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT rid, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f1 AS (SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(w) AS word FROM w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY 1),
at2 AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS a FROM at2 GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS a FROM at2 WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
over AS (SELECT lang, w1, w2, max(a) AS longest FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
two AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, x.f AS l, y.f AS r FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.word = f2.w1
  JOIN f1 y ON y.lang = f2.lang AND y.word = f2.w2 LEFT JOIN over o ON o.lang = f2.lang AND o.w1 = f2.w1 AND o.w2 = f2.w2 WHERE o.longest IS NULL OR 100 * o.longest < 50 * f2.a),
cuts AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.a, x.f AS x, h.a AS head, t.a AS tail, z.f AS z,
    f3.a::HUGEINT * f3.a * 1000000 // (x.f::HUGEINT * t.a) AS s1, f3.a::HUGEINT * f3.a * 1000000 // (h.a::HUGEINT * z.f) AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.word = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.word = f3.w3
  JOIN f2 h ON h.lang = f3.lang AND h.w1 = f3.w1 AND h.w2 = f3.w2 JOIN f2 t ON t.lang = f3.lang AND t.w1 = f3.w2 AND t.w2 = f3.w3),
every AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN x ELSE head END, CASE WHEN s1 <= s2 THEN tail ELSE z END FROM cuts),
scored AS (SELECT *, (a::HUGEINT * a * 1000000 // (l::HUGEINT * r))::BIGINT AS score FROM every)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored) JOIN n USING (lang) WHERE rank <= 2000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_context_mixing": op1_context_mixing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_license_scan": op8_license_scan,
    "op9_token_blocks": op9_token_blocks,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_piece_codec": op12_piece_codec,
    "op13_phrases": op13_phrases,
}
ORACLES: dict[str, str] = {"op2_chat_formatting": OP2_SQL, "op6_jaccard_join": OP6_SQL, "op10_quality_rules": OP10_SQL, "op13_phrases": OP13_SQL}
