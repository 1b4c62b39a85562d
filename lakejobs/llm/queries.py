"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import (
    decontamination,
    filter_audit,
    fingerprints,
    jaccard_join,
    language_id,
    line_blocks,
    mixing,
    periodic_runs,
    quality_model,
    token_counts,
    toxicity,
    url_filters,
    warc,
)
from lakejobs.llm.common import held_out, table
from lakejobs.session import work_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

RULES = (
    url_filters.Rule(url_filters.BLOCK, "net/"),
    url_filters.Rule(url_filters.ALLOW, "example.net/en/"),
    url_filters.Rule(url_filters.BLOCK, "example.com/de/"),
    url_filters.Rule(url_filters.ALLOW, "org/fr/"),
)
# The large source is thinned, five are raised, the rest share what is left.
MIXTURE = mixing.Mixture(
    {"src0": 0.15, **{f"src{i}": 0.06 for i in range(1, 6)}}, rest=0.55, seed="mix-1"
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).withColumn("held_out", held_out(F.col("doc_id")))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_blocks.dedup_lines(docs)


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), RULES)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumn("contaminated", F.lit(True))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIXTURE)


ORACLES["op6_mixing"] = mixing.mixture_sql(MIXTURE)


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_warc(warc.with_revisits(table(spark, sf_dir, "pages")), path)
    return warc.archived(warc.read_warc(spark, path))


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM w"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM t, range(1, greatest(len(w) - 4, 1) + 1) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT doc_id, doc_id AS c FROM documents
  UNION SELECT e.b, reach.c FROM reach JOIN e ON reach.doc_id = e.a)
SELECT reach.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id"""


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS failing
  FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, failing, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, failing),
x(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
    (SELECT bit FROM x WHERE letter = substr(filter_order, step, 1)) AS bit,
    coalesce((SELECT sum(bit) FROM x WHERE instr(substr(filter_order, 1, step - 1), letter) > 0), 0)::INT AS before
  FROM o, range(1, 6) AS r(step)),
g AS (SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (failing & (bit | before) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (failing & bit <> 0 AND failing & before = 0), 0) AS removed,
    coalesce(sum(n) FILTER (failing & bit <> 0 AND failing & before <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (failing = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (failing & bit <> 0 AND failing & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (failing & bit <> 0 AND failing & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM g"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_period(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).withColumn("held_out", quality_model.held_out(F.col("doc_id")))
