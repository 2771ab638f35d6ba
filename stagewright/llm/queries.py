"""The registered queries of this subpackage: each operator over its whole table, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.llm import (
    divergence,
    kdsearch,
    langid,
    licenses,
    mixing,
    passages,
    phrases,
    pieces,
    projected,
    quality,
    secrets,
    simhash,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(None)
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query(None)
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by the shortest code."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


OP3_SQL = f"""
WITH whole AS (
  SELECT vec_id, [floor({kdsearch.SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {kdsearch.EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {kdsearch.TOP}"""


@query(OP3_SQL)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of each query."""
    return kdsearch.top_k(table(spark, sf_dir, "embeddings"))


@query(None)
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query(None)
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five neighbours of each query by cosine, found by projections."""
    return projected.nearest(table(spark, sf_dir, "embeddings"))


@query(None)
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.clusters(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _kinds_sql() -> str:
    """One row per match, with its place by adding up the pieces before it."""
    parts = []
    for number, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
    SELECT doc_id, '{rule.kind}' AS kind, {number} AS number, {rule.least} AS least,
           string_split_regex(body, '{pattern}') AS gaps,
           regexp_extract_all(body, '{pattern}', 0) AS hits,
           regexp_extract_all(body, '{pattern}', {rule.group}) AS keys
    FROM bodies""")
    return " UNION ALL ".join(parts)


OP7_SQL = f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
kinds AS ({_kinds_sql()}),
matches AS (
  SELECT doc_id, kind, number, least, i, gaps, hits, keys
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM kinds WHERE len(hits) > 0)),
spans AS (
  SELECT doc_id, kind, number,
         CAST(list_sum([length(x) for x in gaps[1:i]])
              + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS BIGINT) AS first,
         length(hits[i]) AS n
  FROM matches WHERE length(keys[i]) >= least),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || first || ':' || (first + n), ',' ORDER BY first, number) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id"""


def _count_of(kind: str) -> Column:
    mine = F.filter("spans", lambda span: span["kind"] == kind)
    return F.coalesce(F.size(mine), F.lit(0)).cast("long")


@query(OP7_SQL)
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by way of a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings(docs.select("doc_id", "text"), secrets.scan(docs))
    spans = F.coalesce(
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","),
        F.lit(""),
    )
    return found.select(
        "doc_id",
        *[_count_of(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.RULES],
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
    )


@query(None)
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, and whether decoding them gives its text back."""
    vocabulary = pieces.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.with_pieces(docs, vocabulary=vocabulary)
    back = pieces.decode(spark, F.col("pieces"), vocabulary)
    return coded.select(
        "doc_id",
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        back.eqNullSafe(F.col("text")).alias("exact"),
        "pieces",
    )


OP9_SQL = f"""
WITH sized AS (
  SELECT doc_id,
         coalesce(CAST(len(regexp_extract_all(text, '{mixing.WORD}')) AS BIGINT), 0) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS bucket
  FROM documents),
keyed AS (
  SELECT *, length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INTEGER) AS class
  FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [{", ".join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
         {mixing.MOST} :: DOUBLE * source_size AS most
  FROM sources),
levels AS (
  SELECT *, ({mixing.SHARE} :: DOUBLE * (sum(source_size) OVER ()) - coalesce(sum(most) OVER (
             ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / (sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM weighed),
aims AS (
  SELECT source, source_size,
         least(most, weight * (SELECT max(level) FROM levels WHERE level * weight <= most)) AS target
  FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM aims),
placed AS (
  SELECT doc_id, size, r.*,
         row_number() OVER (PARTITION BY k.source ORDER BY class, bucket, doc_id) - 1 AS place
  FROM keyed k JOIN rates r ON k.source = r.source),
offsets AS (
  SELECT source, number,
         CAST(CAST('0x' || substr(md5(source || ':42:' || number), 1, 12) AS BIGINT) AS DOUBLE) / {float(16**12)} :: DOUBLE AS point
  FROM rates, range({mixing.OFFSETS}) AS r(number)),
tried AS (
  SELECT p.source, number, any_value(point) AS point,
         abs(sum((floor(point + (place + 1) * rate) - floor(point + place * rate)) * size) - any_value(target)) AS off
  FROM placed p JOIN offsets o ON p.source = o.source GROUP BY p.source, number),
chosen AS (SELECT source, arg_min(point, (off, number)) AS point FROM tried GROUP BY source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST((floor(point + (place + 1) * rate) - floor(point + place * rate)) * size AS BIGINT) AS taken
FROM placed p JOIN chosen c ON p.source = c.source"""


@query(OP9_SQL)
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    drawn = mixing.plan(table(spark, sf_dir, "documents"))
    return drawn.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


@query(None)
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang),
grams AS (
  SELECT lang, g, count(*) AS f
  FROM (SELECT lang, m, w[i:i + m - 1] AS g
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM runs, range(1, {phrases.LONGEST + 1}) AS r(m)))
  GROUP BY lang, g HAVING count(*) >= {phrases.SUPPORT}),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r,
         CAST({phrases.SCALE} :: HUGEINT * c.f // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM grams WHERE len(g) > 1) c
  JOIN grams l ON l.lang = c.lang AND l.g = c.g[1:k]
  JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
best AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, g[i:i + n - 1] AS part, max(f) AS longer
  FROM (SELECT lang, g, f, n, unnest(range(1, len(g) - n + 2)) AS i
        FROM grams, range(2, {phrases.LONGEST}) AS r(n) WHERE n < len(g))
  GROUP BY ALL),
named AS (
  SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, l, r, n, score
  FROM best b JOIN totals t ON t.lang = b.lang
  LEFT JOIN inner_parts p ON p.lang = b.lang AND p.part = b.g
  WHERE longer IS NULL OR 100 :: HUGEINT * longer < {phrases.COVERED} :: HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM named
QUALIFY rank <= {phrases.TOP}"""


@query(OP11_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language."""
    return phrases.top_phrases(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = rf"""
WITH rows_ AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT row_id, lang, source, unnest(terms) AS term FROM rows_),
kept AS (
  SELECT lang, term FROM words GROUP BY lang, term
  HAVING count(DISTINCT row_id) >= {divergence.LEAST_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups_ AS (SELECT DISTINCT lang, source FROM rows_),
counted AS (
  SELECT lang, source, term, count(*) AS n
  FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, v, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM groups_ JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
         CAST(1 + {divergence.UNIT} :: HUGEINT * (n + 1) // (total + v) AS BIGINT) AS p FROM every),
whole AS (
  SELECT lang, term, CAST(1 + {divergence.UNIT} :: HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS BIGINT) AS q
  FROM (SELECT lang, term, any_value(v) AS v, sum(n) AS n FROM every GROUP BY lang, term)),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT)
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts
QUALIFY part = 'pair' OR rank <= {divergence.TOP}"""


@query(OP12_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source of a language differs from the others, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query(None)
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license phrases and notices of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("found", lambda f: f["notice"] < len(licenses.BASE))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")

    starts = F.transform(base, lambda f: f["start"])
    return licenses.with_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        "score",
    )
