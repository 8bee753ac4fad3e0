"""Registered queries of the training-data operators, and their SQL.

Each query applies one operator with production parameters to its whole table
and derives the agreed columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as exact
from . import bpe, centroids, decontaminate, jaccard_join, line_dedup, packing, quality, ranked_search, secret_scan, simhash, toxicity, url_filter
from .common import table, whole_text

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _fold(n: int):
    """crc32 of the id as text, mod ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    out = bpe.encode_documents(table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN, with_decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


SITE_RULES = (
    url_filter.site_rule("allow", "com", "/"),
    url_filter.site_rule("block", "example.com", "/en/"),
    url_filter.site_rule("allow", "www.example.com", "/en/"),
    url_filter.site_rule("block", "net", "/es/"),
    url_filter.site_rule("block", "net", "/fr/"),
)


@_query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict; ``matched`` also names the pattern rules."""
    out = url_filter.url_filter(table(spark, sf_dir, "pages"), SITE_RULES + url_filter.PATTERN_RULES)
    site = F.col("rule").isin([r.name for r in SITE_RULES])
    return out.select("page_id", "host", "path", F.when(site, F.col("rule")).alias("rule"), "verdict",
                      F.col("rule").alias("matched"))


_HOST = "translate(regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _pattern_values() -> str:
    """The pattern rules as SQL rows: place, name, expression, whether it sees the whole URL."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({i}, {text(r.name)}, {text(r.pattern.replace(chr(92) + 'Z', chr(92) + 'z'))}, {r.whole})"
                     for i, r in enumerate(url_filter.PATTERN_RULES))


ORACLE_SQL["op2_url_filters"] = f"""
WITH parts AS (
  SELECT page_id, {_HOST} AS host,
         regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://[^/?#]*([\\s\\S]*)', 1) AS rest
  FROM pages),
rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
                                ('net/es/', 'block'), ('net/fr/', 'block')),
patterns(place, name, pattern, whole) AS (VALUES {_pattern_values()}),
hits AS (
  SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = split_part(r.rule, '/', 1) OR ends_with(p.host, '.' || split_part(r.rule, '/', 1)))
   AND starts_with(p.path, substr(r.rule, strpos(r.rule, '/')))
  GROUP BY ALL),
others AS (
  SELECT page_id, arg_min(name, place) AS name
  FROM parts, patterns WHERE regexp_matches(host || CASE WHEN whole THEN rest ELSE path END, pattern) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, h.rule,
       coalesce(h.verdict, CASE WHEN w.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(h.rule, w.name) AS matched
FROM parts p LEFT JOIN others w USING (page_id) LEFT JOIN hits h USING (page_id)"""


@_query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, one row per piece."""
    parts = packing.pieces(table(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packing.best_fit_pack(parts).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without its duplicate three-line windows."""
    out = line_dedup.line_dedup(table(spark, sf_dir))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"),
                      spans.alias("spans"), F.sha2("text", 256).alias("text_sha256"))


ORACLE_SQL["op4_line_dedup"] = """
WITH lines AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, p, l[p + 1] || chr(10) || l[p + 2] || chr(10) || l[p + 3] AS w
  FROM lines, unnest(range(0, greatest(len(l) - 2, 0))) AS t(p)
  WHERE trim(l[p + 1] || l[p + 2] || l[p + 3], ' ') <> ''),
later AS (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS nth FROM windows),
covered AS (SELECT DISTINCT doc_id, p + k AS line FROM later, unnest([0, 1, 2]) AS t(k) WHERE nth > 1),
stretches AS (
  SELECT doc_id, min(line) AS s, max(line) + 1 AS e
  FROM (SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS g FROM covered)
  GROUP BY doc_id, g),
gone AS (
  SELECT doc_id, sum(e - s) AS n, string_agg(s || ':' || e, ',' ORDER BY s) AS spans FROM stretches GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(l.l[p + 1], chr(10) ORDER BY p) AS text
  FROM lines l, unnest(range(0, len(l.l))) AS t(p)
  WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = l.doc_id AND c.line = p)
  GROUP BY l.doc_id)
SELECT l.doc_id, CAST(len(l.l) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       coalesce(g.spans, '') AS spans, sha256(coalesce(k.text, '')) AS text_sha256
FROM lines l LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)"""


@_query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; ``n_near``, for the ids
    divisible by 50: how many other documents' fingerprints are within the radius."""
    return simhash.count_near(simhash.edit_comparison(table(spark, sf_dir)), F.col("doc_id") % 50 == 0)


@_query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from four fifths of the label ids."""
    stats = quality.statistics(table(spark, sf_dir))
    model = quality.train(stats, table(spark, sf_dir, "labels"), usable=_fold(5) != 0)
    return quality.score(stats, model).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    docs = table(spark, sf_dir).withColumn("text_sha256", F.sha2(whole_text(), 256))
    return exact.exact_dedup(docs, keep_cols=("text_sha256",)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


@_query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by five-word shingles."""
    return jaccard_join.jaccard_components(table(spark, sf_dir))


@_query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets of every document."""
    found = secret_scan.secret_scan(table(spark, sf_dir))
    base = [r.kind for r in secret_scan.BASE_RULES]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(listed(of(*base)), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from three quarters of the label ids."""
    docs = table(spark, sf_dir)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=_fold(4) != 2)
    return toxicity.score(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Runs of digits, letters and characters beyond ASCII, A-Z as a-z.
_WORD_LIST = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


@_query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked_search.ranked_search(table(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_ranked_search"] = f"""
WITH terms AS MATERIALIZED (SELECT doc_id, unnest({_WORD_LIST}) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM sizes),
tfs AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest({_WORD_LIST}) AS term FROM benchmark),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, whole GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weighed USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10"""


@_query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside ten-word windows of benchmark items."""
    out = decontaminate.decontaminate(table(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL["op12_decontamination"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORD_LIST} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORD_LIST} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p + 1:p + 10], ' ') AS win
  FROM items, unnest(range(0, greatest(len(w) - 9, 1))) AS t(p) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS win
  FROM d, lengths, unnest(range(0, len(w) - n + 1)) AS t(p)),
hits AS MATERIALIZED (SELECT doc_id, item, p, n FROM places JOIN windows USING (win, n)),
words AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words h USING (doc_id) LEFT JOIN named n USING (doc_id)"""


@_query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 16 clusters after three rounds."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds one after the other: every vector against every centroid."""
    parts = ["""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT k.vec_id, k.v, c.c, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM kept k, c{r} c) GROUP BY vec_id, v)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.v, o.v) AS v FROM c{r} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT best.c AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
          FROM a{r}, unnest(range(1, 65)) AS t(i) GROUP BY ALL) GROUP BY c) n USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(c.v, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best.c"""


ORACLE_SQL["op13_centroid_clustering"] = _clustering_sql()
