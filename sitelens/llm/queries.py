"""Queries of the text operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import (bpe_sql, chunk_dedup, jaccard_rtree, katz, langid, license_scan, line_templates, mixture, periodic_runs,
                          suffix_dedup, token_alignment, url_rules, voronoi_knn)
from sitelens.llm.textops import remainder, ship_package, staged

#: The vocabulary that op10 and the pipeline use.
VOCABULARY = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_register
def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 1
    model = katz.train(docs.filter(~held_out))
    found = katz.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")


@_register
def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture.by_first_use(mixture.mixed(_table(spark, sf_dir, "documents")))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "position")


def _position_sql(share: str, kind: str) -> str:
    """SQL of a source's training position at a share of its demand: its schedule's integral, inverted."""
    whens = []
    for i, knots in enumerate(mixture.SCHEDULES):
        steps = [(t0, t1, r0, (r1 - r0) / (t1 - t0), (t1 - t0) * (r0 + r1) / 2) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        whole, before = sum(s[4] for s in steps), 0.0
        for t0, t1, r0, slope, area in steps:
            need = f"({share} * {whole}::DOUBLE - {before}::DOUBLE)"
            root = f"{t0}::DOUBLE + {need} * 2 / (sqrt(greatest({r0 * r0}::DOUBLE + {need} * {2 * slope}::DOUBLE, 0::DOUBLE)) + {r0}::DOUBLE)"
            whens.append(f"WHEN {kind} = {i} AND {share} <= {(before + area) / whole}::DOUBLE THEN least(greatest({root}, {t0}::DOUBLE), {t1}::DOUBLE)")
            before += area
    return f"CASE {' '.join(whens)} ELSE 1::DOUBLE END"


ORACLE["op2_mixture"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS k FROM documents),
sources AS (
    SELECT *, ([5.0, 2.0, 1.0])[kind + 1]::DOUBLE AS weight FROM (
        SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS kind
        FROM docs GROUP BY source)),
levels(i, level) AS (
    SELECT 0, sum(source_size)::DOUBLE / sum(weight) FROM sources
    UNION ALL
    SELECT i + 1, (SELECT (sum(source_size)::DOUBLE - sum(CASE WHEN weight * level > 3.0 * source_size THEN 3.0 * source_size ELSE 0 END))
                          / sum(CASE WHEN weight * level > 3.0 * source_size THEN 0 ELSE weight END) FROM sources)
    FROM levels WHERE i < 12),
targets AS (SELECT s.*, least(3.0 * source_size, weight * (SELECT arg_max(level, i) FROM levels)) AS target FROM sources s),
placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.kind, least(floor(t.target / t.source_size), 3)::BIGINT AS passes,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM docs d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       (passes * size + least(size, greatest(round(target - passes * source_size)::BIGINT - start, 0)))::BIGINT AS taken,
       CASE WHEN passes > 0 OR least(size, round(target)::BIGINT - start) > 0 OR (size = 0 AND start < target)
            THEN """ + _position_sql("(CASE WHEN target > 0 THEN start / target ELSE 0 END)", "kind") + r""" END AS position
FROM placed
"""


@_register
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_register
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = langid.train(docs.filter(~held_out))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@_register
def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.knn_join(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE["op5_voronoi_knn"] = """
WITH v AS (
    SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@_register
def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op6_chunk_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_register
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_rules"] = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts),
places AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(rule, rhost, rpath, rverdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict
    FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(rverdict, CASE WHEN regexp_matches(host, '(^|[^a-z0-9])(ads|casino|lottery|pills|porn|spam|viagra|warez|xxx)($|[^a-z0-9])')
                               THEN 'block' ELSE 'allow' END) AS verdict
FROM places LEFT JOIN fits USING (page_id)
"""


@_register
def op8_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_rtree.jaccard_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@_register
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.drop_all_recurring_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_register
def op10_bpe_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe_sql.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    docs = _table(spark, sf_dir, "documents")
    return bpe_sql.token_digests(bpe_sql.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded=True))


@_register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def bent(doc_id, n: int) -> np.ndarray | None:
        """The contract's order of words: periodic from some word on in a tenth of the documents."""
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10 or not n:
            return None
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        i = np.arange(n)
        return np.where(i < a, i, a + (i - a) % p)

    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), reorder=bent)
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(periodic_runs.listed(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


ORACLE["op11_periodic_runs"] = r"""
WITH RECURSIVE octets AS (
    SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT)),
               lambda c, x: CASE WHEN x = 0 THEN c ELSE xor(c >> 8, t[(xor(c, x) & 255) + 1]) END)) AS h
    FROM documents, octets),
shaped AS (
    SELECT row, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) AS g FROM docs),
bent AS (
    SELECT row, doc_id, n, CASE WHEN planted THEN
               list_transform(range(0, n), lambda i: w[CASE WHEN i < g % n THEN i ELSE g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) END + 1])
           ELSE w END AS w FROM shaped),
words AS (SELECT row, n, unnest(range(0, n)) AS i, unnest(w) AS word FROM bent),
matches AS (
    SELECT x.row, y.i - x.i AS period, y.i FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= y.n),
diagonals AS (
    SELECT row, period, i, i - row_number() OVER (PARTITION BY row, period ORDER BY i) AS stretch FROM matches),
repeats AS (
    SELECT row, period, (min(i) - period)::BIGINT AS start, (count(*) + period)::BIGINT AS length FROM diagonals GROUP BY row, period, stretch
    HAVING count(*) + period >= greatest(24, 3 * period)),
runs AS (SELECT row, start, length, min(period)::BIGINT AS period FROM repeats GROUP BY row, start, length),
listed AS (
    SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing FROM runs GROUP BY row),
strongest AS (
    SELECT row, start, length, period FROM runs r
    WHERE NOT EXISTS (FROM runs o WHERE o.row = r.row AND (o.length * r.period > r.length * o.period
                      OR o.length * r.period = r.length * o.period AND (o.start, o.period) < (r.start, r.period)))),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
    SELECT w.row, string_agg(word, ' ' ORDER BY w.i) AS collapsed FROM words w ANTI JOIN dropped d ON d.row = w.row AND d.i = w.i GROUP BY w.row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM bent LEFT JOIN listed USING (row) LEFT JOIN strongest USING (row) LEFT JOIN left_over USING (row)
"""


#: The vocabularies that op12 aligns.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


@_register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tokenizers = token_alignment.read_tokenizers(spark, *map(public_tokenizers.path, ALIGNED))
    buckets = token_alignment.bucket_count(docs)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256")
    aligned = token_alignment.align(docs, tokenizers, buckets).select("*", digest).drop("groups")
    aligned = staged(aligned, "token_alignments", batch_rows=token_alignment.DOCUMENT_ROWS)
    found = token_alignment.link_counts(aligned, tokenizers, buckets)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@_register
def op13_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])
    starts = F.transform("base", lambda m: m["start"])
    share = F.when(F.col("n_words") > 0, F.col("covered") / F.col("n_words")).otherwise(0.0)
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), license_scan.labels_of(F.col("base")).alias("base_labels"),
        license_scan.labels_of(F.col("matches")).alias("labels"), share.alias("score"))


def _moves() -> str:
    literal = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join(f"({', '.join(map(literal, row))})" for row in license_scan.transitions(license_scan.standard()))


ORACLE["op13_license_templates"] = r"""
WITH RECURSIVE moves(template, label, phrase, state, word, next, accepts) AS (VALUES """ + _moves() + r"""),
texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
words AS MATERIALIZED (SELECT row, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM texts),
runs(row, template, start, i, state, accepts) AS (
    SELECT w.row, m.template, w.i, w.i + 1, m.next, m.accepts FROM words w JOIN moves m ON m.state = 0 AND m.word = w.word
    UNION
    SELECT r.row, r.template, r.start, w.i + 1, m.next, m.accepts
    FROM runs r JOIN words w ON w.row = r.row AND w.i = r.i
    JOIN moves m ON m.template = r.template AND m.state = r.state AND coalesce(m.word, w.word) = w.word WHERE NOT r.accepts),
accepted AS (
    SELECT row, template, start, min(i) AS stop FROM runs WHERE accepts GROUP BY row, template, start),
found AS (
    SELECT row, label, phrase, start FROM accepted JOIN (SELECT DISTINCT template, label, phrase FROM moves) USING (template)),
summed AS (
    SELECT row, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY row),
spans AS (SELECT DISTINCT row, unnest(range(start, stop)) AS i FROM accepted),
covers AS (SELECT row, count(*) AS covered FROM spans GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN len(w) > 0 THEN coalesce(covered, 0)::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS score
FROM texts LEFT JOIN summed USING (row) LEFT JOIN covers USING (row)
"""
