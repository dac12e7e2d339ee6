"""The queries over these operators: each applies one to its whole table and digests the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthrate.llm.divergence import audit_sources
from hearthrate.llm.fingerprints import compare_with_next
from hearthrate.llm.language import identify
from hearthrate.llm.line_rules import judge
from hearthrate.llm.lm import score_documents
from hearthrate.llm.mixing import mix_sources
from hearthrate.llm.near_dedup import near_duplicates
from hearthrate.llm.nearest import nearest
from hearthrate.llm.pieces import encode_pieces, model_bytes
from hearthrate.llm.private import find_private
from hearthrate.llm.resampling import resample
from hearthrate.llm.secrets import INFERRED, find_secrets
from hearthrate.llm.substring_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Bytes 0x09-0x0D and 0x20 part words; the rest is as in the operators.
WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

PIECE_MODEL = "piece_bpe_32k.model"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


@query()
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_pieces(read(spark, sf_dir, "documents", "doc_id", "text"), model_bytes(public_tokenizers.path(PIECE_MODEL)))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.coalesce(F.get("piece_ends", F.size("ids") - 1), F.lit(0)).cast("long").alias("n_bytes"),
    )


def span_text(spans: str, keep: Callable | None = None) -> Column:
    chosen = F.filter(spans, keep) if keep else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query()
def op3_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        *[span_count("private", kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(span_text("private", lambda s: s["base"]), 256).alias("base_sha256"),
        span_text("private").alias("spans"),
        F.array_join(F.transform("private", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


@query()
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        *[span_count("secrets", kind) for kind in ("assign", "access", "hex")],
        F.sha2(span_text("secrets", lambda s: s["kind"] != INFERRED), 256).alias("base_sha256"),
        span_text("secrets").alias("spans"),
    )


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(docs, model_bytes(public_tokenizers.path(PIECE_MODEL))).select("doc_id", "held_out", "lang_pred", "score")


@query("""
WITH RECURSIVE w AS (SELECT doc_id, """ + WORDS_SQL.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """ AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents", "doc_id", "text"), model_bytes(public_tokenizers.path(PIECE_MODEL)))


@query("""
WITH w AS (SELECT doc_id, """ + WORDS_SQL.format(text="coalesce(text, '')") + """ AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM w WHERE len(w) >= 13),
h AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 12], ' ')) AS h FROM win),
low AS (SELECT h, min(doc_id) AS low FROM h GROUP BY h),
hit AS (SELECT doc_id, list(p) AS ps FROM h JOIN low USING (h) WHERE low < doc_id GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(ps) + o AS k FROM hit, range(13) t(o)),
k AS (SELECT w.doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM w),
kept AS (SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k.k) AS t FROM k ANTI JOIN gone ON k.doc_id = gone.doc_id AND k.k = gone.k GROUP BY k.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table's domain of each document: toxic, or else high or low quality."""
    return read(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").otherwise("low").alias("domain"))


# Shares of tokens the mixed corpus should have.
MIX_WEIGHTS = {"high": 0.80, "low": 0.15, "toxic": 0.05}


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, mix = mix_sources(read(spark, sf_dir, "documents", "doc_id", "text"), domains(spark, sf_dir), weights=MIX_WEIGHTS)
    return rated.select(
        "doc_id", "tokens", *[F.get("posteriors", i).alias(f"p_{name}") for i, name in enumerate(mix.names)], "rate",
        *[F.lit(float(t)).alias(f"target_{name}") for name, t in zip(mix.names, mix.targets)],
    )


@query(r"""
WITH w AS (SELECT 0 AS part, doc_id AS id, regexp_extract_all(""" + LOWER_SQL + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(""" + LOWER_SQL + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
g AS (SELECT part, id, unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS g FROM w),
n AS (SELECT part, id, g, count(*) AS c FROM g GROUP BY ALL),
crc AS (SELECT list(t ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS t FROM range(256) r(i))),
b AS (SELECT g, xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(g), '..'), lambda h: ('0x' || h)::BIGINT),
  lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295)) % 10000 AS b FROM (SELECT DISTINCT g FROM n), crc),
k AS (SELECT b, coalesce(sum(c) FILTER (part = 0), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (part = 1), 0)::DOUBLE AS t FROM n JOIN b USING (g) GROUP BY b),
total AS (SELECT sum(s) AS ss, sum(t) AS tt FROM k),
gain AS (SELECT b, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM k, total),
weight AS (SELECT id, sum(c * gain)::BIGINT AS weight, sum(c)::BIGINT AS n FROM n JOIN b USING (g) JOIN gain USING (b) WHERE part = 0 GROUP BY id),
d AS (SELECT doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT id AS doc_id, w FROM w WHERE part = 0) LEFT JOIN weight ON weight.id = doc_id),
r AS (SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (words >= 20) OVER () AS able FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank FROM r
""")
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(""" + LOWER_SQL + r""", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, v FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM c),
l AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q FROM c GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10
""")
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read(spark, sf_dir, "documents", "text", "lang", "source"))


def good_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))


@query()
def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents", "doc_id", "text"), good_labels(spark, sf_dir), with_text=False)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{c}" for c in counts], "quality.content_words")
