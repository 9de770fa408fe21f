"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.llm import (
    decontaminate, divergence, fill_middle, licenses, mixing, neighbours, ngram_join, quality, secret_scan, substring_dedup, token_counts, token_files, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), size=4, percent=85)


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_substring_dedup(spark, sf_dir):
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op5_secret_scan(spark, sf_dir):
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.span_text("base"), 256).alias("base_sha256"), secret_scan.span_text("found").alias("spans"),
    )


@query
def op6_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op7_token_files(spark, sf_dir):
    read = token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_mixing(spark, sf_dir):
    mix = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixing.planned(mix).select("doc_id", "size", "source_size", "target", "taken", "position")


@query
def op9_quality_rules(spark, sf_dir):
    out = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


URL_RULES = (
    urls.Rule("com", "/", True),
    urls.Rule("example.com", "/en/", False),
    urls.Rule("www.example.com", "/en/", True),
    urls.Rule("net", "/es/", False),
    urls.Rule("net", "/fr/", False),
)
#: Words that host names of the labelled URLs are made of: of sites that bet, sell, track or spam, and of ordinary ones. No host of any given
#: page is among the labels.
BLOCKED_WORDS = (
    "casino", "poker", "roulette", "jackpot", "slots", "betting", "bets", "wager", "viagra", "pills", "pharma", "porn", "adult", "xxx", "escort",
    "camgirls", "spam", "ads", "adserver", "popup", "clickbait", "malware", "warez", "keygen", "payday", "loans", "replica", "phishing",
)
ALLOWED_WORDS = (
    "news", "daily", "docs", "wiki", "library", "museum", "school", "science", "history", "garden", "kitchen", "travel", "weather", "music",
    "theatre", "physics", "chemistry", "data", "council", "health", "hospital", "research", "archive", "journal", "radio", "bridge", "river",
    "forest", "mountain", "harbour", "market", "bakery", "cycling", "football", "chess", "photo", "poetry", "novel", "recipes", "software",
    "linux", "maths", "geology", "biology", "astronomy", "university", "college", "teacher", "parent", "children", "railway", "airport", "energy",
    "climate", "water", "fishing", "painting", "sculpture",
)

#: Every name stands in each of these places, so that nothing but the name tells the kinds apart.
URL_PLACES = (
    ("", "com", ""), ("www.", "example.org", "/en/1043"), ("blog.", "net", "/de/page/27.html"), ("m.", "example.com", "/fr/?page=2"),
    ("shop.", "info", "/index.php?id=318"), ("", "example.net", "/es/2019/archive/"),
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url``, ``label`` and the ``name`` of the host: each word alone and with others of its kind, in several places.

    There are twice as many ordinary words, so the others meet more partners: both kinds have about as many names.
    """
    rows = []
    for words, label, steps in ((BLOCKED_WORDS, 0, (1, 3, 5, 9, 11, 13, 17)), (ALLOWED_WORDS, 1, (5, 11, 23))):
        for i, word in enumerate(words):
            others = [("-" if j % 2 == 0 else "") + words[(i + step) % len(words)] for j, step in enumerate(steps)]
            for name in [word, *(word + other for other in others)]:
                rows += [(f"https://{lead}{name}.{domain}{path}", label, name) for lead, domain, path in URL_PLACES]
    values = ", ".join(f"('{u}', {x}, '{name}')" for u, x, name in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label, name)")


@query
def op10_url_filter(spark, sf_dir):
    out = urls.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, labelled_urls(spark))
    return out.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op11_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op12_fill_in_middle(spark, sf_dir):
    out = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    whole = F.sha2(fill_middle.restored("output", "form"), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), whole)


ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), g AS (
    SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
        ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS e
    FROM d
), f AS (
    SELECT *, least(a, b) AS lo, greatest(a, b) AS hi,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
            WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM g
), p AS (
    SELECT *, substring(text, 1, lo) AS pre, substring(text, lo + 1, hi - lo) AS mid, substring(text, hi + 1, n - hi) AS suf FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH d AS (
    SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc FROM documents
), t AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d
), kept AS (
    SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), langs AS (
    SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), held AS (
    SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source
), groups AS (
    SELECT g.lang, g.source, coalesce(h.n, 0) AS n, coalesce(l.v, 0) AS v, l.n AS lang_n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN held h USING (lang, source) LEFT JOIN langs l ON l.lang = g.lang
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
        (1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * g.v))::BIGINT AS p,
        (1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_n + 2 * g.v))::BIGINT AS q
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
