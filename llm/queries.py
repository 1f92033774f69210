"""The queries of this subpackage: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (exact, html_text, language, lm, near, packing, periods, phrases, substrings, token_files, toxicity, urls,
               whitening)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: (verdict, host, path); fixed values of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op3_exact_dedup", """
    WITH n AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)
    SELECT doc_id, g.keep_id, g.group_size, doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
    FROM n JOIN (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t) g ON n.t = g.t
""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf, "documents"), digest=True).drop("_row")


@query("op9_url_filter")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), RULES)


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(table(spark, sf, "documents")))


@query("op8_decontamination")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.digest(phrases.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_groups(table(spark, sf, "documents"), size=2, share=80)


@query("op2_packing")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_token_files")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.read_tokens(
        token_files.write_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query("op4_toxicity")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


@query("op6_language_id")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Documents (doc_id) and pages (page_id); texts are learned from labelled documents."""
    docs = table(spark, sf, "documents")
    return language.identify(
        language.evidence(docs, table(spark, sf, "pages")), language.likelihoods(docs.select("doc_id", "text", "lang")))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf, "embeddings")))


# The SQL knows the layout of the given pages; the operator does not.
@query("op12_html_extraction", r"""
    WITH article AS (
        SELECT page_id, url,
               regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS t FROM pages),
    blocks AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM article),
    decoded AS (SELECT page_id, url, regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM blocks),
    final AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM decoded)
    SELECT page_id, url, text, length(text) AS n_chars FROM final
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return periods.digest(periods.find_runs(periods.planted(table(spark, sf, "documents"))))
