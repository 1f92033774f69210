"""Language of texts and pages: Bayesian fusion of text, markup, address and host."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from . import urls
from .chars import ngrams
from .common import arrow_batches, quota, stored
from .tokens import pieces
from .toxicity import held_out

SIZES = (2, 3, 4)      # characters of an n-gram
BITS = 16              # n-grams are hashed to 2**BITS features
TRAIN_ROWS = 20_000    # most labelled texts that the likelihoods are estimated on, about
PIECE = 1 << 20        # text whose n-grams are held at once
SPREAD = 16            # partitions of the training texts, whose number is bounded
SMOOTH = 0.5           # added to each count of a feature
WEIGHT = 0.2           # of one n-gram; they overlap, so they count as fewer
FULL = 400             # n-grams beyond which a text gets no surer
KAPPA = 5.0            # how many rows of its own a host needs to outweigh its parent
TRUST = 1.0            # added to the counts of declared languages and suffixes

_VISIBLE = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def declared(html: Column) -> Column:
    """Primary language of the ``lang`` attribute of the ``html`` element, else null."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def visible(html: Column) -> Column:
    """The page without scripts, styles, comments and tags."""
    return F.regexp_replace(html, _VISIBLE, " ")


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


@dataclass
class Likelihoods:
    languages: list[str]
    table: np.ndarray  # (features, languages), log likelihoods

    def of(self, texts: list[str | None]) -> np.ndarray:
        """Tempered log likelihood of each text in each language; zeros without n-grams."""
        parts, first = ngrams(texts, SIZES, BITS)
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        ends = np.append(first, len(parts[0][0]) if parts else 0)
        for feature, inside in parts:
            runs = np.concatenate(([0], np.cumsum(inside)))[ends]
            n += np.diff(runs)
            kept = feature[inside]
            for i in range(len(self.languages)):
                sums = np.concatenate(([0.0], np.cumsum(self.table[kept, i], dtype=np.float64)))
                total[:, i] += np.diff(sums[runs])
        scale = np.minimum(n, FULL) / np.maximum(n, 1) * WEIGHT
        return (total - total.max(axis=1, keepdims=True)) * scale[:, None] if len(self.languages) else total


def likelihoods(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Likelihoods:
    """n-gram likelihoods of each language from rows (doc_id, text, lang) outside the
    held-out fold; about ``train_rows`` of them at most, chosen by a hash of the id. Every
    label is kept, and rare ones keep all their rows: each language has the same quota."""
    spark = labelled.sparkSession
    arrow_batches(spark)
    known = labelled.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    count = known.groupBy("lang").count().collect()
    names = sorted(r["lang"] for r in count)
    if not names:
        return Likelihoods([], np.zeros((1 << BITS, 0), np.float32))
    most = quota([r["count"] for r in count], train_rows)
    shares = F.create_map(*[F.lit(x) for r in count for x in (r["lang"], int(min(1.0, most / r["count"]) * (1 << 30)))])
    part = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < shares[F.col("lang")])
    sample = part.select("text", "lang").repartition(SPREAD, F.xxhash64("text"), F.monotonically_increasing_id())

    def add(batches):
        total = {}
        for batch in pieces(batches, most=PIECE):
            lang = np.searchsorted(names, batch.column("lang").to_pylist())
            features, first = ngrams(batch.column("text").to_pylist(), SIZES, BITS)
            for feature, inside in features:
                at = np.flatnonzero(inside)
                of = lang[np.searchsorted(first, at, side="right") - 1]
                for i in np.unique(of):
                    total[i] = total.get(i, 0) + np.bincount(feature[at[of == i]], minlength=1 << BITS)
        for i, counts in total.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([int(i)], pa.int64()), "counts": pa.array([zstandard.compress(counts.tobytes(), 1)], pa.binary())})

    got = sample.mapInArrow(add, "lang long, counts binary").toArrow()  # SPREAD rows a language at most
    total = np.zeros((len(names), 1 << BITS))
    for lang, data in zip(got.column("lang").to_pylist(), got.column("counts").to_pylist()):
        total[lang] += np.frombuffer(zstandard.decompress(data), np.int64)
    share_of = (total + SMOOTH) / (total.sum(axis=1, keepdims=True) + SMOOTH * total.shape[1])
    return Likelihoods(names, np.ascontiguousarray(np.log(share_of).T.astype(np.float32)))


def evidence(documents: DataFrame | None, pages: DataFrame | None) -> DataFrame:
    """(doc_id, page_id, text, declared, suffix, host, domain) of both kinds of rows. The
    source of a document stands for a host; it has neither markup nor address."""
    none, parts = F.lit(None).cast("string"), []
    if documents is not None:
        source = F.concat(F.lit("source:"), F.col("source"))
        parts.append(documents.select(
            F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"),
            none.alias("suffix"), source.alias("host"), source.alias("domain")))
    if pages is not None:
        host = F.when(urls.host(F.col("url")) != "", urls.host(F.col("url")))
        parts.append(pages.select(
            F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long"), visible(F.col("html")).alias("text"),
            declared(F.col("html")).alias("declared"), urls.suffix(host).alias("suffix"), host.alias("host"),
            domain(host).alias("domain")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _sums(rows: DataFrame, names: Sequence[str], *keys: str) -> DataFrame:
    """Summed posteriors per key."""
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def _mass(names: Sequence[str]) -> Column:
    return sum((F.col(n) for n in names), F.lit(0.0))


def identify(rows: DataFrame, model: Likelihoods) -> DataFrame:
    """One row per row of ``evidence``: doc_id, page_id, lang, confidence, text_lang,
    declared, suffix, host.

    1. Every whole text gets its likelihood in each language; with the languages' shares
       this gives a first posterior.
    2. The first posteriors are summed per host, and host sums per domain and in all:
       a host's prior is its own sums smoothed by its domain's, which are smoothed by the
       global ones. A row's own part is taken out of its host's sums first.
    3. They are also summed per declared language and per address suffix, which gives the
       likelihood of each declaration and suffix in each language.
    4. Prior and likelihoods are multiplied; missing evidence counts nothing.

    Only numbers, never texts, are shuffled; a host with a third of the rows is one row
    per task. A null or empty text leaves the decision to the rest; without any evidence
    the commonest language wins. Without labelled languages ``lang`` is null. Ties go to
    the first language in alphabetical order. Repeated rows are judged each.
    """
    spark = rows.sparkSession
    arrow_batches(spark)
    names = [f"p{i}" for i in range(len(model.languages))]
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        for batch in pieces(batches, most=PIECE):
            scores = own.of(batch.column("text").to_pylist())
            likely = np.exp(scores)
            likely /= likely.sum(axis=1, keepdims=True)
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("doc_id", "page_id", "declared", "suffix", "host", "domain")},
                **{f"t{i}": pa.array(scores[:, i], pa.float64()) for i in range(len(names))},
                **{n: pa.array(likely[:, i], pa.float64()) for i, n in enumerate(names)}})

    columns = "doc_id long, page_id long, declared string, suffix string, host string, domain string"
    if not names:
        return rows.select("doc_id", "page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "suffix", "host")
    kinds = [*[f"t{i} double" for i in range(len(names))], *[f"{n} double" for n in names]]
    first = stored(rows.mapInArrow(run, ", ".join([columns, *kinds])), "evidence")

    hosts = stored(_sums(first, names, "host", "domain"), "hosts")
    whole = hosts.agg(*[F.sum(n).alias(n) for n in names]).first()
    totals = np.array([whole[n] or 0.0 for n in names]) + 1 / len(names)
    world = {n: float(t) for n, t in zip(names, totals / totals.sum())}
    domains = _sums(hosts, names, "domain")
    domains = domains.select(F.col("domain").alias("_domain"), *[
        ((F.col(n) + KAPPA * world[n]) / (_mass(names) + KAPPA)).alias(f"d{n}") for n in names])
    priors = stored(hosts.where("host is not null").join(domains, F.col("domain") == F.col("_domain")).select(
        F.col("host").alias("_host"), *[F.col(n).alias(f"h{n}") for n in names], *[f"d{n}" for n in names]), "priors")

    def told(column: str) -> DataFrame:
        """log P(value | language) of a declaration or suffix."""
        sums = stored(_sums(first.where(F.col(column).isNotNull()), names, column), column)
        all_ = sums.agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).first()
        return sums.select(F.col(column).alias(f"_{column}"), *[
            F.log((F.col(n) + TRUST) / ((all_[n] or 0.0) + TRUST * max(all_["n"], 1))).alias(f"{column}_{n}") for n in names])

    joined = first
    for column in ("declared", "suffix"):
        joined = joined.join(stored(told(column), column), F.col(column) == F.col(f"_{column}"), "left")
    joined = joined.join(priors, F.col("host") == F.col("_host"), "left")
    rest = sum((F.greatest(F.col(f"h{n}") - F.col(n), F.lit(0.0)) for n in names), F.lit(0.0))
    logs = []
    for i, n in enumerate(names):
        prior = F.coalesce(
            (F.greatest(F.col(f"h{n}") - F.col(n), F.lit(0.0)) + KAPPA * F.col(f"d{n}")) / (rest + KAPPA), F.lit(world[n]))
        zero = F.lit(0.0)
        logs.append((F.log(prior) + F.col(f"t{i}") + F.coalesce(f"declared_{n}", zero) + F.coalesce(f"suffix_{n}", zero)).alias(f"l{i}"))
    fused = joined.select("doc_id", "page_id", "declared", "suffix", "host", *[f"t{i}" for i in range(len(names))], *logs)

    def best(letter: str) -> tuple[Column, Column]:
        values = F.array(*[F.col(f"{letter}{i}") for i in range(len(names))])
        languages = F.array(*[F.lit(x) for x in model.languages])
        return F.element_at(languages, F.array_position(values, F.array_max(values)).cast("int")), F.array_max(values)

    lang, top = best("l")
    sure = F.lit(1.0) / sum((F.exp(F.col(f"l{i}") - top) for i in range(len(names))), F.lit(0.0))
    return fused.select("doc_id", "page_id", lang.alias("lang"), sure.alias("confidence"), best("t")[0].alias("text_lang"),
                        "declared", "suffix", "host")
