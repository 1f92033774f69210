"""Every operator on odd rows that are alone: in a table, and in a partition of their own."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import exact, html_text, language, lm, near, packing, periods, phrases, substrings, token_files, toxicity, urls
from tests.llm import brute
from tests.llm.conftest import CLASHES, SCHEMA, sentence
from tests.llm.test_operators import RULES, toxic_texts

LONE = [(1, None), (2, ""), (3, " "), (4, "\n"), (5, "x"), (6, "é"), (7, "ab cd"), (None, None), (None, ""), (8, "\U0001F600"),
        (9, "x" * 300_000), (10, "<|endoftext|>"), (2, "again")]


def frames(spark, rows):
    """One frame whose rows lie in partitions of their own."""
    out = None
    for i, t in rows:
        part = spark.createDataFrame([(i, t, None, "s", 0)], SCHEMA).coalesce(1)
        out = part if out is None else out.unionByName(part)
    return out


@pytest.fixture(scope="module")
def lone(spark):
    return frames(spark, LONE)


@pytest.fixture(scope="module")
def model(spark):
    made = toxic_texts(120)
    return toxicity.train(spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string"),
                          spark.createDataFrame([(i, y) for i, _, y in made], "doc_id bigint, toxic int"))


@pytest.fixture(scope="module")
def operators(spark, model, byte_bpe, word_bpe):
    """Operators that give one row per document, as functions of the documents."""
    bench = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "item_id bigint, text string")
    labelled = spark.createDataFrame([(i, t, "a" if y else "b") for i, t, y in toxic_texts(60)], "doc_id bigint, text string, lang string")
    likely = language.likelihoods(labelled)
    return {
        "exact": exact.exact_groups,
        "near": near.near_groups,
        "substrings": substrings.remove_repeats,
        "phrases": lambda d: phrases.decontaminate(d, bench),
        "lm": lm.score,
        "toxicity": lambda d: toxicity.score(d, model),
        "language": lambda d: language.identify(language.evidence(d, None), likely),
        "token_files": lambda d: token_files.read_tokens(token_files.write_tokens(d, word_bpe)),
        "packing": lambda d: packing.pack(d, byte_bpe).select("doc_id", "doc_tokens", "start").where("start = 0"),
        "periods": lambda d: periods.digest(periods.find_runs(periods.planted(d))),
        "html": lambda d: html_text.extract(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"),
                                                     F.col("text").alias("html"))).withColumnRenamed("page_id", "doc_id"),
        "urls": lambda d: urls.judge(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url")), RULES).withColumnRenamed(
            "page_id", "doc_id"),
    }


NAMES = ["exact", "near", "substrings", "phrases", "lm", "toxicity", "language", "token_files", "packing", "periods", "html", "urls"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_in_partitions_of_their_own(operators, lone, name):
    got = operators[name](lone).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in LONE)


@pytest.mark.parametrize("name", NAMES)
def test_a_single_null_text_is_a_table(spark, operators, name):
    got = operators[name](spark.createDataFrame([(6, None, None, None, None)], SCHEMA)).collect()
    assert [r["doc_id"] for r in got] == [6]


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns(spark, operators, lone, name):
    if name in ("html", "urls", "language"):
        return  # these choose their columns above; their own tests add clashing ones
    few = lone.where("length(text) < 100 or text is null")
    clash = few.select("*", *[F.lit("x").alias(c) for c in sorted(set(CLASHES))])
    shown = lambda df: sorted(map(str, (r.asDict() for r in df.drop("sequence_id", "offset").collect())))
    assert shown(operators[name](clash)) == shown(operators[name](few))


def test_a_lone_empty_text_has_no_ngrams():
    from llm.chars import ngrams
    for texts in ([""], [None], ["", None], ["a"], []):
        for sizes in ((1,), (3, 4, 5), (9,)):
            parts, first = ngrams(texts, sizes, 8)
            assert len(first) == len(texts) and len(parts) == len(sizes)
    (part,), _ = ngrams(["abc", ""], (5,), 16)
    assert part[1].sum() == 1  # the text between its two blanks


def test_gaps_of_columns():
    rng = np.random.default_rng(2)
    for _ in range(50):
        counts = rng.integers(0, 6, 8)
        columns = np.concatenate([np.sort(rng.choice(1 << 22, c, replace=False)) for c in counts]) if counts.sum() else np.zeros(0, np.int64)
        columns = columns.astype(np.int64)
        assert (toxicity._columns(toxicity._gaps(columns, counts), counts) == columns).all()


def test_rare_toxic_texts_are_all_fitted(spark):
    """One per cent of toxic texts and a small fit: the quota keeps every one of them."""
    rng = random.Random(12)
    made = [(i, sentence(rng, 30) + (" utterly stupid moron" if i % 100 == 3 else ""), int(i % 100 == 3)) for i in range(3_000)]
    docs = spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + [(90_000 + i, 1) for i in range(500)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, labels, train_rows=100)).collect()}
    assert sum(got[i] for i, _, y in made if y) >= 29 and sum(got[i] for i, _, y in made if not y) <= 30


def test_ratios_are_those_of_the_definition(spark):
    """Log-count ratios of all n-grams of three to five characters, against plain counting."""
    made = toxic_texts(80)
    docs = spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id bigint, toxic int")
    seen = []
    logistic = toxicity._logistic
    toxicity._logistic = lambda parts, ratio: (seen.append(ratio), logistic(parts, ratio))[1]
    try:
        toxicity.train(docs, labels)
    finally:
        toxicity._logistic = logistic
    import math
    import zlib
    counts, texts = [Counter(), Counter()], [0, 0]
    for i, t, y in made:
        if zlib.crc32(str(i).encode()) % 5:
            texts[y] += 1
            low = f" {t.lower()} "
            counts[y].update({low[k:k + n] for n in (3, 4, 5) for k in range(len(low) - n + 1)})
    part = [toxicity.SMOOTH * n / sum(texts) for n in texts]
    plain = [math.log((counts[1][g] + part[1]) / texts[1]) - math.log((counts[0][g] + part[0]) / texts[0])
             for g in {*counts[0], *counts[1]}]
    got = Counter(np.round(seen[0], 4).tolist())
    want = Counter(round(float(np.float32(r)), 4) for r in plain)
    assert sum((got & want).values()) >= 0.99 * len(plain)  # features are hashed, so a few collide


def test_equal_ids_link_what_any_of_their_texts_links(spark):
    """The rows of one id are one node; rows of other ids are reached through any of them."""
    rng = random.Random(17)
    text = {n: sentence(rng, 40, 5_000) for n in "ABCD"}
    rows = [(5, text["A"]), (5, text["B"]), (7, text["A"] + " more"), (8, text["B"] + " more"),
            (9, text["C"]), (9, text["D"]), (3, text["C"] + " end"), (4, text["D"] + " end"), (4, None), (6, "apart")]
    got = near.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {5: 5, 7: 5, 8: 5, 9: 3, 3: 3, 4: 3, 6: 6} and len(got) == len(rows)
    assert {r["n_shingles"] for r in got if r["doc_id"] == 4} == {0, 40}


def test_pipeline_against_brute_force(spark, tmp_path, byte_bpe):
    """Planted toxic, equal, near-equal and leaked documents, and the rows of each stage."""
    rng = random.Random(23)
    made = [(i, t, y) for i, t, y in toxic_texts(200)]
    base = [t for _, t, y in made if not y and len(t.split()) > 25]
    rows = [(i, t) for i, t, _ in made]
    rows += [(500 + k, t.upper() if k % 2 else t) for k, t in enumerate(base[:20])]
    rows += [(600 + k, t + " tail") for k, t in enumerate(base[20:40])]
    items = [(k, sentence(rng, 14)) for k in range(5)]
    rows += [(700 + k, sentence(rng, 20) + " " + items[k % 5][1] + " " + sentence(rng, 20)) for k in range(10)]
    rows += [(800, None), (801, ""), (802, None), (None, "no id"), (803, "y " * 3_000)]
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in made], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")

    kept, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = docs.collect()

    def pairs(name):
        return [(r["doc_id"], r["text"]) for r in kept[name]]

    toxic = {i for i, _, y in made if y}
    clean = [r for r in rows if r[0] not in toxic]
    missed = {i for i, _ in pairs("toxicity")} & toxic
    assert len(missed) <= 2 and set(clean) <= set(pairs("toxicity"))
    after = pairs("toxicity")
    assert sorted(brute.low(t) for _, t in pairs("exact dedup")) == sorted({brute.low(t) for _, t in after})
    least = {brute.low(t): max((i for i, u in after if i is not None and brute.low(u) == brute.low(t)), default=None) for _, t in after}
    assert {i for i, _ in pairs("exact dedup")} == set(least.values())
    before = pairs("exact dedup")
    order = sorted((i for i, _ in before), key=lambda i: (i is None, i or 0))
    sets = {k: brute.shingles(dict(before)[i], 5) for k, i in enumerate(order)}
    groups = brute.components(sets, 80)
    assert {i for i, _ in pairs("near dedup")} == {order[k] for k, g in groups.items() if g == k}
    leaked = {i for i, _, hits, _ in brute.leaks(pairs("near dedup"), items, 10) if hits}
    assert leaked and {i for i, _ in pairs("decontamination")} == {i for i, _ in pairs("near dedup")} - leaked
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(byte_bpe)
    total = {i: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs("decontamination")}
    packed = Counter()
    for r in kept["packing"]:
        packed[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == total[r["doc_id"]] and r["offset"] + r["length"] <= 1024
    assert packed == Counter(total)
    assert sorted(map(str, corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect())) == sorted(
        map(str, docs.drop("sequence_id", "offset").collect()))
    empty = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{folder}/documents.parquet").limit(0), folder)
    assert empty.count() == 0


def test_the_toxicity_fit_holds_two_bytes_a_feature(spark, monkeypatch):
    """The driver unpacks one piece of the fit at a time, and gets no table of all at once."""
    docs = spark.createDataFrame([(i, f"word{i} plain text of number {i * 7919} " * 20) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    seen, fit = [], toxicity._logistic

    def spy(parts, ratio):
        for y, counts, columns in parts:
            assert columns.nbytes <= 2.1 * counts.sum()
            there = toxicity._columns(columns, counts)
            assert len(there) == counts.sum() and there.max() < len(ratio)
            seen.append(int(counts.sum()))
        return fit(parts, ratio)

    monkeypatch.setattr(toxicity, "_logistic", spy)
    monkeypatch.setattr(type(docs), "toArrow", None)
    model = toxicity.train(docs, labels)
    assert sum(seen) > 0 and len(model.feature) > 0
