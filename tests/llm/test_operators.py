"""Each operator against a plain version, on rows with nulls, blanks, ties and repeats."""

import io
import random
import time
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import encoding, exact, language, lm, near, packing, phrases, substrings, token_files, toxicity, urls
from llm.tokens import window_hashes, words
from tests.llm import brute
from tests.llm.conftest import SCHEMA, sentence


def pairs(odd):
    return [(r[0], r[1]) for r in odd]


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_words_and_windows():
    texts = ["a  bb\tccc", None, "", " x", "ä ö a bb ccc", "y\n"]
    w = words(pa.array(texts))
    assert [w.text(i).decode() for i in range(len(w))] == [x for t in texts for x in brute.words(t)]
    assert w.first.tolist() == [0, 3, 3, 3, 4, 9, 10]
    assert w.hash[0] == w.hash[6] and len(set(w.hash.tolist())) == 7
    h, at = window_hashes(w, 3)
    assert at.tolist() == [0, 4, 5, 6] and h[0] == h[3] != h[1]
    mixed = ["Don't STOP-now 12ab", "É é", "a_b"]
    a = words(pa.array(mixed), alnum=True, lower=True)
    assert [a.text(i).decode() for i in range(len(a))] == [x for t in mixed for x in brute.alnum(t)]


@pytest.mark.parametrize("which", ["docs", "clashing"])
def test_exact_groups(request, odd, which):
    wanted, groups = brute.exact(pairs(odd))
    got = exact.exact_groups(request.getfixturevalue(which), digest=True)
    assert rows(got, "doc_id", "keep_id", "group_size") == wanted
    assert got.where("kept").count() == groups
    assert got.where("text_sha256 is null").isEmpty()
    lazy = exact.exact_groups(request.getfixturevalue(which))
    assert not lazy.where("text_sha256 is null").isEmpty()  # single texts need no full hash
    assert rows(lazy, "doc_id", "keep_id", "group_size") == wanted


def test_drop_exact_keeps_columns(clashing, odd):
    out = exact.drop_exact(clashing)
    assert out.columns == clashing.columns and out.count() == brute.exact(pairs(odd))[1]


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups(docs, odd, size):
    sets = defaultdict(frozenset)
    for i, t in pairs(odd):
        if i is not None and i != 409:  # two texts under one id have no plain answer
            sets[i] = brute.shingles(t, size)
    wanted = brute.components(sets, 80)
    got = {r["doc_id"]: r for r in near.near_groups(docs.where("doc_id <> 409 or doc_id is null"), size).collect()}
    assert {i: got[i]["component_id"] for i in wanted} == wanted
    assert all(got[i]["n_shingles"] == len(sets[i]) and got[i]["kept"] == (wanted[i] == i) for i in wanted)
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_near_groups_of_a_large_group(spark):
    """Hundreds of variants of one text, many at the edge of the threshold."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    made = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(0, 8)):
            text[rng.randrange(60)] = f"x{rng.randrange(10_000)}"
        made.append((i, " ".join(text)))
    wanted = brute.components({i: brute.shingles(t, 2) for i, t in made}, 80)
    df = spark.createDataFrame(made, "doc_id bigint, text string")
    assert dict(rows(near.near_groups(df, 2), "doc_id", "component_id")) == wanted
    small = near.TILE_ROWS
    near.TILE_ROWS = 40
    try:
        assert dict(rows(near.near_groups(df, 2), "doc_id", "component_id")) == wanted
    finally:
        near.TILE_ROWS = small


def test_shingles_of_a_batch_take_little_memory():
    """A task holds a piece of its batch as hashes, not the whole batch (8 MB here)."""
    rng = random.Random(6)
    texts = [sentence(rng, 400, 5000) for _ in range(3500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    assert batch.nbytes > 7 << 20
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in near._sign(5)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 32 << 20


def test_pigeonhole():
    """Any two signatures that differ in REACH symbols share a key."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, near.SYMBOLS, dtype=np.uint16)
        b = a.copy()
        at = rng.choice(near.SYMBOLS, near.REACH, replace=False)
        b[at] ^= np.uint16(1)
        assert set(near.keys(a[None])[0].tolist()) & set(near.keys(b[None])[0].tolist())


def test_drop_near(clashing):
    out = near.drop_near(exact.drop_exact(clashing))
    assert out.columns == clashing.columns
    left = [brute.shingles(r["text"], 5) for r in out.collect()]
    left = {i: s for i, s in enumerate(left) if s}
    assert len(set(brute.components(left, 80).values())) == len(left)
    assert rows(out.where("doc_id in (400, 401, 402)"), "doc_id") == [(401,), (402,)]  # white space is a text of its own


@pytest.mark.parametrize("which", ["docs", "clashing"])
def test_remove_repeats(request, odd, which):
    got = substrings.remove_repeats(request.getfixturevalue(which))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute.repeats(pairs(odd), 13)
    for r in got.where("n_removed > 0").collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_decontaminate(spark, docs, odd):
    texts = [t for _, t in pairs(odd) if t and 20 < len(t.split()) < 1000]
    items = [(1, texts[0].upper()), (2, " ".join(texts[1].split()[5:17])), (2, texts[2]), (3, "one"), (4, None), (5, ""),
             (None, texts[3]), (6, "nowhere to be found at all in any of these texts"), (7, "two words")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("hits", F.lit(1))
    got = phrases.decontaminate(docs, bench)
    found = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()), key=str)
    assert found == brute.leaks(pairs(odd), items, 10)
    passes = phrases.QUERY_WORDS
    phrases.QUERY_WORDS = 20  # several passes over the index
    try:
        again = phrases.decontaminate(docs, bench)
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in again.collect()), key=str) == found
    finally:
        phrases.QUERY_WORDS = passes


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x fox y blue"), (2, "blue fox red"), (3, "red " + "z " * 30 + "fox blue")],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, "red fox blue")], "item_id bigint, text string")
    assert rows(phrases.decontaminate(docs, bench).where("n_hit > 0"), "doc_id") == []
    assert rows(phrases.decontaminate(docs, bench, within=5).where("matches > 0"), "doc_id") == [(1,), (2,)]


def test_language_model(clashing, odd):
    got = lm.score(clashing)
    shown = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
                    for r in got.collect()), key=str)
    assert shown == brute.unigrams(pairs(odd))
    assert all(r["score"] < 0 for r in got.collect())


def test_language_model_sums_to_one():
    """Over all known words and the unknown one, in any context."""
    rng = np.random.default_rng(1)
    n = 300
    hashes = np.sort(rng.integers(1, 2**63, n, dtype=np.uint64))
    ending = rng.integers(0, 1 << 16, n)
    count = rng.integers(1, 50, n)
    own = np.arange(10)
    class_of = np.full(1 << 16, lm.CLASSES - 1)
    class_of[ending[10:]] = lm.OWN + rng.integers(0, lm.ENDINGS, n - 10)
    cls = np.concatenate([own, class_of[ending[10:]]])
    model = lm.Model(int(count.sum()), n, hashes[:10], own, class_of, np.bincount(cls, weights=count, minlength=lm.CLASSES),
                     np.bincount(cls, minlength=lm.CLASSES), 0.6, hashes, rng.normal(0, 0.1, (1 << lm.ROW_BITS, lm.CLASSES)).astype("f4"),
                     rng.normal(0, 1, lm.CLASSES).astype("f4"))
    # One text per word: the same two words, then that word.
    h = np.column_stack([np.full(n + 1, hashes[3]), np.full(n + 1, hashes[40]), np.append(hashes, np.uint64(7))]).reshape(-1)
    e = np.column_stack([np.full(n + 1, ending[3]), np.full(n + 1, ending[40]), np.append(ending, 0)]).reshape(-1)
    c = np.column_stack([np.full(n + 1, count[3]), np.full(n + 1, count[40]), np.append(count, 0)]).reshape(-1)
    doc = np.repeat(np.arange(n + 1), 3)
    p = 10 ** model.score(lm.Tokens(h, e, doc, np.ones(len(h), bool)), c)
    assert p[2::3].sum() == pytest.approx(1, abs=1e-3)


def test_sums_by_row():
    rng = np.random.default_rng(9)
    for row in (rng.integers(0, lm.BATCH, lm.BATCH), rng.zipf(1.3, 3001) % 999, np.full(5, 7), np.zeros(0, np.int64)):
        values = rng.normal(size=(len(row), 8))
        want = np.zeros((lm.BATCH, 8))
        np.add.at(want, row, values)
        found, sums = lm.sums_by_row(values, row)
        assert found.tolist() == sorted(set(row.tolist()))
        np.testing.assert_allclose(sums, want[found], rtol=1e-9, atol=1e-9)


def test_learning_takes_little_time():
    """A step costs less than the sums of its slopes do by numpy's reduceat alone."""
    rng = np.random.default_rng(10)
    n = 60_000
    hashes = np.sort(rng.integers(1, 2**63, 4096, dtype=np.uint64))
    model = lm.Model(n, 4096, hashes[:10], np.arange(10), np.arange(1 << 16) % lm.CLASSES, np.ones(lm.CLASSES, np.int64),
                     np.ones(lm.CLASSES, np.int64), 0.5, hashes, np.zeros((1 << lm.ROW_BITS, lm.CLASSES), np.float32),
                     np.zeros(lm.CLASSES, np.float32))
    t = lm.Tokens(rng.choice(hashes, n), rng.integers(0, 1 << 16, n), np.arange(n) // 500, np.ones(n, bool))
    features = model.contexts(t)[0][:lm.BATCH]
    steps = -(-len(model.contexts(t)[0]) // lm.BATCH)

    def seconds(work):
        best = []
        for _ in range(3):
            began = time.thread_time()
            work()
            best.append(time.thread_time() - began)
        return min(best)

    def plain():
        p = np.ones((lm.BATCH, lm.CLASSES), np.float32)
        for j in range(3):
            by = np.argsort(features[:, j], kind="stable")
            np.add.reduceat(p[by], np.unique(features[by, j], return_index=True)[1], axis=0)

    assert seconds(lambda: model.learn(t, np.zeros(len(model.weights), np.float32))) < steps * seconds(plain)


def test_packing(docs, odd, byte_bpe):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(byte_bpe)
    ids = defaultdict(list)
    for i, t in pairs(odd):
        ids[i].append(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    got = packing.pack(docs, byte_bpe, ids=True).collect()
    sequences = defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(d[4 * r["start"]:4 * (r["start"] + r["length"])] == r["ids"] and len(d) == 4 * r["doc_tokens"] for d in ids[r["doc_id"]])
    assert sum(r["length"] for r in got) == sum(len(d) // 4 for own in ids.values() for d in own)
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_first_fit_decreasing():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1024) for _ in range(500)]
    got = packing.first_fit_decreasing(sizes, 1024)
    bins, wanted = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, used in enumerate(bins) if used + sizes[i] <= 1024), None)
        if b is None:
            b = len(bins)
            bins.append(0)
        wanted[i] = (b, bins[b])
        bins[b] += sizes[i]
    assert got == wanted


@pytest.mark.parametrize("name, spaced", [("byte_bpe", True), ("word_bpe", False)])
def test_encoder_is_the_tokenizer(request, name, spaced):
    from tokenizers import Tokenizer
    path = request.getfixturevalue(name)
    plain = Tokenizer.from_file(path)
    rng = random.Random(4)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'", "s", "'s", "\u00a0", "\u00e9", "\u0301", "1", "!", "\u3000", "<|endoftext|>",
             "\u0130", "\x1c", "\x85", "\u00df", ".", ",", "|", "$$$", " Wort", " mot.\nEt"]
    texts = [None, "", " "] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    wanted = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoding.Encoder(path, spaced)(texts) == wanted


def test_token_files(spark, docs, odd, word_bpe):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(word_bpe)
    manifest = token_files.write_tokens(docs, word_bpe, frame_bytes=2_000)
    got = token_files.read_tokens(manifest, ids=True).orderBy("start").collect()
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order) and len(got) == len(odd)
    total = 0
    for r in got:
        assert r["start"] == total and len(r["ids"]) == 4 * r["n_tokens"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        total += r["n_tokens"]
    wanted = sorted(((i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in pairs(odd)), key=str)
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=str) == wanted
    some = spark.createDataFrame([(3,), (407,), (999_999,)], "doc_id bigint")
    assert rows(token_files.read_tokens(manifest, some), "doc_id", "start") == [
        (r["doc_id"], r["start"]) for r in got if r["doc_id"] in (3, 407)]


def test_frames_are_read_alone_and_checked():
    out = io.BytesIO()
    writer = token_files.Writer(out, 100)
    for i in range(50):
        writer.add(i, np.full(10, i, "<u4").tobytes())
    writer.close()
    reader = token_files.Reader(io.BytesIO(out.getvalue()))
    assert len(reader.packed) == 26 and [d[0] for d in reader.documents([7])] == [7] and reader.frames_read == 1
    import zstandard
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole[:2000] == b"".join(np.full(10, i, "<u4").tobytes() for i in range(50))  # plain readers work
    damaged = bytearray(out.getvalue())
    damaged[int(reader.at[3]) + 8] ^= 1
    broken = token_files.Reader(io.BytesIO(bytes(damaged)))
    assert list(broken.documents([0]))
    with pytest.raises(Exception):
        list(broken.documents([7]))


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


def judged(url):
    rest = (url or "").split("://", 1)
    host = path = ""
    if len(rest) == 2:
        tail = rest[1]
        cut = min([tail.find(c) for c in "/?#" if c in tail] or [len(tail)])
        host, tail = tail[:cut].translate(brute.LOWER), tail[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit, key=lambda r: len(r[0]), default=(None, None)))


def test_urls(spark):
    rng = random.Random(6)
    made = ["http://" + rng.choice(["a.", "WWW.", "m.x.", ""]) + rng.choice(["example.com", "shop.net", "b.org", "com"])
            + rng.choice(["", "/", "/en/1", "/es/2?q=1&r=2", "/fr/x#top", "?z=/en/"]) for _ in range(300)]
    made += [None, "", "no scheme", "http://", "http://x.com:80/en/", "a://b://c.net/es/", "http://é.net/es/ü", "http://c.com/" + "9" * 20_000,
             "HTTP://Example.COM\n/en/", "x://net/es/1", "x://subnet/es/1"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(made)], "page_id bigint, url string, rule string")
    got = {r["page_id"]: r for r in urls.judge(pages, RULES).collect()}
    assert len(got) == len(made)
    for i, u in enumerate(made):
        host, path, rule, verdict = judged(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
    assert urls.judge(pages.limit(0), RULES).count() == 0
    only = pages.where("url like 'http://com/%'")
    assert rows(urls.judge(only, RULES).select("verdict").distinct(), "verdict") in ([("allow",)], [])


def toxic_texts(n):
    rng = random.Random(8)
    made = []
    for i in range(n):
        text = sentence(rng, rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            text += rng.choice([" you moron", " what a Clown!", " utterly stupid thing"])
        made.append((i, text, int(bad)))
    return made


def test_toxicity(spark, clashing, none):
    made = toxic_texts(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in made] + [(1000, None), (1001, ""), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in made] + [(0, 1, None), (None, 0, 1), (5000, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 603 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [(y, got[i]["predicted"]) for i, _, y in made if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in made)
    assert len(held) > 80 and sum(y == p for y, p in held) >= 0.97 * len(held)
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0
    assert toxicity.keep_clean(clashing, labels.limit(0)).columns == clashing.columns
    assert toxicity.keep_clean(none, labels).count() == 0


@pytest.mark.parametrize("train_rows", [toxicity.TRAIN_ROWS, 40])
def test_toxicity_of_few_toxic_texts(spark, train_rows):
    """Ten toxic texts are enough, and every labelled text counts, also beyond the fit."""
    rng = random.Random(21)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    made = [(i, sentence(rng, 40) + (" utterly stupid moron" if k % 7 == 0 else ""), int(k % 7 == 0)) for k, i in enumerate(ids[:70])]
    assert sum(y for _, _, y in made) == 10
    new = [(1000 + k, sentence(rng, 40) + (" utterly stupid moron" if k % 2 else ""), k % 2) for k in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in made + new], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, train_rows)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert sum(got[i] == y for i, _, y in new) >= 39
    clean = toxicity.keep_clean(docs, labels)
    assert {i for i, _, y in made if y}.isdisjoint(r["doc_id"] for r in clean.collect())


def test_toxicity_counts_rows_beyond_the_fit(spark):
    """Features are counted on all labelled texts, however few the fit takes."""
    made = toxic_texts(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id bigint, toxic int")
    few, all_ = (len(toxicity.train(docs, labels, n).feature) for n in (20, toxicity.TRAIN_ROWS))
    assert few == all_


def test_language(spark):
    rng = random.Random(3)
    syllables = {"aa": ["ka", "ro", "mi", "tun"], "bb": ["schü", "eit", "ung", "ver"], "cc": ["ción", "que", "ell", "ado"]}
    text = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(n))
    made = [(i, text(lang, rng.randint(1, 40)), lang, f"s{i % 3}") for i, lang in enumerate(rng.choice(sorted(syllables)) for _ in range(300))]
    docs = spark.createDataFrame([*made, (900, None, None, None), (901, "", None, "s1"), (901, "", None, "s1")],
                                 "doc_id bigint, text string, lang string, source string")
    page = lambda i, lang, body, said: (
        i, f"http://h{lang}.{lang}.org/{i}", f"<html lang='{said}'><script>x</script><p>{body}</p></html>")
    pages = [page(i, lang, text(lang, 20), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    pages += [page(100, "bb", "", "bb"), (101, "http://hcc.cc.org/", None), (102, None, None), (103, "http://haa.aa.org", "<p></p>")]
    pages = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("lang", F.lit("x"))
    model = language.likelihoods(docs)
    got = language.identify(language.evidence(docs, pages), model).collect()
    by_doc = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    by_page = {r["page_id"]: r for r in got if r["page_id"] is not None}
    assert len(got) == 303 + 64
    right = [by_doc[i]["lang"] == lang for i, _, lang, _ in made if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(right) > 40 and sum(right) >= 0.97 * len(right)
    assert by_page[100]["lang"] == "bb" and by_page[101]["lang"] == "cc" and by_page[103]["lang"] == "aa"
    assert by_page[102]["lang"] in syllables and all(0 < r["confidence"] <= 1 for r in got)
    empty = language.identify(language.evidence(docs.limit(0), pages.limit(0)), language.likelihoods(docs.limit(0)))
    assert empty.count() == 0


def test_every_language_is_kept(spark):
    """More labels than 64, and a language whose rows are few among many."""
    def text(rng, lang, n):
        own = random.Random(lang)
        syllables = ["".join(own.choice("bcdfghklmnprstvz") + own.choice("aeiouäöü") for _ in range(2)) for _ in range(6)]
        return " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(n))

    rng = random.Random(31)
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5]
    langs = [f"l{k:02}" for k in range(66) for _ in range(4)] + ["often"] * 900 + ["rare"] * 2
    made = [(i, text(rng, lang, 40), lang) for i, lang in zip(ids, langs)]
    docs = spark.createDataFrame(made, "doc_id bigint, text string, lang string")
    model = language.likelihoods(docs, 400)
    assert model.languages == sorted(set(langs))
    got = model.of([text(rng, lang, 40) for lang in model.languages]).argmax(axis=1)
    assert (got == np.arange(68)).all()
    new = spark.createDataFrame([(1, text(rng, "rare", 40), "s")], "doc_id bigint, text string, source string")
    assert language.identify(language.evidence(new, None), model).first()["lang"] == "rare"


def test_empty_tables(spark, none, byte_bpe, word_bpe):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert exact.exact_groups(none).count() == 0
    assert near.near_groups(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert phrases.decontaminate(none, bench).count() == 0
    assert lm.score(none).count() == 0
    assert packing.pack(none, byte_bpe).count() == 0
    assert token_files.read_tokens(token_files.write_tokens(none, word_bpe)).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


def test_empty_benchmark(spark, docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert phrases.decontaminate(docs, bench).where("n_hit > 0").count() == 0
    assert spark.createDataFrame([], SCHEMA).columns == docs.columns
