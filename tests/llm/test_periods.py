"""Periodic runs against comparing every word with every later one."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from llm import periods
from llm.tokens import words
from tests.llm import brute


def runs(w, least):
    n, seen = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            b = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - b >= q:
                seen.setdefault((b, i + q), q)
            i += 1
    return sorted((b, e - b, q) for (b, e), q in seen.items() if e - b >= least)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def collapsed(w, found):
    gone = {i for b, n, q in found for i in range(b + q, b + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text):
    w = planted(doc_id, brute.words(text))
    found = runs(w, 12)
    b, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (doc_id, len(found), b, n, q, 1000 * n // q if n else None,
            sha("".join(f"{b},{n},{q}\n" for b, n, q in found)), sha(collapsed(w, found)))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def hard_texts():
    rng = random.Random(1)
    out = [["x"] * 300, ["x"] * 5, [], [str(i.bit_count() % 2) for i in range(1500)]]
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    out.append(list(b))
    for n in (30, 100, 400):
        for k in (1, 2, 3, 5):
            out += [[str(rng.randrange(k)) for _ in range(n)] for _ in range(3)]
    for _ in range(40):
        out.append((["a"] * rng.randint(5, 60) + ["b"]) * 6)
        out.append(((list("ab") * 60)[:rng.randint(20, 90)] * 5)[:rng.randint(100, 400)])
        p = rng.randint(1, 7)
        root = [str(rng.randrange(3)) for _ in range(p)] * 200
        out.append(root[:rng.randint(60, 160)] + root[rng.randint(0, p):][:rng.randint(60, 160)])  # runs that touch
    return out


@pytest.mark.parametrize("least", [2, 12])
def test_runs(least):
    texts = hard_texts()
    w = words(pa.array([" ".join(t) for t in texts]))
    got = {d: [] for d in range(len(texts))}
    for d, *run in periods.runs_of(w.hash, w.first, least).tolist():
        got[d].append(tuple(run))
    assert got == {d: runs(t, least) for d, t in enumerate(texts)}


def test_touching_runs_are_needed():
    """Two runs of one small period supply periods that no chosen place shows."""
    texts = hard_texts()
    w = words(pa.array([" ".join(t) for t in texts]))
    whole, touching = len(periods.runs_of(w.hash, w.first)), periods._touching
    periods._touching = lambda *_: iter(())
    try:
        assert len(periods.runs_of(w.hash, w.first)) < whole
    finally:
        periods._touching = touching


@pytest.mark.parametrize("which", ["docs", "clashing"])
def test_query_rows(request, odd, which):
    short = [(r[0], r[1]) for r in odd if r[1] is None or len(r[1]) < 50_000]
    df = request.getfixturevalue(which)
    got = periods.digest(periods.find_runs(periods.planted(df.where("text is null or length(text) < 50000"))))
    rows = sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=str)
    assert rows == sorted((wanted(i, t) for i, t in short), key=str)


def test_repeated_lines_and_a_long_text(spark):
    rng = random.Random(4)
    verse = [f"w{rng.randrange(50)}" for _ in range(9_000)]
    docs = [(1, " ".join(verse * 3)), (2, "a b c\n" * 5), (3, "a b c\n" * 5), (None, "z " * 12), (4, "z " * 11)]
    got = {r["doc_id"]: r for r in periods.find_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 27_000, 9_000)] and got[1]["collapsed_text"] == " ".join(verse)
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 15, 3)] == [tuple(r) for r in got[3]["runs"]]
    assert got[None]["collapsed_text"] == "z" and got[4]["runs"] == [] and got[4]["n_words"] == 11


def test_empty_table_and_lone_rows(spark, none):
    assert periods.digest(periods.find_runs(periods.planted(none))).count() == 0
    for row in ((1, None), (6, ""), (None, " \n"), (None, None), (6, "one")):
        df = spark.createDataFrame([row], "doc_id long, text string")
        got = periods.digest(periods.find_runs(periods.planted(df))).collect()
        assert [tuple(r[n] for n in NAMES) for r in got] == [wanted(*row)]
