import random

import public_tokenizers
import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("start", "length", "label", "score", "kept", "keep_id", "block", "bucket", "data", "row", "n", "key", "id",
           "spans", "items", "first", "words", "sequence_id", "offset", "label", "tile")


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_rows():
    """Nulls, blanks, repeated rows, equal ids, ties, copies, near copies, a shared passage, a long text."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(3, 90)) for _ in range(40)]
    passage = sentence(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper() if i % 2 else t) for i, t in enumerate(base[:12])]          # copies up to case
    rows += [(200 + i, t + " extra") for i, t in enumerate(base) if len(t.split()) > 20]     # near copies
    rows += [(300 + i, sentence(rng, 30) + "\n" + passage + "  " + sentence(rng, 25)) for i in range(8)]
    rows += [(400, None), (401, ""), (402, " \t\n "), (403, "One"), (404, "one"), (405, "two words"), (405, "two words"),
             (406, "Ünï cödé — ça va? ½ £5 日本 語"), (None, "no id at all here"), (None, None),
             (407, sentence(rng, 20_000)), (408, "<|endoftext|> a's b'S  c"), (409, base[3]), (409, base[5])]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), len(t or "")) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return odd_rows()


@pytest.fixture(scope="session")
def docs(spark, odd):
    return spark.createDataFrame(odd, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, docs):
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit("x").alias(c) for c in sorted(set(CLASHES))])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")
