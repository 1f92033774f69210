"""Near-duplicates: b-bit MinHash signatures joined by multi-index Hamming search."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW, arrow_batches, maybe_member, member_bitmap, numbered, same_names, stored, without
from .components import components
from .tokens import mix, pieces, window_hashes, words

CHUNKS = 12      # pieces that a signature is split into
CHUNK = 5        # symbols of a piece
ERRORS = 1       # symbols of a piece that may differ
SYMBOLS = CHUNKS * CHUNK
REACH = CHUNKS * (ERRORS + 1) - 1  # pigeonhole: every pair that differs in so many symbols is met
FARTHEST = SYMBOLS // 2            # a pair that differs in more symbols is not confirmed

TILE_ROWS = 512          # classes of a bucket that are compared at once with as many others
TILE_SHINGLES = 200_000
COLUMNS = 1_024          # shingles of a 0/1 matrix
PIECE = 1 << 18          # text whose shingles are hashed at once; some 50 times as many bytes

_RANDOM = np.random.Generator(np.random.PCG64(11))
_TIMES = _RANDOM.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(1, 2**63, SYMBOLS, dtype=np.uint64)
_KEEP = [c for c in itertools.combinations(range(CHUNK), CHUNK - ERRORS)]
_FACTOR = _RANDOM.integers(1, 2**63, (CHUNKS, len(_KEEP), CHUNK - ERRORS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. With fewer than ``size`` words the
    whole sequence is one shingle; without words there is none."""
    w = words(texts, lower=True)
    h, at = window_hashes(w, size)
    edges = np.searchsorted(at, w.first)
    out = []
    for d in range(w.docs):
        own = h[edges[d]:edges[d + 1]]
        if len(own):
            out.append(np.unique(own))
        else:
            short = w.hash[w.first[d]:w.first[d + 1]]
            whole = np.zeros(min(len(short), 1), np.uint64)
            for k, x in enumerate(short):  # fewer than ``size`` words
                whole = mix(whole ^ x + np.uint64(k + 1))
            out.append(whole)
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """SYMBOLS symbols of 16 bits: of each random order of the shingles, the first one."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 1024):
        np.minimum(least, ((s[at:at + 1024, None] ^ _FLIP) * _TIMES).min(axis=0), out=least)
    return (mix(least) >> np.uint64(48)).astype(np.uint16)


def keys(signatures: np.ndarray) -> np.ndarray:
    """All index keys of signatures (rows): each chunk with every choice of allowed errors
    left out. Two signatures share a key if one of their chunks differs in ERRORS symbols
    at most."""
    chunks = signatures.reshape(len(signatures), CHUNKS, CHUNK).astype(np.uint64)
    out = np.empty((len(signatures), CHUNKS, len(_KEEP)), np.uint64)
    for v, keep in enumerate(_KEEP):
        out[:, :, v] = (mix(chunks[:, :, keep] + np.uint64(1)) * _FACTOR[:, v]).sum(axis=2)
    return mix(out.reshape(len(signatures), -1))


def _sign(size: int):
    def run(batches):
        for batch in pieces(batches, most=PIECE):
            sets = shingle_sets(batch.column("text"), size)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "same": pa.array([mix(s).sum(dtype=np.uint64).tobytes() + mix(s ^ _FLIP[0]).sum(dtype=np.uint64).tobytes()
                                  for s in sets], pa.binary()),
                "signature": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())})
    return run


def _explode_keys(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        k = keys(signs)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(k.reshape(-1).view(np.int64)),
            "id": pa.array(np.repeat(batch.column("doc_id").to_numpy(), k.shape[1]))})


def distance(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Symbols that differ, row by row."""
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint16).reshape(-1, SYMBOLS)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint16).reshape(-1, SYMBOLS)
    return (x != y).sum(axis=1)


def _close(batches):
    for batch in batches:
        if batch.num_rows:
            near = distance(batch.column("sa"), batch.column("sb")) <= FARTHEST
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _confirm(size: int, share: int):
    """Pairs whose full shingle sets overlap enough. The second text comes in runs."""
    def run(batches):
        last, theirs = None, None
        for batch in pieces(batches, "ta", PIECE):
            sets = shingle_sets(batch.column("ta"), size)
            ids = batch.column("b").to_pylist()
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, own in enumerate(sets):
                if ids[i] != last:
                    last, theirs = ids[i], shingle_sets(batch.column("tb").slice(i, 1), size)[0]
                if 100 * min(len(own), len(theirs)) < share * max(len(own), len(theirs)):
                    continue
                both = len(np.intersect1d(own, theirs, assume_unique=True))
                good[i] = both > 0 and 100 * both >= share * (len(own) + len(theirs) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))
    return run


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link: their lengths allow it, their signatures are not
    too far apart, and their full sets overlap by ``share`` per cent of the union."""
    slim = classes.select(F.col("doc_id").alias("_id"), "n", "signature")
    with_a = pairs.join(slim.withColumnsRenamed({"n": "na", "signature": "sa"}), F.col("a") == F.col("_id")).drop("_id")
    with_b = with_a.join(slim.withColumnsRenamed({"n": "nb", "signature": "sb"}), F.col("b") == F.col("_id")).drop("_id")
    able = with_b.where(100 * F.least("na", "nb") >= share * F.greatest("na", "nb")).select("a", "b", "sa", "sb")
    close = stored(able.mapInArrow(_close, "a long, b long"), "close")
    texts = _texts(stored(close.select(F.col("a").alias("_want")).union(close.select("b")).distinct(), "wanted"), docs)
    left = close.join(texts.withColumnRenamed("text", "ta"), F.col("a") == F.col("_id")).drop("_id")
    full = left.join(texts.withColumnRenamed("text", "tb"), F.col("b") == F.col("_id")).drop("_id")
    return stored(full.mapInArrow(_confirm(size, share), "a long, b long"), "links")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """As few of some edges as connect the same nodes."""
    up: dict[int, int] = {}

    def root(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[rx] = ry
            out.append((x, y))
    return out


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another, from 0/1
    matrices over the shingles that both lists have, some columns at a time."""
    lh, rh = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(lh, rh)
    out = np.zeros((len(left), len(right)), np.float32)
    lr, rr = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    lk, rk = np.isin(lh, shared), np.isin(rh, shared)
    lr, rr = lr[lk], rr[rk]
    lc, rc = np.searchsorted(shared, lh[lk]), np.searchsorted(shared, rh[rk])
    lo, ro = np.argsort(lc, kind="stable"), np.argsort(rc, kind="stable")
    lr, lc, rr, rc = lr[lo], lc[lo], rr[ro], rc[ro]
    for at in range(0, len(shared), COLUMNS):
        parts = []
        for n, r, c in ((len(left), lr, lc), (len(right), rr, rc)):
            a, b = np.searchsorted(c, (at, at + COLUMNS))
            m = np.zeros((n, min(COLUMNS, len(shared) - at)), np.float32)
            m[r[a:b], c[a:b] - at] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def _tile(size: int, share: int):
    """Links between classes of different components in one pair of tiles of a bucket."""
    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        tile = table.column("tile").to_numpy()
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        sets = []
        for batch in pieces(table.select(["text"]).to_batches(), most=PIECE):
            sets += shingle_sets(batch.column("text"), size)
        n = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        able = labels[left][:, None] != labels[right][None, :]
        small, large = np.minimum(n[left][:, None], n[right]), np.maximum(n[left][:, None], n[right])
        able &= 100 * small >= share * large
        left, right, able = left[able.any(axis=1)], right[able.any(axis=0)], able[able.any(axis=1)][:, able.any(axis=0)]
        edges = []
        if len(left):
            both = overlaps([sets[x] for x in left], [sets[x] for x in right])
            good = able & (both > 0) & (100 * both >= share * (n[left][:, None] + n[right] - both))
            x, y = np.nonzero(good)
            edges = _forest(ids[left[x]], ids[right[y]])
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})
    return run


def _across(named: DataFrame, classes: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """Links between classes (id) that share a bucket (key) but not yet a component (label).

    A bucket with the same members as another is left out. A large bucket is dealt over
    tiles, and each pair of tiles is compared by itself: a task holds two tiles, and what
    it returns is a forest of the links it found, never the pairs.
    """
    sizes = named.join(classes.select(F.col("doc_id").alias("_id"), "n"), F.col("id") == F.col("_id"))
    summed = sizes.groupBy("key").agg(
        F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count(F.lit(1)).alias("_rows"),
        F.sum("n").alias("_shingles"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("_members"))
    open_ = summed.where("_lo < _hi").groupBy("_rows", "_shingles", "_members").agg(F.min("key").alias("_key")).select(
        "_key", F.ceil(F.greatest(F.col("_rows") / TILE_ROWS, F.col("_shingles") / TILE_SHINGLES)).cast("int").alias("_tiles"))
    dealt = stored(named.join(stored(open_, "open"), F.col("key") == F.col("_key")).select(
        "key", "id", "label", "_tiles", F.pmod(F.xxhash64("id"), F.col("_tiles")).cast("int").alias("tile")), "dealt")
    texts = _texts(dealt.select(F.col("id").alias("_want")).distinct(), docs)
    pair = F.transform(F.sequence(F.lit(0), F.col("_tiles") - 1), lambda k: F.struct(
        F.least("tile", k).alias("i"), F.greatest("tile", k).alias("j")))
    spread = dealt.join(texts, F.col("id") == F.col("_id")).select(
        "key", "id", "label", "tile", "text", F.explode(pair).alias("_pair")).select(
        "key", "id", "label", "tile", "text", "_pair.i", "_pair.j")
    return stored(spread.groupBy("key", "i", "j").applyInArrow(_tile(size, share), "a long, b long"), "across")


def _texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(_id, text) of some ids, one row each. A bitmap of fixed size keeps most other texts
    out of the shuffle."""
    there = maybe_member(
        docs.select(F.col("doc_id").alias("_want"), "text"), member_bitmap(wanted, "_want"), "_want"
    ).where("_maybe").join(wanted.withColumnRenamed("_want", "_w"), F.col("_want") == F.col("_w"), "left_semi")
    return stored(there.groupBy(F.col("_want").alias("_id")).agg(F.min("text").alias("text")), "texts")


def near_groups(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``size``-word shingles (A-Z lower-cased) overlap
    by ``share`` per cent of their union; ``component_id`` is the smallest id reachable.

    1. Documents with one and the same set are one class; only classes go on.
    2. A class's signature has SYMBOLS symbols of b = 16 bits. It is split into CHUNKS
       chunks; each chunk is indexed under every choice of ERRORS left-out symbols. By
       pigeonhole all pairs that differ in at most REACH symbols share a key; of pairs
       at a similarity of exactly 0.8 more than 0.9999999 do, and nearer ones more.
    3. In every key's bucket each class is paired with the bucket's smallest id only.
       Pairs are confirmed on the full sets, and links make components.
    4. In buckets that still hold several components, classes of different components are
       paired until no such pair is left untried. A large group of copies is thus one
       star and not all its pairs, and no pair that could link two components is left out.

    Null and blank texts have no shingles: n_shingles 0, linked with nothing. Fewer words
    than ``size`` make one shingle. Repeated rows and equal ids fall in one class, also if
    their texts differ: an id is linked with whatever one of its texts is linked with. A null
    id is linked with nothing. Very long texts are read whole; an empty table gives no rows.
    """
    docs = same_names(docs, ("doc_id", "text"))
    arrow_batches(docs.sparkSession)
    signed = _signed(docs, size)
    several = signed.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min(F.xxhash64("same")).alias("_lo"), F.max(F.xxhash64("same")).alias("_hi")).where("_lo < _hi")
    if several.isEmpty():
        return _groups(docs, signed, size, share)
    rows = numbered(docs, "near")
    by_row = rows.select(F.col(ROW).alias("doc_id"), "text")
    found = stored(_groups(by_row, _signed(by_row, size), size, share).join(
        rows.select(F.col(ROW).alias("_row"), F.col("doc_id").alias("_doc")), F.col("doc_id") == F.col("_row")), "by-row")
    ids = found.where("n_shingles > 0 and _doc is not null").select("_doc", "component_id")
    spread = ids.groupBy("_doc").agg(F.min("component_id").alias("_lo"), F.max("component_id").alias("_hi")).where("_lo < _hi")
    over = components(ids.join(spread.select(F.col("_doc").alias("_of"), "_lo"), F.col("_doc") == F.col("_of")).select(
        F.col("component_id").alias("a"), F.col("_lo").alias("b")).distinct())
    least = ids.join(over, F.col("component_id") == F.col("node"), "left").select(
        "_doc", "component_id", F.coalesce("label", "component_id").alias("_group"))
    names = least.groupBy("_group").agg(F.min("_doc").alias("_least"))
    named = stored(least.select("component_id", "_group").distinct().join(names, "_group").select(
        F.col("component_id").alias("_component"), "_least"), "names")
    own = F.when(F.col("n_shingles") > 0, F.col("_least"))
    found = found.join(named, F.col("component_id") == F.col("_component"), "left").select(
        F.col("_doc").alias("doc_id"), "n_shingles", F.when(F.col("_doc").isNotNull(), F.coalesce(own, "_doc")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    return stored(docs.mapInArrow(_sign(size), "doc_id long, n long, same binary, signature binary"), "signed")


def _groups(docs: DataFrame, signed: DataFrame, size: int, share: int) -> DataFrame:
    """The rows of ``near_groups`` where each id has one set of shingles."""
    classes = stored(signed.where("n > 0 and doc_id is not null").groupBy("n", "same").agg(
        F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature")), "classes")

    # Two different sets overlap by share / 100 only if their union is large enough.
    least = -(-share // (100 - share)) if share < 100 else 2**62
    able = classes.where(F.col("n") >= least).select("doc_id", "signature")
    indexed = able.mapInArrow(_explode_keys, "key long, id long")
    shared = indexed.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    buckets = stored(indexed.join(shared.drop("_n"), "key"), "buckets")

    tried = stored(buckets.where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct(), "tried")
    links = confirmed(tried, classes, docs, size, share)
    if not links.isEmpty():
        labels = components(links)
        buckets = buckets.join(labels, F.col("id") == F.col("node"), "left").select(
            "key", "id", F.coalesce("label", "id").alias("label"))
    else:
        buckets = buckets.select("key", "id", F.col("id").alias("label"))
    rest = _across(stored(buckets, "named"), classes, docs, size, share)
    links = links.union(rest)

    found = signed.select("doc_id", "n", "same")
    if links.isEmpty():
        named = classes.select(F.col("n").alias("_n"), F.col("same").alias("_same"), F.col("doc_id").alias("label"))
    else:
        labels = components(links)
        named = classes.join(labels, F.col("doc_id") == F.col("node"), "left").select(
            F.col("n").alias("_n"), F.col("same").alias("_same"), F.coalesce("label", "doc_id").alias("label"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return found.join(stored(named, "names"), (F.col("n") == F.col("_n")) & (F.col("same") == F.col("_same")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest
    doc_id (nulls last; of equal ids any one). All their columns as they were."""
    rows = numbered(docs, "near")
    arrow_batches(docs.sparkSession)
    by_row = rows.select(F.col(ROW).alias("doc_id"), "text")
    named = _groups(by_row, _signed(by_row, size), size, share).where("n_shingles > 0")
    ids = rows.select(F.col(ROW).alias("_row"), F.col("doc_id").alias("_doc"))
    members = stored(named.select("doc_id", "component_id").join(ids, F.col("doc_id") == F.col("_row")).select(
        "_row", "component_id", F.struct(F.col("_doc").isNull(), "_doc", "_row").alias("_rank")), "members")
    first = members.groupBy("component_id").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    gone = members.join(stored(first, "first"), "component_id").where("_rank._row <> _first._row").select("_row")
    return without(rows, gone)
