"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import ROW, ascii_lower, maybe_member, member_bitmap, numbered, stored, without

PREFIX = 256  # characters of the second refinement


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the
    largest id stays. Three scans with built-in functions only:

    1. lengths are counted; only lengths that occur twice go on;
    2. of those, (length, hash of the first PREFIX characters) are counted;
    3. rows that may share both get SHA-256 of the whole normalised text, and rows with
       the same digest are a group.

    What survives a step reaches the next scan as a bitmap of fixed size. A false positive
    only costs a hash. Texts never move: what is shuffled is counts and (id, digest).

    Null text counts as empty. Repeated rows, also with equal ids, are members like others;
    ``kept`` is true for exactly one row of each group. A null id is smaller than any other.
    ``text_sha256`` is null where no full hash was needed, unless ``digest`` asks for all.
    An empty table gives no rows. Other columns of ``docs`` are not touched.
    """
    rows = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    sized = rows.withColumn("_length", F.octet_length("_text"))

    lengths = sized.groupBy("_length").count().where("count > 1")
    by_length = member_bitmap(lengths, "_length")

    prefix = F.xxhash64(ascii_lower(F.substring("_text", 1, PREFIX)))
    same_length = maybe_member(sized, by_length, "_length").where("_maybe").drop("_maybe")
    heads = same_length.groupBy("_length", prefix.alias("_prefix")).count().where("count > 1")
    by_prefix = member_bitmap(heads, "_length", "_prefix")

    full = F.sha2(ascii_lower(F.col("_text")), 256)
    marked = maybe_member(sized.withColumn("_prefix", prefix), by_prefix, "_length", "_prefix")
    hashed = stored(marked.select(
        "doc_id", F.monotonically_increasing_id().alias("_row"), "_maybe",
        (full if digest else F.when(F.col("_maybe"), full)).alias("text_sha256")), "exact")

    # Stored, so that the join below has a shuffle of its own, of which Spark splits a hot digest.
    groups = stored(hashed.where("_maybe").groupBy(F.col("text_sha256").alias("_sha")).agg(
        F.max(F.struct("doc_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "groups")
    # A row outside any group joins on nothing; its own digest, or row number, spreads it.
    key = F.when(F.col("_maybe"), F.col("text_sha256")).otherwise(F.col("_row").cast("string"))
    return (
        hashed.withColumn("_key", key)
        .join(groups, F.col("_key") == F.col("_sha"), "left")
        .select(
            "doc_id",
            F.when(F.col("_keep").isNull(), F.col("doc_id")).otherwise(F.col("_keep.doc_id")).alias("keep_id"),
            F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("_keep._row") == F.col("_row"), F.lit(True)).alias("kept"),
            "text_sha256", "_row",
        )
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row with a larger doc_id repeats; all
    their columns as they were."""
    rows = numbered(docs, "exact")
    groups = exact_groups(rows.select(F.struct("doc_id", ROW).alias("doc_id"), "text"))
    return without(rows, groups.where(~F.col("kept")).select(f"doc_id.{ROW}"))
