"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerguard.session import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BITMAP_BITS = 1 << 22     # size of a member bitmap: 512 KB, whatever the input
BUCKET_BITS = 32_768      # fixed by bitmap_construct_agg
ARROW_BYTES = 8 << 20     # most bytes in an Arrow batch, unless one row is larger


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on pure ASCII and is much faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back; cuts the lineage."""
    return written(df, f"llm-{name}")


ROW = "__llm_row"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows stored with a number of their own, so that repeated rows and null or equal
    ids are told apart."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), f"{name}-rows")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Numbered rows without those whose number is in ``gone`` (one column); the columns
    come back as they were."""
    gone = stored(gone.select(F.col(gone.columns[0]).alias("__llm_gone")), "gone")
    return rows.join(gone, F.col(ROW) == F.col("__llm_gone"), "left_anti").drop(ROW)


def same_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only these columns, so that extra columns of a table cannot clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def member_bitmap(keys: DataFrame, *columns: str) -> DataFrame:
    """A bitmap of BITMAP_BITS bits over the hashes of some key columns, as at most
    BITMAP_BITS / BUCKET_BITS rows (bucket, bits); bounded, so safe to broadcast."""
    at = F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS))
    return (
        keys.select(at.alias("_at"))
        .groupBy(F.expr(f"_at div {BUCKET_BITS}").alias("_bucket"))
        .agg(F.expr(f"bitmap_construct_agg(_at % {BUCKET_BITS})").alias("_bits"))
    )


def maybe_member(df: DataFrame, bitmap: DataFrame, *columns: str) -> DataFrame:
    """Adds ``_maybe``: false only if the key is surely not among those of the bitmap."""
    at = F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS))
    bit = F.expr(
        f"shiftright(cast(conv(hex(substring(_bits, cast((_at % {BUCKET_BITS}) div 8 as int) + 1, 1)), 16, 10) as int),"
        " cast(_at % 8 as int)) & 1 = 1")
    return (
        df.withColumn("_at", at)
        .join(F.broadcast(bitmap.withColumnRenamed("_bucket", "_bucket_")),
              F.expr(f"_at div {BUCKET_BITS}") == F.col("_bucket_"), "left")
        .withColumn("_maybe", F.coalesce(bit, F.lit(False)))
        .drop("_at", "_bits", "_bucket_")
    )


def quota(counts: Sequence[int], most: int) -> float:
    """Rows that each group may have at most, so that all together have ``most``."""
    left = most
    for i, n in enumerate(ordered := sorted(counts)):
        if n * (len(ordered) - i) >= left:
            return left / (len(ordered) - i)
        left -= n
    return float(max(counts))
