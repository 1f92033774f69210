"""CSV sources: permissive text staging and the lenient by-name reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clean import squeeze
from ..schemas import STAGING, text_schema

# Unquoted empty cells become NULL and quoted ones the empty string. That needs a null
# marker that no file carries; quotes are escaped by doubling them.
READ_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "\u0001",
}


POSITION = "source_position"


def _position() -> Column:
    """File, block and row: orders rows as in the file without a global sort."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(POSITION)


def read_raw(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | str,
    position: bool = False,
    multi_line: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Every row of a raw CSV as text, plus ``loaded_at``.

    A row with missing cells is padded with NULL and one with surplus cells loses them;
    ``malformed_rows`` reports both as they stand in the file, and ``strict`` stops there.

    ``columns`` is a list or the name of a staging table. The schema is declared and
    checked against the header, never inferred, so files split freely over tasks;
    ``multi_line`` allows line breaks inside quotes but reads each file in one task.
    ``position`` adds the place of the row in its file.
    """
    names = STAGING[columns] if isinstance(columns, str) else list(columns)
    df = (
        spark.read.schema(text_schema(names))
        .options(**{**READ_OPTIONS, "mode": "FAILFAST" if strict else "PERMISSIVE"}, enforceSchema="false",
                 columnPruning="false", multiLine=str(multi_line).lower())
        .csv(path)
    )
    place = [_position()] if position else []
    return df.select(*names, *place, F.current_timestamp().alias("loaded_at"))


def malformed_rows(spark: SparkSession, path: str, columns: Sequence[str] | str, multi_line: bool = False,
                   header: bool = True) -> DataFrame:
    """Rows whose number of cells differs from the header's: DF[source_position, record, loaded_at].

    All cells are parsed (no column pruning), since that is what shows the fault."""
    names = STAGING[columns] if isinstance(columns, str) else list(columns)
    schema = text_schema(names).add("_record", "string")
    df = (
        spark.read.schema(schema)
        .options(**{**READ_OPTIONS, "header": str(header).lower()}, enforceSchema="true", columnPruning="false",
                 columnNameOfCorruptRecord="_record",
                 multiLine=str(multi_line).lower())
        .csv(path)
    )
    # Spark refuses a plan that reads nothing but the corrupt record; the first cell goes along.
    kept = df.where(F.col("_record").isNotNull() & (F.col(f"`{names[0]}`").isNotNull() | F.col(f"`{names[0]}`").isNull()))
    return kept.select(_position(), F.col("_record").alias("record"), F.current_timestamp().alias("loaded_at"))


def read_lenient(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """All columns by header name; cells and header trimmed, short rows padded with
    empty text, surplus cells dropped."""
    df = spark.read.options(**READ_OPTIONS, ignoreLeadingWhiteSpace="true").csv(path)
    place = [_position()] if position else []
    return df.select(*[
        F.coalesce(squeeze(F.col(f"`{c}`")), F.lit("")).alias(c.strip()) for c in df.columns
    ], *place)
