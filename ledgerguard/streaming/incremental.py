"""Incremental ingest on Structured Streaming.

Tables grow by one folder per micro-batch, ``batch_id=<n>``, written in overwrite mode: a
batch that runs again after a lost driver or executor replaces its own output, so every
row lands once. The streams' own checkpoints stand for the high-water mark.

What a sink must know of the past lies in an index in hash buckets beside its table
(``sources/buckets.py``): a batch reads and writes the buckets of its own keys, never
history, and drops its intermediate tables when it ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..functions.clean import present
from ..operators.anomalies import PAYLOAD, conflict_keys
from ..operators.skew import flag, lookup_join
from ..session import passing
from ..sources.buckets import Buckets


# -- the high-water mark -------------------------------------------------------------------

def newer_than(df: DataFrame, at: str, mark) -> DataFrame:
    """Batch form: rows after the stored mark; all rows while there is none."""
    return df if mark is None else df.where(F.col(at) > F.lit(mark))


def high_water_mark(df: DataFrame, at: str) -> DataFrame:
    return df.agg(F.max(at).alias("last_processed_at"))


def stream_of(
    spark: SparkSession, path: str, schema, at: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet folder as a stream. The checkpoint remembers which files were read.
    ``at`` becomes a zoned timestamp, which watermarks need."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.parquet(path)
    return df.withColumn(at, F.col(at).cast("timestamp")) if at else df


def drain(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what is there in micro-batches, then stop."""
    query = (
        df.writeStream.foreachBatch(sink).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink whose output of a batch is the same however often the batch runs."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


DAY = "_day"


def write_batch(rows: DataFrame, path: str, batch_id: int, day: str | None = None) -> None:
    """One folder per batch; with ``day``, its rows are also split by day, so that readers
    with a horizon open the folders of those days only."""
    out = rows.withColumn(DAY, F.col(day).cast("date")) if day else rows
    out.write.mode("overwrite").partitionBy(*([DAY] if day else [])).parquet(f"{path}/batch_id={batch_id}")


def stored(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, since=None
) -> DataFrame:
    """A table written in batches, optionally only the batches before one, and only the
    days from one on; empty at first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    fields = [*schema.fields, T.StructField("batch_id", T.LongType())]
    if since is not None:
        fields.append(T.StructField(DAY, T.DateType()))
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    if before is not None:
        df = df.where(F.col("batch_id") < before)
    if since is not None:
        df = df.where(F.col(DAY) >= F.lit(since).cast("date"))
    return df.select(*[f.name for f in schema.fields])


def _schema(df: DataFrame) -> T.StructType:
    return T.StructType(list(df.schema.fields))


def horizon_start(batch: DataFrame, day: str | None, horizon_days: int | None):
    """First day that a sink looks back to, or None for all of history."""
    if day is None or horizon_days is None:
        return None
    return batch.agg(F.date_sub(F.min(F.col(day).cast("date")), horizon_days)).first()[0]


INDEX = "_index"     # readers of the table's folder pass over it
BUCKETS = 64


def key_index(batch: DataFrame, path: str, key: str, *columns: str | None) -> Buckets:
    """The index beside a table: its keys, with some more columns of the rows."""
    kept = [key, *[c for c in columns if c and c != key]]
    return Buckets(batch.sparkSession, f"{path}/{INDEX}", key, T.StructType([batch.schema[c] for c in kept]), BUCKETS)


def _seen(index: Buckets, keys: DataFrame, batch_id: int, day: str | None, since) -> DataFrame:
    """The keys among those of a batch that the index holds from a day on: DF[_seen]."""
    found = index.find(keys, "_key", batch_id)
    if since is not None:
        found = found.where(F.col(day).cast("date") >= F.lit(since).cast("date"))
    return found.select(F.col(index.key).alias("_seen")).distinct()


def _batch_keys(batch: DataFrame, key: str) -> DataFrame:
    return batch.where(_keyed(key)).select(F.col(key).alias("_key")).distinct()


def _keyed(key: str) -> Column:
    return present(F.col(key).cast("string"))


# -- never insert twice -----------------------------------------------------------------------

def first_of_batch(batch: DataFrame, key: str, order) -> DataFrame:
    """The first row of every key. Rows without a key (NULL or blank) are no repeats of one
    another and all stay."""
    rank = Window.partitionBy(key).orderBy(*order)
    firsts = batch.where(_keyed(key)).withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")
    return firsts.unionByName(batch.where(~F.coalesce(_keyed(key), F.lit(False))))


def insert_new(path: str, key: str, order, day: str | None = None, horizon_days: int | None = None):
    """Sink: ON CONFLICT (key) DO NOTHING against earlier batches, within a horizon if one
    is given. Of the past only the index buckets of the batch's keys are read. Rows without
    a key are always inserted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        index = key_index(batch, path, key, day)
        with passing(batch.sparkSession) as keep:
            keys = keep(_batch_keys(batch, key), "keys")
            seen = _seen(index, keys, batch_id, day, horizon_start(batch, day, horizon_days))
            fresh = keep(lookup_join(first_of_batch(batch, key, order), seen, key, "_seen", "left_anti"), "fresh")
            write_batch(fresh, path, batch_id, day)
            index.append(fresh.where(_keyed(key)), batch_id)
    return write


def unique_within(df: DataFrame, key: str, at: str, horizon: str = "1 day") -> DataFrame:
    """Stream form: the first row of a key within a horizon, in bounded state. Rows without
    a key pass."""
    timed = df.withWatermark(at, horizon)
    bare = timed.where(~F.coalesce(_keyed(key), F.lit(False)))
    return timed.where(_keyed(key)).dropDuplicatesWithinWatermark([key]).unionByName(bare)


# -- accept or reject ---------------------------------------------------------------------------

def accept_or_reject(
    tests: dict[str, Column], accepted: str, rejected: str, key: str, order,
    day: str | None = None, horizon_days: int | None = None,
):
    """Sink: rows that break a rule, or repeat a key, go to the reject table with their
    reasons; the others to the accepted one. ``tests`` are true for a broken row.

    The first good row of a key wins, found by a pre-aggregated minimum over ``order``
    (unique per row); a broken row does not take the key. Rows without a key (NULL or
    blank) repeat nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        index = key_index(batch, accepted, key, day)
        with passing(batch.sparkSession) as keep:
            keys = keep(_batch_keys(batch, key), "keys")
            seen = _seen(index, keys, batch_id, day, horizon_start(batch, day, horizon_days)).withColumn("_old", F.lit(True))
            broken = F.array_compact(F.array(*[F.when(flag(t), F.lit(n)) for n, t in tests.items()]))
            position = F.struct(*order)
            rows = keep(lookup_join(batch.withColumn("_broken", broken), seen, key, "_seen"), "rows")
            good = (F.size("_broken") == 0) & F.col("_old").isNull()
            firsts = rows.where(good & _keyed(key)).groupBy(F.col(key).alias("_key")).agg(F.min(position).alias("_first"))
            judged = lookup_join(rows, firsts, key, "_key")
            repeat = F.col("_old").isNotNull() | (good & flag(position != F.col("_first")))
            judged = judged.withColumn("reasons", F.when(
                repeat, F.array_append("_broken", F.lit("duplicate_key"))).otherwise(F.col("_broken")))
            judged = keep(judged.select(*batch.columns, "reasons"), "judged")
            fine = judged.where(F.size("reasons") == 0).drop("reasons")
            write_batch(fine, accepted, batch_id, day)
            write_batch(judged.where(F.size("reasons") > 0), rejected, batch_id, day)
            index.append(fine.where(_keyed(key)), batch_id)
    return write


# -- conflicts that arrive late -----------------------------------------------------------------

def correct_conflicts(
    history: str, retractions: str, key: str = "idempotency_key", payload=PAYLOAD, id: str = "id",
    day: str | None = None, horizon_days: int | None = None,
):
    """Sink for the batch rule on a stream: all rows of a conflicting key leave core.

    Every batch is kept in ``history``. A key of the batch that conflicts, within it or
    with history, retracts all its rows so far, also those accepted earlier; core is
    history less retractions (``corrected``). The index holds key, id and payload; a batch
    reads the buckets of its keys.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, history, batch_id, day)
        index = key_index(batch, history, key, id, *payload, day)
        index.append(batch.where(_keyed(key)), batch_id)
        since = horizon_start(batch, day, horizon_days)
        with passing(batch.sparkSession) as keep:
            rows = index.find(keep(_batch_keys(batch, key), "keys"), "_key", batch_id + 1)
            if since is not None:
                rows = rows.where(F.col(day).cast("date") >= F.lit(since).cast("date"))
            affected = keep(rows, "affected")
            conflicts = conflict_keys(affected, key, payload)
            write_batch(lookup_join(affected, conflicts, key, "conflict_key", "left_semi").select(id, key), retractions, batch_id)
    return write


def corrected(rows: DataFrame, retracted: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """History without the rows of retracted keys."""
    gone = retracted.select(F.col(key).alias("_gone")).where(F.col("_gone").isNotNull()).distinct()
    return lookup_join(rows, gone, key, "_gone", "left_anti")


def held_until(df: DataFrame, key: str, at: str, horizon: str, payload=PAYLOAD, order=()) -> DataFrame:
    """Hold form: a key's rows gather in state until the watermark passes the horizon, then
    come out once with their count, verdict and first row (by ``at`` and ``order``).

    ``released`` turns those of keys without a conflict back into rows. Rows without a key
    need no holding and are left to the caller."""
    spans = [f for i, c in enumerate(payload) for f in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))]
    first = F.min_by(F.struct(*df.columns), F.struct(at, *order)).alias("first_row")
    grouped = (
        df.withWatermark(at, horizon)
        .where(_keyed(key))
        .groupBy(F.col(key), F.session_window(at, horizon).alias("held"))
        .agg(F.count(F.lit(1)).alias("rows"), first, *spans)
    )
    differ = F.lit(False)
    for i in range(len(payload)):
        differ = differ | flag(F.col(f"lo{i}") != F.col(f"hi{i}"))
    return grouped.select(
        key, F.col("held.start").alias("first_seen"), "rows", differ.alias("conflict"), "first_row")


def released(held: DataFrame) -> DataFrame:
    """The first rows of held keys without a conflict, as they came."""
    return held.where(~F.col("conflict")).select("first_row.*")


# -- running totals ---------------------------------------------------------------------------------

def running_totals(
    df: DataFrame, at: str, amount: Column, status: Column, every: str = "1 day",
    lateness: str = "1 day",
) -> DataFrame:
    """Daily or hourly totals per window, with the status breakdown."""
    ok = status == "SUCCESS"
    return (
        df.withWatermark(at, lateness)
        .groupBy(F.window(at, every).alias("w"))
        .agg(F.count(F.lit(1)).alias("total_tx"),
             F.count_if(ok).alias("success_count"),
             F.count_if(status == "FAILED").alias("failed_count"),
             F.sum(F.when(ok, amount)).alias("total_volume"))
        .select(F.col("w.start").alias("window_start"), "total_tx", "success_count",
                "failed_count", "total_volume")
    )


def upsert_into(path: str, key: str, buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """Sink for update mode: the rows that a batch changed take the place of those with their
    keys, in the buckets of these keys only. The old state stays readable until the new one
    is complete, and a batch that runs again leaves the same state. ``updated`` reads it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        Buckets(batch.sparkSession, path, key, batch.schema, buckets).upsert(batch, batch_id)
    return write


def updated(spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int = 16) -> DataFrame:
    return Buckets(spark, path, key, schema, buckets).read()


# -- serving table --------------------------------------------------------------------------------

def latest_per_user(df: DataFrame, user: str, at: str, id: str, keep: int = 50) -> DataFrame:
    """The newest rows of each user. Spark cuts to ``keep`` per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(user).orderBy(F.desc_nulls_last(at), F.desc(id)))
    return df.withColumn("recency", rank).where(F.col("recency") <= keep)


def keep_latest(path: str, user: str, at: str, id: str, keep: int = 50, buckets: int = BUCKETS):
    """Sink: the newest ``keep`` rows of every user over all batches. A batch merges its own
    newest rows into the buckets of its users; late rows take their place by time, and other
    buckets are not touched. ``latest_kept`` reads the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = Buckets(batch.sparkSession, path, user, batch.schema, buckets)
        with passing(batch.sparkSession) as store:
            new = store(latest_per_user(batch, user, at, id, keep).drop("recency"), "newest")
            touched = table.of_keys(new)
            merged = latest_per_user(table.read(touched, batch_id).unionByName(new), user, at, id, keep)
            table.replace(merged.drop("recency"), touched, batch_id)
    return write


def latest_kept(
    spark: SparkSession, path: str, schema: T.StructType, user: str, at: str, id: str, of: DataFrame | None = None,
    keep: int = 50, buckets: int = BUCKETS,
) -> DataFrame:
    """The kept rows with their recency; of some users only, if a frame names them."""
    table = Buckets(spark, path, user, schema, buckets)
    return latest_per_user(table.read() if of is None else table.find(of), user, at, id, keep)


def current_balance(df: DataFrame, user: str, at: str, balance: str, id: str) -> DataFrame:
    """Closing balance of the newest row per user, by aggregation alone."""
    return df.groupBy(user).agg(F.max_by(balance, F.struct(at, id)).alias("current_balance"))
