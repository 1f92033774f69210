"""Typed core tables and lookups from text staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.clean import (
    NNI, PHONE, clean_cast, clean_or, empty_to_null, fix_prefix, lookup, matches, present, to_bool,
)
from ..schemas import BAD_PREFIX, CATEGORY_PREFIX, CORE_TYPES, CURRENCY, LOOKUP_TYPES
from .quarantine import exclude
from .skew import lookup_join


def first_wins(df: DataFrame, key: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key, the first by an explicit order, never by physical order.

    ``order`` defaults to the position kept at ingest, else to all columns. Spark keeps
    one row per key and task before the shuffle, so a hot key stays small.
    """
    if order is None:
        order = ["source_position"] if "source_position" in df.columns else [
            c for c in df.columns if c != key]
    rank = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def typed(table: str, types: dict[str, str], strict: bool = False, **special: Column) -> list[Column]:
    """The cast of each column of a table; ``special`` replaces single columns."""
    out = []
    for name, dtype in types.items():
        if name in special:
            value = special[name]
        elif dtype == "string":
            value = empty_to_null(name)
        else:
            value = clean_cast(name, dtype, strict)
        out.append(value.alias(name))
    return out


def _position(df: DataFrame) -> list[str]:
    return ["source_position"] if "source_position" in df.columns else []


def _cast(df: DataFrame, table: str, strict: bool, **special: Column) -> DataFrame:
    rows = df.select(*typed(table, CORE_TYPES[table], strict, **special), *_position(df))
    return rows.where(F.col("id").isNotNull())


def _first_per_id(rows: DataFrame) -> DataFrame:
    return first_wins(rows, "id").drop("source_position")


def core_users(users: DataFrame, strict: bool = False) -> DataFrame:
    """Users with an id, a well-formed identity number and phone, and a region."""
    kept = users.where(
        present("id") & matches("nni", NNI) & matches("phone", PHONE) & present("wilaya_id"))
    return _first_per_id(_cast(kept, "users", strict, nni=F.col("nni"), phone=F.col("phone")))


def core_accounts(accounts: DataFrame, users: DataFrame, strict: bool = False) -> DataFrame:
    """Accounts of users that reached core."""
    kept = accounts.where(present("id") & present("user_id") & present("account_number"))
    rows = _cast(
        kept, "accounts", strict,
        account_number=F.col("account_number"),
        account_type=F.col("account_type"),
        status=F.col("status"),
        currency=clean_or("currency", CURRENCY),
        is_primary=to_bool("is_primary"),
    )
    owners = users.select(F.col("id").alias("owner_id")).distinct()
    return _first_per_id(lookup_join(rows, owners, "user_id", "owner_id", "left_semi"))


def core_merchants(merchants: DataFrame, strict: bool = False, repair: bool = True) -> DataFrame:
    """Merchants with code, category and region; bad name prefixes repaired on the way."""
    kept = merchants.where(
        present("id") & present("code") & present("category_code") & present("wilaya_id"))
    name = empty_to_null("name")
    if repair:
        name = fix_prefix(name, lookup("category_code", CATEGORY_PREFIX), BAD_PREFIX)
    return _first_per_id(_cast(
        kept, "merchants", strict, code=F.col("code"), category_code=F.col("category_code"),
        name=name, updated_at=clean_cast("created_at", "timestamp_ntz", strict)))


def repair_names(
    df: DataFrame, name: str, key: str, prefixes: DataFrame, bad: str
) -> DataFrame:
    """Rewrite a bad prefix through a lookup table DF[key, prefix] of one row per key."""
    side = prefixes.select(F.col("key").alias("_prefix_key"), F.col("prefix").alias("_prefix"))
    joined = lookup_join(df, side, key, "_prefix_key")
    return joined.withColumn(name, fix_prefix(name, F.col("_prefix"), bad)).drop("_prefix_key", "_prefix")


def core_agencies(agencies: DataFrame, strict: bool = False) -> DataFrame:
    kept = agencies.where(present("id") & present("code") & present("wilaya_id"))
    return _first_per_id(_cast(
        kept, "agencies", strict, code=F.col("code"),
        updated_at=clean_cast("created_at", "timestamp_ntz", strict)))


def cast_transactions(tx: DataFrame, strict: bool = False) -> DataFrame:
    """Staged transactions with core types; no row is dropped."""
    types = {c: t for c, t in CORE_TYPES["transactions"].items() if c in tx.columns}
    special = {c: F.col(c) for c in ("reference", "idempotency_key", "transaction_type", "status")}
    if "currency" in types:
        special["currency"] = clean_or("currency", CURRENCY)
    if "fee" in types:
        special["fee"] = F.coalesce(
            clean_cast("fee", types["fee"], strict), F.lit(0).cast(types["fee"]))
    return tx.select(*typed("transactions", types, strict, **special), *_position(tx))


def core_transactions(
    tx: DataFrame, *issues: DataFrame, strict: bool = False, drop_repeats: bool = True,
    unique_ids: bool = False,
) -> DataFrame:
    """Transactions in no issue table, cast, first row per id.

    The issue tables become one distinct set of ids and one anti join. Exact repeats of
    an idempotency key are no conflict; the first stays, because keys are unique in core,
    and ``repeated_transactions`` reports the rest. ``drop_repeats=False`` keeps them all. ``unique_ids`` says that no id is
    repeated (see ``has_repeats``) and saves the shuffle of the wide rows.
    """
    kept = exclude(tx, *issues, id="id")
    return _finish(cast_transactions(kept, strict), drop_repeats, unique_ids)


def core_from_route(
    routed: DataFrame, strict: bool = False, drop_repeats: bool = True, unique_ids: bool = False
) -> DataFrame:
    """The same table from routed rows, without stored issue tables."""
    return _finish(
        cast_transactions(routed.where(F.col("route") == "CORE"), strict), drop_repeats, unique_ids)


def has_repeats(tx: DataFrame, key: str = "id") -> bool:
    """Does a typed key occur twice? Counts the key column alone, which is far less to
    shuffle than the rows, and stops at the first repeat."""
    keys = tx.select(clean_cast(key, CORE_TYPES["transactions"][key]).alias("k")).where("k is not null")
    return not keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def own_key() -> Column:
    """The idempotency key; rows without one stand for themselves."""
    return F.when(present("idempotency_key"), F.concat(F.lit("k"), F.col("idempotency_key"))).otherwise(
        F.concat(F.lit("i"), F.col("id").cast("string")))


def repeated_transactions(rows: DataFrame) -> DataFrame:
    """What ``drop_repeats`` leaves out: DF[staging_transaction_id, idempotency_key, first_id].

    ``rows`` are those that reach core, repeats included. The first of a key is found by
    aggregation, so a hot key costs one row per task."""
    order = F.struct(*(_position(rows) or ["id"]))
    keyed = rows.where(F.col("id").isNotNull()).withColumn("_own", own_key()).withColumn("_order", order)
    firsts = keyed.groupBy("_own").agg(
        F.min("_order").alias("_first"), F.min_by("id", "_order").alias("first_id"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1")
    return keyed.join(firsts, "_own").where(F.col("_order") != F.col("_first")).select(
        F.col("id").cast("string").alias("staging_transaction_id"), "idempotency_key", "first_id")


def first_of_keys(tx: DataFrame) -> DataFrame:
    """Which staged rows ``drop_repeats`` leaves, where no typed id is repeated: DF[id, own_key], ``id``
    as it is staged. Only ids, keys and positions are shuffled, not the rows."""
    named = tx.select(F.col("id").alias("_staged"), clean_cast("id", CORE_TYPES["transactions"]["id"]).alias("id"),
                      "idempotency_key", *_position(tx)).where(F.col("id").isNotNull())
    firsts = first_wins(named.withColumn("own_key", own_key()), "own_key", _position(tx) or ["id"])
    return firsts.select(F.col("_staged").alias("id"), "own_key")


def _finish(rows: DataFrame, drop_repeats: bool, unique_ids: bool) -> DataFrame:
    rows = rows.where(F.col("id").isNotNull())
    if not unique_ids:
        rows = first_wins(rows, "id", _position(rows) or ["created_at", "reference", "idempotency_key", "amount", "status"])
    if drop_repeats:
        order = _position(rows) or ["id"]
        rows = first_wins(rows.withColumn("_own", own_key()), "_own", order).drop("_own")
    return rows.drop("source_position")


# -- lookups --------------------------------------------------------------------------

def load_lookup(raw: DataFrame, table: str, key: str = "id", strict: bool = True) -> DataFrame:
    """A typed lookup. A repeated key fails the job: broken staging must be seen.

    A category's merchant code goes through integer, so leading zeros vanish.
    """
    types = LOOKUP_TYPES[table]
    texts = {c: F.col(c) for c, t in types.items() if t == "string"}
    if "mcc" in types:
        texts["mcc"] = clean_cast("mcc", "int", strict).cast("string")
    rows = raw.select(*typed(table, types, strict, **texts))
    return assert_unique(rows, key, table)


def assert_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """The frame itself; running it raises if a key occurs twice."""
    message = F.concat(F.lit(f"{name}: duplicate {key} "), F.col(key).cast("string"))
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(
        F.when(F.col("n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(False)))
    return df.unionByName(repeated.select(*[
        F.col(f.name) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ]))


def assert_count(df: DataFrame, expected: int, name: str = "table") -> DataFrame:
    """Raise unless the frame has exactly the expected rows; counts at most one more."""
    rows = df.limit(expected + 1).count()
    if rows != expected:
        more = "more" if rows > expected else str(rows)
        raise AssertionError(f"{name} has {more} rows, expected {expected}")
    return df
