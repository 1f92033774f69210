"""The given star-schema tables seen as ledger tables.

Staging frames are all text, with faults set by the remainder of the key; typed frames
have core columns. The oracle states the same rules in SQL (``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import core


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


TYPE = """case substring(o_orderpriority, 1, 1)
    when '1' then 'PAY' when '2' then 'TRF' when '3' then 'WIT' when '4' then 'BIL' else 'DEP' end"""


# -- staging ------------------------------------------------------------------------------

def staged_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr(
        "*", "o_orderkey as k", "string(o_orderkey) as key", "string(o_custkey) as cust",
        "cast(o_totalprice as decimal(14,2)) as price", "string(date(o_orderdate)) as day",
        "concat(lpad(string(o_orderkey % 24), 2, '0'), ':00:00') as clock")
    return rows.selectExpr(
        "key as id",
        "concat('TX', if(k % 500 = 3, string(k - 1), key)) as reference",
        "concat('k', if(k % 10 = 1, string(k - 1), key)) as idempotency_key",
        f"{TYPE} as transaction_type",
        "concat(if(k % 97 = 0, '-', ''), string(price)) as amount",
        "if(k % 20 = 0, '', if(k % 701 = 7, '-1.00', concat(string(k % 5), '.00'))) as fee",
        "concat(if(k % 97 = 0, '-', ''), string(price)) as total_amount",
        "if(k % 20 = 0, '', if(k % 703 = 9, 'EUR', 'MRU')) as currency",
        "if(k % 37 = 0, '', if(k % 31 = 0, string(o_custkey + 100000000), cust)) as source_account_id",
        "if(k % 41 = 0, '', cust) as destination_account_id",
        "if(k % 43 = 0, '', string(k % 7)) as merchant_id",
        "if(k % 601 = 5, 'abc', if(k % 4 <> 0, '', string(k % 10))) as agency_id",
        "case o_orderstatus when 'O' then 'SUCCESS' when 'F' then 'FAILED' else 'PENDING' end as status",
        "if(o_orderstatus = 'F' and k % 2 = 0, 'INSUFFICIENT_FUNDS', '') as failure_reason",
        "'600000.00' as balance_before",
        """case when k % 89 = 0 then '-1.00' when o_orderstatus = 'O' then string(600000 - price)
           when k % 53 = 0 then '599999.00' else '600000.00' end as balance_after""",
        "concat('N', string(k % 5)) as node_id",
        "concat('N', string(k * 3 % 5)) as processing_node",
        "key as sequence_number",
        "if(k % 2 = 0, 'APP', 'USSD') as channel",
        "day as transaction_date",
        "clock as transaction_time",
        "concat(day, 'T', clock, '.000Z') as created_at",
        """case when k % 3 = 1 then '' when k % 101 = 0 then concat(day, 'T00:00:00.000Z')
           else concat(day, 'T23:59:59.000Z') end as completed_at""",
    )


def staged_with_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """The staged transactions, some of them a second time under another id: exact repeats
    of an idempotency key, which are no conflict."""
    rows = staged_transactions(spark, sf)
    again = rows.where("cast(id as bigint) % 50 = 22").withColumn(
        "id", F.expr("string(cast(id as bigint) + 500000000)"))
    return rows.unionByName(again)


def staged_users(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").selectExpr("*", "c_custkey as k", "string(c_custkey) as key")
    return rows.selectExpr(
        "key as id",
        "if(c_acctbal < 0, concat('XX', lpad(key, 8, '0')), lpad(key, 10, '0')) as nni",
        "concat('+222', lpad(if(k % 25 = 1, string(k - 1), key), 8, '0')) as phone",
        "c_name as full_name",
        "if(k % 2 = 0, 'F', 'M') as gender",
        "concat('1990-01-', lpad(string(k % 28 + 1), 2, '0')) as birth_date",
        "if(k % 5 < 3, '', concat('u', key, '@example.org')) as email",
        "string(c_nationkey) as wilaya_id",
        "if(k % 30 = 2, 'elsewhere', concat('NATION_', string(c_nationkey))) as wilaya_name",
        "if(k % 10 = 9, 'BLOCKED', 'ACTIVE') as status",
        "'2020-02-01' as registration_date",
        "'2020-02-01T08:00:00.000Z' as created_at",
        "'' as updated_at",
    )


def staged_accounts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").selectExpr(
        "*", "c_custkey as k", "string(c_custkey) as key", "cast(c_acctbal as decimal(14,2)) as money")
    return rows.selectExpr(
        "key as id",
        "key as user_id",
        "concat('ACC', lpad(key, 9, '0')) as account_number",
        "if(c_mktsegment = 'BUILDING', 'CORPORATE', 'WALLET') as account_type",
        "if(k % 9 = 0, '', 'MRU') as currency",
        "string(money) as balance",
        "string(cast(money + k % 7 * 1000 as decimal(14,2))) as available_balance",
        "'50000.00' as daily_limit",
        "'500000.00' as monthly_limit",
        "if(k % 4 = 3, 'FROZEN', 'ACTIVE') as status",
        "case k % 3 when 0 then 'true' when 1 then 'false' else 'yes' end as is_primary",
        "concat('2020-01-', lpad(string(k % 28 + 1), 2, '0')) as opened_date",
        "'' as last_activity",
        "'2020-01-01T00:00:00.000Z' as created_at",
        "'' as updated_at",
    )


def staged_merchants(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr("*", "p_partkey as k", "string(p_partkey) as key")
    return rows.selectExpr(
        "key as id",
        "if(k % 50 = 13, '', concat('MRC', lpad(key, 9, '0'))) as code",
        "concat(if(k % 2 = 0, 'undefined ', ''), p_name) as name",
        "p_type as category_code",
        "string(p_size % 25) as wilaya_id",
        "if(k % 11 = 0, 'INACTIVE', 'ACTIVE') as status",
        "'2021-06-06T15:25:48.000Z' as created_at",
    )


def staged_agencies(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").selectExpr("*", "s_suppkey as k", "string(s_suppkey) as key")
    return rows.selectExpr(
        "key as id",
        "if(k % 20 = 13, '', concat('AG', lpad(key, 6, '0'))) as code",
        "s_name as name",
        "string(s_nationkey) as wilaya_id",
        "if(k % 9 = 0, '', string(cast(s_acctbal as decimal(14,2)))) as float_balance",
        "case k % 3 when 0 then 'BRONZE' when 1 then 'SILVER' else 'GOLD' end as tier",
        "concat('LIC-', lpad(key, 6, '0')) as license_number",
        "'ACTIVE' as status",
        "'2020-06-24T08:28:57.000Z' as created_at",
    )


def staged_wilayas(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "string(n_nationkey) as id",
        "concat('W', lpad(string(n_nationkey), 2, '0')) as code",
        "n_name as name",
        "r_name as capital",
        "'' as latitude",
        "'' as longitude",
        "string(n_nationkey * 1000) as population",
        "'0.5' as economic_weight",
    )


def staged_tx_types(spark: SparkSession, sf: str) -> DataFrame:
    codes = table(spark, sf, "orders").groupBy(F.expr(TYPE).alias("code")).agg(
        F.min("o_orderkey").alias("first"))
    return codes.selectExpr(
        "string(first) as id", "code", "lower(code) as label", "'' as description",
        "string(code = 'TRF') as requires_destination",
        "string(code = 'PAY') as requires_merchant",
        "string(code in ('DEP', 'WIT')) as requires_agency",
        "if(code = 'DEP', 'true', '') as is_credit",
    )


def staged_categories(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(14,2)")
    types = table(spark, sf, "part").groupBy(F.col("p_type").alias("code")).agg(
        F.min("p_partkey").alias("first"), F.min(price).alias("lo"), F.max(price).alias("hi"))
    return types.selectExpr(
        "string(first) as id", "code", "concat('0', string(first + 500)) as mcc",
        "lower(code) as label", "'' as description", "string(lo) as avg_min", "string(hi) as avg_max",
    )


# -- core and lookups -----------------------------------------------------------------------

def users(spark, sf):
    return core.core_users(staged_users(spark, sf))


def accounts(spark, sf):
    return core.core_accounts(staged_accounts(spark, sf), users(spark, sf))


def merchants(spark, sf):
    return core.core_merchants(staged_merchants(spark, sf), repair=False)


def agencies(spark, sf):
    return core.core_agencies(staged_agencies(spark, sf))


def wilayas(spark, sf):
    return core.load_lookup(staged_wilayas(spark, sf), "wilayas")


def tx_types(spark, sf):
    return core.load_lookup(staged_tx_types(spark, sf), "tx_types")


def categories(spark, sf):
    return core.load_lookup(staged_categories(spark, sf), "categories")


# -- typed transactions: all rows, whatever their route ------------------------------------------

def payments(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as typed transactions between accounts."""
    return core.cast_transactions(staged_transactions(spark, sf))


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as typed purchases at merchants (parts) through agencies (suppliers)."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "*", "l_orderkey * 8 + l_linenumber as id", "l_linenumber as n",
        "cast(l_extendedprice as decimal(14,2)) as amount", "cast(l_quantity as decimal(14,2)) as fee",
        "case l_returnflag when 'A' then 'SUCCESS' when 'N' then 'FAILED' else 'PENDING' end as status",
        "cast(2000000 as decimal(14,2)) as balance_before")
    return rows.selectExpr(
        "id",
        "concat('LI', string(id)) as reference",
        "concat(string(l_orderkey), '-', string(n)) as idempotency_key",
        "'PAY' as transaction_type",
        "amount",
        "fee",
        "l_partkey as merchant_id",
        "l_suppkey as agency_id",
        "status",
        "balance_before",
        """cast(case when status = 'SUCCESS'
                then balance_before - amount - fee + case n when 7 then 5 when 6 then 1 else 0 end
                when n = 3 then balance_before - n else balance_before end as decimal(14,2)) as balance_after""",
        "date(l_shipdate) as transaction_date",
    )


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """Events as typed transactions with a time of day."""
    return table(spark, sf, "events").selectExpr(
        "event_id as id",
        "concat(string(user_id), '-', string(event_id div 3)) as idempotency_key",
        "user_id as source_account_id",
        "cast(value as decimal(14,2)) as amount",
        "if(event_type = 'error', 'FAILED', 'SUCCESS') as status",
        "ts as created_at",
        "date(ts) as transaction_date",
        "date_format(ts, 'HH:mm:ss') as transaction_time",
    )


def items_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as staged transactions: the natural repeats of (order, line) are the
    conflicting idempotency keys."""
    return table(spark, sf, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id",
        "concat('LI', string(l_orderkey)) as reference",
        "concat_ws('-', l_orderkey, l_linenumber) as idempotency_key",
        "string(cast(l_extendedprice as decimal(14,2))) as amount",
        "l_returnflag as status",
        "string(l_partkey) as source_account_id",
        "string(l_suppkey) as destination_account_id",
    )
