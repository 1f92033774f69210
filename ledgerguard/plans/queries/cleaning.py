"""Scalar cleaning: casts, defaults, predicates, dates, derived values."""

from pyspark.sql import functions as F

from ...functions import clean
from ...operators.core import repair_names
from .. import bindings as b
from ..oracle import sql
from ..registry import query


@query("p1_clean_cast", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN NULL
       ELSE CAST(c_acctbal AS DECIMAL(14,2)) END::DOUBLE AS balance,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS nation,
       CASE WHEN c_custkey % 3 = 0 THEN TRUE WHEN c_custkey % 3 = 1 THEN FALSE END AS flagged,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END AS day,
       '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 08:30:00' AS at,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || ':15:00' END AS clock
FROM customer
""")
def p1(spark, sf):
    k = F.col("c_custkey")
    raw = b.table(spark, sf, "customer").select(
        k.cast("string").alias("id"),
        F.when(k % 7 == 0, "").when(k % 11 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("c_nationkey").cast("string"))).alias("nation"),
        F.when(k % 3 == 0, "true").when(k % 3 == 1, "false").otherwise("").alias("flagged"),
        F.when(k % 13 == 0, "2024").otherwise(
            F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))).alias("day"),
        F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("T08:30:00.000Z")).alias("at"),
        F.when(k % 17 == 0, "25:00:00").otherwise(
            F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":15"))).alias("clock"),
    )
    types = {"id": "bigint", "balance": "decimal(14,2)", "nation": "int", "flagged": "boolean",
             "day": "date", "at": "timestamp_ntz", "clock": "time"}
    return raw.select(*[clean.clean_cast(c, t).alias(c) for c, t in types.items()])


@query("p2_clean_or_default", sql("""
SELECT id, COALESCE(NULLIF(currency, ''), 'MRU') AS currency,
       CAST(COALESCE(CAST(NULLIF(fee, '') AS DECIMAL(14,2)), 0) AS DOUBLE) AS fee FROM ledger
"""))
def p2(spark, sf):
    return b.staged_transactions(spark, sf).select(
        "id", clean.clean_or("currency", "MRU").alias("currency"),
        clean.clean_or(clean.clean_cast("fee", clean.MONEY), 0).alias("fee"))


@query("p3_to_bool", """
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN FALSE ELSE quality = 1 END AS good, toxic = 1 AS toxic FROM labels
""")
def p3(spark, sf):
    text = F.when(F.col("doc_id") % 5 == 4, "yes").when(F.col("quality") == 1, "true").otherwise("false")
    toxic = F.when(F.col("toxic") == 1, "true")
    return b.table(spark, sf, "labels").select(
        "doc_id", clean.to_bool(text).alias("good"), clean.to_bool(toxic).alias("toxic"))


@query("p4_fix_prefix", """
SELECT p_partkey, CASE WHEN starts_with(p_name, 'small ')
       THEN replace(p_name, 'small ', CASE WHEN p_type = 'ECONOMY' THEN '' ELSE lower(p_type) || ' ' END)
       ELSE p_name END AS name FROM part
""")
def p4(spark, sf):
    part = b.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), "p_type")
    prefixes = part.select("p_type").distinct().where("p_type <> 'ECONOMY'").select(
        F.col("p_type").alias("key"), F.concat(F.lower("p_type"), F.lit(" ")).alias("prefix"))
    return repair_names(part, "name", "p_type", prefixes, "small ").select("p_partkey", "name")


@query("p5_matches", sql(r"""
SELECT id, regexp_full_match(nni, '[0-9]{10}') AS nni_ok, regexp_full_match(phone, '\+222[0-9]{8}') AS phone_ok,
       regexp_full_match(nni, '[0-9]+') AS digits FROM staged_users
"""))
def p5(spark, sf):
    return b.staged_users(spark, sf).select(
        "id", clean.matches("nni", clean.NNI).alias("nni_ok"), clean.matches("phone", clean.PHONE).alias("phone_ok"),
        clean.matches("nni", clean.DIGITS).alias("digits"))


@query("p6_present", sql("""
SELECT COUNT(*) FILTER (WHERE email <> '') AS with_email, COUNT(*) FILTER (WHERE updated_at <> '') AS updated,
       COUNT(*) FILTER (WHERE id <> '') AS with_id FROM staged_users
"""))
def p6(spark, sf):
    return b.staged_users(spark, sf).agg(
        F.count_if(clean.present("email")).alias("with_email"),
        F.count_if(clean.present("updated_at")).alias("updated"),
        F.count_if(clean.present("id")).alias("with_id"))


@query("p7_month_week", """
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week, COUNT(*) AS n
FROM orders GROUP BY 1, 2
""")
def p7(spark, sf):
    return b.table(spark, sf, "orders").groupBy(
        clean.month_of("o_orderdate").alias("month"), clean.week_of("o_orderdate").alias("week")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("p8_hour_of", "SELECT CAST(hour(ts) AS BIGINT) AS hour, COUNT(*) AS n FROM events GROUP BY 1")
def p8(spark, sf):
    return b.activity(spark, sf).groupBy(clean.hour_of("transaction_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p9_elapsed_seconds", """
SELECT event_type, epoch_us(MAX(ts)) / 1e6 - epoch_us(MIN(ts)) / 1e6 >= 0 AS forward,
       CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS DOUBLE) / 1e6 AS seconds
FROM events GROUP BY event_type
""")
def p9(spark, sf):
    spans = b.table(spark, sf, "events").groupBy("event_type").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"))
    seconds = clean.elapsed_seconds("first", "last")
    return spans.select("event_type", (seconds >= 0).alias("forward"), seconds.alias("seconds"))


@query("p10_discrepancy", sql("""
SELECT id, CAST(ABS(balance_after - (balance_before - amount - fee)) AS DOUBLE) AS off, COUNT(*) AS n
FROM purchases WHERE status = 'SUCCESS' AND ABS(balance_after - (balance_before - amount - fee)) > 1 GROUP BY 1, 2
"""))
def p10(spark, sf):
    off = clean.discrepancy("balance_before", "amount", "fee", "balance_after")
    return b.purchases(spark, sf).where((F.col("status") == "SUCCESS") & (off > 1)).groupBy(
        "id", off.alias("off")).agg(F.count(F.lit(1)).alias("n"))


@query("p11_conflict_group_id", sql("""
SELECT 'idem_' || idempotency_key AS group_id, COUNT(*) AS n FROM purchases GROUP BY 1
"""))
def p11(spark, sf):
    return b.purchases(spark, sf).groupBy(clean.conflict_group_id("idempotency_key").alias("group_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p12_set_range_prefix", """
SELECT COUNT(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) AS in_set,
       COUNT(*) FILTER (WHERE o_totalprice BETWEEN 1000 AND 50000) AS in_range,
       COUNT(*) FILTER (WHERE o_orderpriority LIKE '1-%') AS with_prefix FROM orders
""")
def p12(spark, sf):
    return b.table(spark, sf, "orders").agg(
        F.count_if(clean.allowed("o_orderstatus", ["O", "F"])).alias("in_set"),
        F.count_if(F.col("o_totalprice").between(1000, 50000)).alias("in_range"),
        F.count_if(F.col("o_orderpriority").like("1-%")).alias("with_prefix"))


@query("p13_label_by", """
SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'today' ELSE '' END AS label,
       COUNT(*) AS n FROM orders GROUP BY 1, 2
""")
def p13(spark, sf):
    labels = {"1-URGENT": "now", "2-HIGH": "today"}
    return b.table(spark, sf, "orders").groupBy(
        "o_orderpriority", clean.label_by("o_orderpriority", labels).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("p14_first_existing", """
SELECT 'c_custkey' AS id_column, COUNT(DISTINCT c_custkey) AS ids FROM customer
""")
def p14(spark, sf):
    df = b.table(spark, sf, "customer")
    column = clean.first_existing(df, "customer_id", "c_custkey", "c_name")
    return df.agg(F.count_distinct(column).alias("ids")).select(F.lit(column).alias("id_column"), "ids")
