"""Sources and sinks, as round trips through the shared scratch folder."""

from pyspark.sql import functions as F

from ...operators.reports import daily_totals
from ...session import scratch
from ...sources.csv import malformed_rows, read_lenient, read_raw
from ...sources.layers import LayerStore, issue_rows, upsert, write_fact, write_report
from .. import bindings as b
from ..oracle import sql
from ..registry import query


def _csv(df, spark, name):
    path = scratch(spark, name)
    df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("s1_read_raw", sql("""
SELECT id, nni, phone, full_name || ', "' || gender || '"' AS full_name,
       CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN NULL ELSE email END AS email, TRUE AS loaded FROM staged_users
"""))
def s1(spark, sf):
    users = b.staged_users(spark, sf).select(
        "id", "nni", "phone",
        F.concat("full_name", F.lit(', "'), "gender", F.lit('"')).alias("full_name"),
        F.when(F.col("id").cast("bigint") % 4 != 0, F.col("email")).alias("email"))
    raw = read_raw(spark, _csv(users, spark, "users"), users.columns)
    return raw.withColumn("loaded", F.col("loaded_at").isNotNull()).drop("loaded_at")


@query("s1_malformed_rows", sql("""
SELECT CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN id || ',' || nni || ',' || phone || ',surplus' ELSE id || ',' || nni END AS record
FROM staged_users WHERE CAST(id AS BIGINT) % 10 IN (3, 4)
"""))
def s1_malformed(spark, sf):
    """Some rows have a cell too many, some one too few."""
    key = F.col("id").cast("bigint")
    cells = F.concat_ws(",", "id", "nni", "phone")
    line = F.when(key % 10 == 4, F.concat(cells, F.lit(",surplus"))).when(
        key % 10 == 3, F.concat_ws(",", "id", "nni")).otherwise(cells)
    path = scratch(spark, "users-lines")
    b.staged_users(spark, sf).select(line.alias("value")).write.text(path)
    return malformed_rows(spark, path, ["id", "nni", "phone"], header=False).select("record")


@query("s2_read_lookups", sql("""
SELECT CAST(id AS VARCHAR) AS id, code, name, capital, '' AS latitude, CAST(population AS VARCHAR) AS population FROM wilayas
"""))
def s2(spark, sf):
    path = _csv(b.staged_wilayas(spark, sf), spark, "wilayas")
    return read_raw(spark, path, "wilayas").select("id", "code", "name", "capital", "latitude", "population")


@query("s3_read_lenient", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '' AS note, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
""")
def s3(spark, sf):
    padded = b.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias(" id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name "),
        F.lit(None).cast("string").alias("note"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("\t ")).alias("nation"))
    return read_lenient(spark, _csv(padded, spark, "customers"))


@query("s4_full_refresh", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def s4(spark, sf):
    """The second refresh replaces the first."""
    store = LayerStore(spark, scratch(spark, "layers"))
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    store.replace(customers, "core", "customers")
    store.replace(customers.where("c_acctbal >= 0").drop("c_acctbal"), "core", "customers")
    return store.read("core", "customers")


@query("s5_issue_rows", sql("""
SELECT id AS staging_transaction_id, 'flagged' AS anomaly_type, 'why' AS anomaly_details, amount AS payload_amount,
       status AS payload_status, CASE WHEN merchant_id = '' THEN NULL ELSE merchant_id END AS payload_merchant,
       TRUE AS keeps_null FROM ledger
"""))
def s5(spark, sf):
    tx = b.staged_transactions(spark, sf).withColumn(
        "merchant_id", F.nullif("merchant_id", F.lit(""))).withColumn("nothing", F.lit(None).cast("string"))
    rows = issue_rows(tx, "flagged", "why")
    return rows.select(
        "staging_transaction_id", "anomaly_type", "anomaly_details",
        F.get_json_object("raw_payload", "$.amount").alias("payload_amount"),
        F.get_json_object("raw_payload", "$.status").alias("payload_status"),
        F.get_json_object("raw_payload", "$.merchant_id").alias("payload_merchant"),
        F.col("raw_payload").contains('"nothing":null').alias("keeps_null"))


@query("s4_failed_refresh", "SELECT c_custkey, c_name, 1 AS versions FROM customer")
def s4_failed(spark, sf):
    """A run that dies after its first table leaves every table as it was."""
    store = LayerStore(spark, scratch(spark, "layers"))
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    store.replace(customers, "core", "customers")
    try:
        with store.run():
            store.replace(customers.limit(0), "core", "customers")
            raise RuntimeError("lost")
    except RuntimeError:
        pass
    return store.read("core", "customers").withColumn("versions", F.lit(store.manifest()["core.customers"]))


@query("s6_upsert", """
SELECT p_partkey AS code, CASE WHEN p_size > 40 THEN 'new ' || p_name ELSE p_brand END AS description FROM part
""")
def s6(spark, sf):
    part = b.table(spark, sf, "part")
    old = part.select(F.col("p_partkey").alias("code"), F.col("p_brand").alias("description"))
    new = part.where("p_size > 40").select(
        F.col("p_partkey").alias("code"), F.concat(F.lit("new "), "p_name").alias("description"))
    return upsert(old, new, "code")


@query("s7_write_report", sql("""
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, COUNT(*) AS total_tx FROM payments GROUP BY transaction_date
"""))
def s7(spark, sf):
    path = scratch(spark, "report")
    write_report(daily_totals(b.payments(spark, sf)), path)
    return spark.read.parquet(path).select("transaction_date", "total_tx")


@query("s8_partitioned_fact", sql("""
SELECT year(transaction_date)::VARCHAR || 'q' || quarter(transaction_date)::VARCHAR AS tx_quarter, COUNT(*) AS n,
       CAST(SUM(amount) AS DOUBLE) AS volume FROM payments WHERE year(transaction_date) = 1996 GROUP BY 1
"""))
def s8(spark, sf):
    path = scratch(spark, "fact")
    write_fact(b.payments(spark, sf).select("id", "amount", "transaction_date"), path, "transaction_date")
    return spark.read.parquet(path).where(F.col("tx_quarter").startswith("1996")).groupBy("tx_quarter").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("volume"))
