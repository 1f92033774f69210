"""Profiles, single-column checks and transaction rules."""

from pyspark.sql import functions as F

from ...operators import checks, profile as profiles, rules
from ...session import scratch
from .. import bindings as b
from ..oracle import sql, top_values
from ..registry import query


def _text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# -- profiles ----------------------------------------------------------------------------------

PROFILED = ["id", "nni", "phone", "full_name", "gender", "birth_date", "email", "wilaya_id", "wilaya_name", "status",
            "registration_date", "created_at", "updated_at"]
CELLS = "WITH cells AS (SELECT 'balance' AS col, balance AS v FROM staged_accounts" + "".join(
    f" UNION ALL SELECT '{c}', {c} FROM staged_users" for c in PROFILED) + ")"
TYPE = r"""
CASE WHEN COUNT(*) FILTER (WHERE v <> '') = 0 THEN 'empty'
     WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) FILTER (WHERE v <> '') THEN 'integer'
     WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]*\.?[0-9]+')) FILTER (WHERE v <> '') THEN 'float'
     WHEN bool_and(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9:.]+Z)?')) FILTER (WHERE v <> '') THEN 'date/datetime'
     ELSE 'string' END
"""
def _profiled(spark, sf):
    return b.staged_users(spark, sf).select(*PROFILED)


@query("e1_profile", sql(CELLS + f"""
SELECT col AS column, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE v = '') AS empty_count,
       CAST(COUNT(*) FILTER (WHERE v = '') AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS empty_pct,
       COUNT(DISTINCT NULLIF(v, '')) AS distinct_count, {TYPE} AS inferred_type,
       COALESCE(MIN(NULLIF(v, '')), '') AS min, COALESCE(MAX(NULLIF(v, '')), '') AS max,
       COALESCE((SELECT string_agg(e, '|' ORDER BY e) FROM (SELECT DISTINCT x.v AS e FROM cells x
                 WHERE x.col = cells.col AND x.v <> '' ORDER BY e LIMIT 5)), '') AS examples
FROM cells WHERE col <> 'balance' GROUP BY col
"""))
def e1(spark, sf):
    return profiles.profile(_profiled(spark, sf))


@query("e1_profile_approx", sql(CELLS + f"""
SELECT col AS column, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE v = '') AS empty_count,
       CAST(COUNT(*) FILTER (WHERE v = '') AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS empty_pct,
       TRUE AS near, {TYPE} AS inferred_type,
       COALESCE(MIN(NULLIF(v, '')), '') AS min, COALESCE(MAX(NULLIF(v, '')), '') AS max
FROM cells WHERE col <> 'balance' GROUP BY col
"""))
def e1_approx(spark, sf):
    """The estimate of distinct values is compared with the exact count, within four times its error."""
    text = _profiled(spark, sf)
    exact = profiles.profile(text).select("column", F.col("distinct_count").alias("_exact"))
    rough = profiles.approximate_profile(text, error=0.05).join(exact, "column")
    near = F.abs(F.col("distinct_count") - F.col("_exact")) <= 0.2 * F.col("_exact") + 1
    return rough.withColumn("near", near).drop("distinct_count", "_exact")


EVENT_CELLS = """
SELECT 'event_id' AS col, CAST(event_id AS VARCHAR) AS v FROM events
UNION ALL SELECT 'ts', strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT 'event_type', event_type FROM events
UNION ALL SELECT 'value', CAST(CAST(value AS DECIMAL(20,4)) AS VARCHAR) FROM events
UNION ALL SELECT 'props', props FROM events"""


def _events(spark, sf):
    """All columns as text. Times and numbers are written in a fixed form, which both engines share."""
    return b.table(spark, sf, "events").select(
        F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("user_id").cast("string"), "event_type", F.col("value").cast("decimal(20,4)").cast("string").alias("value"), "props")


@query("e1_profile_events", f"""
WITH cells AS ({EVENT_CELLS}), known AS (SELECT col, trim(COALESCE(v, '')) AS v FROM cells),
ranked AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY v) AS r FROM (SELECT DISTINCT col, v FROM known WHERE v <> ''))
SELECT col AS column, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE v = '') AS empty_count,
       CAST(COUNT(*) FILTER (WHERE v = '') AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS empty_pct,
       COUNT(DISTINCT NULLIF(v, '')) AS distinct_count,
       CASE WHEN col IN ('event_id', 'user_id') THEN 'integer' WHEN col = 'value' THEN 'float' WHEN col = 'ts' THEN 'date/datetime'
            ELSE 'string' END AS inferred_type,
       COALESCE(MIN(NULLIF(v, '')), '') AS min, COALESCE(MAX(NULLIF(v, '')), '') AS max,
       (SELECT string_agg(x.v, '|' ORDER BY x.v) FROM ranked x WHERE x.col = known.col AND x.r <= 5) AS examples
FROM known GROUP BY col
""")
def e1_events(spark, sf):
    return profiles.profile(_events(spark, sf))


@query("e1_profile_merged", f"""
WITH cells AS ({EVENT_CELLS}), known AS (SELECT col, trim(COALESCE(v, '')) AS v FROM cells)
SELECT col AS column, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE v = '') AS empty_count,
       CAST(COUNT(*) FILTER (WHERE v = '') AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS empty_pct, TRUE AS near,
       CASE WHEN col IN ('event_id', 'user_id') THEN 'integer' WHEN col = 'value' THEN 'float' WHEN col = 'ts' THEN 'date/datetime'
            ELSE 'string' END AS inferred_type,
       COALESCE(MIN(NULLIF(v, '')), '') AS min, COALESCE(MAX(NULLIF(v, '')), '') AS max
FROM known GROUP BY col
""")
def e1_merged(spark, sf):
    """Four parts are profiled one by one; the stored sketches make the profile of the whole.
    Its distinct counts are compared with the exact ones, within four times their error."""
    text, path = _events(spark, sf), scratch(spark, "profile")
    for part in range(4):
        rows = text.where(F.pmod(F.col("event_id").cast("bigint"), F.lit(4)) == part)
        profiles.sketch(rows).write.parquet(f"{path}/part={part}")
    merged = profiles.merged_profile(spark.read.parquet(path).drop("part"))
    exact = profiles.profile(text).select("column", F.col("distinct_count").alias("_exact"))
    rough = merged.join(exact, "column")
    near = F.abs(F.col("distinct_count") - F.col("_exact")) <= 0.1 * F.col("_exact") + 1
    return rough.withColumn("near", near).drop("distinct_count", "_exact")


@query("e2_infer_types", sql(CELLS + f"SELECT col AS column, {TYPE} AS inferred_type FROM cells GROUP BY col"))
def e2(spark, sf):
    balance = b.staged_accounts(spark, sf).select("balance")
    return profiles.infer_types(_profiled(spark, sf)).unionByName(profiles.infer_types(balance))


@query("e3_duplicates", """
WITH k AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS v, COUNT(*) AS n
           FROM lineitem GROUP BY 1)
SELECT 'lineitem' AS dataset, 'line' AS column, CAST(0 AS BIGINT) AS empty, COUNT(*) AS distinct,
       COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(SUM(n) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (WHERE n > 1) = 0 AS strict_unique,
       (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT v FROM k WHERE n > 1 ORDER BY v LIMIT 10)) AS samples
FROM k
""")
def e3(spark, sf):
    return profiles.duplicates(
        b.purchases(spark, sf).select(F.col("idempotency_key").alias("line")), ["line"], "lineitem")


@query("e3_duplicates_users", sql("""
WITH cells AS (SELECT 'id' AS col, id AS v FROM staged_users UNION ALL SELECT 'phone', phone FROM staged_users
               UNION ALL SELECT 'email', email FROM staged_users),
k AS (SELECT col, v, COUNT(*) AS n FROM cells GROUP BY col, v)
SELECT 'users' AS dataset, col AS column,
       CAST(COALESCE(SUM(n) FILTER (WHERE v = ''), 0) AS BIGINT) AS empty, COUNT(*) FILTER (WHERE v <> '') AS distinct,
       COUNT(*) FILTER (WHERE v <> '' AND n > 1) AS duplicate_keys,
       CAST(COALESCE(SUM(n) FILTER (WHERE v <> '' AND n > 1), 0) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (WHERE n > 1 OR v = '') = 0 AS strict_unique,
       COALESCE((SELECT string_agg(s.v, '|' ORDER BY s.v) FROM (
           SELECT v FROM k x WHERE x.col = k.col AND v <> '' AND n > 1 ORDER BY v LIMIT 10) s), '') AS samples
FROM k GROUP BY col
"""))
def e3_users(spark, sf):
    return profiles.duplicates(b.staged_users(spark, sf), ["id", "phone", "email"], "users")


# -- format checks -----------------------------------------------------------------------------

def _one(rule, source, value):
    return f"SELECT '{rule}' AS rule, (SELECT COUNT(*) FROM ({source}) q) AS count, {top_values(source, value)} AS samples"


BAD_NAME = "SELECT c_name FROM customer WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]*[02468]')"


@query("e4_regex", _one("name", BAD_NAME, "c_name"))
def e4(spark, sf):
    return checks.run_checks(b.table(spark, sf, "customer"), [
        checks.regex_check("c_name", r"^Customer#[0-9]*[02468]\z", "name")])


@query("e4_identity_and_phone", sql(
    _one("nni must be 10 digits", "SELECT nni FROM staged_users WHERE NOT regexp_full_match(nni, '[0-9]{10}')", "nni")
    + " UNION ALL "
    + _one("phone must match +222XXXXXXXX", r"SELECT phone FROM staged_users WHERE NOT regexp_full_match(phone, '\+222[0-9]{8}')", "phone")))
def e4_users(spark, sf):
    return checks.run_checks(b.staged_users(spark, sf), [checks.nni_check(), checks.phone_check()])


BALANCE = ("SELECT CASE WHEN c_custkey % 100 = 9 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR) END AS v, "
           "CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS DOUBLE) AS x FROM customer")


@query("e5_sign", _one("balance >= 0", f"SELECT v FROM ({BALANCE}) p WHERE v = 'n/a' OR x < 0", "v") + " UNION ALL "
       + _one("balance > 0", f"SELECT v FROM ({BALANCE}) p WHERE v = 'n/a' OR x <= 0", "v"))
def e5(spark, sf):
    text = F.when(F.col("c_custkey") % 100 == 9, "n/a").otherwise(
        F.col("c_acctbal").cast("decimal(14,2)").cast("string"))
    df = b.table(spark, sf, "customer").select(text.alias("balance"))
    return checks.run_checks(df, [
        checks.non_negative_check("balance", "balance >= 0"), checks.positive_check("balance", "balance > 0")])


DATES = ("SELECT CASE o_orderkey % 6 WHEN 0 THEN d WHEN 1 THEN d || ' 10:11:12' WHEN 2 THEN d || ' 10:11:12.250000' "
         "WHEN 3 THEN d || 'T10:11:12Z' WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'on ' || d END AS v "
         "FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders)")


@query("e6_date", _one("order date parsable", f"SELECT v FROM ({DATES}) p WHERE starts_with(v, 'on ')", "v"))
def e6(spark, sf):
    k, day = F.col("o_orderkey") % 6, F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(k == 0, day).when(k == 1, F.concat(day, F.lit(" 10:11:12")))
        .when(k == 2, F.concat(day, F.lit(" 10:11:12.250000"))).when(k == 3, F.concat(day, F.lit("T10:11:12Z")))
        .when(k == 4, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.concat(F.lit("on "), day))
    )
    df = b.table(spark, sf, "orders").select(text.alias("placed"))
    return checks.run_checks(df, [checks.date_check("placed", "order date parsable")])


@query("e7_enum", _one("status in {O,F}", "SELECT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')", "o_orderstatus"))
def e7(spark, sf):
    return checks.run_checks(b.table(spark, sf, "orders"), [
        checks.enum_check("o_orderstatus", ["O", "F"], "status in {O,F}")])


BAD_NATION = "SELECT CAST(c_nationkey AS VARCHAR) AS v FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)"


@query("e8_in_reference", f"""
SELECT 'customer' AS dataset, 'c_nationkey' AS column, 'nation.n_nationkey' AS reference_set,
       (SELECT COUNT(*) FROM ({BAD_NATION}) q) AS count, {top_values(BAD_NATION, 'v')} AS samples
""")
def e8(spark, sf):
    nation = b.table(spark, sf, "nation").where("n_regionkey <> 2")
    return checks.check_in_reference(
        b.table(spark, sf, "customer"), "c_nationkey", nation, "n_nationkey", "customer", "nation.n_nationkey")


BAD_PAIR = ("SELECT u.wilaya_id || ' => expected=' || w.name || ', got=' || u.wilaya_name AS v "
            "FROM staged_users u JOIN wilayas w ON CAST(w.id AS VARCHAR) = u.wilaya_id WHERE w.name <> u.wilaya_name")


@query("e9_pair", sql(f"""
SELECT 'users' AS dataset, 'wilaya_id' AS id_column, 'wilaya_name' AS name_column, 'wilayas(id->name)' AS reference_set,
       (SELECT COUNT(*) FROM ({BAD_PAIR}) q) AS count, {top_values(BAD_PAIR, 'v')} AS samples
"""))
def e9(spark, sf):
    return checks.check_pair(
        b.staged_users(spark, sf), "wilaya_id", "wilaya_name", b.staged_wilayas(spark, sf), "id", "name",
        "users", "wilayas(id->name)")


ORPHAN = "SELECT CAST(o_custkey AS VARCHAR) AS v FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"


@query("e10_orphans", f"""
SELECT 'orders' AS dataset, 'o_custkey' AS column, 'customer.c_custkey' AS target,
       (SELECT COUNT(*) FROM ({ORPHAN}) q) AS count, {top_values(ORPHAN, 'v')} AS samples
""")
def e10(spark, sf):
    customers = b.table(spark, sf, "customer").where("c_acctbal >= 0")
    return checks.check_orphans(
        b.table(spark, sf, "orders"), "o_custkey", customers, "c_custkey", "orders", "customer.c_custkey")


# -- rules -----------------------------------------------------------------------------------

@query("r1_failed_balance", sql(_one(
    "FAILED => balance_before == balance_after",
    "SELECT id FROM ledger WHERE status = 'FAILED' AND CAST(balance_after AS DOUBLE) <> CAST(balance_before AS DOUBLE)", "id")))
def r1(spark, sf):
    return checks.run_checks(b.staged_transactions(spark, sf), [rules.failed_balance_rule()])


@query("r2_sign", sql(
    _one("amount must be > 0", "SELECT id FROM ledger WHERE CAST(amount AS DOUBLE) <= 0", "id") + " UNION ALL "
    + _one("fee must be >= 0", "SELECT id FROM ledger WHERE CAST(NULLIF(fee, '') AS DOUBLE) < 0", "id") + " UNION ALL "
    + _one("balance_after must be >= 0", "SELECT id FROM ledger WHERE CAST(balance_after AS DOUBLE) < 0", "id")))
def r2(spark, sf):
    return checks.run_checks(b.staged_transactions(spark, sf), [
        rules.sign_rule("amount", False), rules.sign_rule("fee", True), rules.sign_rule("balance_after", True)])


EARLY = ("SELECT CAST(l_orderkey AS VARCHAR) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
         "WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)")


@query("r3_date_order", _one("shipped >= ordered", EARLY, "v"))
def r3(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("ordered"))
    rows = b.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").cast("string").alias("shipped")
    ).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return checks.run_checks(rows, [rules.date_order_rule("ordered", "shipped", "l_orderkey")])


@query("r3_date_order_ledger", sql(_one(
    "completed_at >= created_at", "SELECT CAST(id AS VARCHAR) AS v FROM payments WHERE completed_at < created_at", "v")))
def r3_ledger(spark, sf):
    return checks.run_checks(b.staged_transactions(spark, sf), [rules.date_order_rule()])


@query("r4_status", _one(
    "status must be one of allowed values",
    "SELECT CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus AS v FROM orders WHERE o_orderstatus NOT IN ('O', 'F')", "v"))
def r4(spark, sf):
    return checks.run_checks(b.table(spark, sf, "orders"), [
        rules.status_rule("o_orderstatus", ["O", "F"], "o_orderkey")])


# First by ship date; part, supplier, price and flag make the order unique within a key.
ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag"


def _first_seen(rule, key, payload):
    diff = " OR ".join(f"{c} <> f_{c}" for c in payload)
    firsts = ", ".join(f"first_value({c}) OVER (PARTITION BY {key} ORDER BY {ORDER}) AS f_{c}" for c in payload)
    rows = (f"SELECT k FROM (SELECT {key} AS k, {', '.join(payload)}, {firsts} FROM lineitem) f WHERE {diff}")
    return _one(rule, rows, "k")


def _items(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "*", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line"))


@query("r5_idempotency_payload", _first_seen(
    "same idempotency_key with different payload",
    "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", ["l_extendedprice", "l_returnflag"]))
def r5(spark, sf):
    return rules.idempotency_payload_rule(
        _items(spark, sf), [c.strip() for c in ORDER.split(",")], "line", "l_extendedprice", "l_returnflag")


@query("r6_reference_amount", _first_seen(
    "same reference with different amount", "CAST(l_orderkey AS VARCHAR)", ["l_extendedprice"]))
def r6(spark, sf):
    return rules.reference_amount_rule(
        _items(spark, sf), [c.strip() for c in ORDER.split(",")], "l_orderkey", "l_extendedprice")


@query("r7_columns_differ", sql(_one(
    "node_id != processing_node", "SELECT id FROM ledger WHERE node_id <> processing_node", "id") + " UNION ALL "
    + _one("l_returnflag != l_linestatus",
           "SELECT CAST(l_orderkey AS VARCHAR) AS v FROM lineitem WHERE l_returnflag <> l_linestatus", "v")))
def r7(spark, sf):
    nodes = checks.run_checks(
        b.staged_transactions(spark, sf), [rules.columns_differ_rule("node_id", "processing_node")])
    flags = checks.run_checks(
        b.table(spark, sf, "lineitem"), [rules.columns_differ_rule("l_returnflag", "l_linestatus", "l_orderkey")])
    return nodes.unionByName(flags)


@query("r8_sequence_gaps", """
SELECT user_id, previous, event_id, event_id - previous - 1 AS missing FROM (
  SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) g
WHERE event_id - previous > 1
""")
def r8(spark, sf):
    return rules.sequence_gaps(b.table(spark, sf, "events"), "user_id", "event_id")


@query("r9_available_over_balance", sql(_one(
    "available_balance <= balance",
    "SELECT id FROM staged_accounts WHERE CAST(available_balance AS DECIMAL(14,2)) > CAST(balance AS DECIMAL(14,2))", "id")))
def r9(spark, sf):
    return checks.run_checks(b.staged_accounts(spark, sf), [rules.available_over_balance_rule()])
