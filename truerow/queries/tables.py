"""The driver tables as the inputs of the library: JSON records of several endpoints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.config import Relationship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a file that comes in fewer splits than there are cores, over all cores.

    The given files hold a single row group, which one task would have to turn into JSON.
    Inputs with enough splits are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def coded(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.col(key) if isinstance(key, str) else key)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _records(rows: DataFrame, endpoint: str, record_id: Column, payload: Column) -> DataFrame:
    return rows.select(
        F.lit(endpoint).alias("endpoint"),
        record_id.alias("record_id"),
        F.to_json(payload).alias("payload"),
    )


def line_id() -> Column:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


LINE_ID_SQL = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(round(l_extendedprice * 100) AS BIGINT))"
)


# -- change records --------------------------------------------------------------------------


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a JSON change record of (event type, user).

    The event is a deletion when its value is below 5.
    """
    events = spread(table(spark, sf_dir, "events"))
    payload = F.struct(
        F.col("user_id").cast("string").alias("id"),
        iso(F.col("ts")).alias("_modified_at"),
        (F.col("value") >= 5).alias("active"),
        "event_id",
        "props",
    )
    return events.select(
        F.col("event_type").alias("endpoint"), F.to_json(payload).alias("payload"), "event_id"
    )


# -- records that refer to each other --------------------------------------------------------

RELATIONSHIPS = (
    Relationship("line_parts", "lines", ("part", "spare"), "parts", ("id", "code")),
    Relationship("line_suppliers", "lines", ("supplier",), "suppliers"),
    Relationship("order_customers", "orders", ("customer",), "customers"),
)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with references in texts, lists and objects at several depths."""
    rows = spread(table(spark, sf_dir, "lineitem"))
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    deep = F.struct(F.concat(F.lit(" C"), F.col("l_suppkey"), F.lit(" ")).alias("deep"))
    part = F.struct(
        coded("C", "l_partkey").alias("main"),
        F.array(deep, F.struct(coded("C", "l_partkey").alias("deep"))).alias("more"),
        F.col("l_linenumber").alias("n"),
    )
    spare = F.when(F.col("l_tax") == 0, "plm:").otherwise(
        F.concat(F.lit("C"), F.col("l_partkey"), F.lit("K"))
    )
    payload = F.struct(
        line_id().alias("id"),
        F.when(bad, coded("X", "l_suppkey")).otherwise(coded("C", "l_suppkey")).alias("supplier"),
        part.alias("part"),
        F.array(spare).alias("spare"),
        (F.col("l_discount") > 0).alias("discounted"),
    )
    return _records(rows, "lines", line_id(), payload)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "orders"))
    own = coded("O", "o_orderkey")
    return _records(
        rows,
        "orders",
        own,
        F.struct(own.alias("id"), F.array(coded("C", "o_custkey")).alias("customer")),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotional parts are stored under another id; only large parts have a code."""
    rows = table(spark, sf_dir, "part")
    key = coded("C", "p_partkey")
    own = F.when(F.col("p_type") == "PROMO", F.concat(key, F.lit("-P"))).otherwise(key)
    code = F.when(F.col("p_size") > 25, F.concat(key, F.lit("K")))
    return _records(rows, "parts", own, F.struct(own.alias("id"), code.alias("code")))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with debts are stored under another id."""
    rows = table(spark, sf_dir, "supplier")
    own = F.when(F.col("s_acctbal") < 0, coded("S", "s_suppkey")).otherwise(coded("C", "s_suppkey"))
    return _records(rows, "suppliers", own, F.struct(own.alias("id")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with debts are stored under another id."""
    rows = table(spark, sf_dir, "customer")
    own = F.when(F.col("c_acctbal") < 0, coded("S", "c_custkey")).otherwise(coded("C", "c_custkey"))
    nation = coded("N", "c_nationkey")
    return _records(rows, "customers", own, F.struct(own.alias("id"), nation.alias("nation")))


def referring_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    builders = (lines, orders, parts, suppliers, customers)
    return union([build(spark, sf_dir) for build in builders])


REFS_SQL = f"""
refs AS (
  SELECT 'line_parts' AS relationship, {LINE_ID_SQL} AS record_id, 'C' || l_partkey AS ref
  FROM lineitem
  UNION SELECT 'line_parts', {LINE_ID_SQL}, 'C' || l_suppkey FROM lineitem
  UNION SELECT 'line_parts', {LINE_ID_SQL}, 'C' || l_partkey || 'K' FROM lineitem WHERE l_tax <> 0
  UNION SELECT 'line_suppliers', {LINE_ID_SQL},
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'X' ELSE 'C' END || l_suppkey
  FROM lineitem
  UNION SELECT 'order_customers', 'O' || o_orderkey, 'C' || o_custkey FROM orders
),
targets AS (
  SELECT 'line_parts' AS relationship,
    'C' || p_partkey || CASE WHEN p_type = 'PROMO' THEN '-P' ELSE '' END AS ref FROM part
  UNION SELECT 'line_parts', 'C' || p_partkey || 'K' FROM part WHERE p_size > 25
  UNION SELECT 'line_suppliers',
    CASE WHEN s_acctbal < 0 THEN 'S' ELSE 'C' END || s_suppkey FROM supplier
  UNION SELECT 'order_customers',
    CASE WHEN c_acctbal < 0 THEN 'S' ELSE 'C' END || c_custkey FROM customer
),
statuses AS (
  SELECT r.*, CASE WHEN NOT regexp_matches(r.ref, '^C[0-9]') THEN 'invalid_ref'
    WHEN t.ref IS NOT NULL THEN 'seen' ELSE 'not_seen' END AS status
  FROM refs r LEFT JOIN targets t ON t.relationship = r.relationship AND t.ref = r.ref
),
counts AS (
  SELECT 'lines' AS endpoint, count(*) AS records FROM lineitem
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'parts', count(*) FROM part
  UNION ALL SELECT 'suppliers', count(*) FROM supplier
  UNION ALL SELECT 'customers', count(*) FROM customer
),
coverage AS (
  SELECT relationship,
    CASE relationship WHEN 'order_customers' THEN 'orders' ELSE 'lines' END AS source_endpoint,
    CASE relationship WHEN 'line_parts' THEN 'parts' WHEN 'line_suppliers' THEN 'suppliers'
      ELSE 'customers' END AS target_endpoint,
    any_value(c.records) AS source_records,
    count(DISTINCT record_id) AS source_records_with_refs,
    count(DISTINCT record_id) FILTER (status <> 'seen') AS source_records_with_missing_refs,
    count(*) AS declared_refs,
    count(*) FILTER (status = 'seen') AS seen_refs,
    count(*) FILTER (status = 'not_seen') AS missing_refs,
    count(*) FILTER (status = 'invalid_ref') AS invalid_refs,
    round_even(count(*) FILTER (status = 'seen') / count(*) * 100, 2) AS coverage_percent
  FROM statuses JOIN counts c
    ON c.endpoint = CASE relationship WHEN 'order_customers' THEN 'orders' ELSE 'lines' END
  GROUP BY relationship
)
"""
