"""A registered target over two ingests, and small parts of targets and reports over the driver tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.functions.issues import ISSUES_TYPE, issue, present
from truerow.functions.times import parse_since
from truerow.operators import reports
from truerow.operators.apply import ingest
from truerow.operators.check import numeric_counts
from truerow.plans import targets
from truerow.plans.runs import run_after_ingest
from truerow.queries.files import RawFolder
from truerow.queries.state import FOLD_SQL, SCHEMAS
from truerow.queries.tables import table, union
from truerow.session import scratch_dir
from truerow.sources.store import VALIDATION_INDEX, VALIDATION_RUNS, MasterStore

#: The products are the sign-ups, by user, each with the click of the same user.
TARGET = "sign-ups"


def _sign_ups(records: DataFrame, scope: DataFrame | None) -> DataFrame:
    """M7: a sign-up with its user's click, if there is one."""

    def event(endpoint: str, name: str) -> DataFrame:
        number = F.get_json_object("payload", "$.event_id").cast("bigint")
        return records.where(F.col("endpoint") == endpoint).select("record_id", number.alias(name))

    docs = event("signup", "sign_up").join(event("click", "click"), "record_id", "left")
    docs = docs.withColumnRenamed("record_id", "product_id")
    return docs if scope is None else docs.join(scope, "product_id", "left_semi")


def _late(docs: DataFrame) -> DataFrame:
    """A click must come after the sign-up."""
    early = F.coalesce(F.col("click") < F.col("sign_up"), F.lit(False))
    found = issue("EARLY", "The click came first.", "error", "PLM", "click", "click.order")
    return docs.select(
        "product_id",
        F.concat_ws("/", "sign_up", "click").alias("display_name"),
        (~early).alias("ready"),
        present([F.when(early, found)]).cast(ISSUES_TYPE).alias("issues"),
    )


def _runs(spark: SparkSession, sf_dir: str) -> MasterStore:
    """L1, L2: a full run after the first two raw runs, a scoped one after the third."""

    def reached(changed: DataFrame, states: list[DataFrame]) -> DataFrame:
        return changed.where(F.col("endpoint").isin("signup", "click")).select("record_id").distinct()

    targets.register_target(TARGET, reconstruct=_sign_ups, validate=_late, affected=reached, rule_set_version="s1")
    folder = RawFolder(spark, sf_dir).put(0, 1)
    store = MasterStore(spark, scratch_dir(spark, "targets"), buckets=2)
    run_after_ingest(store, TARGET, ingest(store, folder.path, SCHEMAS))
    run_after_ingest(store, TARGET, ingest(store, folder.put(2).path, SCHEMAS))
    return store


def target_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after the scoped run is that of a full one on the same state."""
    index = _runs(spark, sf_dir).read(VALIDATION_INDEX.name)
    return index.select("product_id", "display_name", "ready", F.array_join("issue_codes", ",").alias("codes"))


def target_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both runs; only the full one stores all results."""
    return _runs(spark, sf_dir).read(VALIDATION_RUNS.name).select(
        "target", "rule_set_version", "total_records", "ready_records",
        F.col("latest_result_path").isNotNull().alias("with_results"),
    )


def _signed(state: str) -> str:
    return f"""(
  SELECT s.record_id, s.event_id AS sign_up, c.event_id AS click, coalesce(c.event_id >= s.event_id, true) AS ready
  FROM (SELECT * FROM {state} WHERE endpoint = 'signup') s
  LEFT JOIN (SELECT * FROM {state} WHERE endpoint = 'click') c ON c.record_id = s.record_id)"""


def static_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target's static table, here the regions with their number of nations."""

    def regions(session: SparkSession) -> DataFrame:
        nations = table(session, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("nations"))
        return table(session, sf_dir, "region").join(nations, "r_regionkey", "left").select("r_name", "nations")

    targets.register_target("regions", artifact=regions)
    return targets.artifact("regions", spark)


def markdown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a Markdown table, numbers to the right."""
    kinds = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("most"))
    text = reports.markdown_table(kinds, ["Type", "Brand", "Parts", "Largest"], ["p_type", "p_brand", "n", "most"])
    return spark.createDataFrame([(line,) for line in text.split("\n")], "line STRING")


#: Absolute times and durations, all from one moment.
SINCE = ("3m", "10d", "2y", "36h", "2001-01-15T12:00", "2001-01-15T12:00+02:00")
NOW = datetime(2001, 8, 31, tzinfo=UTC)


def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders since each of several times and durations."""
    orders = table(spark, sf_dir, "orders")

    def since(text: str) -> DataFrame:
        start = F.lit(parse_since(text, NOW)).cast("timestamp_ntz")
        chosen = orders.where(F.col("o_orderdate").cast("timestamp_ntz") >= start)
        return chosen.agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys")).withColumn("since", F.lit(text))

    return union([since(text) for text in SINCE])


def numeric_counts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only numbers, and yes or no, count; texts, lists and nulls do not, nor does what is no object."""
    line = F.struct(
        F.col("l_linenumber").alias("whole"),
        (F.col("l_linenumber") + 0.75).alias("part"),
        (F.col("l_returnflag") == "R").alias("flag"),
        F.col("l_linenumber").cast("string").alias("text"),
        F.array("l_linenumber").alias("list"),
        F.lit(None).cast("int").alias("none"),
    )
    text = F.to_json(line, {"ignoreNullFields": "false"})
    text = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    counts = table(spark, sf_dir, "lineitem").select(F.explode(numeric_counts(F.parse_json(text))).alias("name", "n"))
    return counts.groupBy("name").agg(F.count("*").alias("entries"), F.sum("n").alias("total"))


QUERIES = {
    "target_index": (
        target_index,
        FOLD_SQL
        + f"""
SELECT record_id AS product_id, concat_ws('/', sign_up, click) AS display_name, ready,
  CASE WHEN ready THEN '' ELSE 'EARLY' END AS codes FROM {_signed("s3")}""",
    ),
    "target_runs": (
        target_runs,
        FOLD_SQL
        + f"""
SELECT '{TARGET}' AS target, 's1' AS rule_set_version, count(*) AS total_records,
  count(*) FILTER (ready) AS ready_records, true AS with_results FROM {_signed("s2")}
UNION ALL SELECT '{TARGET}', 's1', count(*), count(*) FILTER (ready), false FROM {_signed("s3")}""",
    ),
    "static_artifact": (
        static_artifact,
        """
SELECT r_name, (SELECT CASE WHEN count(*) > 0 THEN count(*) END FROM nation WHERE n_regionkey = r_regionkey) AS nations
FROM region""",
    ),
    "markdown_lines": (
        markdown_lines,
        """
SELECT '| Type | Brand | Parts | Largest |' AS line UNION ALL SELECT '| --- | --- | ---: | ---: |'
UNION ALL SELECT '| ' || p_type || ' | ' || p_brand || ' | ' || count(*) || ' | ' || max(p_size) || ' |'
FROM part GROUP BY p_type, p_brand""",
    ),
    "since_filter": (
        since_filter,
        " UNION ALL ".join(
            f"SELECT count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys, '{text}' AS since FROM orders WHERE o_orderdate >= {start}"
            for text, start in zip(
                SINCE,
                (
                    "TIMESTAMP '2001-05-31'",
                    "TIMESTAMP '2001-08-21'",
                    "TIMESTAMP '1999-08-31'",
                    "TIMESTAMP '2001-08-29 12:00'",
                    "TIMESTAMP '2001-01-15 12:00'",
                    "TIMESTAMP '2001-01-15 10:00'",
                ),
            )
        ),
    ),
    "numeric_counts": (
        numeric_counts_of,
        """
WITH o AS (SELECT * FROM lineitem WHERE l_linestatus <> 'F')
SELECT 'whole' AS name, count(*) AS entries, CAST(sum(l_linenumber) AS BIGINT) AS total FROM o
UNION ALL SELECT 'part', count(*), CAST(sum(l_linenumber) AS BIGINT) FROM o
UNION ALL SELECT 'flag', count(*), count(*) FILTER (l_returnflag = 'R') FROM o""",
    ),
}
