"""The star-schema tables in the roles of claims, policies, customers, agents and events.

Money goes in as decimal(18,2), so that sums and averages are exact and do not
depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.entities import CLAIMS
from smelter.operators.conform import conform
from smelter.operators.dedup import latest_per_key

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str):
    return F.col(name).cast("string")


def utc(name: str):
    return F.col(name).cast("timestamp")


def plain_time(name: str):
    """A timestamp without zone, as the tables store it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def silver_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as claims: newest line per (order, line number), typed, valid."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("claim_date"),
        F.col("l_extendedprice").alias("claim_amount"),
        F.col("l_returnflag").alias("claim_status"),
    )
    newest = latest_per_key(lines, ["l_orderkey", "l_linenumber"], ("claim_date",))
    named = newest.withColumns(
        {"claim_id": F.concat_ws("-", "l_orderkey", "l_linenumber"), "policy_id": text("l_orderkey")}
    )
    return conform(named, CLAIMS.typed).withColumn("claim_amount", F.col("claim_amount").cast(MONEY))


def silver_claims_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), text("o_custkey").alias("customer_id")
    )
    return silver_claims(spark, sf_dir).join(owners, "l_orderkey")


CLAIMS_SQL = """
silver_claims AS (
    SELECT l_orderkey, concat_ws('-', l_orderkey, l_linenumber) AS claim_id,
           CAST(l_orderkey AS VARCHAR) AS policy_id, CAST(l_shipdate AS DATE) AS claim_date,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS claim_amount, upper(trim(l_returnflag)) AS claim_status
    FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_returnflag,
                 row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                    ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
                                             l_returnflag DESC NULLS LAST) AS rn
          FROM lineitem)
    WHERE rn = 1 AND l_orderkey IS NOT NULL AND l_shipdate IS NOT NULL AND l_extendedprice > 0
)
"""


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as policies; status O stands for active."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("policy_id"),
        text("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("premium"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("start_date"),
    )


def claim_events(events: DataFrame) -> DataFrame:
    """Events, batch or stream, in the typed form of claim events."""
    return events.select(
        text("event_id").alias("claim_id"),
        text("user_id").alias("policy_id"),
        text("user_id").alias("customer_id"),
        F.col("value").cast("decimal(28,8)").alias("claim_amount"),
        F.col("event_type").alias("claim_status"),
        utc("ts").alias("event_timestamp"),
    )


EVENTS_SQL = """
claim_events AS (
    SELECT CAST(event_id AS VARCHAR) AS claim_id, CAST(user_id AS VARCHAR) AS policy_id,
           CAST(user_id AS VARCHAR) AS customer_id, CAST(value AS DECIMAL(18,2)) AS claim_amount,
           event_type AS claim_status, ts AS event_timestamp
    FROM events
)
"""


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as an unbounded source.

    The source takes folders; a pattern also fits a table that is one file.
    """
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def exact_average(total: str, count: str, scale: int) -> str:
    """SQL for total/count rounded half up to ``scale`` digits, of decimals with two.

    Integer arithmetic, so that no floating-point division decides a tie; for
    totals that are not negative.
    """
    units = f"CAST(({total}) * 100 AS HUGEINT) * {10 ** (scale - 2)}"
    return f"CAST((2 * {units} + ({count})) // (2 * ({count})) AS DOUBLE) / 1e{scale}"
