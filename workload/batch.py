"""Batch queries."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.contracts import ColumnRule, ColumnSpec, Contract
from smelter.entities import AGENTS, CUSTOMERS, POLICIES
from smelter.operators import features, history, monitor, quality
from smelter.operators.conform import conform
from smelter.operators.dedup import duplicate_keys, latest_per_key
from smelter.operators.lineage import add_lineage
from smelter.plans.batch import ingest, run_batch
from smelter.plans.history import merge_history, read_history
from smelter.plans.increments import clean_new, read_silver
from smelter.session import Run, scratch_dir
from smelter.sources import Lake, extract_fields, read_raw_csv, type_fields
from workload.registry import query
from workload.tables import (
    CLAIMS_SQL,
    EVENTS_SQL,
    claim_events,
    exact_average,
    plain_time,
    policies,
    silver_claims,
    silver_claims_with_customer,
    table,
    text,
)

RUN = Run(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc), "00000000-0000-0000-0000-000000000000")
AS_OF = RUN.ts


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- bronze -----------------------------------------------------------------


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, o_orderpriority, 'orders' AS source_system, DATE '2024-01-31' AS ingestion_date,
       TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp,
       '00000000-0000-0000-0000-000000000000' AS process_id, TRUE AS has_source_file
FROM orders
""")
def raw_string_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as raw strings with lineage columns."""
    orders = table(spark, sf_dir, "orders")
    raw = add_lineage(orders, RUN, "orders")
    return raw.select(
        text("o_orderkey").alias("o_orderkey"),
        text("o_custkey").alias("o_custkey"),
        "o_orderstatus",
        "o_orderpriority",
        "source_system",
        "ingestion_date",
        plain_time("ingestion_timestamp"),
        "process_id",
        F.col("source_file_name").contains("orders.parquet").alias("has_source_file"),
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS VARCHAR) AS age, c_mktsegment AS gender,
       c_name AS location, CAST(NULL AS VARCHAR) AS join_date, 'legacy_csv' AS source_system,
       '00000000-0000-0000-0000-000000000000' AS process_id, DATE '2024-01-31' AS ingestion_date,
       TRUE AS is_csv
FROM customer
""")
def csv_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files read as strings, checked, appended by ingestion date, read back."""
    lake = Lake(scratch_dir(spark, "csv-to-bronze"))
    files = lake.path("files", "customers")
    customer_rows(spark, sf_dir).write.option("header", True).csv(files)
    ingest(spark, lake, CUSTOMERS, files, RUN)
    bronze = lake.read(spark, "bronze", "customers", merge_schema=True)
    return bronze.select(
        *["customer_id", "age", "gender", "location", "join_date"],
        *["source_system", "process_id", "ingestion_date"],
        F.col("source_file_name").endswith(".csv").alias("is_csv"),
    )


# Orders with gaps: low priority has no customer, no date if not specified.
def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("policy_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", text("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", text("o_orderdate")).alias("start_date"),
    )


@query("""
SELECT 'policy_id' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS null_count FROM orders
UNION ALL
SELECT 'customer_id', count(*) FILTER (o_custkey IS NULL OR o_orderpriority IS NULL OR o_orderpriority = '5-LOW')
FROM orders
UNION ALL
SELECT 'start_date', count(*) FILTER (o_orderdate IS NULL OR o_orderpriority IS NULL
                                      OR o_orderpriority = '4-NOT SPECIFIED')
FROM orders
""")
def required_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in mandatory columns, all counted in one pass."""
    rules = Contract("orders", tuple(ColumnSpec(c, nullable=False) for c in ("policy_id", "customer_id", "start_date")))
    return quality.null_audit(_gappy(spark, sf_dir), rules)


@query("""
SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'events', count(*) FROM events
""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table; parquet answers from its footers."""
    lineitem, orders, events = (
        quality.row_count(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "row_count")
        for t in ("lineitem", "orders", "events")
    )
    return lineitem.unionByName(orders).unionByName(events)


# --- silver -----------------------------------------------------------------

ODD_TEXT = Contract(
    "odd_text",
    (
        ColumnSpec("order_id", nullable=False),
        ColumnSpec("amount", "double", nullable=False, rules=(ColumnRule("greater_than", 0),)),
        ColumnSpec("units", "integer", rules=(ColumnRule("greater_than", 0), ColumnRule("less_than", 120))),
        ColumnSpec("day", "date"),
        ColumnSpec("sent_at", "timestamp"),
        ColumnSpec("status", transform="upper_trim"),
        ColumnSpec("label", transform="trim"),
        ColumnSpec("not_in_source", "double"),
    ),
)


@query(r"""
WITH raw AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN concat(' ', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), ' ')
             WHEN '2-HIGH' THEN concat('-', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR))
             WHEN '3-MEDIUM' THEN o_orderstatus
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
        CASE o_orderstatus WHEN 'O' THEN concat(CAST(o_custkey AS VARCHAR), '.7')
             WHEN 'F' THEN concat(CAST(o_custkey AS VARCHAR), 'e1')
             ELSE CAST(o_custkey AS VARCHAR) END AS units,
        CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '2024-02-30'
             ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
        CASE o_orderpriority WHEN '5-LOW' THEN o_orderpriority
             ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS sent_at,
        concat('  ', lower(o_orderstatus), ' ') AS status,
        concat('  ', o_orderpriority, ' ') AS label,
        o_orderpriority AS untouched
    FROM orders
), typed AS (
    SELECT order_id, TRY_CAST(trim(amount) AS DOUBLE) AS amount,
        CASE WHEN regexp_full_match(units, '\s*[+-]?(\d+\.?\d*|\.\d+)\s*')
             THEN CAST(trunc(TRY_CAST(units AS DOUBLE)) AS INTEGER) END AS units,
        TRY_CAST(day AS DATE) AS day, TRY_CAST(sent_at AS TIMESTAMP) AS sent_at,
        upper(trim(status)) AS status, trim(label) AS label, CAST(NULL AS DOUBLE) AS not_in_source, untouched
    FROM raw
)
SELECT * FROM typed WHERE order_id IS NOT NULL AND amount IS NOT NULL AND amount > 0 AND units > 0 AND units < 120
""")
def contract_cast_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-up, casts and limits of a contract on text that is partly unreadable."""
    price, buyer = F.col("o_totalprice").cast("decimal(18,2)").cast("string"), text("o_custkey")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), price, F.lit(" ")))
        .when(priority == "2-HIGH", F.concat(F.lit("-"), price))
        .when(priority == "3-MEDIUM", status)
        .otherwise(price)
        .alias("amount"),
        F.when(status == "O", F.concat(buyer, F.lit(".7")))
        .when(status == "F", F.concat(buyer, F.lit("e1")))
        .otherwise(buyer)
        .alias("units"),
        F.when(priority == "4-NOT SPECIFIED", F.lit("2024-02-30"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day"),
        F.when(priority == "5-LOW", priority)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("sent_at"),
        F.concat(F.lit("  "), F.lower(status), F.lit(" ")).alias("status"),
        F.concat(F.lit("  "), priority, F.lit(" ")).alias("label"),
        priority.alias("untouched"),
    )
    return conform(raw, ODD_TEXT).withColumn("sent_at", plain_time("sent_at"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
             l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per key, ties by all other columns."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ("l_shipdate",))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE_RULES = Contract(
    "lines",
    (
        ColumnSpec("l_orderkey", nullable=False),
        ColumnSpec("l_quantity", "double", nullable=False, rules=(ColumnRule("greater_than", 2), ColumnRule("less_than", 49))),
        ColumnSpec("l_shipdate", "date", nullable=False),
    ),
)


@query("""
WITH newest AS (
    SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_quantity DESC NULLS LAST) = 1
), counted AS (
    SELECT (SELECT count(*) FROM lineitem) AS record_count, count(*) AS survivors,
           count(*) FILTER (l_orderkey IS NOT NULL AND l_shipdate IS NOT NULL
                            AND l_quantity > 2 AND l_quantity < 49) AS cleaned_count,
           count(*) FILTER (l_orderkey IS NULL) AS failed_l_orderkey_not_null,
           count(*) FILTER (l_quantity IS NULL) AS failed_l_quantity_not_null,
           count(*) FILTER (NOT coalesce(l_quantity > 2, FALSE)) AS failed_l_quantity_greater_than,
           count(*) FILTER (NOT coalesce(l_quantity < 49, FALSE)) AS failed_l_quantity_less_than,
           count(*) FILTER (l_shipdate IS NULL) AS failed_l_shipdate_not_null
    FROM newest
)
SELECT record_count, record_count - survivors AS duplicate_count, survivors - cleaned_count AS invalid_count,
       cleaned_count, failed_l_orderkey_not_null, failed_l_quantity_not_null, failed_l_quantity_greater_than,
       failed_l_quantity_less_than, failed_l_shipdate_not_null, record_count - cleaned_count AS dropped_count,
       CASE WHEN record_count > 0 THEN CAST(cleaned_count AS DOUBLE) / CAST(record_count AS DOUBLE) * 100
            ELSE 0 END AS pass_rate
FROM counted
""")
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of cleaning, from one scan and one shuffle."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return quality.dq_metrics(lines, LINE_RULES, ["l_orderkey", "l_linenumber"], ("l_shipdate",))


@query(f"""
WITH {CLAIMS_SQL}
SELECT claim_id, policy_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_date, claim_status,
       CAST(NULL AS VARCHAR) AS claim_type
FROM silver_claims
""")
def claims_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = silver_claims(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    return as_doubles(typed, "claim_amount")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(NULL AS VARCHAR) AS product_type, CAST(o_totalprice AS DOUBLE) AS premium,
       upper(trim(o_orderstatus)) AS status, CAST(o_orderdate AS DATE) AS start_date
FROM orders
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_totalprice > 0
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST) = 1
""")
def policies_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(policies(spark, sf_dir), "policy_id", ("start_date",))
    return conform(newest, POLICIES.typed)


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw strings; the nation number stands for the age."""
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("customer_id"),
        text("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_name").alias("location"),
        F.lit(None).cast("string").alias("join_date"),
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS INTEGER) AS age,
       upper(trim(c_mktsegment)) AS gender, trim(c_name) AS location, CAST(NULL AS DATE) AS join_date
FROM customer
WHERE c_custkey IS NOT NULL AND c_nationkey > 0 AND c_nationkey < 120
""")
def customers_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(latest_per_key(customer_rows(spark, sf_dir), "customer_id"), CUSTOMERS.typed)


def agent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as agents with their nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            text("s_suppkey").alias("agent_id"),
            F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("name"),
            F.lower("n_name").alias("agent_type"),
            F.concat("r_name", F.lit("  ")).alias("region"),
            F.when(F.col("s_acctbal") > 0, " active").otherwise("on_leave").alias("status"),
        )
    )


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS agent_id, s_name AS name, upper(n_name) AS agent_type, r_name AS region,
       CASE WHEN s_acctbal > 0 THEN 'ACTIVE' ELSE 'ON_LEAVE' END AS status
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def agents_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(latest_per_key(agent_rows(spark, sf_dir), "agent_id"), AGENTS.typed)


# --- gold -------------------------------------------------------------------


@query(f"""
WITH {CLAIMS_SQL}
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(claim_id) AS total_claims,
       CAST(sum(claim_amount) AS DOUBLE) AS total_claim_amount,
       {exact_average('sum(claim_amount)', 'count(claim_amount)', 6)} AS avg_claim_amount,
       CAST(max(claim_amount) AS DOUBLE) AS max_claim_amount
FROM silver_claims JOIN orders ON o_orderkey = l_orderkey
GROUP BY o_custkey
""")
def claims_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, typed, valid claims summed up per customer."""
    gold = features.claims_features(silver_claims_with_customer(spark, sf_dir))
    return as_doubles(gold, "total_claim_amount", "avg_claim_amount", "max_claim_amount")


@query(f"""
WITH per_customer AS (
    SELECT owner, count(o_orderkey) AS n, count(*) FILTER (o_orderstatus = 'O') AS active,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
    FROM (SELECT *, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS owner FROM orders)
    GROUP BY owner
)
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(trim(c_mktsegment)) AS segment, c_acctbal AS balance,
       coalesce(n, 0) AS total_policies, coalesce(active, 0) AS active_policies,
       coalesce({exact_average('total', 'n', 6)}, 0) AS avg_premium,
       coalesce(CAST(total AS DOUBLE), 0) AS total_premium
FROM customer LEFT JOIN per_customer ON c_custkey = owner
WHERE c_custkey IS NOT NULL AND c_acctbal > 0
""")
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid customers with policy features, 0 where they have none.

    Orders of every tenth customer stand for policies that nobody owns.
    """
    rules = Contract(
        "customers",
        (
            ColumnSpec("customer_id", nullable=False),
            ColumnSpec("segment", transform="upper_trim"),
            ColumnSpec("balance", "double", rules=(ColumnRule("greater_than", 0),)),
        ),
    )
    customers = table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    owned = F.when(F.col("customer_id").cast("long") % 10 != 0, F.col("customer_id"))
    known = policies(spark, sf_dir).withColumn("customer_id", owned)
    gold = features.customer_features(conform(customers, rules), features.policy_features(known, active="O"))
    return as_doubles(gold, "avg_premium", "total_premium")


def _risk_sql(key: str, tiers: tuple, per_claim: int) -> str:
    points = " ".join(f"WHEN total > {floor} THEN {p}" for floor, p in tiers)
    return f"""
WITH {CLAIMS_SQL}, per_key AS (
    SELECT {key}, count(claim_id) AS n, sum(claim_amount) AS total, max(claim_amount) AS biggest,
           {exact_average('sum(claim_amount)', 'count(claim_amount)', 6)} AS mean
    FROM silver_claims JOIN orders ON o_orderkey = l_orderkey GROUP BY {key}
)
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS premium, o_orderstatus AS status,
       o_orderdate AS start_date, n AS total_claims, CAST(total AS DOUBLE) AS total_claim_amount,
       mean AS avg_claim_amount, CAST(biggest AS DOUBLE) AS max_claim_amount,
       CAST(least(100, 30 + {per_claim} * coalesce(n, 0) + CASE {points} ELSE 0 END) AS DOUBLE) AS overall_risk_score
FROM orders LEFT JOIN per_key USING ({key})
"""


def _risk(spark: SparkSession, sf_dir: str, claims: DataFrame, key: str, **score) -> DataFrame:
    per_key = features.claims_features(claims, by=key)
    scored = features.risk_features(policies(spark, sf_dir), per_key, on=key, **score)
    return as_doubles(scored, "premium", "total_claim_amount", "avg_claim_amount", "max_claim_amount")


@query(_risk_sql("o_orderkey", ((50000, 40), (10000, 20)), 10))
def risk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies scored by the claims on them."""
    return _risk(spark, sf_dir, silver_claims(spark, sf_dir), "policy_id")


@query(_risk_sql("o_orderkey", ((200000, 40), (100000, 20)), 5))
def risk_features_wide_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with limits that spread the scores."""
    claims = silver_claims(spark, sf_dir)
    return _risk(spark, sf_dir, claims, "policy_id", per_claim=5, tiers=((200000, 40), (100000, 20)))


@query(_risk_sql("o_custkey", ((2500000, 40), (2000000, 20)), 1))
def risk_features_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies scored by all claims of their customer."""
    claims = silver_claims_with_customer(spark, sf_dir)
    return _risk(spark, sf_dir, claims, "customer_id", per_claim=1, tiers=((2500000, 40), (2000000, 20)))


@query(_risk_sql("o_custkey", ((2500000, 40), (2000000, 20)), 1))
def risk_features_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with customers cut into pieces as if they were too large for one task."""
    claims = silver_claims_with_customer(spark, sf_dir)
    tiers = ((2500000, 40), (2000000, 20))
    return _risk(spark, sf_dir, claims, "customer_id", rows_per_piece=8, per_claim=1, tiers=tiers)


_MONTHLY_SQL = f"""
WITH {CLAIMS_SQL}
SELECT CAST(date_trunc('month', claim_date) AS TIMESTAMP) AS claim_year_month,
       CAST(year(claim_date) AS INTEGER) AS claim_year, CAST(month(claim_date) AS INTEGER) AS claim_month,
       count(claim_id) AS total_claims, CAST(sum(claim_amount) AS DOUBLE) AS total_claim_amount,
       {exact_average('sum(claim_amount)', 'count(claim_amount)', 6)} AS avg_claim_amount,
       CAST(max(claim_amount) AS DOUBLE) AS max_claim_amount, CAST(min(claim_amount) AS DOUBLE) AS min_claim_amount,
       count(claim_id) AS claim_count
FROM silver_claims
GROUP BY 1, 2, 3
ORDER BY 1
"""


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = silver_claims(spark, sf_dir).withColumn("ingestion_timestamp", RUN.ts_column)
    return features.monthly_summary(history.stamp_current(claims))


def _monthly_output(summary: DataFrame) -> DataFrame:
    measures = [f"{m}_claim_amount" for m in ("total", "avg", "max", "min")]
    return as_doubles(summary, *measures).withColumn("claim_year_month", plain_time("claim_year_month"))


@query(_MONTHLY_SQL)
def monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current claims per month, in order."""
    return _monthly_output(_monthly(spark, sf_dir))


@query(_MONTHLY_SQL + "LIMIT 5")
def monthly_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five months."""
    return _monthly_output(features.preview(_monthly(spark, sf_dir)))


# --- history ----------------------------------------------------------------

_HISTORY_SQL = """
WITH versions AS (
    SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus FROM lineitem
    WHERE l_shipdate IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate
                               ORDER BY l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
), changed AS (
    SELECT * FROM versions
    WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate)
    QUALIFY row_number() OVER w = 1
         OR l_returnflag IS DISTINCT FROM lag(l_returnflag) OVER w
         OR l_linestatus IS DISTINCT FROM lag(l_linestatus) OVER w
), history AS (
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate AS effective_from,
           lead(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate) AS effective_to
    FROM changed
)
SELECT *, effective_to IS NULL AS is_current FROM history
"""


def _line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp"), "l_returnflag", "l_linestatus"
    )
    return history.build_history(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def _history_output(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        plain_time("effective_from"), plain_time("effective_to"), "is_current",
    )


@query(_HISTORY_SQL)
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version intervals of every order line."""
    return _history_output(_line_history(spark, sf_dir))


@query(_HISTORY_SQL + "WHERE effective_to IS NULL")
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_output(history.current_rows(_line_history(spark, sf_dir)))


@query(_HISTORY_SQL + """
WHERE effective_from <= TIMESTAMP '1998-06-01 00:00:00'
  AND (effective_to IS NULL OR effective_to > TIMESTAMP '1998-06-01 00:00:00')
""")
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every order line on a day."""
    return _history_output(history.as_of(_line_history(spark, sf_dir), "1998-06-01 00:00:00"))


@query(_HISTORY_SQL)
def scd2_history_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of order lines merged from three batches that each hold versions of all times."""
    lake = Lake(scratch_dir(spark, "history"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp"), "l_returnflag", "l_linestatus", "l_suppkey"
    )
    for batch_id in range(3):
        batch = lines.where(F.pmod("l_suppkey", F.lit(3)) == (batch_id * 2) % 3).drop("l_suppkey")
        merge_history(
            spark, lake, "silver", "lines", batch, batch_id, ["l_orderkey", "l_linenumber"], "l_shipdate", buckets=16
        )
    return _history_output(read_history(spark, lake, "silver", "lines"))


_USERS_SQL = """
WITH changed AS (
    SELECT user_id, ts, event_type FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    QUALIFY row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w
)
SELECT user_id, event_type, ts AS effective_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS effective_to,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
FROM changed
"""


@query(_USERS_SQL)
def scd2_history_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version intervals where single keys have long histories."""
    return _user_history(spark, sf_dir)


@query(_USERS_SQL)
def scd2_history_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with users cut into time ranges as if they were too large for one task."""
    return _user_history(spark, sf_dir, rows_per_piece=30)


def _user_history(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp"), "event_type")
    versions = history.build_history(events, "user_id", "ts", **how)
    return versions.select(
        "user_id", "event_type", plain_time("effective_from"), plain_time("effective_to"), "is_current"
    )


# --- events -----------------------------------------------------------------

HOURLY_SELECT = f"""
SELECT customer_id, date_trunc('hour', event_timestamp) AS event_timestamp, count(*) AS claims_count,
       CAST(sum(claim_amount) AS DOUBLE) AS total_amount,
       {exact_average('sum(claim_amount)', 'count(claim_amount)', 12)} AS avg_amount,
       CAST(max(claim_amount) AS DOUBLE) AS max_amount
FROM claim_events
"""
HOURLY_SQL = f"WITH {EVENTS_SQL} {HOURLY_SELECT} GROUP BY 1, 2"
HOURLY_7D_SQL = HOURLY_SQL + " HAVING date_trunc('hour', event_timestamp) > TIMESTAMP '2024-01-24 00:00:00'"


def hourly_output(hourly: DataFrame) -> DataFrame:
    return as_doubles(hourly, "total_amount", "avg_amount", "max_amount").withColumn(
        "event_timestamp", plain_time("event_timestamp")
    )


@query(HOURLY_SQL)
def hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per customer and hour."""
    return hourly_output(monitor.hourly_claims(claim_events(table(spark, sf_dir, "events"))))


@query(f"""
WITH {EVENTS_SQL}
SELECT event_timestamp, claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_status
FROM claim_events
WHERE claim_amount > 100 AND event_timestamp > TIMESTAMP '2024-01-30 00:00:00'
ORDER BY claim_amount DESC
""")
def high_value_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large events of the last day, largest first."""
    events = claim_events(table(spark, sf_dir, "events"))
    alerts = monitor.high_value_alerts(events, AS_OF, threshold=100, back=dt.timedelta(days=1))
    return as_doubles(alerts, "claim_amount").withColumn("event_timestamp", plain_time("event_timestamp"))


@query(f"""
WITH {EVENTS_SQL}
SELECT claim_status, count(*) AS count_ FROM claim_events
WHERE event_timestamp > TIMESTAMP '2024-01-30 00:00:00' GROUP BY claim_status
""")
def status_counts_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.status_counts(claim_events(table(spark, sf_dir, "events")), AS_OF)


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k_text, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_whole, CAST(NULL AS VARCHAR) AS absent
FROM events
""")
def event_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a JSON document by path; an absent path gives NULL."""
    fields = (("k_text", "$.k", "string"), ("k", "$.k", "double"), ("k_whole", "$.k", "integer"),
              ("absent", "$.no.such", "string"))
    return type_fields(
        extract_fields(table(spark, sf_dir, "events").select("event_id", "props"), fields, value="props"), fields
    )


LONG_AMOUNT = """concat(l_orderkey % 9 + 1, lpad(l_partkey, 7, '0'), lpad(l_suppkey, 7, '0'), '.',
    lpad(l_orderkey % 10000000, 7, '0'), l_linenumber % 9 + 1)"""


@query(f"""
SELECT l_orderkey, l_linenumber, CAST(CAST({LONG_AMOUNT.replace('lpad(l_partkey', 'lpad(CAST(l_partkey AS VARCHAR)')
       .replace('lpad(l_suppkey', 'lpad(CAST(l_suppkey AS VARCHAR)')
       .replace('lpad(l_orderkey % 10000000', 'lpad(CAST(l_orderkey % 10000000 AS VARCHAR)')}
       AS DECIMAL(28,8)) AS VARCHAR) AS amount
FROM lineitem
""")
def event_decimal_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of 15 digits before the point and 8 after it, bare and quoted, come out of JSON exactly."""
    quote = F.when(F.col("l_linenumber") % 2 == 0, '"').otherwise("")
    document = F.concat(F.lit('{"claim": {"amount": '), quote, F.expr(LONG_AMOUNT), quote, F.lit("}}"))
    events = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", document.alias("value"))
    fields = (("amount", "$.claim.amount", "decimal"),)
    typed = type_fields(extract_fields(events, fields), fields)
    return typed.withColumn("amount", F.col("amount").cast("decimal(28,8)").cast("string"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_acctbal AS VARCHAR) AS balance,
       CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS segment
FROM customer
""")
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with their columns in another order, or one column more, keep every value under its name."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", text("c_custkey").alias("customer_id"), text("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    folder = scratch_dir(spark, "mixed-csv")
    for part, columns in enumerate((["customer_id", "balance"], ["balance", "customer_id"], ["segment", "customer_id", "balance"])):
        rows.where(F.col("c_custkey") % 3 == part).select(*columns).write.option("header", True).csv(f"{folder}/{part}")
    return read_raw_csv(spark, [f"{folder}/{part}" for part in range(3)]).select("customer_id", "balance", "segment")


# --- whole flow -------------------------------------------------------------


def raw_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables as raw files of the four entities."""
    orders = table(spark, sf_dir, "orders")
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return {
        "policies": policies(spark, sf_dir).select(
            "policy_id", "customer_id", F.lit("order").alias("product_type"), "premium", "status",
            F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        ),
        "claims": table(spark, sf_dir, "lineitem").join(owner, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("claim_date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("claim_amount"),
            F.col("l_returnflag").alias("claim_status"),
            F.lit("line").alias("claim_type"),
        ),
        "customers": customer_rows(spark, sf_dir),
        "agents": agent_rows(spark, sf_dir),
    }


@query(f"""
WITH lines AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS claim_id, o_custkey, l_shipdate,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
), claims AS (
    SELECT * FROM (
        SELECT * FROM lines
        QUALIFY row_number() OVER (PARTITION BY claim_id
            ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC NULLS LAST, CAST(amount AS VARCHAR) DESC NULLS LAST,
                     l_returnflag DESC NULLS LAST) = 1)
    WHERE amount > 0
), per_customer AS (
    SELECT o_custkey, count(*) AS n, sum(amount) AS total FROM claims GROUP BY o_custkey
), customers AS (
    SELECT c_custkey FROM customer WHERE c_nationkey > 0 AND c_nationkey < 120
)
SELECT 'claims_features' AS table_name, count(*) AS row_count, CAST(sum(n) AS BIGINT) AS items,
       round(CAST(sum(total) AS DOUBLE), 2) AS amount FROM per_customer
UNION ALL
SELECT 'customer_features', count(DISTINCT c_custkey), count(o_orderkey),
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2)
FROM customers LEFT JOIN orders ON c_custkey = o_custkey
UNION ALL
SELECT 'risk_features', count(*), CAST(sum(n) AS BIGINT),
       round(CAST(sum(least(100, 30 + 10 * coalesce(n, 0)
           + CASE WHEN total > 50000 THEN 40 WHEN total > 10000 THEN 20 ELSE 0 END)) AS DOUBLE), 2)
FROM orders LEFT JOIN per_customer USING (o_custkey)
UNION ALL
SELECT 'monthly_claims_summary', count(DISTINCT date_trunc('month', l_shipdate)), count(*),
       round(CAST(sum(amount) AS DOUBLE), 2) FROM claims
UNION ALL
SELECT 'agents', count(*), count(DISTINCT n_name), CAST(0 AS DOUBLE)
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def medallion_batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of all entities through bronze, silver and gold; totals of what came out."""
    lake = Lake(scratch_dir(spark, "batch-run"))
    raw = raw_entities(spark, sf_dir)
    sources = {name: lake.path("files", name) for name in raw}
    with ThreadPoolExecutor(len(raw)) as pool:
        list(pool.map(lambda name: raw[name].write.option("header", True).csv(sources[name], compression="gzip"), raw))
    run_batch(spark, lake, sources, RUN)

    def totals(layer: str, name: str, items, amount) -> DataFrame:
        return lake.read(spark, layer, name).agg(
            F.count(F.lit(1)).alias("row_count"), items.cast("long").alias("items"), F.round(amount, 2).alias("amount")
        ).select(F.lit(name).alias("table_name"), "row_count", "items", "amount")

    claims = totals("gold", "claims_features", F.sum("total_claims"), F.sum("total_claim_amount"))
    customers = totals("gold", "customer_features", F.sum("total_policies"), F.sum("total_premium"))
    risk = totals("gold", "risk_features", F.sum("total_claims"), F.sum("overall_risk_score"))
    monthly = totals("gold", "monthly_claims_summary", F.sum("total_claims"), F.sum("total_claim_amount"))
    agents = totals("silver", "agents", F.count_distinct("agent_type"), F.lit(0.0))
    return claims.unionByName(customers).unionByName(risk).unionByName(monthly).unionByName(agents)


NEXT_RUN = Run(RUN.ts + dt.timedelta(days=1), "00000000-0000-0000-0000-000000000001")


@query("""
WITH newest AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS premium,
           CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-31 00:00:00' END AS since
    FROM orders
    WHERE o_orderkey % 15 <> 0
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey DESC, o_totalprice DESC, o_orderstatus DESC, o_orderdate DESC) = 1
)
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(premium AS DOUBLE) AS premium,
       upper(trim(o_orderstatus)) AS status, CAST(o_orderdate AS DATE) AS start_date, since AS effective_from
FROM newest WHERE premium > 0
""")
def policies_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies arrive in two files of one day and one of the next, which replaces a third of them, some by invalid rows."""
    lake = Lake(scratch_dir(spark, "increments"))
    rows = policies(spark, sf_dir).select(
        "policy_id", "customer_id", F.lit("order").alias("product_type"), "premium", "status",
        F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
    )
    part = F.col("policy_id").cast("long") % 3
    replaced = F.when(F.col("policy_id").cast("long") % 5 == 0, F.lit(-1)).otherwise(F.col("premium") + 1)
    arriving = [
        (rows.where(part < 2), RUN),
        (rows.where(part == 2), RUN),
        (rows.where(part == 0).withColumn("premium", replaced), NEXT_RUN),
    ]
    for i, (files, run) in enumerate(arriving):
        files.write.option("header", True).csv(f"{lake.root}/files/{i}")
        ingest(spark, lake, POLICIES, f"{lake.root}/files/{i}", run)
        clean_new(spark, lake, POLICIES, run, buckets=8)
    silver = read_silver(spark, lake, "policies")
    return silver.select("policy_id", "customer_id", "premium", "status", "start_date", plain_time("effective_from"))


@query("""
WITH claims AS (
    SELECT * FROM (
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS claim_id, o_custkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC NULLS LAST, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) DESC NULLS LAST,
                     l_returnflag DESC NULLS LAST) = 1)
    WHERE amount > 0
), per_customer AS (
    SELECT o_custkey, count(*) AS n, sum(amount) AS total FROM claims GROUP BY o_custkey
)
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_totalprice AS DOUBLE) AS premium,
       coalesce(n, 0) AS total_claims, round(CAST(coalesce(total, 0) AS DOUBLE), 2) AS total_claim_amount,
       CAST(least(100, 30 + 10 * coalesce(n, 0) + CASE WHEN total > 50000 THEN 40 WHEN total > 10000 THEN 20 ELSE 0 END) AS DOUBLE)
           AS overall_risk_score
FROM orders LEFT JOIN per_customer USING (o_custkey)
""")
def batch_run_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs, each with half of the files, the second on top of the first one's silver; all gold risk rows."""
    lake = Lake(scratch_dir(spark, "batch-increments"))
    raw = raw_entities(spark, sf_dir)
    # Halves by the last digit of the policy, the customer or the agent.
    keys = {"policies": "policy_id", "claims": "policy_id", "customers": "customer_id", "agents": "agent_id"}
    for half, run in enumerate((RUN, NEXT_RUN)):
        sources = {name: f"{lake.root}/files/{half}/{name}" for name in raw}
        for name, rows in raw.items():
            mine = F.crc32(F.col(keys[name]).cast("string")) % 2 == half
            rows.where(mine).write.option("header", True).csv(sources[name])
        run_batch(spark, lake, sources, run, incremental=True, buckets=4)
    risk = lake.read(spark, "gold", "risk_features")
    return risk.select(
        "policy_id", "customer_id", "premium", F.col("total_claims").cast("long").alias("total_claims"),
        F.round("total_claim_amount", 2).alias("total_claim_amount"), "overall_risk_score",
    )
