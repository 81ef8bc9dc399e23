"""The insurance entities: keys, raw contracts and typed contracts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from smelter.contracts import ColumnRule, ColumnSpec, Contract, load_contract


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    raw: Contract | None
    typed: Contract
    description: str
    # Whether the batch run looks for keys left on several silver rows.
    audit_keys: bool = False


def _raw(table: str, filled: list[str], may_be_null: list[str]) -> Contract:
    return Contract(
        table,
        tuple(ColumnSpec(c, nullable=False) for c in filled) + tuple(ColumnSpec(c) for c in may_be_null),
    )


def _typed(table: str, *specs: ColumnSpec) -> Contract:
    return Contract(table, specs)


POSITIVE = ColumnRule("greater_than", 0)

# Column names, types, clean-ups and limits that results must match.
POLICIES = Entity(
    "policies",
    "policy_id",
    _raw("bronze_policies", ["policy_id", "customer_id"], ["product_type", "premium", "status", "start_date"]),
    _typed(
        "silver_policies",
        ColumnSpec("policy_id", nullable=False),
        ColumnSpec("customer_id", nullable=False),
        ColumnSpec("product_type", transform="upper_trim"),
        ColumnSpec("premium", "double", nullable=False, rules=(POSITIVE,)),
        ColumnSpec("status", transform="upper_trim"),
        ColumnSpec("start_date", "date"),
    ),
    "Typed, validated policies with history columns",
    audit_keys=True,
)
CLAIMS = Entity(
    "claims",
    "claim_id",
    _raw("bronze_claims", ["claim_id", "policy_id", "claim_amount"], ["claim_date", "claim_status", "claim_type"]),
    _typed(
        "silver_claims",
        ColumnSpec("claim_id", nullable=False),
        ColumnSpec("policy_id", nullable=False),
        ColumnSpec("claim_amount", "double", nullable=False, rules=(POSITIVE,)),
        ColumnSpec("claim_date", "date", nullable=False),
        ColumnSpec("claim_status", transform="upper_trim"),
        ColumnSpec("claim_type", transform="upper_trim"),
    ),
    "Typed, validated claims with history columns",
)
CUSTOMERS = Entity(
    "customers",
    "customer_id",
    _raw("bronze_customers", ["customer_id"], ["age", "gender", "location", "join_date"]),
    _typed(
        "silver_customers",
        ColumnSpec("customer_id", nullable=False),
        ColumnSpec("age", "integer", nullable=False, rules=(POSITIVE, ColumnRule("less_than", 120))),
        ColumnSpec("gender", transform="upper_trim"),
        ColumnSpec("location", transform="trim"),
        ColumnSpec("join_date", "date"),
    ),
    "Typed, validated customers with history columns; holds personal data",
)
AGENTS = Entity(
    "agents",
    "agent_id",
    _raw("bronze_agents", ["agent_id"], ["name", "agent_type", "region", "status"]),
    _typed(
        "silver_agents",
        ColumnSpec("agent_id", nullable=False),
        ColumnSpec("name", transform="trim"),
        ColumnSpec("agent_type", transform="upper_trim"),
        ColumnSpec("region", transform="trim"),
        ColumnSpec("status", transform="upper_trim"),
    ),
    "Typed, validated agents with history columns",
)
REALTIME_CLAIMS = _typed(
    "silver_claims_realtime",
    ColumnSpec("claim_id", nullable=False),
    ColumnSpec("policy_id", nullable=False),
    ColumnSpec("claim_amount", "double", nullable=False, rules=(POSITIVE,)),
    ColumnSpec("claim_status", transform="upper_trim"),
    ColumnSpec("claim_type", transform="upper_trim"),
    ColumnSpec("event_timestamp", "timestamp", nullable=False),
)
# Event field, path in the JSON document, type.
CLAIM_EVENT_FIELDS = (
    ("claim_id", "$.claim_id", "string"),
    ("policy_id", "$.policy_id", "string"),
    ("customer_id", "$.customer_id", "string"),
    ("claim_amount", "$.claim_amount", "decimal"),
    ("claim_status", "$.claim_status", "string"),
    ("event_timestamp", "$.event_timestamp", "timestamp"),
)


def with_contract_files(spark: SparkSession, entity: Entity, folder: str) -> Entity:
    """The entity with the contracts of ``folder`` in place of the built-in ones.

    Files are ``bronze/bronze_<name>.yaml`` and ``silver/silver_<name>.yaml``.
    Without the first, raw data is not checked; the second must exist.
    """
    root = folder.rstrip("/")
    return replace(
        entity,
        raw=load_contract(spark, f"{root}/bronze/bronze_{entity.name}.yaml", on_missing="skip"),
        typed=load_contract(spark, f"{root}/silver/silver_{entity.name}.yaml"),
    )


ENTITIES = {e.name: e for e in (POLICIES, CLAIMS, CUSTOMERS, AGENTS)}
