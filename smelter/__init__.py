"""smelter: raw data in, refined tables out, as plain Spark jobs.

Raw CSV and JSON events become untyped bronze tables with lineage columns,
bronze becomes typed, validated, deduplicated silver, and silver becomes gold
feature tables.  Everything is DataFrame expressions; no Python runs per row.
"""

from smelter.contracts import ColumnRule, ColumnSpec, Contract, load_contract, parse_contract
from smelter.session import Run, build_session, scratch_dir, use_utc

__all__ = [
    "ColumnRule",
    "ColumnSpec",
    "Contract",
    "Run",
    "build_session",
    "load_contract",
    "parse_contract",
    "scratch_dir",
    "use_utc",
]
