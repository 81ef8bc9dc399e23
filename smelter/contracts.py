"""Schema contracts: what a table's columns must be, checked when loaded.

A *raw* contract names the columns that must exist.  A *typed* contract also
gives each column's type, clean-up and limits.  Contracts are small driver-side
values; ``operators.conform`` turns them into column expressions.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

try:
    import yaml
except ImportError:  # contracts can be JSON then
    yaml = None

log = logging.getLogger(__name__)

# The keywords contract files use.
TYPES = ("string", "double", "integer", "date", "timestamp", "decimal")
TRANSFORMS = ("trim", "upper_trim")
RULES = ("greater_than", "less_than")


@dataclass(frozen=True)
class ColumnRule:
    """A limit on a column's value; a NULL value does not meet it."""

    rule: str
    value: float

    def __post_init__(self) -> None:
        if self.rule not in RULES:
            raise ValueError(f"unknown rule {self.rule!r}; known: {RULES}")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    transform: str | None = None
    rules: tuple[ColumnRule, ...] = ()

    def __post_init__(self) -> None:
        if self.type not in TYPES:
            raise ValueError(f"column {self.name}: unknown type {self.type!r}; known: {TYPES}")
        if self.transform is not None and self.transform not in TRANSFORMS:
            raise ValueError(f"column {self.name}: unknown transformation {self.transform!r}; known: {TRANSFORMS}")


@dataclass(frozen=True)
class Contract:
    """Columns of one table, in order."""

    table: str
    columns: tuple[ColumnSpec, ...]

    def __post_init__(self) -> None:
        names = self.names
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"contract {self.table}: columns named twice: {twice}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def mandatory(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


def _mandatory_key(entry: Mapping, key: str):
    if key not in entry:
        raise ValueError(f"column {entry.get('name')}: {key!r} is missing")
    return entry[key]


def _business(entry: Mapping) -> ColumnSpec:
    rules = tuple(ColumnRule(r["rule"], r["value"]) for r in entry.get("validation", ()))
    return ColumnSpec(
        name=entry["name"],
        type=_mandatory_key(entry, "type"),
        nullable=_mandatory_key(entry, "nullable"),
        transform=entry.get("transformation"),
        rules=rules,
    )


def _event(entry: Mapping) -> ColumnSpec:
    surplus = {"transformation", "validation"} & set(entry)
    if surplus:
        raise ValueError(f"event column {entry['name']} takes no {sorted(surplus)}")
    return ColumnSpec(entry["name"], _mandatory_key(entry, "type"), entry.get("nullable", True))


def _required(entry: Mapping) -> ColumnSpec:
    return ColumnSpec(entry["name"], nullable=_mandatory_key(entry, "nullable"))


def parse_contract(doc: Mapping) -> Contract:
    """Contract from a parsed file.

    ``required_columns`` make a raw contract; ``business_columns`` and
    ``event_columns`` a typed one.  Other keys are documentation.
    """
    if "required_columns" in doc:
        specs: Iterable[ColumnSpec] = map(_required, doc["required_columns"])
    elif "business_columns" in doc:
        specs = [*map(_business, doc["business_columns"]), *map(_event, doc.get("event_columns", ()))]
    else:
        raise ValueError("a contract needs required_columns or business_columns")
    return Contract(doc.get("table_name", "table"), tuple(specs))


def load_contract(spark: SparkSession, path: str, on_missing: str = "error") -> Contract | None:
    """Contract file (YAML or JSON) from any storage Spark can read.

    ``on_missing="skip"`` returns None for an absent file, so that raw ingestion
    can go on unchecked; typed tables want ``"error"``.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing is 'error' or 'skip'")
    try:
        found = [r[0] for r in spark.read.text(path, wholetext=True).take(2)]
        if len(found) > 1:
            raise ValueError(f"{path} is a folder of files, not one contract")
        text = (found or [""])[0]
    except AnalysisException as exc:
        if on_missing == "skip" and exc.getCondition() == "PATH_NOT_FOUND":
            log.warning("no contract at %s, not checked", path)
            return None
        raise
    doc = yaml.safe_load(text) if yaml is not None else json.loads(text)
    if not isinstance(doc, Mapping):
        raise ValueError(f"{path} is not a contract")
    return parse_contract(doc)
