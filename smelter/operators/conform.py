"""Apply a typed contract: clean up, cast, and keep the rows that pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.contracts import ColumnSpec, Contract
from smelter.functions.casts import cast_lenient, ref

_TRANSFORMS = {
    "trim": F.trim,
    "upper_trim": lambda c: F.upper(F.trim(c)),
}
_RULES = {
    "greater_than": lambda c, v: c > F.lit(v),
    "less_than": lambda c, v: c < F.lit(v),
}


@dataclass(frozen=True)
class Compiled:
    """A contract as expressions: new column values, and named row checks on them."""

    columns: dict[str, Column]
    checks: dict[str, Column]

    @property
    def passes(self) -> Column:
        """True where every check holds; a check on NULL does not hold."""
        return reduce(Column.__and__, self.checks.values(), F.lit(True))


def _value(spec: ColumnSpec, field: T.StructField | None) -> Column:
    if field is None:
        return cast_lenient(F.lit(None).cast("string"), spec.type, T.StringType())
    value, source = ref(field.name), field.dataType
    if spec.transform:
        value, source = _TRANSFORMS[spec.transform](value), T.StringType()
    return cast_lenient(value, spec.type, source)


def compile_contract(contract: Contract, schema: T.StructType) -> Compiled:
    """Expressions for a table of this schema; no job runs.

    A contract column the table lacks becomes a NULL column of its type if it
    may be NULL, and is an error if not.  As in Spark, letter case does not
    distinguish columns.
    """
    present = {f.name.lower(): f for f in schema.fields}
    absent = [c for c in contract.mandatory if c.lower() not in present]
    if absent:
        raise ValueError(f"{contract.table}: mandatory columns are missing: {absent}")
    columns = {s.name: _value(s, present.get(s.name.lower())) for s in contract.columns}
    checks = {}
    for spec in contract.columns:
        if not spec.nullable:
            checks[f"{spec.name}_not_null"] = ref(spec.name).isNotNull()
        for rule in spec.rules:
            checks[f"{spec.name}_{rule.rule}"] = _RULES[rule.rule](ref(spec.name), rule.value)
    return Compiled(columns, checks)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Typed, valid rows of ``df``; columns outside the contract pass through.

    One projection and one filter, whatever the number of columns.
    """
    compiled = compile_contract(contract, df.schema)
    return df.withColumns(compiled.columns).where(compiled.passes)
