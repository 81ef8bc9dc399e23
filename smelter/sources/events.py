"""JSON events to columns by a field mapping."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.contracts import TYPES
from smelter.functions.casts import AMOUNT_TYPE, cast_lenient, ref

# (column, path such as $.claim.id, contract type)
Field = tuple[str, str, str]

_PATH = re.compile(r"\$(\.\w+)+")


def _steps(path: str) -> list[str]:
    if not _PATH.fullmatch(path):
        raise ValueError(f"not a member path: {path!r}")
    return path.split(".")[1:]


def _document_schema(fields: Sequence[Field], leaf_type: T.DataType) -> T.StructType:
    tree: dict = {}
    for _, path, _ in fields:
        *parents, leaf = _steps(path)
        node = tree
        for step in parents:
            node = node.setdefault(step, {})
            if node is None:
                raise ValueError(f"{path}: {step} is mapped as a value too")
        if node.setdefault(leaf, None) is not None:
            raise ValueError(f"{path} is mapped as a parent too")

    def struct(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, leaf_type if v is None else struct(v)) for k, v in node.items()])

    return struct(tree)


def extract_fields(events: DataFrame, fields: Sequence[Field], value: str = "value") -> DataFrame:
    """The mapped fields of each JSON document as strings, other columns kept.

    A path the document lacks gives NULL, an unreadable document a row of NULLs;
    unmapped members are left out.  A JSON number read as text passes through a
    double, so decimal members are read as decimals too, and that value stands
    wherever the text does not say the same.
    """

    def member(document: Column, path: str) -> Column:
        return reduce(lambda node, step: node[step], _steps(path), document)

    # Some sources, Kafka among them, give the document as bytes.
    text = ref(value).cast("string")
    parsed = events.withColumn("__document", F.from_json(text, _document_schema(fields, T.StringType())))
    columns = {name: member(F.col("__document"), path) for name, path, _ in fields}
    decimals = [f for f in fields if f[2] == "decimal"]
    if decimals:
        amount_type = T.DataType.fromDDL(AMOUNT_TYPE)
        exact = F.from_json(text, _document_schema(decimals, amount_type))
        for name, path, _ in decimals:
            value_ = member(exact, path)
            same = value_.isNull() | value_.eqNullSafe(columns[name].try_cast(AMOUNT_TYPE))
            columns[name] = F.when(same, columns[name]).otherwise(value_.cast("string"))
    return parsed.withColumns(columns).drop("__document", *({value} - set(columns)))


def type_fields(events: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The mapped fields with their types; unreadable values become NULL."""
    unknown = sorted({t for _, _, t in fields} - set(TYPES))
    if unknown:
        raise ValueError(f"unknown field types: {unknown}")
    types = {f.name: f.dataType for f in events.schema.fields}
    return events.withColumns({name: cast_lenient(ref(name), kind, types[name]) for name, _, kind in fields})
