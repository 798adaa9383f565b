"""The fixed set of comparisons, with type checks."""

from __future__ import annotations

import datetime
import decimal
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Op(Enum):
    """Comparison operators by symbol; the position is the integer code (fixed values)."""

    EQUALS = "="
    GREATER_THAN = ">"
    LESS_THAN = "<"
    LESS_THAN_OR_EQ = "<="
    GREATER_THAN_OR_EQ = ">="
    LIKE = "LIKE"
    NOT_EQUALS = "<>"

    @classmethod
    def of(cls, op: "Op | str | int") -> "Op":
        if isinstance(op, Op):
            return op
        if isinstance(op, int):
            return list(cls)[op]
        return cls(op)


def family(dtype: T.DataType) -> str:
    """Types of one family may be compared; others never are."""
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return dtype.simpleString()


def _family_of_constant(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float, decimal.Decimal)):
        return "number"
    if isinstance(value, str):
        return "string"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return "time"
    return type(value).__name__


def column_name(df: DataFrame, field: str | int) -> str:
    """A field by name, or by position."""
    if isinstance(field, int):
        if not 0 <= field < len(df.columns):
            raise IndexError(f"no field {field}")
        return df.columns[field]
    if field not in df.columns:
        raise KeyError(f"no field {field}")
    return field


def compare(left: Column, op: Op, right: Column, kind: str) -> Column:
    """LIKE is containment on strings and equality on everything else."""
    if op is Op.LIKE:
        return left.contains(right) if kind == "string" else left == right
    return {
        Op.EQUALS: left == right,
        Op.GREATER_THAN: left > right,
        Op.LESS_THAN: left < right,
        Op.LESS_THAN_OR_EQ: left <= right,
        Op.GREATER_THAN_OR_EQ: left >= right,
        Op.NOT_EQUALS: left != right,
    }[op]


def predicate(df: DataFrame, field: str | int, op: Op | str | int, constant) -> Column:
    """``field op constant`` as a Column; mixed types are rejected."""
    name = column_name(df, field)
    kind = family(df.schema[name].dataType)
    other = _family_of_constant(constant)
    if kind != other:
        raise TypeError(f"cannot compare {name} ({kind}) with a {other}")
    return compare(F.col(name), Op.of(op), F.lit(constant), kind)


def field_families(left: DataFrame, lname: str, right: DataFrame, rname: str) -> str:
    """The common family of two join fields; mixed types are rejected."""
    a = family(left.schema[lname].dataType)
    b = family(right.schema[rname].dataType)
    if a != b:
        raise TypeError(f"cannot compare {lname} ({a}) with {rname} ({b})")
    return a
