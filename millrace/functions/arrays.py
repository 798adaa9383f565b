"""Vector and assignment expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_product(weights: Column, values: Column) -> Column:
    """Sum of products in double; different lengths are an error."""
    total = F.aggregate(
        F.zip_with(weights, values, lambda w, x: w.cast("double") * x.cast("double")),
        F.lit(0.0),
        lambda acc, p: acc + p,
    )
    return F.when(F.size(weights) == F.size(values), total).otherwise(
        F.raise_error(F.lit("vector sizes differ")).cast("double")
    )


def dot_constant(weights: list[float], values: Column) -> Column:
    """Dot product with a fixed weight list, as plain arithmetic in one codegen stage."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.lit(float(w)) * F.get(values, F.lit(i)).cast("double")
    return F.when(F.size(values) == len(weights), total).otherwise(
        F.raise_error(F.lit("vector sizes differ")).cast("double")
    )


def array_slice(values: Column, begin: int, end: int) -> Column:
    """Elements [begin, end), zero-based."""
    return F.slice(values, begin + 1, end - begin)


def array_at(values: Column, index: int | Column) -> Column:
    """Bounds-checked zero-based access."""
    i = F.lit(index) if isinstance(index, int) else index
    return F.when((i >= 0) & (i < F.size(values)), F.get(values, i)).otherwise(
        F.raise_error(F.lit("index out of range")).cast("double")
    )


def label_at(row: Column) -> Column:
    """The label of a (label, features) row."""
    return row.getField("label")


# The assignment operators.
ASSIGN_OPS = ("ASSIGN", "PLUS", "MINUS", "TIMES", "DIVIDE", "AND", "OR", "XOR")


def assign(op: str, current: Column, incoming: Column, integers: bool = False) -> Column:
    """``current op= incoming``; the bit operators need integers.

    Integer operands divide with truncation, as an integer ``/=`` does, and a zero divisor is an
    error. ``integers`` says which they are, as an expression doesn't know its type.
    """
    forms = {
        "ASSIGN": lambda: incoming,
        "PLUS": lambda: current + incoming,
        "MINUS": lambda: current - incoming,
        "TIMES": lambda: current * incoming,
        "DIVIDE": lambda: F.call_function("div", current, incoming) if integers else current / incoming,
        "AND": lambda: current.bitwiseAND(incoming),
        "OR": lambda: current.bitwiseOR(incoming),
        "XOR": lambda: current.bitwiseXOR(incoming),
    }
    if op not in forms:
        raise ValueError(f"unknown assignment {op}")
    return forms[op]()
