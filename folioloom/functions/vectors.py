"""Vector arithmetic on array<float> columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """v over its length; a zero vector stays zero."""
    return _scaled(v, F.lit(1.0))


def _scaled(v: Column, sign: Column) -> Column:
    # The length is the variable of an outer function, so it is worked out once a vector, not once a component.
    length = F.coalesce(F.nullif(norm(v), F.lit(0.0)), F.lit(1.0))
    return F.transform(F.array(length), lambda n: F.transform(doubles(v), lambda x: x * sign / n))[0]


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is zero, null where either is null."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).when(length.isNotNull(), F.lit(0.0))


def keyed(v: Column, reverse: Column) -> Column:
    """The unit vector, turned round for reverse-keyed rows; null keying counts as not reversed."""
    sign = F.when(F.coalesce(reverse, F.lit(False)), -1.0).otherwise(1.0)
    return _scaled(v, sign)


def literal_vector(values) -> Column:
    return F.array(*(F.lit(float(x)) for x in values))
