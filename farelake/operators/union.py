"""Union frames by column name, widening column types where the frames disagree."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

class CannotUnite(TypeError):
    """Columns of one name whose types have nothing in common."""


_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """Smallest type that holds both: null < integers by size < double; dates < zoneless < zoned times.

    Raises CannotUnite for types that have nothing in common, such as boolean and integer.
    """
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if left in _INTEGERS and right in _INTEGERS:
        return max(left, right, key=_INTEGERS.index)
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return T.DoubleType()
    moments = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(left, moments) and isinstance(right, moments):
        return max(left, right, key=lambda t: moments.index(type(t)))
    raise CannotUnite(f"{left.simpleString()} and {right.simpleString()} have no common type")


def widen(schemas: Sequence[T.StructType]) -> T.StructType:
    """Common schema: names matched without case, spelled and ordered as first seen in `schemas`."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            seen = fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
            try:
                seen.dataType = wider_type(seen.dataType, field.dataType)
            except CannotUnite as error:
                raise CannotUnite(f"column {field.name}: {error}") from None
    return T.StructType(list(fields.values()))


def converted(value: Column, source: T.DataType, target: T.DataType, name: str) -> Column:
    """The value in another type. A double becomes an integer only if it is one; NaN becomes null.

    Any other double stops the query with an error that names the column, the value and the file.
    """
    floating = isinstance(source, (T.DoubleType, T.FloatType))
    if not (floating and isinstance(target, T.IntegralType)):
        return value.cast(target)
    whole = (value == F.floor(value)) & (F.abs(value) <= 2**53)
    message = F.concat(
        F.lit(f"column {name} holds "), value.cast("string"), F.lit(", which is no integer, in "), F.input_file_name()
    )
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(None).cast(target))
        .when(whole, value.try_cast(target))
        .otherwise(F.raise_error(message).cast(target))
    )


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Select `schema` from the frame: cast, respell, and fill missing columns with null."""
    present = {field.name.lower(): field for field in frame.schema}

    def column(field: T.StructField) -> Column:
        source = present.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{source.name}`")
        return converted(value, source.dataType, field.dataType, field.name).alias(field.name)

    return frame.select(*[column(field) for field in schema])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all frames on the widened schema."""
    schema = widen([frame.schema for frame in frames])
    return reduce(DataFrame.unionAll, [conform(frame, schema) for frame in frames])
