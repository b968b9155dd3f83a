"""Persisted tables and text display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save(
    frame: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write zstd Parquet. With `partition_by`, an overwrite replaces only the partitions it holds."""
    writer = frame.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a saved table; a declared schema spares reading any footer."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def double_text(value: Column) -> Column:
    """A double as text, by one rule: the shortest digits, plain for exponents from -4 to 15, as `1e+16` beyond.

    The digits and the exponent are read from Spark's own text, which changes form at other places.
    """
    size = F.abs(value).cast("string")
    parts = F.split(size, "E")
    whole, fraction = F.split(parts[0], r"\.")[0], F.split(parts[0], r"\.")[1]
    shift = F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(0))
    joined = F.concat(whole, fraction)
    leading = F.length(joined) - F.length(F.ltrim(joined, F.lit("0")))
    digits = F.rtrim(F.ltrim(joined, F.lit("0")), F.lit("0"))
    # The value is 0.<digits> times ten to this power.
    point = F.length(whole) + shift - leading
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(
            point >= F.length(digits),
            F.concat(digits, F.repeat(F.lit("0"), point - F.length(digits)), F.lit(".0")),
        )
        .otherwise(
            F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1, F.length(digits)))
        )
    )
    rest = F.substr(digits, F.lit(2), F.length(digits))
    power = F.abs(point - 1).cast("string")
    scientific = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""),
        F.when(point > 0, "e+").otherwise("e-"),
        F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power),
    )
    text = F.when(value == 0, "0.0").when((point > -4) & (point <= 16), plain).otherwise(scientific)
    negative = value.cast("string").startswith("-")
    signed = F.when(negative, F.concat(F.lit("-"), text)).otherwise(text)
    endless = F.when(negative, "-inf").otherwise("inf")
    return F.when(F.isnan(value), "nan").when(F.abs(value) == float("inf"), endless).otherwise(signed)


def display_text(frame: DataFrame) -> DataFrame:
    """All columns as text: null as `-`, booleans as `True` and `False`, doubles as `double_text`."""

    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            shown = double_text(value.cast("double"))
        elif isinstance(field.dataType, T.BooleanType):
            shown = F.initcap(value.cast("string"))
        else:
            shown = value.cast("string")
        return F.coalesce(F.when(value.isNotNull(), shown), F.lit("-")).alias(field.name)

    return frame.select(*[text(field) for field in frame.schema])


def print_table(frame: DataFrame) -> None:
    """Print every row as a text table. Rows come a partition at a time; only widths are found first."""
    shown = display_text(frame)
    names = shown.columns
    found = shown.agg(*[F.max(F.length(f"`{n}`")).alias(f"w{i}") for i, n in enumerate(names)]).first()
    widths = [max(len(name), width or 0) for name, width in zip(names, found, strict=True)]
    rule = "+".join(["", *["-" * (w + 2) for w in widths], ""])

    def line(cells: Sequence[str]) -> str:
        padded = [f" {c.ljust(w)} " for c, w in zip(cells, widths, strict=True)]
        return "|".join(["", *padded, ""])

    print(rule, line(names), rule, sep="\n")
    for row in shown.toLocalIterator():
        print(line(row))
    print(rule)
