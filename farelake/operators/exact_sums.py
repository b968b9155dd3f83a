"""Sums of doubles that are exact before they are rounded, so they are the same for any order of addition.

A plain `sum` rounds after every addition; how rows are dealt to tasks then shows in the last digits.
Here a value x becomes a whole number of units of 2**(16 * c - 54), where c is the class of its
magnitude, and that number is cut into four limbs of 18 bits. Limbs add up as integers, per key and
class, in any order. There are 134 classes at most, and money needs two or three, so after the partial
aggregation a task has a few rows per key. Per key the classes are then carried into each other as digits
to the base 2**16, and the leading ones, with a mark for whether anything follows, are rounded once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a class and of a limb, limbs of a value, and how far the unit lies below the class.
CLASS, LIMB, LIMBS, BELOW = 16, 18, 4, 54
#: Classes that the sum of a class may reach into, and digits that decide how a sum is rounded.
REACH, DIGITS = 8, 6
WIDE = "decimal(38,0)"


def _scaled(value: Column, power: Column) -> Column:
    """value * 2**power, in two steps, neither of which leaves the range of doubles."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _limbs(value: Column, size: Column) -> list[Column]:
    """The limbs of a value of a class, highest first; all but the first are not negative."""
    rest, out = _scaled(value, BELOW - CLASS * size), []
    for place in reversed(range(LIMBS)):
        unit = float(1 << (LIMB * place))
        limb = F.floor(rest / unit)
        out.append(limb.cast("bigint"))
        rest = rest - limb * unit
    return out


def _carried(sums: Column, classes: Column, sign: Column) -> Column:
    """(carry, digits): the digits of the sum from the lowest class on; the carry is -1 below zero."""
    base = F.lit(1 << CLASS)

    def step(state: Column, size: Column) -> Column:
        total = F.coalesce(sums[size], F.lit(0).cast(WIDE)) * sign + state["carry"]

        def split(t: Column) -> Column:
            carry = F.floor(t / base).cast(WIDE)
            return F.struct(
                carry.alias("carry"), F.concat(state["digits"], F.array((t - carry * base).cast("int"))).alias("digits")
            )

        return _bound(total.cast(WIDE), split)

    start = F.struct(F.lit(0).cast(WIDE).alias("carry"), F.array().cast("array<int>").alias("digits"))
    return F.aggregate(classes, start, step)


def _rounded(digits: Column, lowest: Column) -> Column:
    """Digits from the lowest class on as the nearest double."""

    def step(state: Column, digit: Column) -> Column:
        leading = (state["taken"] == 0) & (digit == 0)
        full = state["taken"] == DIGITS
        return F.struct(
            F.when(leading | full, state["held"])
            .otherwise(state["held"] * F.lit(1 << CLASS) + digit)
            .cast(WIDE)
            .alias("held"),
            F.when(leading | full, state["taken"]).otherwise(state["taken"] + 1).alias("taken"),
            F.when(full, state["left"] + 1).otherwise(state["left"]).alias("left"),
            (state["more"] | (full & (digit > 0))).alias("more"),
        )

    start = F.struct(
        F.lit(0).cast(WIDE).alias("held"),
        F.lit(0).alias("taken"),
        F.lit(0).alias("left"),
        F.lit(False).alias("more"),
    )
    found = F.aggregate(F.reverse(digits), start, step)

    def value(f: Column) -> Column:
        # One more bit tells whether anything follows, so a tie is a tie only if nothing does.
        held = (f["held"] * 2 + F.when(f["more"], 1).otherwise(0)).cast(WIDE)
        return _scaled(held.cast("double"), CLASS * (lowest + f["left"]) - BELOW - 1)

    return _bound(found, value)


def exact_sums(frame: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Per key the sum of every value, rounded once, and `<name>_n`, how many there are.

    Null is left out, a key with nothing else has a null sum; NaN, or infinities of both signs, make NaN.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("x")) for n, v in values.items()]))
    long = frame.select(*[F.col(k) for k in keys], each.alias("each")).select(*keys, "each.*")
    endless = F.abs("x") == float("inf")
    plain = F.when(~F.isnan("x") & ~endless & (F.col("x") != 0), F.col("x"))
    sized = long.withColumn("plain", plain).withColumn("size", F.floor(F.log2(F.abs("plain")) / CLASS).cast("int"))
    cut = sized.select("*", *[limb.alias(f"limb{i}") for i, limb in enumerate(_limbs(F.col("plain"), F.col("size")))])
    parts = cut.groupBy(*keys, "name", "size").agg(
        F.count("x").alias("n"),
        F.count_if(F.isnan("x")).alias("nans"),
        F.count_if(F.col("x") == float("inf")).alias("above"),
        F.count_if(F.col("x") == float("-inf")).alias("below"),
        *[F.sum(f"limb{i}").alias(f"limb{i}") for i in range(LIMBS)],
    )
    whole = F.lit(0).cast(WIDE)
    for i in range(LIMBS):
        unit = F.lit(str(1 << (LIMB * (LIMBS - 1 - i)))).cast("decimal(18,0)")
        whole = (whole + (F.col(f"limb{i}").cast("decimal(19,0)") * unit).cast(WIDE)).cast(WIDE)
    entry = F.when(F.col("size").isNotNull(), F.struct("size", whole.alias("sum")))
    met = parts.groupBy(*keys, "name").agg(
        *[F.sum(c).alias(c) for c in ("n", "nans", "above", "below")],
        F.map_from_entries(F.collect_list(entry)).alias("sums"),
        F.min("size").alias("low"),
        F.max("size").alias("high"),
    )
    classes = F.sequence("low", F.col("high") + REACH)
    negative = _carried(F.col("sums"), classes, F.lit(1))["carry"] < 0
    signed = met.withColumn("sign", F.when(negative, -1).otherwise(1))
    digits = _carried(F.col("sums"), classes, F.col("sign"))["digits"]
    total = F.when(F.col("low").isNull(), 0.0).otherwise(F.col("sign") * _rounded(digits, F.col("low")))
    strange = F.when((F.col("nans") > 0) | ((F.col("above") > 0) & (F.col("below") > 0)), float("nan"))
    strange = strange.when(F.col("above") > 0, float("inf")).when(F.col("below") > 0, float("-inf"))
    summed = signed.select(*keys, "name", "n", F.when(F.col("n") > 0, strange.otherwise(total)).alias("total"))
    out = []
    for name in values:
        mine = F.col("name") == name
        out += [F.max(F.when(mine, F.col("total"))).alias(name), F.max(F.when(mine, F.col("n"))).alias(f"{name}_n")]
    return summed.groupBy(*keys).agg(*out)
