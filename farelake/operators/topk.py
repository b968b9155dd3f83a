"""The most frequent of very many keys, without moving every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.operators.aggregates import group_count, top_by_count

#: Buckets that keys are hashed to; as many numbers reach the driver.
BUCKETS = 1 << 14


def top_keys(
    rows: DataFrame, key: Column, name: str, limit: int, keep_missing: bool = True, buckets: int = BUCKETS
) -> DataFrame:
    """`name` and `n` of the `limit` most frequent keys, as counting all of them gives; ties by key, nulls last.

    1. Rows are counted per hash bucket of their key: a bound from above on every key in it. A task moves
       `buckets` rows at most, however many keys it has.
    2. The keys of the fullest buckets are counted. The `limit`-th of those counts is a bound from below on
       what a winner has.
    3. Only keys in buckets that reach that bound are counted for the result.

    So the rows are read three times, one column each, and of the rare keys none is moved that does not
    share a bucket with a frequent one. Where frequencies hardly differ, most buckets reach the bound and
    all keys are counted, as plainly.
    """
    keyed = rows.select(key.alias(name))
    if not keep_missing:
        keyed = keyed.dropna(subset=[name])
    bucket = F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")
    sizes = [(r.bucket, r.n) for r in keyed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()]

    def counted(wanted: list[int]) -> DataFrame:
        some = keyed if len(wanted) == len(sizes) else keyed.where(bucket.isin(wanted))
        return top_by_count(group_count(some, F.col(name), name), "n", [name], limit)

    fullest = sorted(sizes, key=lambda size: -size[1])[:limit]
    found = counted([b for b, _ in fullest]).collect()
    bar = found[limit - 1].n if len(found) >= limit else 0
    return counted([b for b, n in sizes if n >= bar])
