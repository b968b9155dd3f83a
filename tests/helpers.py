"""Hand-written trips, and the same rows in the oracle."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

NOON = dt.datetime(2024, 1, 10, 12)

COLUMNS = {
    "VendorID": pa.int64(),
    "tpep_pickup_datetime": pa.timestamp("us"),
    "tpep_dropoff_datetime": pa.timestamp("us"),
    "passenger_count": pa.float64(),
    "trip_distance": pa.float64(),
    "RatecodeID": pa.float64(),
    "store_and_fwd_flag": pa.string(),
    "PULocationID": pa.int64(),
    "DOLocationID": pa.int64(),
    "payment_type": pa.int64(),
    "fare_amount": pa.float64(),
    "extra": pa.float64(),
    "mta_tax": pa.float64(),
    "tip_amount": pa.float64(),
    "tolls_amount": pa.float64(),
    "improvement_surcharge": pa.float64(),
    "total_amount": pa.float64(),
    "congestion_surcharge": pa.float64(),
    "Airport_fee": pa.float64(),
}

USUAL = {
    "VendorID": 1,
    "tpep_pickup_datetime": NOON,
    "tpep_dropoff_datetime": NOON + dt.timedelta(minutes=10),
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "tip_amount": 2.0,
    "total_amount": 13.0,
}


def trip(**changes):
    return {**USUAL, **changes}


def write_trips(rows, path, types=None):
    """Write rows as Parquet; `types` overrides the columns and their types."""
    fields = COLUMNS if types is None else types
    columns = {name: pa.array([r.get(name) for r in rows], t) for name, t in fields.items()}
    pq.write_table(pa.table(columns), path, compression="zstd")
    return str(path)


def sql_rows(sql, **tables):
    """Run SQL in the oracle over Parquet paths given by view name."""
    con = duckdb.connect()
    for name, source in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {source}")
    return con.execute(sql).fetchall()


def same(left, right):
    """Equal rows, NaN equal to itself, order as given."""

    def plain(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return [tuple(map(plain, r)) for r in left] == [tuple(map(plain, r)) for r in right]
