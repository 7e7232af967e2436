"""Declared schemas of the input and output tables.

Inputs are read with these schemas (no inference: partition columns stay
zero-padded text); outputs are written in this column order.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

PARTITION = [StructField("year", StringType()), StructField("month", StringType()),
             StructField("day", StringType())]

TRACE = StructType([
    StructField("imsi", LongType()),
    StructField("start_timestamp", TimestampNTZType()),
    StructField("end_timestamp", TimestampNTZType()),
    StructField("start_source_cell_id", IntegerType()),
    StructField("end_source_cell_id", IntegerType()),
    *PARTITION,
])

SITE_CELLS = StructType([StructField("source_cell_id", IntegerType())])
AREA_CELLS = StructType([StructField("source_cell_id", IntegerType()), StructField("msoa", StringType())])
RAIL_CELLS = StructType([StructField("cell_id", IntegerType())])
TIME_SERIES = StructType([StructField("ts", StringType())])

_LOAD = [StructField("load_timestamp", TimestampNTZType()), *PARTITION]

DWELLS = StructType([
    StructField("date_dt", DateType()), StructField("user_id", LongType()),
    StructField("first_event", TimestampNTZType()), StructField("last_event", TimestampNTZType()),
    *_LOAD,
])

USERS = StructType([
    StructField("user_id", LongType()), StructField("total_visits", LongType()),
    StructField("total_days", LongType()), StructField("commuters", IntegerType()),
    *_LOAD,
])

ORIGIN_MSOA = StructType([
    StructField("date_dt", DateType()), StructField("user_id", LongType()),
    StructField("first_event", TimestampNTZType()), StructField("last_known_event", TimestampNTZType()),
    StructField("origin_msoa", StringType()),
    *_LOAD,
])

USERS_ATTACHMENT = StructType([
    StructField("date_dt", DateType()), StructField("timeband", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("total_visits", LongType()),
    StructField("commuters", IntegerType()), StructField("first_event", TimestampNTZType()),
    StructField("last_event", TimestampNTZType()), StructField("dwell_time", DoubleType()),
    StructField("rail_trips", IntegerType()), StructField("other_trips", IntegerType()),
    StructField("tube_trips", IntegerType()),
    *_LOAD,
])

OUTPUTS = {"dwells": DWELLS, "users": USERS, "origin_msoa": ORIGIN_MSOA, "users_attachment": USERS_ATTACHMENT}
