"""The event table: one row per event, dimensions in nested structs, parameters in an
array of typed key/value structs, day-sharded by ``table_suffix`` ('YYYYMMDD')."""

from __future__ import annotations

from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ]
)

EVENT_PARAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", PARAM_VALUE),
    ]
)

TRAFFIC_SOURCE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)

GEO = T.StructType([T.StructField("country", T.StringType()), T.StructField("city", T.StringType())])

DEVICE = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("operating_system", T.StringType()),
    ]
)

ECOMMERCE = T.StructType([T.StructField("purchase_revenue", T.DoubleType())])

# Data columns in storage order; ``table_suffix`` is the partition column of the
# directory layout and is appended by Spark when reading.
EVENT_DATA_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("traffic_source", TRAFFIC_SOURCE),
        T.StructField("geo", GEO),
        T.StructField("device", DEVICE),
        T.StructField("ecommerce", ECOMMERCE),
        T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    ]
)

SUFFIX_COLUMN = "table_suffix"

# Full schema as seen by analyses. The suffix is a string on purpose: partition
# discovery would infer 20201101 as an integer and turn the range test numeric.
EVENT_SCHEMA = T.StructType(EVENT_DATA_SCHEMA.fields + [T.StructField(SUFFIX_COLUMN, T.StringType())])
