"""Declared schemas.

``CALL_RECORD_SCHEMA`` is the call-record table as it is *stored* by the
producer: nullable integers arrive as doubles and timestamps are zone-less.
``sources.files.read_files`` casts each file group to it, so files whose
``id`` is ``bigint`` and files whose ``id`` is ``double`` scan as one table.
"""

from __future__ import annotations

from pyspark.sql import types as T

CALL_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.DoubleType()),
        T.StructField("subscriber_id", T.StringType()),
        T.StructField("sim_card_number", T.StringType()),
        T.StructField("imsi_number", T.StringType()),
        T.StructField("imei_number", T.StringType()),
        T.StructField("service_type", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("roaming_status", T.BooleanType()),
        T.StructField("caller_number", T.StringType()),
        T.StructField("receiver_number", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("cell_tower_id", T.StringType()),
        T.StructField("location_latitude", T.DoubleType()),
        T.StructField("location_longitude", T.DoubleType()),
        T.StructField("location_area_code", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("network_type", T.StringType()),
        T.StructField("network_provider", T.StringType()),
        T.StructField("signal_strength_dbm", T.DoubleType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("call_type", T.StringType()),
        T.StructField("call_start_time", T.TimestampNTZType()),
        T.StructField("call_end_time", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("call_duration_seconds", T.DoubleType()),
        T.StructField("message_content", T.StringType()),
        T.StructField("message_length", T.DoubleType()),
    ]
)

SALES_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType(), False),
        T.StructField("Order_Date", T.DateType()),
        T.StructField("Ship_Date", T.DateType()),
        T.StructField("Ship_Mode", T.StringType()),
        T.StructField("Postal_Code", T.StringType()),
        T.StructField("Region", T.StringType()),
        T.StructField("Product_Reference", T.StringType()),
        T.StructField("Category", T.StringType()),
        T.StructField("Sub_Category", T.StringType()),
        T.StructField("Sales", T.DoubleType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("Profit", T.DoubleType()),
        T.StructField("State", T.StringType()),
    ]
)
