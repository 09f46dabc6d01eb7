"""Fixed schemas of the catalog record and the stored row.

The field order is the contract: the text decoder assigns split parts to
fields by position. The JDBC sink appends to an existing table by column
name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The catalog record, in declaration order (14 fields).
CATALOG_SCHEMA = T.StructType([
    T.StructField("satellite", T.StringType()),
    T.StructField("data_url", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("load_info", T.StringType()),
    T.StructField("resolution", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("image_id", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("name_en", T.StringType()),
    T.StructField("band_count", T.IntegerType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("boundary", T.StringType()),
    T.StructField("cloud", T.DoubleType()),
])

# The three constants appended to every stored row.
STORED_CONSTANTS = (
    ("owner", "ADMIN", T.StringType()),
    ("privilege", "PUBLIC", T.StringType()),
    ("has_data", False, T.BooleanType()),
)

STORED_SCHEMA = T.StructType(
    list(CATALOG_SCHEMA.fields)
    + [T.StructField(name, dtype) for name, _, dtype in STORED_CONSTANTS]
)

# Field separator of a catalog line and of extent text.
FIELD_SEPARATOR = ","
EXTENT_SEPARATOR = " "
