"""Typed decode of delimited catalog lines, generated from a StructType.

Semantics kept from the original loader:

* a line splits into exactly ``len(schema)`` parts or the whole record
  defaults (strings NULL, numbers 0, booleans false);
* fields are assigned in order and the first bad number stops the
  assignment: earlier fields keep their values, that field and every later
  one stay at the default;
* an empty or NULL numeric text reads as ``0``; booleans are ``true`` in any
  case and false otherwise; quotes are kept inside string values.

Everything is a Column expression over one ``parts`` array, so a decode is a
single narrow projection -- no UDF, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.strings import ColumnOrName, _col, java_trim, quoted_split
from lodestar.schema import CATALOG_SCHEMA, FIELD_SEPARATOR, STORED_CONSTANTS

# The numeric text grammar accepted by the original parsers.
# Integers: optional sign and ASCII digits, no blanks. Floating point: the
# text is trimmed first, may be NaN/Infinity, and may end in a type suffix.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$"
FLOAT_SUFFIX = r"[fFdD]$"

ERROR_ARITY = "arity"
ERROR_TYPE = "type"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def empty_numeric_default(c: ColumnOrName) -> Column:
    """NULL or empty numeric text becomes ``'0'``."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit("0")).otherwise(c)


def char_decode(c: ColumnOrName) -> Column:
    """First character; NULL or empty text becomes a single space."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(" ")).otherwise(F.substring(c, 1, 1))


def boolean_decode(c: ColumnOrName) -> Column:
    """``true`` in any letter case is true; everything else (NULL too) is false."""
    return F.coalesce(F.lower(_col(c)) == F.lit("true"), F.lit(False))


def is_char_field(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType) and bool(field.metadata.get("char"))


def parse_field(text: Column, field: T.StructField) -> tuple[Column, Column, Column]:
    """``(value, ok, default)`` for one field's raw text."""
    dtype = field.dataType
    if isinstance(dtype, _INTEGRAL):
        s = empty_numeric_default(text)
        value = F.when(s.rlike(INTEGER_PATTERN), s.try_cast(dtype))
        return value, value.isNotNull(), F.lit(0).cast(dtype)
    if isinstance(dtype, _FRACTIONAL):
        s = java_trim(empty_numeric_default(text))
        value = F.when(s.rlike(FLOAT_PATTERN),
                       F.regexp_replace(s, FLOAT_SUFFIX, "").try_cast(dtype))
        return value, value.isNotNull(), F.lit(0.0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return boolean_decode(text), F.lit(True), F.lit(False)
    if is_char_field(field):
        return char_decode(text), F.lit(True), F.lit("\u0000")
    if isinstance(dtype, T.StringType):
        return text, F.lit(True), F.lit(None).cast(dtype)
    raise TypeError(f"unsupported field type for text decode: {field.name} {dtype}")


def arity_ok(parts: ColumnOrName, schema: T.StructType = CATALOG_SCHEMA) -> Column:
    """The split produced exactly one part per schema field."""
    return F.size(_col(parts)) == F.lit(len(schema.fields))


def parsed_columns(parts: ColumnOrName, schema: T.StructType = CATALOG_SCHEMA) -> list[Column]:
    """Step 1 of the decode: ``_arity`` plus each field's parsed value ``_v<i>``
    (NULL when the text does not parse; strings as they are)."""
    parts = _col(parts)
    out = [arity_ok(parts, schema).alias("_arity")]
    for i, field in enumerate(schema.fields):
        value, _, _ = parse_field(F.try_element_at(parts, F.lit(i + 1)), field)
        out.append(value.alias(f"_v{i}"))
    return out


def gated_columns(schema: T.StructType = CATALOG_SCHEMA) -> list[Column]:
    """Step 2: typed fields with first-failure gating, plus ``error`` and ``error_field``.

    Reads the ``_v<i>`` columns of :func:`parsed_columns`, so every field is
    parsed once however many later gates depend on it.
    """
    arity = F.col("_arity")
    gate = arity
    out, failures = [], []
    for i, field in enumerate(schema.fields):
        v = F.col(f"_v{i}")
        numeric = isinstance(field.dataType, (*_INTEGRAL, *_FRACTIONAL))
        if numeric:
            gate = gate & v.isNotNull()
            failures.append(F.when(v.isNull(), F.lit(field.name)))
        _, _, default = parse_field(F.lit(None).cast("string"), field)
        out.append(F.when(gate, v).otherwise(default).cast(field.dataType).alias(field.name))
    first_bad = F.coalesce(*failures) if failures else F.lit(None).cast("string")
    error = (F.when(~arity, F.lit(ERROR_ARITY))
             .when(first_bad.isNotNull(), F.lit(ERROR_TYPE)))
    return out + [error.alias("error"), F.when(arity, first_bad).alias("error_field")]


def decode_lines(df: DataFrame, text_col: str = "value", schema: T.StructType = CATALOG_SCHEMA,
                 keep: tuple[str, ...] = (), separator: str = FIELD_SEPARATOR) -> DataFrame:
    """Annotated decode: ``keep`` columns, the typed fields, ``error``, ``error_field``.

    Three narrow steps in one stage: split, parse every field once, gate.
    The split is produced by a one-element ``explode`` on purpose: a later
    filter on ``error`` would otherwise be pushed below a plain projection
    with the split inlined into each field's parse, splitting the line once
    per field instead of once. The parse step stays a projection of its own
    because collapsing it would copy each (regex-checked) parse into every
    later field's gate.
    """
    split = df.select(*keep, F.col(text_col).alias("_text"),
                      F.explode(F.array(quoted_split(F.col(text_col), separator))).alias("_parts"))
    parsed = split.select(*keep, "_text", *parsed_columns("_parts", schema))
    return parsed.select(*keep, *gated_columns(schema), "_text")


@dataclass
class DecodeResult:
    accepted: DataFrame
    rejected: DataFrame


def apply_error_policy(annotated: DataFrame, mode: str = "quarantine",
                       schema: T.StructType = CATALOG_SCHEMA,
                       keep: tuple[str, ...] = ()) -> DataFrame | DecodeResult:
    """What happens to records that failed to decode.

    ``keep``: every record flows on with its defaults (original behaviour).
    ``drop``: failed records are removed.
    ``quarantine``: two frames, accepted records and rejected raw lines with
    the reason.
    ``fail``: the first failed record fails its task with the reason.
    """
    fields = [f.name for f in schema.fields]
    err = F.col("error")
    if mode == "keep":
        return annotated.select(*keep, *fields)
    if mode == "drop":
        return annotated.filter(err.isNull()).select(*keep, *fields)
    if mode == "quarantine":
        return DecodeResult(
            accepted=annotated.filter(err.isNull()).select(*keep, *fields),
            rejected=annotated.filter(err.isNotNull()).select(
                *keep, F.col("_text").alias("line"), "error", "error_field"),
        )
    if mode == "fail":
        # raise_error inside the filter predicate, so column pruning cannot drop it
        check = F.when(err.isNotNull(), F.raise_error(F.concat(
            F.lit("catalog decode failed ("), err, F.lit(" "),
            F.coalesce(F.col("error_field"), F.lit("")), F.lit("): "), F.col("_text")))
            .cast("boolean")).otherwise(F.lit(True))
        return annotated.filter(check).select(*keep, *fields)
    raise ValueError(f"unknown error mode {mode!r}; use keep, drop, quarantine or fail")


def record_encode(cols: list[ColumnOrName], separator: str = FIELD_SEPARATOR) -> Column:
    """Join field values with ``separator``; NULL prints as ``null``; no quoting."""
    return F.concat_ws(separator, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])


def append_constants(df: DataFrame) -> DataFrame:
    """Add the owner / privilege / has-data constants of a stored row."""
    return df.withColumns({name: F.lit(value).cast(dtype) for name, value, dtype in STORED_CONSTANTS})
