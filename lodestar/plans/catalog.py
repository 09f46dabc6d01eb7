"""Catalog load end to end: text -> quote-aware split -> typed decode ->
error policy -> stored rows with constants (-> JDBC sink)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from lodestar.functions.decode import DecodeResult, append_constants, apply_error_policy, decode_lines
from lodestar.operators.counts import load_report
from lodestar.schema import CATALOG_SCHEMA


@dataclass
class CatalogLoad:
    annotated: DataFrame   # typed fields + error, error_field, _text
    stored: DataFrame      # rows to store (17 columns), after the error policy
    rejected: DataFrame | None
    report: DataFrame      # attempted, rejected, accepted


def load_catalog(lines: DataFrame, text_col: str = "value", on_error: str = "quarantine",
                 keep: tuple[str, ...] = ()) -> CatalogLoad:
    """Decode catalog lines into stored rows.

    ``on_error``: ``quarantine`` (default; rejected lines kept apart with a
    reason), ``keep`` (failed records flow on with defaults -- the original
    loader's behaviour), ``drop`` or ``fail``.
    """
    annotated = decode_lines(lines, text_col=text_col, keep=keep)
    result = apply_error_policy(annotated, on_error, CATALOG_SCHEMA, keep)
    if isinstance(result, DecodeResult):
        stored, rejected = append_constants(result.accepted), result.rejected
    else:
        stored, rejected = append_constants(result), None
    return CatalogLoad(annotated=annotated, stored=stored, rejected=rejected,
                       report=load_report(annotated))
