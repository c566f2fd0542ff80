"""Scalar extraction from a VARIANT payload.

The rule: a missing path, a JSON null, an object and an array all give SQL null; any other value gives
its text. The path reaches the Parquet scan as a shredded field, so only the asked-for parts of
the payload are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_scalars(df: DataFrame, payload: str, paths: Mapping[str, str]) -> DataFrame:
    """Replace the ``payload`` column by one text column per ``name -> path``.

    Each path is looked up once and printed once: as columns of their own, the value and its text are
    not repeated in every branch that needs them.
    """
    kept = [c for c in df.columns if c != payload]
    values = {name: F.try_variant_get(payload, path, "variant") for name, path in paths.items()}
    found = df.select(*kept, *[value.alias(f"{name}_value") for name, value in values.items()])
    printed = found.select(
        "*", *[F.col(f"{name}_value").cast("string").alias(f"{name}_text") for name in paths]
    )
    return printed.select(*kept, *[_unless_nested(name).alias(name) for name in paths])


def _unless_nested(name: str) -> Column:
    text = F.col(f"{name}_text")
    # Objects and arrays print as "{..." or "[...". Text that merely starts that way is rare, so
    # the costlier type inspection runs only for those rows.
    looks_nested = F.substring(text, 1, 1).isin("{", "[")
    is_nested = F.schema_of_variant(f"{name}_value").rlike("^(OBJECT|ARRAY)")
    return F.when(looks_nested & is_nested, None).otherwise(text)


def whole_number(text: str) -> Column:
    """Text as a bigint, null when it is not one (``12.7`` is not)."""
    # A failing try_cast raises and catches inside; the pattern keeps that to overflows.
    return F.when(F.col(text).rlike(r"^\s*[+-]?[0-9]+\s*$"), F.col(text)).try_cast("bigint")
