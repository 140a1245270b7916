"""Column headers with units."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wxspark.constants import UNITS


def header(name: str) -> str:
    unit = UNITS.get(name, "")
    return f"{name} ({unit})" if unit else name


def rename_units(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: header(name) for name in df.columns})
