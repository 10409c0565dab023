"""Defaults for missing labels, and header clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipecast.config import DEFAULT_CURRENCY, UNDEFINED_DIVISION


def division_or_undefined(clean: Column | str = "sales_div_clean") -> Column:
    column = F.col(clean) if isinstance(clean, str) else clean
    return F.coalesce(column, F.lit(UNDEFINED_DIVISION))


def currency_or_default(code: Column | str = "currencyisocode") -> Column:
    column = F.col(code) if isinstance(code, str) else code
    return F.coalesce(column, F.lit(DEFAULT_CURRENCY))


def clean_header(name: str) -> str:
    """``" Stage 1 (USD) "`` becomes ``"stage_1_usd"``."""
    return name.strip().lower().translate(str.maketrans({" ": "_", "(": None, ")": None}))


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(name) for name in df.columns])
