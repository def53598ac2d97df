"""Schemas of the published forms. Names and order are the contract."""

from __future__ import annotations

from pyspark.sql import types as T

_NUMERIC = ("coupon", "quantity", "market_value", "pct_nav", "ytm", "ytc", "instrument_yield")

# Field names in published order
HOLDING_FIELDS = ("instrument", "isin", "holding_type", "industry", "rating", "coupon", "quantity", "market_value", "pct_nav", "ytm", "ytc", "instrument_yield", "maturity_date", "section", "listed_status", "underlying", "position_side")
HOLDING_TYPES = ("equity", "debt", "money_market", "cash", "derivative", "fund_unit", "commodity", "other")

HOLDING = T.StructType([T.StructField(n, T.DoubleType() if n in _NUMERIC else T.StringType()) for n in HOLDING_FIELDS])
RAW_HOLDING = T.StructType([T.StructField(n, T.StringType()) for n in ("instrument", "isin", "industry", "industry_rating", "rating", "section", "quantity", "market_value", "pct_nav", "coupon", "ytm", "ytc", "instrument_yield", "maturity_date")])
GRID = "file string, sheet_no int, sheet string, row_no int, cells array<string>"
