"""Scalar column helpers: JVM-side expressions only (no Python UDFs)."""

from tallyhouse.functions.calendar import date_spine, pg_day_name, pg_day_of_week
from tallyhouse.functions.money import fx_to_usd, money, round_money, total
from tallyhouse.functions.sku import normalize_sku

__all__ = ["date_spine", "pg_day_name", "pg_day_of_week", "fx_to_usd", "money",
           "round_money", "normalize_sku", "total"]
