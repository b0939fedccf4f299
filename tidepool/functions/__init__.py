"""Column expressions shared by the models (all built-in, codegen-friendly)."""

from tidepool.functions.keys import date_key, safe_ratio, surrogate_key, days_between, null_as

__all__ = ["date_key", "safe_ratio", "surrogate_key", "days_between", "null_as"]
