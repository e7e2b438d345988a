"""Minute-level market prices joined with a daily exchange rate, as Spark DataFrames.

Operators take DataFrames and parameters and return DataFrames. They expect the
session time zone to be UTC; ``pin_utc`` sets it.
"""

from fxtape.rules import MarketRules
from fxtape.shared import pin_utc

__all__ = ["MarketRules", "pin_utc"]
