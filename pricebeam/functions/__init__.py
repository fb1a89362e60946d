"""Column-level building blocks."""

from pricebeam.functions.dates import as_of_date, date_text, month_start, trailing_days, week_start
from pricebeam.functions.normalize import normalize
from pricebeam.functions.returns import forward_fill, pct_change, with_returns
from pricebeam.functions.sql_functions import register_functions
from pricebeam.functions.volatility import (
    array_volatility,
    with_frame_volatility,
    with_prior_return,
)

__all__ = [
    "array_volatility", "as_of_date", "date_text", "forward_fill", "month_start", "normalize",
    "pct_change", "register_functions", "trailing_days", "week_start", "with_frame_volatility",
    "with_prior_return", "with_returns",
]
