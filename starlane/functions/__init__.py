"""Column expressions; all of them are built-in, JVM-side functions."""

from starlane.functions.calendar import add_calendar, within_years
from starlane.functions.means import exact_mean, half_up_mean, rounded_mean, to_units

__all__ = [
    "add_calendar",
    "exact_mean",
    "half_up_mean",
    "rounded_mean",
    "to_units",
    "within_years",
]
