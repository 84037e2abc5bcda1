"""Rules on order dates, punctuality and order type."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

PLANNED_MINUS_ACTUAL = "planned_minus_actual"
ACTUAL_MINUS_PLANNED = "actual_minus_planned"


def month_of(date: str, as_of: datetime.date | None = None) -> Column:
    """First day of the date's month; of the as-of date's month where it is null."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.trunc(F.coalesce(F.col(date), today), "month")


def as_date(column: str) -> Column:
    """The value as a date; null where it is not one."""
    return F.col(column).try_cast("date")


def on_time(planned: str = "ZZGLTRP_ORIG", actual: str = "FTRMI") -> Column:
    """1 when finished by the planned day, else 0; null while either day is unknown."""
    return (F.col(planned) >= F.col(actual)).cast("int")


def deviation_days(planned: str = "ZZGLTRP_ORIG", actual: str = "FTRMI") -> Column:
    """Planned minus actual finish in days; null while either is unknown."""
    return F.datediff(F.col(planned), F.col(actual))


def lateness(
    deviation: str = "actual_on_time_deviation", sign: str = PLANNED_MINUS_ACTUAL
) -> Column:
    """Lateness label of a deviation in days; null for null.

    By default positive deviations get the "late" labels although they mean the
    planned day lies after the actual one; that is the established output.
    ``sign=ACTUAL_MINUS_PLANNED`` labels the truly late orders as late instead.
    """
    if sign not in (PLANNED_MINUS_ACTUAL, ACTUAL_MINUS_PLANNED):
        raise ValueError(f"unknown sign {sign!r}")
    days = F.col(deviation) if sign == PLANNED_MINUS_ACTUAL else -F.col(deviation)
    # fixed values: the labels and their limits in days
    return (F.when(days > 10, ">10 days late")
            .when(days > 5, "6-10 days late")
            .when(days > 0, "1-5 days late")
            .when(days.isNotNull(), "On time or early"))


def order_type(sales_order: str = "KDAUF") -> Column:
    """Made to order when a sales order is given (even an empty one), else to stock."""
    # fixed values: the two labels
    return F.when(F.col(sales_order).isNull(), "MTS").otherwise("MTO")
