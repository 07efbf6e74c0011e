"""Date parts with the modelled database's conventions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: month and day names are blank-padded to 9 characters.
NAME_WIDTH = 9

# English names as date_format writes them; a choice by number costs far less than formatting each row.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _chosen(names: tuple[str, ...], number: Column, padded: bool) -> Column:
    # element_at counts as never NULL here, so NULL is told apart before it.
    return F.when(number.isNotNull(), F.element_at(F.array(*[F.lit(n.ljust(NAME_WIDTH) if padded else n) for n in names]), number))


def month_start(d: Column) -> Column:
    """First day of the month as DATE (``trunc`` keeps DATE; ``date_trunc`` would give TIMESTAMP)."""
    return F.trunc(d, "MM")


def month_name(d: Column, padded: bool = True) -> Column:
    return _chosen(MONTHS, F.month(d), padded)


def day_name(d: Column, padded: bool = True) -> Column:
    return _chosen(DAYS, F.weekday(d) + 1, padded)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later`` (``CURRENT_DATE - d``)."""
    return F.datediff(later, earlier)
