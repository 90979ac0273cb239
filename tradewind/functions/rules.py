"""Business rules and exact arithmetic, as functions from columns to columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Order statuses that never bill.
UNBILLED_STATUSES = ("canceled", "unavailable")

# Macro-region of each state code.
REGION_STATES = {
    "North": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Central-West": ("DF", "GO", "MS", "MT"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}

# Upper bound in days of each delivery-speed bucket, ascending.
SPEED_BUCKETS = ((3, "0-3 days"), (7, "4-7 days"), (14, "8-14 days"), (30, "15-30 days"))
SPEED_OVERFLOW, SPEED_MISSING = "30+ days", "not_delivered"

# Upper bound in days late of each lateness bucket, ascending.
LATENESS_BUCKETS = (
    (-10, "10+ days early"),
    (-1, "1-9 days early"),
    (0, "on the promise date"),
    (3, "1-3 days late"),
    (7, "4-7 days late"),
    (14, "8-14 days late"),
)
LATENESS_OVERFLOW = "15+ days late"
ALL_DELIVERED = "ALL DELIVERED"

# Upper bound in grams (exclusive) of each weight class, ascending.
WEIGHT_CLASSES = ((500, "light"), (2000, "medium"), (10000, "heavy"))


def c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def revenue_recognised(status: str | Column = "order_status") -> Column:
    """True once an order bills. NULL status stays NULL, so a filter drops it."""
    return ~c(status).isin(*UNBILLED_STATUSES)


def ladder(value: Column, steps, overflow, missing=None, strict: bool = False) -> Column:
    """First step whose bound covers ``value``; ``missing`` when it is NULL."""
    chain = F.when(value.isNull(), F.lit(missing))
    for bound, label in steps:
        chain = chain.when(value < bound if strict else value <= bound, F.lit(label))
    return chain.otherwise(F.lit(overflow))


def delivery_speed_bucket(days: Column) -> Column:
    return ladder(days, SPEED_BUCKETS, SPEED_OVERFLOW, SPEED_MISSING)


def lateness_position(days_late: Column) -> Column:
    """1 for the earliest bucket up to 7 for the latest."""
    steps = [(bound, i) for i, (bound, _) in enumerate(LATENESS_BUCKETS, start=1)]
    return ladder(days_late, steps, len(LATENESS_BUCKETS) + 1)


def lateness_label(position: Column) -> Column:
    labels = [label for _, label in LATENESS_BUCKETS] + [LATENESS_OVERFLOW]
    return F.element_at(F.array(*map(F.lit, labels)), position)


def region_of(state: str | Column) -> Column:
    chain = reduce(
        lambda acc, item: acc.when(c(state).isin(*item[1]), F.lit(item[0])), REGION_STATES.items(), F
    )
    return chain.otherwise(F.lit("Unknown"))


def decimal(column: str | Column, precision: int = 12, scale: int = 2) -> Column:
    return c(column).cast(f"decimal({precision},{scale})")


def quotient(numerator: Column, denominator: Column, scale: int) -> Column:
    """Exact decimal division rounded half up; NULL on a zero or NULL denominator.

    Both sides are decimals before the division, so the result does not depend on the order in
    which tasks summed their parts.
    """
    top, bottom = decimal(numerator, 26, 6), decimal(denominator, 20, 2)
    return decimal(top / F.nullif(bottom, decimal(F.lit(0), 20, 2)), 20, scale)


def percent(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    return quotient(decimal(numerator, 24, 6) * 100, denominator, scale)


def mean(column: str | Column, scale: int) -> Column:
    """Exact average of an integer or decimal column, NULLs ignored."""
    return quotient(F.sum(c(column)), F.count(c(column)), scale)


def share_true(flag: Column, scale: int = 2) -> Column:
    """Percentage of rows where ``flag`` holds; NULL counts as false and stays below the line."""
    return percent(F.count_if(flag), F.count("*"), scale)


def round_double(column: Column, scale: int) -> Column:
    """Round a double the same way in every engine, by way of a decimal."""
    return F.round(column.cast("decimal(28,10)"), scale)


def clean(column: str | Column, letter_case=F.lower) -> Column:
    """Trim, fold case, and turn the empty string into NULL."""
    return F.nullif(letter_case(F.trim(c(column))), F.lit(""))


def zip_prefix(column: str | Column) -> Column:
    return F.lpad(F.trim(c(column)), 5, "0")


def date_key(ts: str | Column) -> Column:
    return F.date_format(c(ts), "yyyyMMdd").cast("int")


def month_start(day: str | Column) -> Column:
    return F.trunc(c(day), "month")


def year_month(day: str | Column) -> Column:
    return F.date_format(c(day), "yyyy-MM")
