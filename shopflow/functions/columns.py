"""Column expressions shared by several operators. All stay JVM-side."""

from functools import reduce

from pyspark.sql import Column, functions as F

from shopflow import schemas
from shopflow.functions import fixed_values as fixed


def is_cancelled(invoice_no="invoice_no") -> Column:
    """True for a cancelled invoice; a null invoice number is not cancelled."""
    return F.coalesce(F.col(invoice_no).startswith(fixed.CANCEL_PREFIX), F.lit(False))


def original_invoice(invoice_no="invoice_no") -> Column:
    return F.regexp_replace(invoice_no, f"^{fixed.CANCEL_PREFIX}", "")


def line_total(quantity="quantity", unit_price="unit_price") -> Column:
    return (F.col(quantity) * F.col(unit_price)).cast(schemas.LINE_AMOUNT)


def report_date(ts="invoice_date") -> Column:
    return F.to_date(ts)


def valid_email(email="email") -> Column:
    """Match on the trimmed address: padding is cleaned later, not a reason to reject."""
    return F.coalesce(F.trim(email).rlike(fixed.EMAIL_PATTERN), F.lit(False))


def standard_tier(tier="loyalty_tier") -> Column:
    return F.initcap(F.trim(tier))


def category_or_default(category="category") -> Column:
    blank = F.col(category).isNull() | (F.trim(category) == "")
    return F.when(blank, F.lit(fixed.UNCATEGORIZED)).otherwise(F.col(category))


def passes(rule: str) -> Column:
    """A rule that evaluates to NULL counts as failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def passes_all(rules: dict) -> Column:
    return reduce(lambda a, b: a & b, [passes(r) for r in rules.values()], F.lit(True))


def failed_rules(rules: dict) -> Column:
    """Names of the rules a row breaks, in rule order."""
    named = [F.when(~passes(r), F.lit(name)) for name, r in rules.items()]
    return F.array_compact(F.array(*named))


def whole_number(text, dtype) -> Column:
    """Text as an integer type, null when it is none; "12.0" counts, "12.7" does not."""
    number = F.col(text).try_cast("decimal(38,4)")
    return F.when(number == F.floor(number), number.try_cast(dtype))


def currency_of(country="country") -> Column:
    chain = F
    for name, code in fixed.COUNTRY_CURRENCY.items():
        chain = chain.when(F.col(country) == name, F.lit(code))
    return chain.otherwise(F.lit(fixed.DEFAULT_CURRENCY))


def as_date(as_of) -> Column:
    """Accept a date, an ISO string or a Column."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def stamp(now=None) -> Column:
    """Audit time: the given moment, else the time of the query."""
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")
