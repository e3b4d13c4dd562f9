"""Short forms for test rows."""

from datetime import date, datetime
from decimal import Decimal


def ts(text):
    return datetime.fromisoformat(text)


def day(text):
    return date.fromisoformat(text)


D = Decimal
