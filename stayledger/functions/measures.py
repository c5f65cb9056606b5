"""Aggregate expressions shared by marts and charts.

All combine partially on the map side. Money stays decimal, so sums are exact
and do not depend on the order of rows; averages divide an exact sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def total(column: str) -> Column:
    return F.sum(column)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL over zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


class Rows:
    """Amounts of a group from its rows."""

    @staticmethod
    def rows() -> Column:
        return row_count()

    @staticmethod
    def total(column: str) -> Column:
        return total(column)

    @staticmethod
    def present(column: str) -> Column:
        return F.count(column)


class Parts:
    """The same amounts from partial counts and sums, which may be negative."""

    @staticmethod
    def rows() -> Column:
        return F.sum("n_rows")

    @staticmethod
    def total(column: str) -> Column:
        return F.when(Parts.present(column) > 0, F.sum(f"sum_{column}"))

    @staticmethod
    def present(column: str) -> Column:
        return F.sum(f"n_{column}")


def mean(column: str, amounts: type = Rows) -> Column:
    return safe_ratio(amounts.total(column), amounts.present(column))


def ratio_of_sums(numerator: str, denominator: str) -> Column:
    return safe_ratio(F.sum(numerator), F.sum(denominator))
