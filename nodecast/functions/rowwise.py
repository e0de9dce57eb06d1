"""Column functions across several columns of one row; NULLs are skipped.

They take column names and are stated as SQL text, which stays inside generated
code and costs one call to Spark however many columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


def quoted(text: str) -> str:
    """A text as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_name(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def _joined(template: str, names: Sequence[str], by: str) -> str:
    return "(" + by.join(template.format(quoted_name(name)) for name in names) + ")"


def present_count(names: Sequence[str]) -> Column:
    return F.expr(_joined("int({} IS NOT NULL)", names, " + "))


def present_sum(names: Sequence[str]) -> Column:
    """Sum of the values that are there; NULL only if none is."""
    total, none = _joined("coalesce({}, 0D)", names, " + "), _joined("{} IS NULL", names, " AND ")
    return F.expr(f"CASE WHEN NOT {none} THEN {total} END")


def present_mean(names: Sequence[str]) -> Column:
    return present_sum(names) / F.nullif(present_count(names), F.lit(0))


def present_max(names: Sequence[str]) -> Column:
    return F.greatest(*names) if len(names) > 1 else F.col(names[0])


def to_number(column: Column) -> Column:
    """As DOUBLE, where text that is no number, and NaN, become NULL."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)
