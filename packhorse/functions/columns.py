"""Column helpers built from JVM-side functions only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(value: str | Column) -> Column:
    """A double as a decimal, so that sums do not depend on the order of rows."""
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def total(value: Column) -> Column:
    """The exact sum of a money column, as a double."""
    return F.sum(value).cast("double")


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold; a rule that is null does not hold."""
    marks = [
        F.when(F.coalesce(rule, F.lit(False)), F.lit(None)).otherwise(F.lit(name))
        for name, rule in rules.items()
    ]
    return F.array_compact(F.array(*marks))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def quoted(name: str) -> str:
    """A column name for use in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal for use in a SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unused(wanted: str, taken: Iterable[str]) -> str:
    """`wanted`, with underscores in front if a column of that name is there, in any case."""
    there = {name.lower() for name in taken}
    while wanted.lower() in there:
        wanted = f"_{wanted}"
    return wanted
