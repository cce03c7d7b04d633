"""Column expressions used by more than one operator. All are built from Spark
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmap.schemas import NULL_TOKENS


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(or_, tests)


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(and_, tests)


def null_tokens(df: DataFrame, columns: list[str], tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Turn every null token of the given string columns into NULL."""
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in columns})


def is_blank(name: str) -> Column:
    """Only spaces; a tab is content."""
    return F.trim(F.col(name)) == ""


def count_null(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def yes_no(test: Column) -> Column:
    return F.when(test, "Y").otherwise("N")


def null_label(name: str, present: str = "OK") -> Column:
    return F.when(F.col(name).isNull(), "NULL").otherwise(present)


def percent(part: str, whole: str) -> Column:
    """``part`` in percent of ``whole`` to two places; NULL if ``whole`` is 0.
    Worked out in decimals, so that ties round the same on every machine."""
    share = F.col(part).cast("decimal(20,0)") * 100 / F.nullif(F.col(whole).cast("decimal(20,0)"), F.lit(0))
    return F.round(share, 2).cast("double")


def share_reaches(part: str, whole: str, pct: int) -> Column:
    """Whether ``part`` is at least ``pct`` percent of ``whole``. Compared in
    whole numbers, so exactly 95 % is 95 %; not true for an empty whole."""
    return (F.col(whole) > 0) & (F.col(part) * 100 >= F.col(whole) * pct)


def sentinel(name: str, as_type: str, value: str) -> Column:
    """A key with its NULL replaced, so that NULL keys meet each other."""
    return F.coalesce(F.col(name).cast(as_type), F.lit(value).cast(as_type)).alias(name)


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def has_special_chars(name: str) -> Column:
    """Whether the text holds a line break or a double quote anywhere."""
    return F.coalesce(F.col(name), F.lit("")).rlike('\n|\r|"')


def split_fields(line: Column, names: list[str], sep: str = ",") -> list[Column]:
    """One column per name from a delimited line; '' where the line is short."""
    return [F.split_part(line, F.lit(sep), F.lit(i)).alias(n) for i, n in enumerate(names, 1)]


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side. A frame may be
    empty: its columns are then NULL and the row is kept."""
    columns = [c for frame in frames for c in frame.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in columns])
