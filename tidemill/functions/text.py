"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(line) -> Column:
    """Words of a line cut at single spaces.

    Inner empty words stay, trailing ones are dropped; the empty line is one
    empty word and an all-blank line has none.
    """
    line = F.col(line) if isinstance(line, str) else line
    bare = F.rtrim(line, F.lit(" "))
    none = F.array().cast("array<string>")
    return F.when(line == "", F.array(F.lit(""))).when(bare == "", none).otherwise(F.split(bare, " "))


def split_trimmed(line, separator: str = ",") -> Column:
    """Fields of a line cut at a regular expression, trailing empty fields dropped."""
    line = F.col(line) if isinstance(line, str) else line
    fields = F.split(line, separator)
    # Position of the last non-empty field; 0 if all are empty.
    last = F.aggregate(
        F.transform(fields, lambda x, i: F.when(x != "", i + 1).otherwise(0)),
        F.lit(0),
        lambda best, i: F.greatest(best, i),
    )
    return F.when(line == "", F.array(F.lit(""))).otherwise(F.slice(fields, F.lit(1), last))


def words(df: DataFrame, line: str, word: str = "word", keep: list[str] | None = None) -> DataFrame:
    """One row per word of `line`; `keep` names columns to carry along."""
    return df.select(*(keep or []), F.explode(tokens(line)).alias(word))


def text_lines(df: DataFrame, text: str, line: str = "line", keep: list[str] | None = None) -> DataFrame:
    """One row per line of a multi-line text, with its number from 0."""
    return df.select(*(keep or []), F.posexplode(F.split(text, "\n")).alias("line_no", line))


def cents(money) -> Column:
    """A money amount with two decimals as whole cents, so that sums do not depend on order."""
    money = F.col(money) if isinstance(money, str) else money
    return F.round(money * 100).cast("long")


def from_cents(total) -> Column:
    total = F.col(total) if isinstance(total, str) else total
    return total / F.lit(100.0)


def minute_label(ts) -> Column:
    return F.date_format(ts, "yyyyMMdd-HHmm")
