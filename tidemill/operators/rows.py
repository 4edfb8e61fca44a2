"""Row-wise work: parsing, guarding, filtering, projecting and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string


def parse_delimited(
    df: DataFrame,
    line: str,
    ddl: str,
    sep: str = ",",
    on_error: str = "fail",
    keep: list[str] | None = None,
) -> DataFrame:
    """Typed columns from a delimited line.

    `on_error`: "fail" stops the query at a malformed number, "null" leaves the
    field empty, "drop" leaves the row out, "quarantine" keeps it and adds the
    column `bad_line`, null for good rows.
    """
    fields = _parse_datatype_string(ddl).fields
    parts = F.split(F.col(line), f"\\Q{sep}\\E")
    strict = on_error == "fail"
    values, wrong = [], F.size(parts) < len(fields)
    for i, field in enumerate(fields):
        raw = F.get(parts, F.lit(i)) if not strict else F.element_at(parts, i + 1)
        value = raw.cast(field.dataType) if strict else raw.try_cast(field.dataType)
        wrong = wrong | value.isNull()
        values.append(value.alias(field.name))
    kept = [F.col(c) for c in keep or []]
    if on_error in ("fail", "null"):
        return df.select(*kept, *values)
    if on_error == "drop":
        return df.filter(~wrong).select(*kept, *values)
    if on_error == "quarantine":
        return df.select(*kept, *values, F.when(wrong, F.col(line)).alias("bad_line"))
    raise ValueError(f"on_error: {on_error}")


def parse_json(df: DataFrame, text: str, ddl: str, keep: list[str] | None = None) -> DataFrame:
    """Typed columns from a JSON object, plus `bad_json`: the text where it does not parse."""
    parsed = F.from_json(
        F.col(text), f"{ddl}, bad_json string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_json"}
    )
    return df.withColumn("__json", parsed).select(*(keep or []), "__json.*")


def json_split(df: DataFrame, text: str, ddl: str, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) of a JSON column."""
    parsed = parse_json(df, text, ddl, keep)
    good = parsed.filter(F.col("bad_json").isNull()).drop("bad_json")
    bad = parsed.filter(F.col("bad_json").isNotNull()).select(*(keep or []), "bad_json")
    return good, bad


def guard(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """Stop the query at the first row for which `bad` holds."""
    stop = F.raise_error(F.lit(message)).cast("boolean")
    return df.filter(F.when(bad, stop).otherwise(F.lit(True)))


def without_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(~F.col(column).startswith(prefix))


def without_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column is not `value`; null rows stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def at_positions(df: DataFrame, *positions: int) -> DataFrame:
    """Columns by position, in the order asked for."""
    return df.select(*[df.columns[i] for i in positions])


def since_millis(df: DataFrame, ts: str, millis: int) -> DataFrame:
    """Rows at or after an epoch-millisecond instant (UTC).

    The bound is a literal of the column's own type, so it reaches the scan.
    """
    kind = dict(df.dtypes)[ts]
    instant = F.timestamp_millis(F.lit(millis))
    return df.filter(F.col(ts) >= instant.cast(kind))


def tag_numbers(df: DataFrame, column: str) -> DataFrame:
    """Add `num` and `tag`: even, odd or str.  The remainder keeps its sign, so -3 is odd."""
    num = F.col(column).try_cast("int")
    tag = F.when(num.isNull(), "str").when(num % 2 == 0, "even").otherwise("odd")
    return df.withColumns({"num": num, "tag": tag})


def routes(df: DataFrame, tag: str, names: list[str]) -> dict[str, DataFrame]:
    """Side outputs: one filtered DataFrame per tag."""
    return {name: df.filter(F.col(tag) == name) for name in names}


def co_map(left: DataFrame, left_value: Column, right: DataFrame, right_value: Column, name: str = "value") -> DataFrame:
    """Two differently typed inputs mapped to one output, tagged with their side."""
    return left.select(F.lit("left").alias("side"), left_value.alias(name)).unionByName(
        right.select(F.lit("right").alias("side"), right_value.alias(name))
    )


def union_all(*inputs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = inputs[0]
    for df in inputs[1:]:
        out = out.unionByName(df)
    return out
