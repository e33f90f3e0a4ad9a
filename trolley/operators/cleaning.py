"""Table cleaning: missing values, sentinels, types, list columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trolley.functions import columns as C
from trolley.functions.draws import draw_order
from trolley.operators.ordering import forward_fill


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def fill_penalty(df: DataFrame, value: float | str, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill NULLs of the columns whose type fits the value."""
    return df.na.fill(value, list(subset)) if subset else df.na.fill(value)


def fill_by_pattern(df: DataFrame, rules: Mapping[str, object], default: object = -1) -> DataFrame:
    """Fill by a name pattern (substring, first match wins), everything else by ``default``."""
    out = []
    for field in df.schema.fields:
        value = next((v for p, v in rules.items() if p in field.name.lower()), default)
        out.append(F.coalesce(F.col(f"`{field.name}`"), F.lit(value).cast(field.dataType)).alias(field.name))
    return df.select(*out)


def on_columns(df: DataFrame, names: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to several columns in a single projection."""
    return df.withColumns({n: change(F.col(n)) for n in names})


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def sentinel_flags(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """One 0/1 column per status text (``text -> new column``)."""
    return df.withColumns({new: F.when(F.col(column) == text, 1).otherwise(0) for text, new in names.items()})


def null_sentinels(df: DataFrame, column: str, sentinels: Sequence[str], pad_order: Sequence[Column] | None = None) -> DataFrame:
    """Status texts to NULL; with ``pad_order`` the previous row's value takes their place."""
    cleaned = df.withColumn(column, C.null_sentinels(F.col(column), sentinels))
    return cleaned if pad_order is None else forward_fill(cleaned, pad_order, [column])


def column_mode(df: DataFrame, column: str):
    """Most frequent value, the smallest on a tie; one row to the driver."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias("m")).first()
    return row["m"]


def impute_mode(df: DataFrame, column: str, bad: str) -> DataFrame:
    """Replace a bad token by the column's mode, which is taken over all values."""
    return df.withColumn(column, F.when(F.col(column) == bad, F.lit(column_mode(df, column))).otherwise(F.col(column)))


def one_hot(df: DataFrame, column: str, values: Sequence, prefix: str = "") -> DataFrame:
    return df.withColumns({f"{prefix}{v}": F.when(F.col(column) == F.lit(v), 1).otherwise(0) for v in values})


def explode_list(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """One row per entry of a delimited list, blanks removed."""
    return df.withColumn(column, F.explode(F.split(F.regexp_replace(F.col(column), " ", ""), f"\\Q{sep}\\E")))


def shuffle_tokens(df: DataFrame, column: str, key: str, seed: int, sep: str = ",") -> DataFrame:
    """Each row's list in a drawn order; the draw depends on row key, place and seed only."""
    entries = F.filter(F.transform(F.split(F.col(column), f"\\Q{sep}\\E"), lambda t: F.trim(t)), lambda t: t != "")
    ranked = F.array_sort(F.transform(entries, lambda t, i: F.struct(
        draw_order(seed, F.col(key), i, t).alias("draw"), t.alias("token"))))
    return df.withColumn(column, F.array_join(F.transform(ranked, lambda e: e["token"]), " "))


def augment(df: DataFrame, columns: Sequence[str], key: str, seed: int) -> DataFrame:
    """The table followed by one shuffled copy per list column."""
    out = df
    for column in columns:
        out = out.unionByName(shuffle_tokens(df, column, key, seed))
    return out


def recode(df: DataFrame, column: str, mapping: Mapping | DataFrame, reverse: bool = False) -> DataFrame:
    """Replace by dictionary: a literal one, or a table (value, id); unknown values pass through."""
    if not isinstance(mapping, DataFrame):
        table = {v: k for k, v in mapping.items()} if reverse else mapping
        return df.withColumn(column, C.recode(F.col(column), table))
    source, target = reversed(mapping.columns[:2]) if reverse else mapping.columns[:2]
    kind = df.schema[column].dataType.simpleString()
    pairs = mapping.select(F.col(source).cast(kind).alias(column), F.col(target).alias("_new"))
    return (df.join(pairs, column, "left")
            .withColumn(column, F.coalesce(F.col("_new").cast("string"), F.col(column).cast("string")))
            .select(*df.columns))
