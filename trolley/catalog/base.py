"""Registry, stand-in tables and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.session import SHUFFLE_CLEANUP, materialise
from trolley.sources.tables import spread

TARGETS = [f"Brand#{i}" for i in range(1, 11)]
SEED = 42


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def stable(df: DataFrame, doubles: Sequence[str], digits: int) -> DataFrame:
    """Round for comparison. Sums run in any order, so a value that lies exactly between two
    roundings could go either way; the odd shift moves such values off the boundary."""
    shift, chosen = f"{1.7 * 10.0 ** -(digits + 1):.6e}", set(doubles)
    return df.selectExpr(*[f"round(CAST(`{c}` AS DOUBLE) + {shift}, {digits}) AS `{c}`" if c in chosen else f"`{c}`" for c in df.columns])


def register(name: str, sql: str | None = None, doubles: Sequence[str] = (), digits: int = 4):
    """Add a query; ``doubles`` are compared after the same rounding on both sides."""
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
            out = build(spark, sf_dir)
            return stable(out, doubles, digits) if doubles else out

        text = sql
        if sql is not None and doubles:
            shift = f"{1.7 * 10.0 ** -(digits + 1):.6e}"
            replaced = ", ".join(f'round(CAST("{c}" AS DOUBLE) + {shift}, {digits}) AS "{c}"' for c in doubles)
            text = f"SELECT * REPLACE ({replaced}) FROM ({sql})"
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(run, text)
        return build
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spread(table(spark, sf_dir, name))


def transactions(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """Purchases: line items with their order's customer and date and their part's brand. Parts come first: the
    second shuffle then carries a line without its order's columns, and the rows end up partitioned by order."""
    lines, orders, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    lines = spread(lines) if spread_out else lines
    return (lines.join(part, lines["l_partkey"] == part["p_partkey"]).join(orders, lines["l_orderkey"] == orders["o_orderkey"])
            .select(F.col("o_custkey").alias("customer_id"), F.col("p_brand").alias("item_id"),
                    F.col("l_orderkey").alias("transaction_id"), F.col("o_orderdate").alias("InvoiceDate"),
                    F.col("l_quantity").alias("item_qty"), F.col("l_extendedprice").alias("item_amt")))


def stored_transactions(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ()) -> DataFrame:
    """The same as a stored narrow table (of the listed ``columns``, by default all), for jobs that read it several
    times; a small single-file input is spread out first, so that later scans use all cores."""
    rows = transactions(spark, sf_dir, spread_out=True)
    return materialise(rows.select(*columns) if columns else rows, "transactions")


def event_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of purchases: times of day to the microsecond, few hot keys."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), F.col("event_type").alias("item_id"),
        F.col("event_id").alias("transaction_id"), F.col("ts").alias("InvoiceDate"),
        F.col("value").alias("item_qty"), F.col("value").alias("item_amt"))


TX = """tx AS (SELECT o_custkey AS customer_id, p_brand AS item_id, l_orderkey AS transaction_id,
  o_orderdate AS "InvoiceDate", l_quantity AS item_qty, l_extendedprice AS item_amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

EV = """ev AS (SELECT user_id AS customer_id, event_type AS item_id, event_id AS transaction_id,
  ts AS "InvoiceDate", value AS item_qty, value AS item_amt FROM events)"""

TARGET_LIST = ", ".join(f"'{t}'" for t in TARGETS)


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def days_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def draw_sql(seed: int, *keys: str) -> str:
    return f"('0x' || substr({draw_order_sql(seed, *keys)}, 1, 8))::BIGINT"


def draw_order_sql(seed: int, *keys: str) -> str:
    return "md5(" + " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) + f" || ':{seed}')"


def measures_sql(windows: Sequence[int], ref: str, prefix: str = "", amount: Sequence[str] = ("sum",),
                 quantity: Sequence[str] = ("sum",), net: bool = False, sep: str = "") -> dict[str, str]:
    """Window aggregates as ``name -> expression``."""
    apply, out = {"sum": "sum", "min": "min", "max": "max", "mean": "avg"}, {}
    for w in windows:
        inside = f'FILTER (WHERE "InvoiceDate" >= {ref} - INTERVAL {w} DAY)'
        out[f"{prefix}F{w}"] = f"nullif(count(transaction_id) {inside}, 0)"
        for letter, column, kinds in (("M", "item_amt", amount), ("Q", "item_qty", quantity)):
            for k in kinds:
                name = f"{prefix}{letter}{w}" + (f"{sep}{k}" if len(kinds) > 1 else "")
                out[name] = f"{apply[k]}({column}) {inside}"
        if net:
            out[f"{prefix}N{w}"] = f"sum(item_amt * item_qty) {inside}"
    return out


def select_sql(expressions: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in expressions.items())


def gap_names(prefix: str = "", n: int = 3) -> list[str]:
    return [f"{prefix}DayDiff{'' if i == 1 else i}{k}" for i in range(1, n + 1) for k in ("Mean", "Std")]


def gaps_sql(source: str, keys: Sequence[str], prefix: str = "", fill_before: bool = False) -> str:
    by = ", ".join(keys)
    gap = [days_sql('"InvoiceDate"', f'lag("InvoiceDate", {i}) OVER w') for i in (1, 2, 3)]
    if fill_before:
        gap = [f"coalesce({g}, 999)" for g in gap]
    stats = ", ".join(f'avg(d{i}) AS "{prefix}DayDiff{"" if i == 1 else i}Mean", stddev_samp(d{i}) AS "{prefix}DayDiff{"" if i == 1 else i}Std"'
                      for i in (1, 2, 3))
    return (f"SELECT {by}, {stats} FROM (SELECT {by}, {gap[0]} AS d1, {gap[1]} AS d2, {gap[2]} AS d3 FROM {source} "
            f'WINDOW w AS (PARTITION BY {by} ORDER BY "InvoiceDate")) GROUP BY {by}')


def block_sql(source: str, keys: Sequence[str], ref: str, windows: Sequence[int], prefix: str = "", fill_before: bool = False,
              letter: str | None = None, span: str | None = None, **options) -> tuple[str, list[str], list[str]]:
    """(SELECT, measure names, double-typed names) of one key's full feature block."""
    named = measures_sql(windows, ref, prefix, **options)
    doubles = [n for n in named if not n.startswith(f"{prefix}F")]
    if letter:
        named[f"{letter}_L"] = days_sql(f"max({ref})", 'max("InvoiceDate")')
        named[f"{letter}_F"] = days_sql(f"max({ref})", 'min("InvoiceDate")')
    if span:
        named[span] = days_sql('max("InvoiceDate")', 'min("InvoiceDate")')
    gaps = gap_names("C_" if prefix else "")
    by = ", ".join(keys)
    text = (f"SELECT * FROM (SELECT {by}, {select_sql(named)} FROM {source} GROUP BY {by}) "
            f"JOIN ({gaps_sql(source, keys, 'C_' if prefix else '', fill_before)}) USING ({by})")
    return text, [*named, *gaps], [*doubles, *gaps]


def widen_sql(source: str, keys: Sequence[str], items: Sequence[str], measures: Sequence[str]) -> str:
    by = ", ".join(keys)
    cells = ", ".join(f"max(CASE WHEN item_id = '{i}' THEN \"{m}\" END) AS \"{m}_{i}\"" for m in measures for i in items)
    return f"SELECT {by}, {cells} FROM {source} GROUP BY {by}"


def labels_sql(source: str, keys: Sequence[str], targets: Sequence[str] = TARGETS) -> str:
    by = ", ".join(keys)
    cells = ", ".join(f"max(CASE WHEN item_id = '{t}' THEN 1 ELSE 0 END) AS \"Target_{t}\"" for t in targets)
    listed = ", ".join(f"'{t}'" for t in targets)
    return f"SELECT {by}, {cells} FROM {source} WHERE item_id IN ({listed}) GROUP BY {by}"


def filled_sql(names: Sequence[str], penalty: str = "999") -> str:
    return ", ".join(f'coalesce("{n}", {penalty}) AS "{n}"' for n in names)
