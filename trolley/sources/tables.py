"""Transaction, basket and plain table readers; writers; stored dictionaries and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Fixed value: CSV times keep their microseconds.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

TRANSACTIONS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("transaction_id", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("item_qty", T.DoubleType()),
    T.StructField("item_amt", T.DoubleType()),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               null_token: str | None = None, header: bool = True) -> DataFrame:
    """Parquet, or CSV with a declared schema and an optional token that means "missing"."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    reader = spark.read.option("header", header)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    if schema is None:
        raise ValueError("a CSV table needs a declared schema: inference reads the data twice")
    return reader.schema(schema).csv(path)


def read_transactions(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """Transactions without incomplete rows."""
    return read_table(spark, path, schema).na.drop("any")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer partitions than cores (one small file) to all cores, for work
    that is heavy per row. A large table has more partitions and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def split_basket(line: Column, sep: str = ",", keep_empty: bool = True) -> Column:
    """Distinct items of one header-less basket line; an empty field is an item if kept."""
    fields = F.split(F.regexp_replace(line, r"\r$", ""), f"\\Q{sep}\\E")
    items = F.array_distinct(fields)
    return items if keep_empty else F.filter(items, lambda i: i != "")


def read_baskets(spark: SparkSession, path: str, sep: str = ",", keep_empty: bool = True) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(split_basket(F.col("value"), sep, keep_empty).alias("items"))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One logical table with a header in every file, optionally one folder per chunk."""
    writer = (df.write.option("header", True).option("timestampFormat", CSV_TIME)
              .option("timestampNTZFormat", CSV_TIME))
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def save_dict(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_dict(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(path: str, weights: DataFrame | None = None, vocabulary: DataFrame | None = None,
               fitted: PipelineModel | None = None) -> None:
    """Weight table, vocabulary and fitted stages side by side in one folder."""
    for name, part in (("weights", weights), ("vocabulary", vocabulary)):
        if part is not None:
            part.write.mode("overwrite").parquet(f"{path}/{name}")
    if fitted is not None:
        fitted.write().overwrite().save(f"{path}/fitted")


def load_model(spark: SparkSession, path: str, part: str = "weights") -> DataFrame | PipelineModel:
    return PipelineModel.load(f"{path}/fitted") if part == "fitted" else spark.read.parquet(f"{path}/{part}")
