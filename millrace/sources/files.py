"""Reading and writing files: CSV in its variants, text lines, Parquet, partitioned tables, literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTED = {"sep": ",", "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header. Without a schema the types cost one more pass over the files."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_csv_quoted(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, **options) -> DataFrame:
    """CSV whose quoted fields may hold separators, quotes and line ends; gzip is read by its suffix."""
    return read_csv(spark, path, schema, **{**QUOTED, **options})


def read_tagged(spark: SparkSession, paths: Mapping[str, str], schema: T.StructType | str, tag: str) -> DataFrame:
    """One frame of several sources, each marked with its name."""
    frames = [read_csv_quoted(spark, path, schema).withColumn(tag, F.lit(name)) for name, path in paths.items()]
    return reduce(DataFrame.unionByName, frames)


# A record must have the right number of fields whichever of them are used.
STRICT = {"mode": "DROPMALFORMED", "ignoreLeadingWhiteSpace": True, "columnPruning": False}


def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def fitting(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the schema, without the rows where a value does not fit its type.

    Spark's own check looks only at the columns a query uses; this one looks at all of them.
    """
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    fits = [F.col(n).isNull() | c.isNotNull() for n, c in casts.items()]
    return rows.where(reduce(Column.__and__, fits)).select(*[c.alias(n) for n, c in casts.items()])


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Only the records that fit the schema; leading blanks are trimmed."""
    return fitting(spark.read.schema(as_text(schema)).options(header=header, **STRICT).csv(path), schema)


def read_lines(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One row per line, or per piece of a line when a pattern to split on is given."""
    lines = spark.read.text(path)
    return lines if split is None else lines.select(F.explode(F.split("value", split)).alias("value"))


def parse_delimited(
    lines: DataFrame,
    header: str,
    columns: Mapping[int, str],
    number: str,
    sentinels: Sequence[str],
    marker: str = "*",
    sep: str = ",",
) -> DataFrame:
    """Text lines to columns: header line and sentinel rows dropped, marker stripped, one column made a
    number. Missing fields and bad numbers become null instead of failing."""
    split = lines.where(F.col("value") != header).select(F.split("value", sep).alias("f"))
    named = split.select(*[F.get("f", F.lit(i)).alias(name) for i, name in columns.items()])
    kept = named.where(F.col(number).isNull() | ~F.col(number).isin(list(sentinels)))
    return kept.withColumn(number, F.replace(F.col(number), F.lit(marker), F.lit("")).try_cast("double"))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Parquet scan; columns and filter are pushed into it."""
    rows = spark.read.parquet(path)
    rows = rows if where is None else rows.where(where)
    return rows if columns is None else rows.select(*columns)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, **options) -> None:
    """CSV with a header, in a chosen number of files, or cut by size with ``maxRecordsPerFile``. Rows are dealt out in turn, not by a key, so
    the files are of even size."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").options(header=True, **options).csv(path)


def insert_partitioned(df: DataFrame, name: str, path: str, renames: Mapping[str, str], partition: str) -> None:
    """Create the partitioned table ``name`` at ``path`` if it is not there, and append the renamed columns.

    The table keeps what earlier inserts stored, also those of another session into the same path. The
    rebalance hint gathers a partition's rows into few files and lets adaptive execution split a large
    one over several tasks.
    """
    spark = df.sparkSession
    renamed = df.select(*[F.col(old).alias(new) for old, new in renames.items()])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema.fields)
    if not spark.catalog.tableExists(name):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        filled = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
        spark.sql(f"CREATE TABLE {name} ({kinds}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
        if filled:
            # Partitions that another catalog wrote there.
            spark.sql(f"MSCK REPAIR TABLE {name}")
    ordered = [c for c in renamed.columns if c != partition] + [partition]
    columns = ", ".join(f"`{c}`" for c in ordered)
    spark.sql(f"INSERT INTO {name} SELECT /*+ REBALANCE(`{partition}`) */ {columns} FROM {{new}}", new=renamed)


def query_view(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Query a frame as text, where ``{name}`` stands for it. The view lives as long as the statement, so no
    view of the caller's is replaced."""
    return df.sparkSession.sql(sql, **{name: df})
