"""CSV, Parquet and catalog tables; SQL over named frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialise
from .schemas import STAR_NAMES, star_schema

# The two time spellings used in the CSV files.
DATE_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


BAD_LINE = "_bad_line"  # the text of a line that does not fit its schema


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _csv(spark: SparkSession, path: str, schema: T.StructType | str, mode: str) -> DataFrame:
    """The columns of the schema, by header name, and BAD_LINE.

    The header is read from one file; a file whose header has other names or another order is an error, not a
    shift of its cells. Columns that the schema does not name are read as text and left out.
    """
    wanted = _struct(schema)
    found = spark.read.option("header", True).csv(path).columns
    if missing := [f.name for f in wanted.fields if f.name not in found]:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(found)}")
    kinds = {f.name: f.dataType for f in wanted.fields}
    layout = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in found])
    rows = (
        spark.read.option("header", True)
        .option("dateFormat", DATE_FORMAT)
        .option("timestampFormat", MINUTE_FORMAT)
        .option("enforceSchema", False)
        # a line is judged by all its cells, whichever of them the query uses
        .option("columnPruning", False)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .schema(layout.add(BAD_LINE, T.StringType()))
        .csv(path)
    )
    return rows.select(*[f"`{f.name}`" for f in wanted.fields], BAD_LINE)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line, whose columns are found by name in any order.

    A leading byte-order mark is ignored and empty cells are NULL. A cell that is not of its type, or a line with
    too few or too many cells, ends the query; ``split_csv`` sets such lines apart instead.
    """
    return _csv(spark, path, schema, "FAILFAST").drop(BAD_LINE)


class Loaded(NamedTuple):
    """The lines that fit the schema; ``file, line`` of those that do not, as written; and ``file, lines, rejected``."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def split_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> Loaded:
    """CSV parsed once, into a table from which the good lines, the bad ones and their counts are read."""
    parsed = materialise(_csv(spark, path, schema, "PERMISSIVE").withColumn("_file", F.input_file_name()), "csv")
    bad = F.col(BAD_LINE).isNotNull()
    rejects = parsed.where(bad).select(F.col("_file").alias("file"), F.col(BAD_LINE).alias("line"))
    counts = parsed.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("lines"), F.count(BAD_LINE).alias("rejected"))
    return Loaded(parsed.where(~bad).drop(BAD_LINE, "_file"), rejects, counts)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV folder with a header in every part file; one part per task, nothing is gathered."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("dateFormat", DATE_FORMAT)
        .option("timestampFormat", MINUTE_FORMAT)
        .csv(path)
    )


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    mode: str = "overwrite",
) -> None:
    """Catalog table. Tables bucketed alike on their join key later join without a shuffle."""
    writer = df.write.mode(mode)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of a folder. Known tables bring their schema, so no file is opened to plan a query."""
    reader = spark.read.schema(star_schema(table)) if table in STAR_NAMES else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def register_folder(spark: SparkSession, folder: str, tables: Iterable[str] = STAR_NAMES) -> None:
    """Make the tables of a folder available to SQL under their own names."""
    register({t: read_parquet(spark, folder, t) for t in tables})


def register(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Spark SQL over catalog tables and over the frames given by name."""
    return spark.sql(text, **(frames or {})) if frames else spark.sql(text)


def table_names(spark: SparkSession) -> DataFrame:
    """Tables and views of the current schema, by name."""
    return spark.sql("SHOW TABLES").select("tableName", "isTemporary").orderBy("tableName")


def inline(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small frame from literals. It is part of the plan, so no task has to unpickle it."""
    kinds = to_arrow_schema(_struct(schema))
    columns = list(zip(*rows)) or [()] * len(kinds)
    made = pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds)], schema=kinds)
    return spark.createDataFrame(made, _struct(schema))
