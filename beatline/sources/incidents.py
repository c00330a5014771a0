"""Readers, writers and schema introspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_incidents(spark: SparkSession, source: str, format: str = "parquet",
                   schema: T.StructType | None = None, **options) -> DataFrame:
    """Scan an incident table.

    ``source`` is a path, or a table name when ``format == "table"``. Any
    installed connector works through ``format``; filters and projections
    applied later are pushed into the scan by Catalyst.
    """
    if format == "table":
        return spark.table(source)
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


#: What both sides agree on, so that any text survives: quotes are doubled (as
#: other CSV writers do), spaces are kept, an empty string is ``""`` and a null
#: is an empty field.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "", "emptyValue": '""',
}
#: What a quoted empty field is read as before it becomes an empty string: the
#: reader takes any value equal to ``nullValue``, quoted or not, for a null.
_EMPTY = "\ue000empty\ue000"


def read_csv(spark: SparkSession, path: str,
             schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header row.

    With a declared schema the file is read once; without one Spark infers
    types in an extra pass (``True``/``False`` become boolean, empty fields
    null). Malformed values become null instead of failing the job.

    ``multi_line``: fields may hold line breaks. Such a file cannot be split,
    so its rows are read by one task; write many files (``write_table`` writes
    one a task), or pass False where no field holds a line break.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("mode", "PERMISSIVE").option("multiLine", multi_line)
    reader = reader.option("emptyValue", _EMPTY)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.select(*[
        F.when(F.col(f"`{f.name}`") != _EMPTY, F.col(f"`{f.name}`")).when(F.col(f"`{f.name}`") == _EMPTY, "").alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_table(df: DataFrame, path: str, format: str = "csv",
                partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", only_present: bool = False) -> None:
    """Write from the executors (S4): one file per task, header for CSV.

    ``partition_by`` (e.g. ``["year"]``) lets later reads prune partitions. Rows
    are then rebalanced by these columns first: Spark joins small parts and splits
    a hot one by measured sizes, so a partition gets few files of even size.
    ``only_present``: overwrite only the partitions that occur in ``df`` and leave
    the others (an empty ``df`` overwrites nothing).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(format)
    if only_present:
        if not partition_by:
            raise ValueError("only_present needs partition_by")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def register_table(spark: SparkSession, name: str, path: str, format: str = "parquet",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Register the files at ``path`` as an external table of the session's catalog
    and collect its statistics (S1): rows, bytes and, for ``columns`` (default:
    all), distinct values, nulls and ranges, in one Spark job.

    With ``spark.sql.cbo.enabled`` the optimizer estimates filters and joins from
    them and so chooses the join; without it the table's size is still used. Dropping
    the table leaves the files. Identifiers are quoted, so any name works.
    """
    quoted = ".".join(f"`{p}`" for p in name.split("."))
    spark.catalog.createTable(name, path=path, source=format)
    listed = "FOR ALL COLUMNS" if columns is None else "FOR COLUMNS " + ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {quoted} COMPUTE STATISTICS " + ("" if columns is not None and not columns else listed))
    return spark.table(name)


def describe_columns(df: DataFrame) -> DataFrame:
    """(column_name, data_type, ordinal_position) of a DataFrame.

    Schema only: no job runs. Types use Spark SQL names.
    """
    rows = [(f.name, f.dataType.simpleString(), i + 1)
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("ordinal_position", T.IntegerType(), False),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (S6); with ``order_by`` the rows are repeatable.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those reach the final merge.
    """
    if order_by:
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
    return df.limit(n)
