"""Event and dimension scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StructField, StructType

from lodgetrail.sources import scratch


def pruned(schema: StructType, wanted: Iterable[str]) -> StructType:
    """The schema cut down to dotted paths, looking through arrays of structs.

    A path that names a struct or an array keeps all of it, unless longer paths
    below it are wanted too. Paths the schema lacks are ignored.
    """
    below: dict[str, set[str]] = {}
    for path in wanted:
        head, _, rest = path.partition(".")
        below.setdefault(head, set())
        if rest:
            below[head].add(rest)

    def cut(data_type: DataType, rest: set[str]) -> DataType:
        if not rest:
            return data_type
        if isinstance(data_type, ArrayType):
            return ArrayType(cut(data_type.elementType, rest), data_type.containsNull)
        if isinstance(data_type, StructType):
            narrow = pruned(data_type, rest)
            # Of a struct without any wanted field, one field still tells NULL from present.
            return narrow if narrow.fields else StructType(data_type.fields[:1])
        return data_type

    return StructType(
        [
            StructField(f.name, cut(f.dataType, below[f.name]), f.nullable)
            for f in schema.fields
            if f.name in below
        ]
    )


# The reader by batches works a default out once a file. The one by rows parses it again for every row.
_BY_BATCHES = {"spark.sql.parquet.enableVectorizedReader": "true", "spark.sql.parquet.enableNestedColumnVectorizedReader": "true"}
_LACKS = "_lacks"


def rows_lacking(spark: SparkSession, source: str, column: str) -> DataFrame:
    """The path (``file``) of each row whose file does not hold the struct column at all.

    A column absent from a file reads as NULL, as does a NULL value. So the
    struct is read as one of a single field that no file has, under a default
    value for the whole struct: only where the column is absent does the
    default show. A struct that is there reads as NULL or holds a NULL.
    """
    default = f"named_struct('{_LACKS}', true)"
    probe = StructField(
        column, StructType([StructField(_LACKS, BooleanType())]), True, {"CURRENT_DEFAULT": default, "EXISTS_DEFAULT": default}
    )
    # A session of its own, so that the options touch no other scan. Structs are
    # compared whole: cutting the read schema to one field would lose the default.
    session = spark.newSession()
    for option in _BY_BATCHES.items():
        session.conf.set(*option)
    return (
        session.read.schema(StructType([probe])).parquet(source)
        .where(F.col(column).eqNullSafe(F.expr(default)))
        .select(F.col("_metadata.file_path").alias("file"))
    )


def files_lacking(spark: SparkSession, source: str, column: StructField) -> DataFrame:
    """Paths (``file``) of the source's files that hold rows but not the struct column at all.

    One narrow job; its result is a written table of at most one row a file.
    """
    path = scratch.fresh_path(spark, "files-lacking")
    rows_lacking(spark, source, column.name).distinct().write.parquet(path)
    return spark.read.schema("file string").parquet(path)


def read_events(
    spark: SparkSession,
    path: str,
    day: str | None = None,
    wanted: Iterable[str] | None = None,
    day_column: str = "date_part",
    flag_lacking: tuple[str, str] | None = None,
) -> DataFrame:
    """Raw events: one dataset, or one day's directory of a dataset partitioned by day.

    With ``day``, only that day's directory is listed, not the whole dataset.

    ``wanted`` lists the dotted paths to read. Spark prunes fields inside
    arrays of structs only in simple cases once the arrays are opened; naming
    them in the read schema makes the scan skip the rest in every case.

    The columns are those of all files of the source together, found by a
    distributed look at every footer: a day may mix layouts, and no one file
    decides what the others hold. Columns a file lacks are NULL in its rows.

    ``flag_lacking`` names a struct column and a flag to add: whether the
    row's file lacks that column. It is added only where some files lack the
    column and some do not, which one narrow job finds out.
    """
    source = path if day is None else f"{path.rstrip('/')}/{day_column}={day}"

    def reader() -> DataFrameReader:
        plain = spark.read.option("mergeSchema", True)
        return plain if day is None else plain.option("basePath", path)

    found = reader().parquet(source)
    events = found if wanted is None else reader().schema(pruned(found.schema, wanted)).parquet(source)
    column, flag = flag_lacking or (None, None)
    if column not in found.columns or not isinstance(found.schema[column].dataType, StructType):
        return events
    lacking = files_lacking(spark, source, found.schema[column])
    if lacking.isEmpty():
        return events
    # No hint: Spark broadcasts the paths where they measure small.
    known = lacking.withColumn(flag, F.lit(True))
    filed = events.select("*", F.col("_metadata.file_path").alias("file"))
    return filed.join(known, "file", "left").drop("file").withColumn(flag, F.coalesce(flag, F.lit(False)))


def read_delimited(
    spark: SparkSession, path: str, columns: Iterable[str], separator: str = "|"
) -> DataFrame:
    """Named columns of delimited text with a header, all as strings, nothing inferred."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", separator)
        .csv(path)
        .select(*columns)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A plain Parquet table."""
    return spark.read.parquet(path)
