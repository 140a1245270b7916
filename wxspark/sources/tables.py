"""Readers and writers. Writing is distributed; reading uses the fixed schemas and fails on a missing path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wxspark.constants import ATTRIBUTES
from wxspark.operators.units import header, rename_units
from wxspark.schemas import OBSERVATION

# The default format keeps milliseconds only.
CSV_OPTIONS = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
_RECORD = "_corrupt_record"


def write_observations_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_observations_csv(spark: SparkSession, path: str) -> DataFrame:
    """A value that does not fit its column fails the job; it would be read as null otherwise."""
    return spark.read.schema(OBSERVATION).options(mode="FAILFAST", **CSV_OPTIONS).csv(path)


def split_observations_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Observations and, beside them, the lines that are none: record, file and the reason. Each line but the headers is
    in one of the two.

    A line is an observation if it has a value of the right type for every column, and no more.
    """
    with_record = StructType([*OBSERVATION.fields, StructField(_RECORD, StringType())])
    lines = spark.read.schema(with_record).options(columnNameOfCorruptRecord=_RECORD, mode="PERMISSIVE", **CSV_OPTIONS).csv(path)
    columns = [F.col(c) for c in OBSERVATION.fieldNames()]
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]) & F.col(_RECORD).isNull()
    bad = lines.where(~whole).select(*columns, _RECORD, F.col("_metadata.file_path").alias("file"))
    fields = F.split(_RECORD, ",")
    wanted = len(OBSERVATION)
    reason = F.when(F.col(_RECORD).isNotNull() & (F.size(fields) != wanted), F.concat(F.size(fields), F.lit(f" of {wanted} fields")))
    for i, field in enumerate(OBSERVATION.fields):
        raw, kind = F.trim(F.get(fields, i)), field.dataType.simpleString()
        given = F.col(_RECORD).isNotNull() & (raw != "")
        reason = reason.when(F.col(field.name).isNull() & given, F.concat(F.lit(f"{field.name} is no {kind}: "), raw))
        reason = reason.when(F.col(field.name).isNull(), F.lit(f"{field.name} is missing"))
    # A line that is short of values but parses has no corrupt record; its values say what it was.
    values = F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return lines.where(whole).drop(_RECORD), bad.select(F.coalesce(_RECORD, values).alias("record"), "file", reason.alias("reason"))


def write_observations(df: DataFrame, path: str, scale: str) -> None:
    """Parquet under ``target_scale=<scale>/``, so a reader of one scale opens that folder only.

    Writing that folder itself replaces one scale and needs no sort by a constant partition column.
    """
    df.write.mode("overwrite").parquet(f"{path}/target_scale={scale}")


def read_observations(spark: SparkSession, path: str, scale: str | None = None) -> DataFrame:
    if scale is not None:
        return spark.read.schema(OBSERVATION).parquet(f"{path}/target_scale={scale}")
    return spark.read.parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = (), buckets: int | None = None) -> None:
    """Catalog table; external when a path is given.

    With ``by`` its rows are in buckets by those columns and sorted by them in each, so that joins and aggregates on them
    need no shuffle of the table. By default there are as many buckets as shuffles have partitions; rows are dealt to them
    first, so each bucket is one file.
    """
    writer = df.write.format("parquet")
    if by:
        buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_regimes(df: DataFrame, path: str) -> None:
    """One folder per weather type; the folder above them is the table of all types."""
    df.write.partitionBy("weather").parquet(path)


def read_regimes(spark: SparkSession, path: str, weather: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if weather is None else df.where(F.col("weather") == weather)


def sheet_names(df: DataFrame) -> DataFrame:
    """The names a reader can open: the table of all types and each type's folder."""
    return df.sparkSession.sql("SELECT 'All Data' AS sheet").union(df.select("weather").distinct())


def union_regimes(parts: list[DataFrame]) -> DataFrame:
    """All types in one table, matched by column name; ``row_no`` already numbers the whole."""
    return reduce(DataFrame.unionByName, parts)


def write_regimes_csv(df: DataFrame, path: str) -> None:
    """The same fan-out as CSV whose headers carry the units."""
    rename_units(df).write.option("header", True).partitionBy(header("weather")).csv(path)


def read_regimes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The types' folders read back, with the headers as they were written."""
    fields = [f"`{header(name)}` double" for name in ATTRIBUTES]
    schema = ", ".join(["row_no long", *fields, f"`{header('weather')}` string"])
    return spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)
