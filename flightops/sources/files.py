"""File sources and sinks (parquet, csv, json)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import col, to_date

# canonical fields that are numeric once typed (csv holds text)
NUMERIC_FIELDS = {
    "scheduled_dep_time": "double", "scheduled_arr_time": "double", "actual_dep_time": "double",
    "actual_arr_time": "double", "departure_delay": "double", "arrival_delay": "double",
    "distance": "double", "cancelled": "double", "diverted": "double", "air_time": "double",
    "taxi_out": "double", "taxi_in": "double", "wheels_off": "double", "wheels_on": "double",
}


def file_format(path: str) -> str:
    low = path.lower().rstrip("/")
    if low.endswith((".parquet", ".pq")):
        return "parquet"
    if low.endswith((".csv", ".csv.gz", ".gz")):
        return "csv"
    if low.endswith(".zip"):
        raise ValueError("zip archives are not splittable; unpack to csv/csv.gz first")
    raise ValueError(f"unsupported dataset format: {path!r} (expected csv or parquet)")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files that a path, folder or glob names, in name order, through the cluster's own file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    found = [s for s in (fs.globStatus(at) or [])]
    listed = [x for s in found for x in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    names = [x.getPath().toString() for x in listed]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith((".", "_"))
                  and n.lower().rstrip("/").endswith((".parquet", ".pq", ".csv", ".gz")))


def find_dataset(spark: SparkSession, folder: str) -> tuple[str, str | None]:
    """("found", first data file) of a folder of external data, or ("not provided", None)."""
    found = data_files(spark, folder)
    return ("found", found[0]) if found else ("not provided", None)


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               limit: int | None = None) -> DataFrame:
    """A file, a folder of files of one format, or a glob. Parquet keeps its
    types. CSV is read with every column as text (no inference pass over the
    data); numeric coercion happens later with ``try_cast`` so a bad value
    becomes null instead of failing the job. ``limit`` is a development
    sample, not an ordered head."""
    paths: list[str] = [path]
    if fmt is None:
        try:
            fmt = file_format(path)
        except ValueError:
            paths = data_files(spark, path)
            kinds = {file_format(p) for p in paths}
            if len(kinds) != 1:
                raise ValueError(f"unsupported dataset format: {path!r} holds {sorted(kinds) or 'no csv or parquet files'}") from None
            fmt = kinds.pop()
    if fmt == "parquet":
        df = spark.read.parquet(*paths)
    elif fmt == "csv":
        header = spark.read.option("header", True).csv(paths[0]).columns
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        df = spark.read.option("header", True).schema(schema).csv(paths)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return df.limit(limit) if limit is not None else df


def type_numeric(df: DataFrame) -> DataFrame:
    """try_cast text columns of known numeric canonical fields."""
    casts = {c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in NUMERIC_FIELDS.items()
             if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(casts) if casts else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unsupported sink format {fmt!r}")
    return path


MONTH = "month_of"


def write_monthly(df: DataFrame, path: str, date_col: str = "flight_date") -> str:
    """Parquet in one folder a month of `date_col` (``month_of=yyyy-MM``; rows without a date in the null folder).

    Only the months that `df` holds are replaced; all other months of the folder stay as they are. Rows are dealt
    by month and day, so a month is a few files, however many tasks made the rows, and a hot month is many."""
    day = to_date(col(date_col))
    dealt = df.withColumn(MONTH, F.date_format(day, "yyyy-MM")).repartition(MONTH, day)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return path


def read_dated(spark: SparkSession, path: str, first: str, last: str, date_col: str = "flight_date") -> DataFrame:
    """Rows of a monthly table with `first` <= date <= `last` (yyyy-MM-dd); only the folders of these months are listed
    in the scan, and the rest of the range is a filter on rows."""
    df = spark.read.option("basePath", path).schema(_with_text_month(spark, path)).parquet(path)
    day = to_date(col(date_col))
    kept = df.where(F.col(MONTH).between(first[:7], last[:7]))
    return kept.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).drop(MONTH)


def _with_text_month(spark: SparkSession, path: str) -> T.StructType:
    """The table's schema with the month as text, so that it is never guessed to be a date or a number."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != MONTH]
    return T.StructType([*fields, T.StructField(MONTH, T.StringType())])
