"""Sources and sinks: CSV exports, JSON lines, Parquet artifacts, per-document files."""

from __future__ import annotations

import csv
import io
import json

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas

_RAW = "_corrupt_record"


#: Fixed value: the longest cell that is read, in characters.
MOST_CELL = 256 * 1024 * 1024


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV export, read through Spark."""
    return [c.lstrip("\ufeff") for c in spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns]


def _beyond(n: int):
    """The cells of raw CSV records behind the first `n`, as JSON; null where there are none."""

    def cells(raw: pd.Series) -> pd.Series:
        csv.field_size_limit(MOST_CELL)

        def one(record: str | None) -> str | None:
            if record is None:
                return None
            found = next(csv.reader(io.StringIO(record, newline="")), [])[n:]
            return json.dumps(found, ensure_ascii=False, separators=(",", ":")) if found else None

        return raw.map(one)

    return F.pandas_udf(cells, "string")


def read_csv(spark: SparkSession, path: str, most_chars: int = -1) -> DataFrame:
    """Rows of an export, a file or a folder of files with one header: all columns strings, empty cells as "", quoted line ends kept.

    Rows are numbered within their file from 1 as source_row. Cells beyond the header, however many, go to extra_values
    as JSON; short rows have "" at their end.
    """
    names = csv_header(spark, path)
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in names), T.StructField(_RAW, T.StringType())])
    rows = (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
        .option("maxCharsPerColumn", most_chars).option("columnNameOfCorruptRecord", _RAW).option("emptyValue", "").csv(path)
    )
    # a file of records with line ends is read by one task in its order, so ids count its rows
    several = len(rows.inputFiles()) > 1
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id"))
    if several:
        rows = rows.join(rows.groupBy("_file").agg(F.min("_id").alias("_first")), "_file")
    else:
        rows = rows.withColumn("_first", F.lit(0))
    cells = (F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names)
    return rows.select((F.col("_id") - F.col("_first") + 1).alias("source_row"), *cells, _beyond(len(names))(F.col(_RAW)).alias("extra_values"))


def json_cell(cell: Column, path: str, kind: str) -> Column:
    """A value of a cell that may hold JSON; null where it holds none, or not there."""
    return F.try_variant_get(F.try_parse_json(cell), path, kind)


def read_json(spark: SparkSession, path: str) -> dict:
    """One JSON document of any file system."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, on any file system."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = held.getFileSystem(spark._jsc.hadoopConfiguration()).create(held, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_artifact(spark: SparkSession, path: str, name: str) -> tuple[DataFrame | None, dict | None]:
    """(table, error): a Parquet artifact, or why it can't be read."""
    try:
        return spark.read.parquet(path), None
    except AnalysisException as e:
        kind = "MissingInput" if "PATH_NOT_FOUND" in str(e) else "UnreadableParquet"
        return None, {"artifact": name, "error": kind, "message": str(e).splitlines()[0]}
    except Exception as e:  # a damaged footer fails in the reader, with an error of its own
        return None, {"artifact": name, "error": "UnreadableParquet", "message": str(e).splitlines()[0]}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def bad_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of the lines that are no JSON, numbered within their file."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "value"))
    return lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull()).select((F.col("pos") + 1).alias("line"), "value")


def write_table(df: DataFrame, path: str, name: str, overwrite: bool = False) -> None:
    """A table in its declared columns; refuses to replace one unless told to."""
    df.select(*(F.col(f.name).cast(f.dataType) for f in schemas.schema(name))).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def as_json_cells(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without them."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema))


def write_jsonl(df: DataFrame, path: str, overwrite: bool = True) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    as_json_cells(df).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_by_document(df: DataFrame, path: str) -> None:
    """A folder of one JSON file for each document. Opt-in: as many files as documents."""
    df.withColumn("doc", F.col("doc_id")).write.mode("overwrite").partitionBy("doc").json(path)


def single_row(df: DataFrame) -> dict:
    """A one-row report as plain Python."""
    row = df.first()
    return json.loads(json.dumps(row.asDict(recursive=True), default=str)) if row else {}
