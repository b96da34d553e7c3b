"""Tables in and out: CSV (plain or compressed), JSON and Parquet.

Paths may point to any file system the session knows. Compressed CSV is read
through the codecs of the Hadoop build (gz and bz2 always).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.cells import MISSING_TOKENS, six_digits
from plumbline.operators.coerce import missing_tokens_to_null
from plumbline.operators.tables import without_nan
from plumbline.sources.quoted import read_quoted, understood


def _suffix(path: str) -> str:
    name = str(path).lower().rstrip("/")
    if name.endswith((".parquet", ".pq")):
        return "parquet"
    if name.endswith((".json", ".jsonl")):
        return "json"
    if name.endswith((".pkl", ".pickle")):
        raise ValueError("pickle tables are not supported: write Parquet")
    return "csv"


#: Quotes are doubled inside quoted cells, on both sides; white space around a cell is part of it.
CSV_FORM = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_table(spark: SparkSession, path: str, fmt: str = "infer", missing: tuple[str, ...] = MISSING_TOKENS,
               multi_line: bool = True, split: bool = True, **options: str) -> DataFrame:
    """Parquet with its types, NaN and infinity as nulls; CSV as text columns with missing-value tokens nulled.

    CSV cells may hold line breaks, and files are split over tasks all the same (``plumbline.sources.quoted``). That needs
    quotes to stand around whole cells only, which is checked; ``split=False``, or an option that changes what a quote or a
    line is, reads each file in one task. ``multi_line=False`` says that no cell holds a line break, which saves a pass; a
    row that does not fit the header fails instead of shifting cells.
    """
    fmt = _suffix(path) if fmt == "infer" else fmt
    if fmt == "parquet":
        return without_nan(spark.read.options(**options).parquet(str(path)))
    if fmt == "json":
        return read_json(spark, path, **options)
    if fmt != "csv":
        raise ValueError(f"unknown format: {fmt}")
    if multi_line and split and understood({**CSV_FORM, **options}):
        return missing_tokens_to_null(read_quoted(spark, str(path), {**CSV_FORM, **options}), missing)
    reading = {"multiLine": "true"} if multi_line else {"multiLine": "false", "mode": "FAILFAST"}
    return missing_tokens_to_null(spark.read.options(**{**CSV_FORM, **reading, **options}).csv(str(path)), missing)


def read_json(spark: SparkSession, path: str, layout: str = "infer", **options: str) -> DataFrame:
    """Records as a table; an array of plain values as one ``value`` column.

    ``layout="lines"``: one record per line in any number of files, split over tasks; a line that is no record fails.
    ``layout="document"``: every file is one JSON document, read whole by one task, which suits modest reports.
    ``layout="infer"`` looks at the first line: a whole record means lines.
    """
    if layout == "infer":
        first = spark.read.text(str(path)).filter(F.trim("value") != "").head()
        layout = "lines" if first is None or _is_record(first[0]) else "document"
    if layout == "lines":
        return spark.read.options(**{"mode": "FAILFAST", **options}).json(str(path))
    if layout != "document":
        raise ValueError("layout must be 'infer', 'lines' or 'document'")
    table = spark.read.options(**{"multiLine": "true", **options}).json(str(path))
    if table.columns == ["_corrupt_record"]:
        raw = spark.read.option("wholetext", "true").text(str(path))
        values = F.from_json("value", T.ArrayType(T.DoubleType()))
        return raw.select(F.explode(values).alias("value"))
    return table


def _is_record(line: str) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def load_dataset(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A CSV data set; a path that does not exist raises Spark's analysis error."""
    return read_table(spark, path, "csv", **options)


def write_table(df: DataFrame, path: str, fmt: str = "infer", short_floats: bool = True,
                mode: str = "overwrite") -> None:
    """Parquet, JSON or CSV (header, doubles to six significant digits)."""
    fmt = _suffix(path) if fmt == "infer" else fmt
    if fmt == "parquet":
        df.write.mode(mode).parquet(str(path))
    elif fmt == "json":
        df.write.mode(mode).json(str(path))
    elif fmt == "csv":
        doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
        out = df.select(*[six_digits(F.col(c)).alias(c) if short_floats and c in doubles else F.col(c)
                          for c in df.columns])
        writer = out.write.mode(mode).options(**CSV_FORM)
        for ending, codec in ((".gz", "gzip"), (".bz2", "bzip2")):
            if str(path).lower().endswith(ending):
                writer = writer.option("compression", codec)
        writer.csv(str(path))
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_audit(report: DataFrame, table_path: str) -> str:
    """The audit report as JSON beside its table."""
    stem = str(table_path).rstrip("/")
    head, _, name = stem.rpartition("/")
    name = name.split(".")[0]
    path = f"{head}/{name}.audit.json" if head else f"{name}.audit.json"
    report.write.mode("overwrite").json(path)
    return path


# -------------------------------------------------------- versioned small reports

def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(str(path))
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def write_version(df: DataFrame, folder: str, fmt: str = "json") -> str:
    """Write to a fresh sub-folder: readers never see half a result, old versions stay."""
    known = [int(n.split("-")[0][1:]) for n in list_names(df.sparkSession, folder) if n.startswith("v")]
    path = f"{str(folder).rstrip('/')}/v{max(known, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    write_table(df, path, fmt, short_floats=False, mode="errorifexists")
    return path


def read_version(spark: SparkSession, folder: str, fmt: str = "json") -> DataFrame:
    """The newest complete version (the one whose job has committed)."""
    for name in reversed(list_names(spark, folder)):
        path = f"{str(folder).rstrip('/')}/{name}"
        fs, marker = _file_system(spark, f"{path}/_SUCCESS")
        if name.startswith("v") and fs.exists(marker):
            if fmt == "json":
                return spark.read.json(path)
            return read_table(spark, path, fmt)
    raise FileNotFoundError(f"no complete version under {folder}")


def write_features(spark: SparkSession, features: list[str], path: str) -> None:
    rows = [(i, f) for i, f in enumerate(features)]
    table = spark.createDataFrame(rows, "position int, feature string").coalesce(1)
    table.write.mode("overwrite").option("header", "true").csv(str(path))


def read_features(spark: SparkSession, path: str) -> list[str]:
    table = spark.read.option("header", "true").csv(str(path))
    order = F.col("position").cast("int") if "position" in table.columns else F.monotonically_increasing_id()
    return [r["feature"] for r in table.orderBy(order).collect()]


def write_predictions(df: DataFrame, path: str, keep: tuple[str, ...] = ()) -> None:
    """The ``prediction`` column (and row keys), as CSV or JSON by the path's suffix."""
    write_table(df.select(*keep, "prediction"), path, short_floats=False)
