"""Scans and sinks. Every reader and writer is a plain Spark data source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waypost.sources.csv_records import csv_records

# Cell texts that a CSV scan reads as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, without scanning its rows."""
    return spark.read.option("header", True).option("escape", '"').option("enforceSchema", True).csv(path).columns


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool | str = "split") -> DataFrame:
    """CSV with a header. Without a schema every column is read as text.

    Raw columns are dirty, so types are never inferred. Cells holding an NA
    token become NULL. Quotes inside quoted cells are doubled, and such cells
    may hold line breaks; a large file is still read by many tasks, in three
    passes (quotes, records, fragments of records at the edges of splits).
    ``multi_line=False`` reads files without such breaks in one pass;
    ``multi_line=True`` reads each file in one task, for files whose lines end
    with a carriage return alone.
    """
    names = csv_header(spark, path)
    schema = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    if multi_line == "split":
        fields = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in schema)
        df = csv_records(spark, path).select(F.from_csv("text", fields, {"escape": '"'}).alias("_row")).select("_row.*")
    else:
        df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').schema(schema).csv(path)
    texts = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *[F.when(~F.col(q(c)).isin(NA_TOKENS), F.col(q(c))).alias(c) if c in texts else F.col(q(c)) for c in df.columns]
    )


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file per partition; rows are never pulled into a single task."""
    quoted = df.write.mode(mode).option("header", True).option("escape", '"')
    quoted.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON records with ISO dates."""
    df.write.mode(mode).option("dateFormat", "yyyy-MM-dd").option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss"
    ).json(path)


def json_records(df: DataFrame, column: str = "record") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(column))


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report bodies as text, one row per report."""
    df.select("report_md").write.mode(mode).text(path)


def q(name: str) -> str:
    """Back-quote a column name that may hold dots, blanks or per-cent signs."""
    return "`" + name.replace("`", "``") + "`"


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; two present aliases of one name are an error."""
    present = {old: new for old, new in names.items() if old in df.columns}
    targets = [present.get(c, c) for c in df.columns]
    twice = sorted({t for t in targets if targets.count(t) > 1})
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    return df.withColumnsRenamed(present)


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def enforce_schema(df: DataFrame, order: list[str]) -> DataFrame:
    """Contract columns first, the others after them; a missing one is an error."""
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rest = [c for c in df.columns if c not in order]
    return df.select(*[F.col(q(c)) for c in order + rest])


def schema_summary(df: DataFrame) -> DataFrame:
    """Row count, column count and number of columns per type."""
    kinds = [kind for _, kind in df.dtypes]
    per_kind = F.array(
        *[F.struct(F.lit(k).alias("dtype"), F.lit(kinds.count(k)).cast("bigint").alias("n_of_dtype")) for k in sorted(set(kinds))]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        "n_rows", F.lit(len(kinds)).cast("bigint").alias("n_columns"), F.inline(per_kind)
    )


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(q(c)) for c in numeric_columns(df)])


def select_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(q(c)) for c in text_columns(df)])


def numeric_columns(df: DataFrame) -> list[str]:
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, kind in df.dtypes if kind in plain or kind.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind == "string"]


def preview(df: DataFrame, condition, cols: list[str], key: list[str], n: int = 3) -> DataFrame:
    """First ``n`` rows that meet a condition, in key order."""
    return df.filter(condition).orderBy(*key).limit(n).select(*cols)
