"""Reference dictionaries as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.functions.text import map_strict
from waypost.sources import vocab
from waypost.sources.files import scan_csv


def dim(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A dictionary as a table.

    No broadcast hint: the optimizer knows the exact size of a local table and
    broadcasts it only while it is under its own threshold.
    """
    return spark.createDataFrame(list(rows), schema)


def mapping_dim(spark: SparkSession, values: Mapping[str, str], key: str, value: str) -> DataFrame:
    return dim(spark, list(values.items()), f"{key} string, {value} string")


def countries(spark: SparkSession) -> DataFrame:
    rows = [(name, code, i) for i, (name, code) in enumerate(vocab.COUNTRY_ISO3.items())]
    return dim(spark, rows, "country string, iso3 string, ord int")


def airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport directory from a CSV with columns ``iata, city, airport[, ord]``.

    ``ord`` is the position in the directory; it decides which code a city
    resolves to. Without it the code order is used.
    """
    df = scan_csv(spark, path)
    position = F.col("ord").try_cast("int") if "ord" in df.columns else F.lit(None).cast("int")
    return df.select("iata", "city", "airport", position.alias("ord"))


def city_codes(directory: DataFrame, primary: Mapping[str, str] | None = None) -> DataFrame:
    """City (upper case) -> one airport code.

    A city with several airports resolves to the last one listed, unless
    ``primary`` names its code. ``ord`` is the city's first position.
    """
    last = directory.groupBy(F.upper("city").alias("city")).agg(
        F.max_by("iata", F.struct("ord", "iata")).alias("iata"), F.min("ord").alias("ord")
    )
    if not primary:
        return last
    override = {city.upper(): code for city, code in primary.items()}
    return last.withColumn("iata", F.coalesce(map_strict(F.col("city"), override), "iata"))
