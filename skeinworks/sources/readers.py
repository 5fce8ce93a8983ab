"""Readers for the file layouts the jobs meet. All return lazy DataFrames with given schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.text import strip


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_quoted_lines_csv(spark: SparkSession, path: str, header: str, schema: str) -> DataFrame:
    """CSV whose whole lines are wrapped in a pair of quotes.

    Each line is stripped, freed of one outer pair and parsed; the header line is dropped, the
    columns take the names of `schema`, and text cells lose blanks and quotes at their ends.
    """
    line = strip(F.col("value"))
    wrapped = line.startswith('"') & line.endswith('"') & (F.length(line) >= 2)
    bare = F.when(wrapped, line.substr(F.lit(2), F.length(line) - 2)).otherwise(line)
    rows = spark.read.text(path).select(bare.alias("line")).where((F.col("line") != header) & (F.col("line") != ""))
    parsed = rows.select(F.from_csv("line", schema).alias("r")).select("r.*")
    clean = [
        F.regexp_replace(strip(F.col(f.name)), r'^"+|"+$', "").alias(f.name)
        if isinstance(f.dataType, StringType)
        else F.col(f.name)
        for f in parsed.schema.fields
    ]
    return parsed.select(*clean)


def read_whole_texts(spark: SparkSession, path: str, *, suffix: str = ".txt") -> DataFrame:
    """One row per file: path and text."""
    d = spark.read.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    return d.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Text files as they are and the review_text of JSON files ('' if absent); others are skipped."""
    plain = read_whole_texts(spark, path, suffix=".txt")
    coded = read_whole_texts(spark, path, suffix=".json").select(
        "path", F.coalesce(F.get_json_object("text", "$.review_text"), F.lit("")).alias("text")
    )
    return plain.unionByName(coded)


def read_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files holding one JSON array of records each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_bulk_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a bulk-index file: action lines are told by their content, not their position."""
    lines = spark.read.text(path).where(F.get_json_object("value", "$.index").isNull() & (F.trim("value") != ""))
    return lines.select(F.from_json("value", schema).alias("d")).select("d.*")


def read_day(spark: SparkSession, path: str, day: str, *, column: str = "day") -> DataFrame:
    """One day of a table partitioned by date; other days' folders are not opened."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(day).cast("date"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def list_objects(spark: SparkSession, path: str, *, suffix: str = "") -> DataFrame:
    """Paths, sizes and times of files below a folder; their content is not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return d.load(path).select("path", "length", "modificationTime")


def catalogued(spark: SparkSession, path: str, name: str, *, kind: str = "csv") -> StructType:
    """Infer the schema over a folder and register it as a view of that name."""
    d = spark.read.option("header", True).option("inferSchema", True).format(kind).load(path)
    d.createOrReplaceTempView(name)
    return d.schema


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Shuffle by key only when the input comes in fewer splits than there are cores.

    A few files that cannot be split would keep costly text work on a few tasks; a table of
    many files is left as it is.
    """
    if df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
    return df
