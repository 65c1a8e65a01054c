"""Checks on JSON-lines files: line audit, key sets, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, file_size, block_start, row_in_task, line) of text files, splittable."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_in_task"),
        F.col("value").alias("line"),
    )


def is_json(line: Column) -> Column:
    """True for exactly one JSON value. Objects may repeat a key; other quotes are not JSON."""
    one_value = F.coalesce(F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))), F.lit(0)) == 1
    strict_object = F.from_json(
        line, "_bad STRING", {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    )["_bad"].isNull()
    blank = F.trim(line) == ""
    return ~blank & one_value & (strict_object | F.try_parse_json(line).isNotNull())


def line_status(line: Column) -> Column:
    return F.when(F.trim(line) == "", "empty").when(is_json(line), "valid").otherwise("malformed")


def audit_jsonl(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """Lines, valid, empty and malformed counts and characters per file."""
    status = line_status(F.col(line))
    return lines.withColumn("_status", status).groupBy(file).agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("_status") == "valid").alias("valid"),
        F.count_if(F.col("_status") == "empty").alias("empty"),
        F.count_if(F.col("_status") == "malformed").alias("malformed"),
        F.sum(F.length(line)).alias("characters"),
    )


def key_sets(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """How often each set of top-level keys occurs among the valid objects of a file."""
    keys = F.array_join(F.array_sort(F.array_distinct(F.json_object_keys(line))), ",")
    return (
        lines.filter(is_json(F.col(line)) & F.json_object_keys(line).isNotNull())
        .groupBy(file, keys.alias("keys"))
        .agg(F.count("*").alias("lines"))
    )


def head_lines(lines: DataFrame, n: int, order: list[Column], file: str = "file") -> DataFrame:
    """First ``n`` lines of each file; map tasks already drop all but ``n`` per file."""
    position = Window.partitionBy(file).orderBy(*order)
    return lines.withColumn("line_no", F.row_number().over(position)).filter(F.col("line_no") <= n)
