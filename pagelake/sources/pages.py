"""Landed pages: one JSON response body per row, with its request context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelake.schemas import RAW_PAGES


def read_pages(spark: SparkSession, path: str, streaming: bool = False,
               fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Read the landing table (``parquet``) or a folder of JSON lines (``json``).

    The schema is fixed, so there is no inference pass over the files, and a
    stream and a batch read give the same columns.  ``body`` stays text: each
    page kind parses only the paths it needs.
    """
    if streaming:
        reader = spark.readStream.schema(RAW_PAGES).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    return spark.read.schema(RAW_PAGES).format(fmt).load(path)
