"""Presentation layer and consolidation of raw files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loadcycle.operators.relational import select_present
from loadcycle.plans import fixed_values as fixed
from loadcycle.sources.tables import read_parquet_folder, write_table


def presentation(stage: DataFrame) -> DataFrame:
    """The 17 columns that modelling reads."""
    return select_present(stage, fixed.PRESENTATION_COLUMNS)


def consolidate(
    spark: SparkSession, folder: str, output: str, mode: str = "overwrite", nanoseconds: Sequence[str] = ()
) -> DataFrame:
    """All Parquet files of ``folder`` as one table in ``output``; types that drift between files are widened.

    The output must lie outside the folder: a second run would read its own result.
    """
    inside, target = folder.rstrip("/") + "/", output.rstrip("/") + "/"
    if target.startswith(inside) or inside.startswith(target):
        raise ValueError("the output must not lie in the input folder, nor hold it")
    write_table(read_parquet_folder(spark, folder, nanoseconds), output, mode)
    return spark.read.parquet(output)
