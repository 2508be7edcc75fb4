"""A key for every row of a table read from files, known without storing the rows again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake import scratch

ROW = "_row"
_PLACE_BITS = 40


def with_row_keys(docs: DataFrame, work: str) -> DataFrame:
    """``docs`` with a long ``_row``, different for every row, repeated rows and rows without an id included.

    The key is the number of the row's file and its place there, so it is the same whenever the
    rows are read again, also by a task that takes over from a lost one. Rows that do not come
    straight from files are stored below ``work`` first. Files are numbered by path, one narrow
    row for each.
    """
    place = F.col("_metadata.row_index")
    try:
        placed = docs.select(*docs.columns, F.col("_metadata.file_path").alias("_path"), place.alias("_place"))
    except AnalysisException:
        docs = scratch.stored(docs, f"{work}/rows")
        placed = docs.select(*docs.columns, F.col("_metadata.file_path").alias("_path"), place.alias("_place"))
    files = placed.select("_path").distinct()
    files = scratch.stored(files.withColumn("_file", F.row_number().over(Window.orderBy("_path")).cast("long")), f"{work}/files")
    key = F.shiftleft(F.col("_file"), _PLACE_BITS) + F.col("_place")
    return placed.join(files, "_path").select(*docs.columns, key.alias(ROW))
