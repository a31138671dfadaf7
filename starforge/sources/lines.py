"""Read text files by physical line, with file, split and in-partition position.

Lines end at ``\\n``, ``\\r`` or ``\\r\\n`` (Hadoop line reader), like Python's
universal newlines. Invalid UTF-8 becomes U+FFFD.

Line numbers are computed per file from per-split counts (see
``operators.ingest``): no global sort and no single task ever holds the lines.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def read_lines(spark: SparkSession, path, derive=None) -> DataFrame:
    """Columns: value, _file, _block (split start byte), _pos (monotonic id), plus
    ``derive(value)`` columns.

    Derived columns are computed in the same projection as ``_pos``: a filter
    on them then cannot be pushed below it (the projection is not
    deterministic), so each derived expression is evaluated once per line.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("recursiveFileLookup", "true").text(paths)
    value = F.make_valid_utf8("value")
    cols = [value.alias("value"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos")]
    return raw.select(*cols, *(derive(value) if derive else []))
