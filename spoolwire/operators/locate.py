"""Where the invalid bytes of a text source are: file, line and byte, found split by split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoolwire.errors import SourceNotFound
from spoolwire.functions.text import head_chars, utf8_repair, utf8_valid_prefix
from spoolwire.operators.source_order import ROW
from spoolwire.sources.csv import BLOCK, FILE, source_exists

#: Consecutive lines whose lengths are ever summed up one by one.
RUN = 4096
#: Characters of a bad line that are shown.
SHOWN = 100


def locate_bad_utf8(spark: SparkSession, path: str, run: int = RUN) -> DataFrame:
    """Every line of ``path`` that isn't valid UTF-8: ``file, line, byte, text``.

    ``line`` counts from 1, ``byte`` is the offset in the file of the line's
    first invalid sequence, ``text`` the start of the line, repaired. Lines end
    in ``\\n``; a byte order mark counts as three bytes of the first line. For
    compressed files ``byte`` is an offset in the uncompressed text. Sources
    without a bad line give no row.

    Lines and bytes are counted per run of ``run`` lines of a split, and summed
    up over the runs of a file; only runs with a bad line are looked at again,
    line by line, without their texts.
    """
    if not source_exists(spark, path):
        raise SourceNotFound(path)
    text = spark.read.option("lineSep", "\n").text(path)
    bad_at = utf8_valid_prefix("value")
    lines = text.select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias(ROW),
        (F.octet_length("value") + 1).cast("long").alias("_bytes"), bad_at.alias("_bad"),
        F.when(bad_at.isNotNull(), head_chars(utf8_repair("value"), SHOWN)).alias("text"),
    ).withColumn("_run", F.expr(f"{ROW} div {int(run)}"))
    runs = lines.groupBy(FILE, BLOCK, "_run").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_length"), F.count("_bad").alias("_bads"), F.max("_size").alias("_size")
    )
    whole = Window.partitionBy(FILE)
    earlier = whole.orderBy(BLOCK, "_run").rowsBetween(Window.unboundedPreceding, -1)
    # a reader drops a byte order mark: the lines then have three bytes less than the file
    mark = F.when(F.sum("_length").over(whole) < F.col("_size"), 3).otherwise(0)
    lines_before, bytes_before = (F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("_n", "_length"))
    torn = runs.select(FILE, BLOCK, "_run", "_bads", lines_before.alias("_lines"), (bytes_before + mark).alias("_start"))
    torn = torn.where("_bads > 0").drop("_bads")
    in_run = Window.partitionBy(FILE, BLOCK, "_run").orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    found = lines.join(torn, [FILE, BLOCK, "_run"]).select(
        F.col(FILE).alias("file"), "text", "_bad",
        (F.col("_lines") + F.count(ROW).over(in_run) + 1).alias("line"),
        (F.col("_start") + F.coalesce(F.sum("_bytes").over(in_run), F.lit(0)) + F.col("_bad")).alias("byte"),
    )
    return found.where(F.col("_bad").isNotNull()).select("file", "line", "byte", "text")
