"""Records in the order of their source: numbers, heads and positions from sums per split.

A scan reads a file in splits, each by one task from its first record to its
last. So a record's place is its split's first number plus its place in the
split: a count per split, and running sums over the splits of a file and over
the files. Records are never shuffled or sorted for it; what is summed is one
row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwire.sources.csv import BLOCK, FILE

#: Place of a record among those that its task reads.
ROW = "_row"
#: Splits beyond which their table is joined as Spark chooses, not broadcast (about 100 bytes each).
BROADCAST_SPLITS = 100_000


def split_sums(rows: DataFrame, keep: Column | None = None) -> DataFrame:
    """One row per split of ``rows`` (with ``_file, _block``): ``_task``, ``_at`` (its place there) and ``_n`` records that ``keep`` holds true for."""
    wanted = F.lit(True) if keep is None else keep
    # the number and the flag first: an aggregate can't number rows
    rows = rows.withColumns({"_at": F.monotonically_increasing_id(), "_task": F.spark_partition_id(), "_wanted": wanted})
    return rows.groupBy(FILE, BLOCK, "_task").agg(F.min("_at").alias("_at"), F.count_if("_wanted").alias("_n"))


def split_starts(sums: DataFrame) -> DataFrame:
    """Where the kept records of every split start, from :func:`split_sums`.

    Columns: ``_file, _block, _n``, ``_first`` (the number that :data:`ROW`
    gives the first kept one), ``_before_file`` and ``_before`` (kept records of
    earlier splits, in the file and in the source). The windows run over one
    small row per split, of which the scheduler holds as many.
    """
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.shiftleft(F.col("_task").cast("long"), 33) + earlier(Window.partitionBy("_task").orderBy("_at"))
    in_file, across = Window.partitionBy(FILE).orderBy(BLOCK), Window.orderBy(FILE, BLOCK)
    return sums.select(FILE, BLOCK, "_n", first.alias("_first"), earlier(in_file).alias("_before_file"), earlier(across).alias("_before"))


def split_counts(rows: DataFrame, keep: Column | None = None) -> DataFrame:
    """:func:`split_starts` of :func:`split_sums`: one pass over ``rows``."""
    return split_starts(split_sums(rows, keep))


def numbered(rows: DataFrame, splits: DataFrame, keep: Column | None = None, broadcast: bool = False) -> DataFrame:
    """The kept ``rows`` with ``record_no`` and ``file_record_no`` (from 1, in source order), by :func:`split_counts` of the same scan.

    Both passes must read the same splits in the same tasks, as scans of files
    that don't change do; a record whose place doesn't fit its split's count
    fails the query instead of getting a wrong number.
    """
    kept = rows if keep is None else rows.filter(keep)
    kept = kept.withColumn(ROW, F.monotonically_increasing_id())
    table = splits.select(FILE, BLOCK, "_n", "_first", "_before", "_before_file")
    joined = kept.join(F.broadcast(table) if broadcast else table, [FILE, BLOCK])
    place = F.col(ROW) - F.col("_first")
    checked = F.when((place >= 0) & (place < F.col("_n")), place).otherwise(F.raise_error(F.lit("the source changed between two passes over it")).cast("long"))
    joined = joined.withColumn(ROW, checked)
    no = {"record_no": F.col("_before") + F.col(ROW) + 1, "file_record_no": F.col("_before_file") + F.col(ROW) + 1}
    return joined.withColumns(no).drop(ROW, "_n", "_first", "_before", "_before_file")


def number_records(rows: DataFrame, keep: Column | None = None) -> DataFrame:
    """``rows`` of a scan with positions, numbered in source order: ``record_no`` in the source, ``file_record_no`` in its file.

    Files follow each other by path. ``keep`` numbers only the records it holds true for.
    """
    return numbered(rows, split_counts(rows, keep), keep)


def source_head(rows: DataFrame, n: int = 5, keep: Column | None = None) -> DataFrame:
    """The first ``n`` records of a source in its order, numbered from 1 (``record_no``): a top-k over the scan, no second pass."""
    kept = (rows if keep is None else rows.filter(keep)).withColumn(ROW, F.monotonically_increasing_id())
    first = kept.orderBy(FILE, BLOCK, ROW).limit(n)
    no = F.row_number().over(Window.orderBy(FILE, BLOCK, ROW)).cast("long")  # of n rows
    return first.withColumn("record_no", no).drop(ROW)
