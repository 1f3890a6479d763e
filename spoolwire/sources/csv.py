"""CSV source: header-derived all-string records with the semantics of a
dictionary-per-row CSV reader.

* values are never typed (``007`` and ``1.50`` stay text);
* an empty field is ``''``, a field missing from a short row is null;
* fields beyond the header width go to an ``_overflow`` array;
* blank lines are skipped, whitespace is kept;
* quoted fields may hold commas, doubled quotes and newlines.

Spark's CSV reader does the parsing. It nulls empty fields and flags short and
long rows with their raw text in a corrupt-record column; the raw text is
tokenised (JVM-side regex) only for those flagged rows to restore the
distinction between empty and missing and to recover the overflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire.errors import EncodingError, HeaderMismatch, SourceNotFound
from spoolwire.functions.text import csv_raw_tokens, csv_unquote
from spoolwire.workspace import path_exists

HEADER_META = "spoolwire.csv_header"
CORRUPT = "_corrupt_record"
OVERFLOW = "_overflow"
#: Where a record comes from: its file, and the first byte of the split that a task reads.
FILE = "_file"
BLOCK = "_block"


# Common spellings of the charsets Spark's CSV reader accepts.
_CHARSET_ALIASES = {"latin1": "iso-8859-1", "latin-1": "iso-8859-1", "ascii": "us-ascii", "utf8": "utf-8"}


def _charset(encoding: str) -> str:
    e = encoding.strip().lower().replace("_", "-")
    return _CHARSET_ALIASES.get(e, e)


def _base_reader(spark: SparkSession, multiline: bool, encoding: str):
    encoding = _charset(encoding)
    return spark.read.options(
        header=True,
        escape='"',  # RFC 4180 doubled quotes; Spark's default escape is a backslash
        multiLine=multiline,
        encoding=encoding,
        inferSchema=False,
    )


def source_exists(spark: SparkSession, path: str) -> bool:
    if any(ch in path for ch in "*?[{"):
        return True  # a glob: let Spark resolve it
    return path_exists(spark, path)


def raw_header(spark: SparkSession, path: str, multiline: bool = True, encoding: str = "utf-8") -> list[str]:
    """The header's cells as written (blank and repeated ones included), from the first record."""
    if not source_exists(spark, path):
        raise SourceNotFound(path)
    first = _base_reader(spark, multiline, encoding).option("header", False).csv(path).first()
    return [c or "" for c in first] if first else []


def csv_header(spark: SparkSession, path: str, multiline: bool = True, encoding: str = "utf-8") -> list[str]:
    """Column names from the header line (only the first record is read)."""
    if not source_exists(spark, path):
        raise SourceNotFound(path)
    return _base_reader(spark, multiline, encoding).csv(path).columns


def check_header_lines(spark: SparkSession, path: str) -> None:
    """Raise :class:`HeaderMismatch` unless the first lines of all files are the same.

    One row per file comes out of a pass over the first split of each file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).where(F.col("_metadata.file_block_start") == 0)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    first = F.regexp_replace(F.min_by("value", "at"), "^\ufeff|\r$", "")
    heads = lines.groupBy("file").agg(first.alias("head")).groupBy("head").agg(F.min("file").alias("file"))
    two = heads.orderBy("file").limit(2).collect()
    if len(two) > 1:
        raise HeaderMismatch(f"header of {two[1].file} is {two[1].head!r}, that of {two[0].file} {two[0].head!r}")


def csv_headers(df: DataFrame) -> list[str]:
    """The header-derived columns of a :func:`scan_csv` result, in file order."""
    return [f.name for f in df.schema.fields if f.metadata.get(HEADER_META)]


def scan_csv(
    spark: SparkSession,
    path: str,
    *,
    multiline: bool = True,
    encoding: str = "utf-8",
    include_header_record: bool = False,
    keep_raw: bool = False,
    check_headers: bool = True,
    with_position: bool = False,
) -> DataFrame:
    """Scan CSV file(s) into all-string columns named by the header.

    Output: the header columns, ``_overflow array<string>`` (fields beyond the
    header width, else null), with ``keep_raw`` ``_corrupt_record`` (the raw
    text of ragged rows), and ``with_position`` ``_file, _block``, from which
    ``operators.source_order`` numbers records.

    Spark's multi-line reader is the default: quoted fields may hold line
    breaks, and each file is one task, so large sources should come as many
    files. ``multiline=False`` splits files across tasks; it returns the same
    rows for sources that :func:`line_safe` approves.

    With several files each file's header is checked against the first
    (``check_headers``), because Spark matches CSV columns by position: by the
    reader itself, or line by line if the header has blank or repeated cells,
    which Spark renames. ``include_header_record`` adds the header's cells, as
    written, as the first record, as a reader given explicit field names would
    return it.
    """
    cells = raw_header(spark, path, multiline, encoding)
    headers = csv_header(spark, path, multiline, encoding)
    for reserved in (CORRUPT, OVERFLOW, *((FILE, BLOCK) if with_position else ())):
        if reserved in headers:
            raise ValueError(f"header column {reserved!r} clashes with a reserved column")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers] + [T.StructField(CORRUPT, T.StringType())])
    renamed = cells != headers and [c.lstrip("\ufeff") for c in cells] != headers
    if check_headers and renamed:
        check_header_lines(spark, path)
    raw_df = (
        _base_reader(spark, multiline, encoding)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=renamed or not check_headers)
        .schema(schema)
        .csv(path)
    )
    width = len(headers)
    raw = F.col(CORRUPT)
    staged = raw_df.withColumn("_toks", F.when(raw.isNotNull(), csv_raw_tokens(raw)))
    n = F.size("_toks")
    meta = {HEADER_META: True}
    cols = []
    for i, h in enumerate(headers):
        c = F.col(f"`{h}`")
        present = raw.isNull() | (F.lit(i) < n)
        cols.append(F.when(present, F.coalesce(c, F.lit(""))).alias(h, metadata=meta))
    cols.append(F.when(n > width, csv_unquote(F.slice("_toks", width + 1, n - width))).alias(OVERFLOW))
    if keep_raw:
        cols.append(raw.alias(CORRUPT))
    if with_position:
        cols += [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]
    out = staged.select(cols)
    if include_header_record:
        # before every file
        row = [tuple(cells) + (None,) + ((None,) if keep_raw else ()) + (("", 0) if with_position else ())]
        head = spark.createDataFrame(row, out.schema)
        out = head.unionByName(out)
        out = out.select([F.col(f"`{h}`").alias(h, metadata=meta) for h in headers] + out.columns[width:])
    return out


# A line whose fields are all empty, quoted or not.
_EMPTY_LINE = r'^(?:"")?(?:,(?:"")?)*+\z'
# A line whose fields are each quoted as a whole, or free of quotes.
_WHOLE_LINE = r'^(?:"(?:[^"]++|"")*+"|[^",]*+)(?:,(?:"(?:[^"]++|"")*+"|[^",]*+))*+$'


def line_safe(spark: SparkSession, path: str, encoding: str = "utf-8") -> bool:
    """Whether reading line by line returns the rows of the multi-line reader, proven by one pass over the source.

    Every line must be a record of its own: each field quoted as a whole or
    free of quotes, no carriage return, no NUL, not made of characters up to
    U+0020 alone (the line reader drops such lines). Sources in other encodings
    than UTF-8 are never approved.
    """
    if _charset(encoding) != "utf-8":
        return False
    return not audit_encoding(spark, path).agg(F.sum("unsafe_lines")).first()[0]


def _marked_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a source as ``value``, with their split (``_file, _block``), ``_bad`` (not UTF-8) and ``_unsafe`` (:func:`line_safe`).

    Patterns are tried only on lines that can fail them: a line without a
    quote has whole fields, and a blank one starts with a character up to U+0020.
    """
    value = F.col("value")
    blank = (value < "!") & value.rlike(r"^[\x00-\x20]+$")
    torn = value.contains('"') & ~value.rlike(_WHOLE_LINE)
    unsafe = blank | value.contains("\r") | value.contains("\x00") | torn
    marks = {FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start"), "_bad": ~F.is_valid_utf8(value), "_unsafe": unsafe}
    return spark.read.option("lineSep", "\n").text(path).withColumns(marks)


def audit_splits(spark: SparkSession, path: str, width: int) -> DataFrame:
    """One pass over the lines of a source: ``bad_lines``, ``unsafe_lines`` and the records with content of every split.

    ``_file, _block, _task, _at, _n`` are those of ``operators.source_order.split_sums``
    over ``scan_csv(..., multiline=False)``, ``_n`` counting the records that have a
    non-empty field or more than ``width`` fields. They hold for sources without
    unsafe lines, where each line that isn't empty is a record but for the first one
    of a file, and a line scan has the splits and tasks of a CSV scan.
    """
    if not source_exists(spark, path):
        raise SourceNotFound(path)
    value = F.col("value")
    # only a line that starts with a comma or a quote can be made of empty fields
    empty = (value.startswith(",") | value.startswith('"')) & value.rlike(_EMPTY_LINE)
    wide = F.length(F.replace(value, F.lit('"'))) >= width
    lines = _marked_lines(spark, path).withColumns({
        "_wanted": (value != "") & (~empty | wide), "_at": F.monotonically_increasing_id(), "_task": F.spark_partition_id(),
    })
    sums = lines.groupBy(FILE, BLOCK, "_task").agg(
        F.min("_at").alias("_at"),
        F.count_if("_wanted").alias("_n"),
        F.min_by("_wanted", F.when(value != "", F.col("_at"))).alias("_head"),
        F.count_if("_bad").alias("bad_lines"),
        F.count_if("_unsafe").alias("unsafe_lines"),
    )
    header = (F.col(BLOCK) == 0) & F.coalesce("_head", F.lit(False))
    return sums.withColumn("_n", F.col("_n") - header.cast("long")).drop("_head")


def audit_encoding(spark: SparkSession, path: str, mode: str = "report") -> DataFrame:
    """Whole-source UTF-8 audit, one row per file: ``file, lines, bad_lines, first_bad, unsafe_lines, ok``.

    Lines are read as raw bytes (Spark's text source does not validate), so
    the check is split-parallel and covers every byte, not a prefix.
    ``first_bad`` is the file's first invalid line (repaired); :func:`locate_bad_utf8`
    says where all of them are. ``unsafe_lines`` counts the lines for which :func:`line_safe` turns a
    source down. ``mode='strict'`` raises :class:`EncodingError` with the
    number of bad files and lines, and the first ten names.
    """
    if not source_exists(spark, path):
        raise SourceNotFound(path)
    if mode not in ("report", "strict"):
        raise ValueError("mode must be 'report' or 'strict'")
    lines = _marked_lines(spark, path)
    at = F.struct(BLOCK, F.monotonically_increasing_id())
    lines = lines.withColumn("_at", at)
    report = lines.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("_bad").alias("bad_lines"),
        F.min_by(F.make_valid_utf8("value"), F.when(F.col("_bad"), F.col("_at"))).alias("first_bad"),
        F.count_if("_unsafe").alias("unsafe_lines"),
    )
    report = report.withColumn("ok", F.col("bad_lines") == 0)
    if mode == "strict":
        failed = report.filter(~F.col("ok")).select("file", "bad_lines")
        total = failed.agg(F.count(F.lit(1)).alias("files"), F.sum("bad_lines").alias("lines")).first()
        if total.files:
            some = ", ".join(f"{r.file} ({r.bad_lines} lines)" for r in failed.orderBy("file").limit(10).collect())
            raise EncodingError(f"invalid UTF-8 in {total.files} files, {total.lines} lines; first: {some}; re-encode the source as UTF-8")
    return report
