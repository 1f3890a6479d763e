"""Text-level expressions: UTF-8 validity, character prefixes, CSV field tokens.

All are built-in Spark expressions (JVM side, inside whole-stage codegen
where Spark supports it); no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One CSV field after a leading comma: a quoted field with doubled quotes
# inside, or an unquoted run up to the next comma. Possessive quantifiers keep
# the Java regex engine from backtracking (and from deep recursion on long
# quoted texts). The caller prefixes the record with a comma so no match is
# ever empty.
_CSV_FIELD = r',("(?:[^"]++|"")*+"|[^,]*+)'


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utf8_ok(col: Column | str) -> Column:
    """True when the bytes (binary or string column) are valid UTF-8."""
    return F.is_valid_utf8(_c(col).cast("string"))


def utf8_repair(col: Column | str) -> Column:
    """Replace each invalid byte sequence with U+FFFD."""
    return F.make_valid_utf8(_c(col).cast("string"))


def utf8_require(col: Column | str) -> Column:
    """The text itself, or a query failure naming the first invalid byte sequence."""
    return F.validate_utf8(_c(col).cast("string"))


def utf8_valid_prefix(col: Column | str) -> Column:
    """How many bytes come before the first invalid sequence; null for valid text."""
    text = _c(col).cast("string")
    # repair marks invalid sequences with U+FFFD: one that the text has itself must not be taken for a mark
    plain = F.replace(text, F.lit("\ufffd"), F.lit("\ufffc"))
    return F.when(~F.is_valid_utf8(text), F.octet_length(F.substring_index(F.make_valid_utf8(plain), "\ufffd", 1)))


def head_chars(col: Column | str, n: int) -> Column:
    """First ``n`` characters (code points, not bytes) of a string."""
    return F.substring(_c(col), 1, n)


def csv_raw_tokens(raw: Column | str) -> Column:
    """Split one raw CSV record into its fields as written (quotes kept), honouring quotes."""
    return F.regexp_extract_all(F.concat(F.lit(","), _c(raw)), F.lit(_CSV_FIELD), 1)


def csv_unquote(tokens: Column) -> Column:
    """Unquote an array of raw CSV fields (``"a""b"`` -> ``a"b``); unquoted fields stay as written."""
    quoted = lambda t: F.startswith(t, F.lit('"')) & F.endswith(t, F.lit('"')) & (F.length(t) > 1)
    inner = lambda t: F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
    return F.transform(tokens, lambda t: F.when(quoted(t), inner(t)).otherwise(t))


def csv_tokens(raw: Column | str) -> Column:
    """Split one raw CSV record into its unquoted fields (``array<string>``).

    Used only on records Spark flagged as ragged, to recover how many fields
    they had and what lay beyond the header width.
    """
    return csv_unquote(csv_raw_tokens(raw))
