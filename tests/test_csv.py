"""CSV source semantics (FIXTURES.md §5) and the encoding audit."""

import os

import pytest
from conftest import write_bytes

from spoolwire import SourceNotFound, drop_empty, scan_csv
from spoolwire.errors import EncodingError, HeaderMismatch
from spoolwire.sources.csv import audit_encoding, csv_headers, line_safe


def rows(df):
    return [tuple(r) for r in df.collect()]


def scan(spark, local_dir, text, **kw):
    return scan_csv(spark, write_bytes(local_dir, "f.csv", text), **kw)


def test_plain_values_stay_strings(spark, local_dir):
    df = scan(spark, local_dir, "ID,年份\n007,1.50\n")
    assert csv_headers(df) == ["ID", "年份"]
    assert rows(df.select(csv_headers(df))) == [("007", "1.50")]
    assert dict(df.dtypes)["ID"] == "string"


def test_empty_field_is_empty_string(spark, local_dir):
    assert rows(scan(spark, local_dir, "a,b\n1,\n")) == [("1", "", None)]


def test_short_row_pads_null(spark, local_dir):
    assert rows(scan(spark, local_dir, "a,b,c\n1,2\n")) == [("1", "2", None, None)]


def test_short_row_keeps_empty_vs_missing(spark, local_dir):
    assert rows(scan(spark, local_dir, "a,b,c\n1,\n")) == [("1", "", None, None)]


def test_long_row_overflow(spark, local_dir):
    assert rows(scan(spark, local_dir, "a,b\n1,2,3,4\n")) == [("1", "2", ["3", "4"])]


def test_long_all_empty_kept(spark, local_dir):
    df = scan(spark, local_dir, "a,b\n,,,\n")
    assert rows(df) == [("", "", ["", ""])]
    assert rows(drop_empty(df)) == [("", "", ["", ""])]


def test_blank_and_all_empty_rows_dropped(spark, local_dir):
    df = scan(spark, local_dir, "a,b\n\n,\n")
    assert rows(df) == [("", "", None)]
    assert rows(drop_empty(df)) == []


def test_whitespace_row_kept(spark, local_dir):
    df = drop_empty(scan(spark, local_dir, "a,b\n , \n"))
    assert rows(df) == [(" ", " ", None)]


def test_quotes_commas_newlines(spark, local_dir):
    df = scan(spark, local_dir, 'a,b\n"x,1","y\nz"\n"q""q",w\n')
    assert sorted(rows(df)) == [("q\"q", "w", None), ("x,1", "y\nz", None)]


def test_quoted_overflow_fields_unquoted(spark, local_dir):
    df = scan(spark, local_dir, 'a,b\n1,2,"x, ""y""",\n')
    assert rows(df) == [("1", "2", ['x, "y"', ""])]


def test_duplicate_header_renamed(spark, local_dir):
    df = scan(spark, local_dir, "a,b,a,c\n1,2,3,4\n")
    assert csv_headers(df) == ["a0", "b", "a2", "c"]
    assert rows(df.select(csv_headers(df))) == [("1", "2", "3", "4")]


def test_blank_header_cells(spark, local_dir):
    df = scan(spark, local_dir, "a,,b,\n1,2,3,4\n")
    assert csv_headers(df) == ["a", "_c1", "b", "_c3"]


def test_bom_stripped(spark, local_dir):
    df = scan(spark, local_dir, b"\xef\xbb\xbfa,b\n1,2\n")
    assert csv_headers(df) == ["a", "b"]


def test_header_only(spark, local_dir):
    df = scan(spark, local_dir, "a,b\n")
    assert csv_headers(df) == ["a", "b"] and df.count() == 0


def test_header_as_record(spark, local_dir):
    df = scan(spark, local_dir, "a,b\n1,2\n", include_header_record=True)
    assert sorted(rows(df.select(csv_headers(df)))) == [("1", "2"), ("a", "b")]
    assert csv_headers(df) == ["a", "b"]


def test_missing_file(spark, local_dir):
    path = os.path.join(local_dir, "nope.csv")
    with pytest.raises(SourceNotFound) as e:
        scan_csv(spark, path)
    assert path in str(e.value)


def test_misaligned_headers_across_files_fail(spark, local_dir):
    write_bytes(local_dir, "1.csv", "a,b\n1,2\n")
    write_bytes(local_dir, "2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception) as e:
        scan_csv(spark, local_dir).collect()
    assert "header" in str(e.value).lower()


def test_many_files_same_header(spark, local_dir):
    write_bytes(local_dir, "1.csv", "a,b\n1,2\n")
    write_bytes(local_dir, "2.csv", "a,b\n3,4\n")
    assert sorted(rows(scan_csv(spark, local_dir))) == [("1", "2", None), ("3", "4", None)]


@pytest.mark.parametrize("multiline", [True, False])
def test_multiline_modes_agree_without_line_breaks(spark, local_dir, multiline):
    text = 'a,b\n"x,1",2\n3,\n'
    assert sorted(rows(scan(spark, local_dir, text, multiline=multiline))) == [("3", "", None), ("x,1", "2", None)]


UNSAFE = ['a,b\n"x\ny",1\n', 'a,b\n"x""\ny",1\n', 'a,b\n5" x,1\n', 'a,b\n5" x,"one\ntwo",7"\n', 'a,b\n1,2\n   \n', 'a,b\n1,x\ry\n', 'a,b\r\n1,2\r\n', 'a,b\n "x",2\n']
SAFE = ['a,b\n"x",1\n', 'a,b\n\n"x, ""y""",1\n\n3,\n', "a,b\n1\n1,2,3\n,,,\n", "a,b\n1,2", "a,b\n é , 2 \n"]


@pytest.mark.parametrize("text", UNSAFE + SAFE)
def test_line_mode_only_where_proven_equal(spark, local_dir, text):
    path = write_bytes(local_dir, "f.csv", text)
    safe = line_safe(spark, path)
    assert safe == (text in SAFE)
    if safe:
        assert sorted(rows(scan_csv(spark, path)), key=repr) == sorted(rows(scan_csv(spark, path, multiline=False)), key=repr)


def test_messy_file_keeps_every_record(spark, local_dir):
    text = 'a,b\n5" pipe,"first\nsecond"\n2,"x\ry"\n   \n\n3,4\n'
    assert sorted(rows(scan(spark, local_dir, text)), key=repr) == sorted(
        [('5" pipe', "first\nsecond", None), ("2", "x\ry", None), ("   ", None, None), ("3", "4", None)], key=repr
    )


@pytest.mark.parametrize(("one", "two"), [("c0,c1", "c1,c0"), ("a,a", "a,b"), ("a,,b", "a,b,"), ("x,x,y", "x,y,x")])
def test_swapped_and_renamed_headers_fail(spark, local_dir, one, two):
    write_bytes(local_dir, "1.csv", one + "\n1,2,3\n")
    write_bytes(local_dir, "2.csv", two + "\n4,5,6\n")
    with pytest.raises(Exception) as e:
        scan_csv(spark, local_dir).collect()
    assert "header" in str(e.value).lower()


def test_equal_duplicate_headers_pass(spark, local_dir):
    write_bytes(local_dir, "1.csv", "a,a\n1,2\n")
    write_bytes(local_dir, "2.csv", "a,a\n3,4\n")
    assert sorted(rows(scan_csv(spark, local_dir))) == [("1", "2", None), ("3", "4", None)]
    write_bytes(local_dir, "3.csv", "a,c\n3,4\n")
    with pytest.raises(HeaderMismatch):
        scan_csv(spark, local_dir)


def test_header_record_has_cells_as_written(spark, local_dir):
    df = scan(spark, local_dir, "a,,a\n1,2,3\n", include_header_record=True)
    assert sorted(rows(df.select(csv_headers(df)))) == [("1", "2", "3"), ("a", "", "a")]


def test_overflow_with_nul_and_quotes(spark, local_dir):
    df = scan(spark, local_dir, 'a\n1,"x\0y",p""q,"r""s"\n')
    assert rows(df) == [("1", ["x\0y", 'p""q', 'r"s'])]


def test_audit_encoding(spark, local_dir):
    good = write_bytes(local_dir, "good.csv", "a,b\n中,文\n")
    bad = write_bytes(local_dir, "bad.csv", b"a,b\n1,\xff\xfe\n")
    r = audit_encoding(spark, good).first()
    assert r.ok and r.lines == 2 and r.bad_lines == 0
    r = audit_encoding(spark, bad).first()
    assert not r.ok and r.bad_lines == 1
    with pytest.raises(EncodingError):
        audit_encoding(spark, bad, mode="strict")


def test_keep_raw_shows_ragged_lines(spark, local_dir):
    df = scan(spark, local_dir, "a,b\n1,2\n3\n4,5,6\n", keep_raw=True)
    assert df.columns == ["a", "b", "_overflow", "_corrupt_record"]
    got = sorted(rows(df), key=repr)
    assert got == sorted([("1", "2", None, None), ("3", None, None, "3"), ("4", "5", ["6"], "4,5,6")], key=repr)
