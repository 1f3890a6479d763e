"""Round-trip properties: record -> wire -> record, CSV write -> scan, load counts."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spoolwire import FileTopic, consume_topic, drop_empty, load_report, scan_csv, string_schema, to_wire, upload_csv
from spoolwire.operators.records import non_empty
from spoolwire.plans.catalog import write_csv

FIELDS = ["ID", "年份", "Unnamed: 15"]
text = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=20))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=60))
def test_wire_round_trip(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in FIELDS))
    from spoolwire import parse_records

    back = parse_records(to_wire(df), string_schema(FIELDS), keep=())
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(alphabet=string.printable + "中文é", max_size=15),
                          st.text(alphabet=string.printable + "中文é", max_size=15)), min_size=1, max_size=40))
def test_csv_round_trip(spark, rows):
    from spoolwire.workspace import scratch_path

    rows = [tuple(v.replace("\r", "") for v in r) for r in rows]
    df = spark.createDataFrame(rows, "a string, b string")
    path = write_csv(df, scratch_path(spark, "rt"))
    back = scan_csv(spark, path)
    assert sorted(map(tuple, back.select("a", "b").collect())) == sorted(rows)


def test_load_counts_add_up(spark, local_dir):
    from conftest import write_bytes

    path = write_bytes(local_dir, "f.csv", "a,b\n1,2\n,\n\n3,\n,,\n , \n")
    df = scan_csv(spark, path)
    r = load_report(df, non_empty(df), "f.csv", "data").first()
    assert (r.rows_in, r.rows_sent, r.rows_skipped) == (5, 4, 1)
    assert r.rows_in == r.rows_sent + r.rows_skipped
    assert drop_empty(df).count() == 4


def test_upload_and_consume_patent_records(spark, local_dir, tmp):
    from conftest import write_bytes

    from spoolwire import PATENT_SCHEMA

    header = ",".join(PATENT_SCHEMA.fieldNames())
    line1 = ",".join(["1", "2001", "北京", "110000", "北京市", "华北", "否"] + ["10"] * 8 + [""])
    line2 = ",".join(["2", "2002", "上海", "310000", "上海市", "华东", "是"] + ["007"] * 8 + [""])
    path = write_bytes(local_dir, "patents.csv", "\n".join([header, line1, ",,,,,,,,,,,,,,,", line2]) + "\n")
    topic = FileTopic(tmp)
    report = upload_csv(spark, path, topic, partitions=2).first()
    assert (report.rows_in, report.rows_sent, report.rows_skipped, report.status) == (3, 2, 1, "ok")
    out = consume_topic(spark, topic, PATENT_SCHEMA)
    assert out.columns == ["key"] + PATENT_SCHEMA.fieldNames()
    got = {r.ID: r for r in out.collect()}
    assert got["2"]["专利申请总量"] == "007" and got["1"]["地区"] == "北京" and got["1"]["Unnamed: 15"] == ""
    assert got["1"].key is None


def test_upload_parity_mode_sends_header(spark, local_dir, tmp):
    from conftest import write_bytes

    from spoolwire import read_topic

    path = write_bytes(local_dir, "f.csv", "a,b\n1,2\n3,4,5\n")
    topic = FileTopic(tmp)
    upload_csv(spark, path, topic, include_header_record=True)
    vals = sorted(bytes(r.value).decode() for r in read_topic(spark, topic).collect())
    assert vals == ['{"a":"1","b":"2"}', '{"a":"3","b":"4","null":["5"]}', '{"a":"a","b":"b"}']


def test_upload_sends_overflow_on_long_rows_only(spark, local_dir, tmp):
    from conftest import write_bytes

    from spoolwire import read_topic

    path = write_bytes(local_dir, "f.csv", "a,b\n1,2\n3,4,5,6\n,,,\n,\n7\n")
    topic = FileTopic(tmp)
    r = upload_csv(spark, path, topic).first()
    assert (r.rows_in, r.rows_sent, r.rows_skipped, r.rows_long) == (5, 4, 1, 2)
    vals = sorted(bytes(x.value).decode() for x in read_topic(spark, topic).collect())
    assert vals == ['{"a":"","b":"","null":["",""]}', '{"a":"1","b":"2"}', '{"a":"3","b":"4","null":["5","6"]}', '{"a":"7","b":null}']


def test_any_failure_is_reported(spark, local_dir, tmp):
    from conftest import write_bytes

    write_bytes(local_dir, "1.csv", "c0,c1\n1,2\n")
    write_bytes(local_dir, "2.csv", "c1,c0\n1,2\n")
    r = upload_csv(spark, local_dir, FileTopic(tmp), raise_errors=False).first()
    assert r.status == "failed" and "header" in r.error.lower()
    path = write_bytes(local_dir, "3.txt", "a\n1\n")
    r = upload_csv(spark, path, FileTopic("/proc/none/topic"), raise_errors=False).first()
    assert r.status == "failed" and r.error


def test_upload_reports_failures(spark, local_dir, tmp):
    from conftest import write_bytes

    bad = write_bytes(local_dir, "bad.csv", b"a,b\n1,\xff\n")
    r = upload_csv(spark, bad, FileTopic(tmp), raise_errors=False).first()
    assert r.status == "failed" and "UTF-8" in r.error
    r = upload_csv(spark, local_dir + "/missing.csv", FileTopic(tmp), raise_errors=False).first()
    assert r.status == "failed" and "missing.csv" in r.error


def test_upload_counts_once_with_range_shuffle(spark, local_dir, tmp):
    # the range partitioner samples its input in a separate job; counts must not double
    from conftest import write_bytes

    path = write_bytes(local_dir, "f.csv", "a,b\n" + "".join(f"{i},{i % 3}\n" for i in range(300)) + ",\n")
    for i, kw in enumerate([{}, {"order_by": ["a"]}, {"key_column": "b"}]):
        r = upload_csv(spark, path, FileTopic(f"{tmp}-{i}"), partitions=3, **kw).first()
        assert (r.rows_in, r.rows_sent, r.rows_skipped) == (301, 300, 1), kw


def test_upload_other_encoding(spark, local_dir, tmp):
    from conftest import write_bytes

    from spoolwire import read_topic

    path = write_bytes(local_dir, "latin.csv", "name,city\nJosé,Zürich\n".encode("latin-1"))
    topic = FileTopic(tmp)
    r = upload_csv(spark, path, topic, encoding="latin1").first()
    assert r.status == "ok" and r.rows_sent == 1
    assert bytes(read_topic(spark, topic).first().value).decode("utf-8") == '{"name":"José","city":"Zürich"}'
