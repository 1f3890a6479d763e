"""Source order, record numbers over holes, positions of bad bytes, and what the default upload keeps."""

import os
import random

import pytest
from conftest import write_bytes
from pyspark.sql import functions as F

from spoolwire import FileTopic, SourceNotFound, first_records, progress, publish, read_topic, scan_csv, upload_csv
from spoolwire.operators.locate import locate_bad_utf8
from spoolwire.operators.records import non_empty
from spoolwire.operators.source_order import number_records, source_head, split_sums
from spoolwire.sinks import topic as topic_sink
from spoolwire.sources.csv import OVERFLOW, audit_encoding, audit_splits, csv_headers


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, so that every file is read by many tasks."""
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def ordered_source(folder, files=5, lines=120):
    """``files`` files of numbered rows, some of them blank or all empty; the kept numbers in source order."""
    rng, no, want = random.Random(1), 0, []
    for f in range(files):
        out = ["n,pad"]
        for _ in range(lines if f else 3):
            kind = rng.random()
            if kind < 0.1:
                out.append("")
            elif kind < 0.2:
                out.append(",")
            else:
                out.append(f"{no},{'x' * rng.randrange(30)}")
                want.append((f, no))
                no += 1
        write_bytes(folder, f"f{f}.csv", "\n".join(out) + "\n")
    return want


def keep_rows(df):
    return (F.col("n") != "") | (F.col("pad") != "")


def test_records_are_numbered_in_source_order(spark, local_dir, small_splits):
    want = ordered_source(local_dir)
    rows = scan_csv(spark, local_dir, multiline=False, with_position=True)
    assert rows.rdd.getNumPartitions() > 20
    got = number_records(rows, keep_rows(rows)).select("n", "record_no", "file_record_no").collect()
    assert sorted((r.record_no, int(r.n)) for r in got) == [(i + 1, no) for i, (_, no) in enumerate(want)]
    first = {f: min(no for g, no in want if g == f) for f, _ in want}
    of = {no: f for f, no in want}
    assert all(r.file_record_no == int(r.n) - first[of[int(r.n)]] + 1 for r in got)
    head = source_head(rows, 5, keep_rows(rows)).orderBy("record_no").collect()
    assert [(int(r.n), r.record_no) for r in head] == [(i, i + 1) for i in range(5)]
    assert source_head(rows.where("false"), 5).count() == 0 and number_records(rows.where("false")).count() == 0


def test_numbers_without_a_broadcast(spark, local_dir, small_splits):
    from spoolwire.operators.source_order import numbered, split_counts

    want = ordered_source(local_dir)
    rows = scan_csv(spark, local_dir, multiline=False, with_position=True)
    joined = numbered(rows.hint("shuffle_hash"), split_counts(rows, keep_rows(rows)).hint("merge"), keep_rows(rows))
    assert sorted((r.record_no, int(r.n)) for r in joined.collect()) == [(i + 1, no) for i, (_, no) in enumerate(want)]


def test_changed_source_is_noticed(spark, local_dir):
    from spoolwire.operators.source_order import numbered, split_counts

    path = write_bytes(local_dir, "a.csv", "n\n1\n2\n")
    rows = scan_csv(spark, path, with_position=True)
    splits = spark.createDataFrame(split_counts(rows).collect(), split_counts(rows).schema)
    write_bytes(local_dir, "a.csv", "n\n1\n2\n3\n")
    with pytest.raises(Exception, match="changed between two passes"):
        numbered(scan_csv(spark, path, with_position=True), splits).collect()


def value_no():
    return F.get_json_object(F.col("value").cast("string"), "$.n").cast("long")


def test_upload_keeps_source_order_with_a_writer_per_split(spark, local_dir, tmp, small_splits):
    want = ordered_source(local_dir)
    t = FileTopic(tmp)
    for round_ in range(2):
        report = upload_csv(spark, local_dir, t, partitions=3).first()
        assert (report.rows_sent, report.status) == (len(want), "ok")
        assert report.rows_in - report.rows_skipped == len(want)
    env = read_topic(spark, t).select("partition", "offset", value_no().alias("n")).collect()
    sizes = [len(want) // 3 + (p < len(want) % 3) for p in range(3)]
    assert sorted((r.partition, r.offset) for r in env) == sorted((p, o) for p in range(3) for o in range(2 * sizes[p]))
    for r in env:
        assert r.n == sum(sizes[: r.partition]) + r.offset % sizes[r.partition]
    files = [f for d, _, names in os.walk(tmp) for f in names if f.endswith(".parquet") and "partition=" in d]
    assert len(files) > 40  # two uploads, each by the tasks that read the source


def test_default_partitions_do_not_narrow_the_write(spark, local_dir, tmp, small_splits):
    ordered_source(local_dir)
    upload_csv(spark, local_dir, FileTopic(tmp))
    files = [f for d, _, names in os.walk(f"{tmp}/partition=0") for f in names if f.endswith(".parquet")]
    assert len(files) > 20


def test_publish_of_a_shuffled_frame_is_dense(spark, tmp):
    t = FileTopic(tmp)
    df = spark.range(5000).withColumn("k", F.col("id") % 50).groupBy("k", "id").count().select(F.col("id").cast("string").alias("n"))
    publish(df, t, partitions=4, keep=F.col("n") != "7")
    publish(df.limit(1), t)
    publish(df.where("false"), t)
    ends = read_topic(spark, t).groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("n"), F.count_distinct("offset").alias("d"))
    got = {r.partition: (r.lo, r.hi, r.n, r.d) for r in ends.collect()}
    assert got == {0: (0, 1250, 1251, 1251), **{p: (0, n - 1, n, n) for p, n in ((1, 1250), (2, 1250), (3, 1249))}}


def test_source_order_takes_no_other_order(spark, local_dir, tmp):
    rows = scan_csv(spark, write_bytes(local_dir, "a.csv", "n\n1\n"), with_position=True)
    with pytest.raises(ValueError):
        publish(rows, FileTopic(tmp), columns=["n"], key_column="n", in_source_order=True)
    with pytest.raises(ValueError):
        scan_csv(spark, write_bytes(local_dir, "b.csv", "_file,b\n1,2\n"), with_position=True)


def test_readers_agree_wherever_a_source_is_approved(spark, local_dir):
    """Random files: the line reader returns the rows of the multi-line reader for every file without an unsafe line."""
    rng = random.Random(5)
    parts = [",", ",", '"', '""', "a", "é", " ", "\t", "\x00", "\x01", "\x0b", "\x0c", "\x1f", "\x85", " ", "﻿", "7", "\n", "\n", "\r"]
    calm = [p for p in parts if p not in ('"', '""', "\r", "\x00")]
    for i in range(400):
        pick = calm if i % 2 else parts
        body = "".join(rng.choice(pick) for _ in range(rng.randrange(25)))
        if i % 3 == 0:
            body = "\n".join(f'"{w}","x, ""y"""' if j % 2 else f"{w},2" for j, w in enumerate(body.replace('"', "").replace("\r", "").split("\n")))
        write_bytes(local_dir, f"f{i:03}.csv", "a,b\n" + body)
    safe = {r.file for r in audit_encoding(spark, local_dir).collect() if not r.unsafe_lines}
    assert len(safe) > 60

    def rows(multiline):
        out = {}
        for r in scan_csv(spark, local_dir, multiline=multiline, with_position=True).collect():
            out.setdefault(r["_file"], []).append(tuple(r[c] for c in ("a", "b", "_overflow")))
        return out

    whole, lines = rows(True), rows(False)
    for f in safe:
        assert sorted(map(repr, whole.get(f, []))) == sorted(map(repr, lines.get(f, []))), f


@pytest.mark.parametrize("line", ["\t", "\x0c", "\x01", " ", "\x1f\x1c", " \t "])
def test_default_upload_loses_no_line(spark, local_dir, tmp, line):
    path = write_bytes(local_dir, "a.csv", f"a,b\n1,2\n{line}\n\n3,4\n")
    report = upload_csv(spark, path, FileTopic(tmp)).first()
    assert (report.rows_in, report.rows_sent) == (3, 3)


def test_numbers_over_holes_against_brute_force(spark):
    rng = random.Random(9)
    present = [(p, o, 1_000_000 * (o // 2)) for p in range(3) for o in range(p * 50, 700) if rng.random() < (1.0, 0.6, 0.02)[p] or o > 690]
    df = spark.createDataFrame(present, "partition int, offset long, us long").select("partition", "offset", F.timestamp_micros("us").alias("timestamp"))
    order = {}
    for p, o, us in sorted(present):
        order.setdefault(p, []).append((o, us))
    for bucket in (16, 64, 1 << 20):
        got = sorted((r.partition, r.line_count, r.rps) for r in progress(df, every=7, bucket=bucket).collect())
        want = []
        for p, rows in order.items():
            for i in range(6, len(rows), 7):
                us = rows[i][1] - rows[0][1]
                want.append((p, i + 1, round((i + 1) * 1e6 / us, 6) if us else None))
        assert got == sorted(want, key=lambda w: w[:2])
        first = sorted((r.partition, r.record_no, r.offset) for r in first_records(df, 9, bucket=bucket).collect())
        assert first == sorted((p, i + 1, o) for p, rows in order.items() for i, (o, _) in enumerate(rows[:9]))
    none = df.where("false")
    assert progress(none).count() == 0 and first_records(none).count() == 0


def brute_bad(data):
    out, at = [], 0
    for no, line in enumerate(data.split(b"\n"), 1):
        try:
            line.decode("utf-8")
        except UnicodeDecodeError as e:
            out.append((no, at + e.start))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("run", [3, 4096])
def test_locate_against_brute_force(spark, local_dir, small_splits, run):
    rng = random.Random(run)
    bits = [b"plain ", "é".encode(), b"\xff", b"\xe4\xb8", "中".encode(), "�".encode(), b"\xc3", b"\xed\xa0\x80", b"\xf0\x9f\x98", b"\r"]
    want = {}
    for f in range(6):
        lines = [b"".join(rng.choice(bits[:2] + bits[4:6] if rng.random() < 0.9 else bits) for _ in range(rng.randrange(12))) for _ in range(150)]
        data = b"\n".join(lines) + (b"\n" if f % 2 else b"")
        if f == 3:
            data = "﻿".encode() + data
        if f == 4:
            data = "fine 中 �\n".encode() * 60
        write_bytes(local_dir, f"f{f}.txt", data)
        want[f"f{f}.txt"] = brute_bad(data)
    got = {}
    for r in locate_bad_utf8(spark, local_dir, run).collect():
        got.setdefault(os.path.basename(r.file), []).append((r.line, r.byte))
        assert "�" in r.text or len(r.text) == 100
    assert {f: sorted(v) for f, v in got.items()} == {f: v for f, v in want.items() if v}


def test_first_bad_line_is_the_earliest(spark, local_dir):
    path = write_bytes(local_dir, "a.csv", b"a\nok\nzz \xff\naa \xff\n")
    assert audit_encoding(spark, path).first().first_bad == "zz �"
    with pytest.raises(SourceNotFound):
        locate_bad_utf8(spark, os.path.join(local_dir, "none.txt"))


def test_audit_counts_the_records_of_every_split(spark, local_dir, small_splits):
    ordered_source(local_dir)
    more = ['n,pad', '""', '"",""', ',,', '"",,""', '""""', '",",', "\u0085", "", 'x,"y ""z"""', ",x", "a,b,c"]
    write_bytes(local_dir, "f7.csv", "\n\n" + "\n".join(more))
    write_bytes(local_dir, "f8.csv", "n,pad")
    rows = scan_csv(spark, local_dir, multiline=False, with_position=True)
    keep = non_empty(rows, csv_headers(rows)) | F.col(OVERFLOW).isNotNull()
    key = ("_file", "_block", "_task")
    want = {tuple(r[k] for k in key): r["_n"] for r in split_sums(rows, keep).collect() if r["_n"]}
    got = audit_splits(spark, local_dir, 2).collect()
    assert {tuple(r[k] for k in key): r["_n"] for r in got if r["_n"]} == want
    assert len(want) > 20 and not sum(r.unsafe_lines + r.bad_lines for r in got)


def test_upload_of_a_safe_source_parses_it_once(spark, local_dir, small_splits, monkeypatch):
    def second_scan(*_):
        raise AssertionError("the records of a source that the audit counted are counted again")

    monkeypatch.setattr(topic_sink, "split_sums", second_scan)
    os.makedirs(f"{local_dir}/in")
    want = ordered_source(f"{local_dir}/in")
    t = FileTopic(f"{local_dir}/topic", "data")
    report = upload_csv(spark, f"{local_dir}/in", t, partitions=3).first()
    assert (report.status, report.rows_sent) == ("ok", len(want))
    sent = read_topic(spark, t).orderBy("partition", "offset").select(F.get_json_object(F.col("value").cast("string"), "$.n").alias("n")).collect()
    assert [int(r.n) for r in sent] == [no for _, no in want]


def test_publish_fails_where_splits_count_other_records(spark, local_dir):
    os.makedirs(f"{local_dir}/in")
    ordered_source(f"{local_dir}/in")
    rows = scan_csv(spark, f"{local_dir}/in", multiline=False, with_position=True)
    more = split_sums(rows, keep_rows(rows)).withColumn("_n", F.col("_n") + 1).localCheckpoint()
    with pytest.raises(RuntimeError, match="were counted"):
        publish(rows, FileTopic(f"{local_dir}/topic", "data"), columns=["n", "pad"], keep=keep_rows(rows), in_source_order=True, splits=more)
