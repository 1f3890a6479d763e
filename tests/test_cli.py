"""The command line mirrors the source application's three jobs."""

from conftest import write_bytes

from spoolwire.__main__ import main
from spoolwire.schemas import PATENT_FIELDS


def test_upload_show_follow(spark, local_dir, tmp, capsys):
    header = ",".join(PATENT_FIELDS)
    line = ",".join(["1", "2001", "北京", "110000", "北京市", "华北", "否"] + ["10"] * 8 + [""])
    path = write_bytes(local_dir, "patents.csv", f"{header}\n{line}\n,,,,,,,,,,,,,,,\n")
    assert main(["upload", path, "--path", tmp, "--partitions", "2"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "rows_sent" in out and "北京" in out
    assert main(["show", "--path", tmp], spark=spark) == 0
    out = capsys.readouterr().out
    assert "parsed schema:" in out and "专利申请总量" in out and "110000" in out
    assert main(["follow", "--path", tmp, "--available-now", "--preview", "3"], spark=spark) == 0
    assert main(["follow", "--path", tmp, "--available-now", "--out", tmp + "-out"], spark=spark) == 0
    assert spark.read.json(tmp + "-out").count() == 1


def test_every_record_is_emitted_and_previewed(spark, local_dir, tmp, capsys):
    path = write_bytes(local_dir, "f.csv", "a\n" + "".join(f"first{i}\n" for i in range(50)))
    assert main(["upload", path, "--path", tmp, "--partitions", "8"], spark=spark) == 0
    assert capsys.readouterr().out.count("first") == 40  # five of each partition
    assert main(["follow", "--path", tmp, "--available-now", "--out", tmp + "-out"], spark=spark) == 0
    assert spark.read.text(tmp + "-out").count() == 50
    path = write_bytes(local_dir, "g.csv", "a\nnewer\n")
    assert main(["upload", path, "--path", tmp], spark=spark) == 0
    out = capsys.readouterr().out
    assert "newer" in out and "first" not in out  # only of the upload just made


def test_upload_failure_exit_code(spark, local_dir, tmp):
    bad = write_bytes(local_dir, "bad.csv", b"a,b\n1,\xff\n")
    assert main(["upload", bad, "--path", tmp], spark=spark) == 1
