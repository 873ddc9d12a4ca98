"""CSV scan edge cases: short/long rows, quoting, NA tokens, file order."""

import os

import pytest

from haulwise.sources.landing import header_columns, scan_feed


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_short_kept_long_dropped(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "f.csv")
    _write(p, "a,b,c\n1,2,3\n4,5\n6,7,8,9\n1,2,3,\n1,2,,\n1,2,3,,5\n\"\",x,\"q\"\"z\"\n\"line\nbreak\",NA,z\n")
    rows = [tuple(r)[1:] for r in scan_feed(spark, p, multiline=True).orderBy("_row_seq").collect()]
    assert rows == [("1", "2", "3"), ("4", "5", None), (None, "x", 'q"z'), ("line\nbreak", None, "z")]


def test_quoted_commas_are_one_field(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "g.csv")
    _write(p, "id,refs\nP1,\"ORD_1,ORD_2\"\nP2,ORD_3\n")
    rows = [tuple(r)[1:] for r in scan_feed(spark, p, multiline=True).orderBy("_row_seq").collect()]
    assert rows == [("P1", "ORD_1,ORD_2"), ("P2", "ORD_3")]


def test_row_seq_follows_file_order(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "h.csv")
    _write(p, "k\n" + "\n".join(str(i) for i in range(50, 0, -1)) + "\n")
    got = [r.k for r in scan_feed(spark, p, multiline=False).orderBy("_row_seq").collect()]
    assert got == [str(i) for i in range(50, 0, -1)]


def test_a_folder_with_other_headers_fails(spark, tmpdir_path):
    """Columns are never taken by position from a file whose header differs."""
    _write(os.path.join(tmpdir_path, "a.csv"), "a,b\n1,2\n")
    assert len(scan_feed(spark, tmpdir_path).collect()) == 1
    _write(os.path.join(tmpdir_path, "b.csv"), "b,a\n3,4\n")
    cols = header_columns(spark, os.path.join(tmpdir_path, "a.csv"))
    with pytest.raises(Exception, match="header|HEADER"):
        scan_feed(spark, tmpdir_path, cols).collect()
