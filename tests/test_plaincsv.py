"""Plain Latin-1 CSV: rows kept whole, each file by its own header."""

from lakesmith.sources.plaincsv import read_csv, read_csv_lines, read_quote_split_csv


def test_standard_rows(spark, tmp_path):
    d = tmp_path / "std"
    d.mkdir()
    (d / "a.csv").write_bytes('a,b,c\n1,2\n4,5,6\n7,8,9,10\n"x\ny","He said ""hi""",É\n'.encode("latin-1"))
    rows = {r.a: r for r in read_csv(spark, str(d)).collect()}
    assert rows["1"].b == "2" and rows["1"].c is None and rows["1"]._bad_line is None   # short: padded
    assert rows["4"].c == "6"
    bad = [r for r in rows.values() if r._bad_line is not None]
    assert len(bad) == 1 and bad[0]._bad_line == "7,8,9,10" and bad[0].b is None          # long: kept whole
    assert rows["x\ny"].b == 'He said "hi"' and rows["x\ny"].c == "É"


def test_quote_split_rows(spark, tmp_path):
    d = tmp_path / "q"
    d.mkdir()
    (d / "p.csv").write_bytes('"id","name","note"\n"1","big "red", box","ok"\n"2","plain","fine"\n'.encode("latin-1"))
    rows = {r.id: r for r in read_quote_split_csv(spark, str(d)).collect()}
    assert rows["1"].name == 'big "red", box' and rows["1"].note == "ok" and rows["2"].note == "fine"


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\n1,2\n")
    (tmp_path / "b.csv").write_bytes(b"b,a,c\n3,4,5\n")
    assert {(r.a, r.b, r.c) for r in read_csv(spark, str(tmp_path)).collect()} == {("1", "2", None), ("4", "3", "5")}


def test_long_row_with_an_empty_field_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\n1,,3\n4\n5,6\n")
    for read in (read_csv, read_csv_lines):
        rows = read(spark, str(tmp_path)).collect()
        assert {(r.a, r.b, r._bad_line) for r in rows} == {(None, None, "1,,3"), ("4", None, None), ("5", "6", None)}
