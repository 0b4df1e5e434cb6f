"""Zipped CSV reader and typed ingest: the edge rows of yearly archives."""

import zipfile

import pytest

from lakesmith.plans.csv_ingest import fetch_plan, ingest_zip_csv, typed_rows
from lakesmith.sources.zipcsv import member_modes, read_zip_csv


def _zip(path, member, text):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, text.encode("latin-1"))


@pytest.fixture()
def landing(tmp_path):
    d = tmp_path / "projects"
    d.mkdir()
    # 1985: quoted newline, doubled quote, Latin-1 letter, missing tokens
    _zip(d / "1985.zip", "RePORTER_1985.csv",
         'id,title,amount,flag\n'
         '1,"Line one\nline two",100,NA\n'
         '2,"He said ""hi""",N/A,x\n'
         '3,Éclair,,y\n')
    # 1986: 'amount' is text this year, 'flag' missing, a new column 'org'
    _zip(d / "1986.zip", "RePORTER_1986.csv",
         'id,title,amount,org\n'
         '4,t4,about 5,ORG\n')
    return str(d)


def test_union_of_headers_and_values(spark, landing):
    raw = read_zip_csv(spark, landing)
    assert raw.columns[3:] == ["id", "title", "amount", "flag", "org", "_bad_line", "_mode"]
    rows = {r.id: r for r in raw.collect()}
    assert rows["1"].title == "Line one\nline two"
    assert rows["2"].title == 'He said "hi"'
    assert rows["3"].title == "Éclair"
    assert rows["4"].flag is None and rows["4"].org == "ORG"
    assert all(r._bad_line is None for r in rows.values())


def test_types_resolved_over_all_years(spark, landing):
    typed = typed_rows(spark, landing)
    types = dict(typed.dtypes)
    assert types["id"] == "bigint"
    assert types["amount"] == "string"      # numeric in 1985, text in 1986 -> text overall
    rows = {r.id: r for r in typed.collect()}
    assert rows[1].flag is None and rows[2].amount is None and rows[3].amount is None
    assert rows[1].source_file == "1985" and rows[4].source_file == "1986"


def test_types_numeric_when_all_years_numeric(spark, tmp_path):
    d = tmp_path / "p"
    d.mkdir()
    _zip(d / "1990.zip", "a.csv", "id,amount\n1,1.5\n2,NA\n")
    _zip(d / "1991.zip", "b.csv", "id,amount\n3,7\n")
    types = dict(typed_rows(spark, str(d)).dtypes)
    assert types["id"] == "bigint" and types["amount"] == "double"


def test_fallback_split_for_unescaped_quotes(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    _zip(d / "2001.zip", "x.csv",
         '"id","name","note"\n'
         '"1","big "red", box","ok"\n'
         '"2","plain","fine"\n')
    modes = {r.member: r.mode for r in member_modes(spark, str(d)).collect()}
    assert modes == {"x.csv": "split"}
    rows = {r.id: r for r in typed_rows(spark, str(d)).collect()}
    assert rows[1].name == 'big "red", box'     # inner quote plus comma kept in the middle field
    assert rows[1].note == "ok" and rows[2].note == "fine"   # no stray quote on the last field


def test_ragged_row_goes_to_fallback_and_is_kept(spark, tmp_path):
    d = tmp_path / "rag"
    d.mkdir()
    _zip(d / "2002.zip", "r.csv", 'a,b\n1,2\n3,4,5\n')
    raw = read_zip_csv(spark, str(d)).collect()
    assert len(raw) == 2
    assert sum(r._bad_line is not None for r in raw) == 1


def test_ingest_is_idempotent(spark, landing, tmp_path):
    lake = str(tmp_path / "lake")
    assert ingest_zip_csv(spark, landing, lake).count() == 4
    assert ingest_zip_csv(spark, landing, lake).count() == 4   # second run adds nothing


def test_fetch_plan_default_grid(spark):
    plan = fetch_plan(spark)
    assert plan.count() == 148
    first = plan.first()
    assert (first.data_type, first.data_year) == ("projects", 1985)
    assert first.url == "https://reporter.nih.gov/exporter/projects/download/1985"
    assert first.landing_path == "data/projects/1985.zip"


def test_fetch_plan_rejects_unknown_type(spark):
    with pytest.raises(Exception, match="unknown data_type"):
        fetch_plan(spark, data_types=["projects", "grants"]).collect()


def test_short_row_is_padded(spark, tmp_path):
    d = tmp_path / "short"
    d.mkdir()
    _zip(d / "2003.zip", "s.csv", 'a,b,c\n1,2\n4,5,6\n')
    rows = {r.a: r for r in read_zip_csv(spark, str(d)).collect()}
    assert rows["1"].b == "2" and rows["1"].c is None and rows["1"]._bad_line is None
    assert rows["4"].c == "6"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_CELL = st.text(alphabet='ab ,"\né1-', min_size=0, max_size=6) | st.sampled_from(["NA", "N/A", "", "12", "-3.5"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_CELL, min_size=3, max_size=3), min_size=1, max_size=12))
def test_zip_reader_matches_pandas(spark, tmp_path_factory, rows):
    import csv as pycsv
    import io
    import uuid

    import pandas as pd

    d = tmp_path_factory.mktemp("prop") / uuid.uuid4().hex
    d.mkdir()
    buf = io.StringIO()
    w = pycsv.writer(buf)
    w.writerow(["x", "y", "z"])
    w.writerows(rows)
    _zip(d / "2000.zip", "2000.csv", buf.getvalue())
    # brute-force oracle: pandas on the same archive, missing tokens as NaN
    want = pd.read_csv(d / "2000.zip", compression="zip", encoding="latin-1", dtype=str)
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    from lakesmith.operators.tables import nulls_for_tokens

    got = nulls_for_tokens(read_zip_csv(spark, str(d)), ["x", "y", "z"]).select("x", "y", "z").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_non_csv_members_are_skipped(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    with zipfile.ZipFile(d / "2004.zip", "w") as z:
        z.writestr("data.csv", "a,b\n1,2\n")
        z.writestr("README.pdf", "%PDF-1.4 not a table")
        z.writestr("__MACOSX/._data.csv", "junk")
    with zipfile.ZipFile(d / "2005.zip", "w") as z:
        z.writestr("export", "a,b\n3,4\n")          # the only member: read whatever its name
    rows = sorted((r.a, r.b) for r in read_zip_csv(spark, str(d)).collect())
    assert rows == [("1", "2"), ("3", "4")]


def test_members_of_one_archive_are_all_read(spark, tmp_path):
    from lakesmith.sources.zipcsv import extract_raw, archive_paths

    d = tmp_path / "multi"
    d.mkdir()
    with zipfile.ZipFile(d / "2006.zip", "w") as z:
        for i in range(5):
            z.writestr(f"part{i}.csv", f"a,b\n{i},x\n{i},y\n")
    rows = read_zip_csv(spark, str(d)).collect()
    assert sorted((r._member, r.a, r.b) for r in rows) == sorted(
        (f"part{i}.csv", str(i), v) for i in range(5) for v in "xy")
    # the work is spread per member: more than one task for one archive
    assert extract_raw(archive_paths(spark, str(d))).rdd.getNumPartitions() > 1


def test_unclosed_quote_loses_no_line(spark, tmp_path):
    d = tmp_path / "open"
    d.mkdir()
    _zip(d / "1.zip", "a.csv", 'a,b\n1,"x\n2,y\n3,z\n4,w')
    _zip(d / "2.zip", "b.csv", '"a","b"\n"5","x\n"6","y"\n"7","z"')
    _zip(d / "3.zip", "c.csv", 'a,b\n8,"x\n9,y\n10,"z\n11,w')           # two of them close each other
    rows = read_zip_csv(spark, str(d)).collect()
    assert {(r.a, r.b) for r in rows if r._bad_line is None} == {
        ("2", "y"), ("3", "z"), ("4", "w"), ("5", "x"), ("6", "y"), ("7", "z"), ("9", "y"), ("11", "w")}
    assert {r._bad_line for r in rows} - {None} == {'1,"x', '8,"x', '10,"z'}
    assert {r.member: r.mode for r in member_modes(spark, str(d)).collect()} == {"a.csv": "lines", "b.csv": "split", "c.csv": "lines"}


def test_fields_of_any_length(spark, tmp_path):
    d = tmp_path / "long"
    d.mkdir()
    _zip(d / "1.zip", "a.csv", f"a,b\n1,x\n2,{'y' * 200_000}\n3,z\n4,w\n")
    rows = {r.a: r for r in read_zip_csv(spark, str(d)).collect()}
    assert set(rows) == {"1", "2", "3", "4"} and len(rows["2"].b) == 200_000
    assert all(r._bad_line is None for r in rows.values())


def test_headers_as_csv_readers_name_them(spark, tmp_path):
    import pandas as pd

    d = tmp_path / "heads"
    d.mkdir()
    _zip(d / "1.zip", "a.csv", "a,a,,x.y,A,_mode\n1,2,3,4,5,6\n")
    raw = read_zip_csv(spark, str(d))
    assert raw.columns[3:-2] == ["a", "a.1", "Unnamed: 2", "x.y", "A.2", "_mode.1"]
    assert list(raw.first())[3:-2] == ["1", "2", "3", "4", "5", "6"]
    assert list(pd.read_csv(d / "1.zip", encoding="latin-1").columns)[:4] == raw.columns[3:7]     # the model for repeats and blanks
    assert dict(typed_rows(spark, str(d)).dtypes)["x.y"] == "bigint"


def _plan_years(spark, first, last):
    return fetch_plan(spark, ["projects"], first, last + 1)


def test_schema_survives_the_second_run(spark, tmp_path):
    from lakesmith.plans.csv_ingest import ingest_planned, lake_schema, missing_archives, read_csv_lake

    d = tmp_path / "projects"
    d.mkdir()
    _zip(d / "1985.zip", "a.csv", "id,n,empty\n1,007,NA\n")
    _zip(d / "1986.zip", "b.csv", "id,n,org\n2,about 5,ORG\n")
    _zip(d / "0001.zip", "d.csv", "id\n9\n")
    _zip(d / "notes.zip", "c.csv", "id\n8\n")               # no year in its name: not planned, no failure
    lake = str(tmp_path / "lake")
    one = ingest_planned(spark, _plan_years(spark, 1985, 1985), str(d), lake, "projects")
    assert dict(one.dtypes)["n"] == "bigint" and one.first().n == 7
    two = ingest_planned(spark, _plan_years(spark, 1985, 1987), str(d), lake, "projects")
    rows = {r.id: r for r in two.collect()}
    assert set(rows) == {1, 2} and rows[2].org == "ORG" and rows[1].org is None
    assert rows[1].n == "007" and rows[2].n == "about 5"      # text in one year: the text that was loaded in all
    assert lake_schema(lake) == {"id": "bigint", "n": "string", "empty": "void", "org": "string"}
    three = ingest_planned(spark, fetch_plan(spark, ["projects"], 1, 2), str(d), lake, "projects")
    assert {r.source_file for r in three.collect()} == {"1985", "1986", "0001"}         # a string, whatever it looks like
    assert [r.data_year for r in missing_archives(spark, _plan_years(spark, 1985, 1987), str(d), "projects").collect()] == [1987]
    assert read_csv_lake(spark, lake).count() == 3


def test_whole_plan_in_one_call(spark, tmp_path):
    from lakesmith.plans.csv_ingest import ingest_plan

    for t in ("projects", "abstracts"):
        (tmp_path / "in" / t).mkdir(parents=True)
        _zip(tmp_path / "in" / t / "1990.zip", "a.csv", f"id,t\n1,{t}\n")
    plan = fetch_plan(spark, ["projects", "abstracts"], 1990, 1992)
    lakes = ingest_plan(spark, plan, str(tmp_path / "in"), str(tmp_path / "lake"), ["projects", "abstracts"])
    assert {t: [r.t for r in df.collect()] for t, df in lakes.items()} == {"projects": ["projects"], "abstracts": ["abstracts"]}
