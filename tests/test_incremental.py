"""Versioned tables, the schema log under loads at once, and the incremental link table."""

import json
import random
import shutil
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakesmith.operators.versions import CommitConflict, commit, latest, publish_version, read_version, remove_old_versions
from lakesmith.plans.linktable import build_link_table, clean_links
from lakesmith.plans.linktable_incremental import read_link_table, refresh_link_table, units


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert publish_version(spark.range(3), path) == 1
    first = read_version(spark, path)
    with pytest.raises(Exception):
        publish_version(spark.range(3).selectExpr("raise_error('no') AS id"), path)
    assert read_version(spark, path).count() == 3               # the failed version does not exist
    assert publish_version(spark.range(9), path, replace=False) == 1
    assert publish_version(spark.range(5), path) == 2
    assert read_version(spark, path).count() == 5 and first.count() == 3 and read_version(spark, path, 1).count() == 3
    assert remove_old_versions(path, keep=1) == 2               # version 1 and the failed one
    assert read_version(spark, path).count() == 5 and latest(path)[0] == 2


def test_one_of_two_writers_commits(tmp_path):
    path = str(tmp_path)
    assert commit(path, {"a": 1}, 0) == 1
    with pytest.raises(CommitConflict):
        commit(path, {"b": 1}, 0)
    assert latest(path) == (1, {"a": 1}) and commit(path, {"b": 1}, 1) == 2
    assert not [p for p in (tmp_path / "_commits").iterdir() if p.name.startswith(".")]


def _zip(path, text):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("f.csv", text)


def test_two_loads_at_once_keep_all_columns(spark, tmp_path, monkeypatch):
    """The second load runs whole between the first one's look at the schema and its commit."""
    from lakesmith.plans import csv_ingest

    lake = str(tmp_path / "lake")
    for name, text in (("base", "id,v\n1,1\n"), ("one", "id,a,v\n2,x,2.5\n"), ("two", "id,b,V\n3,7,3\n")):
        (tmp_path / name).mkdir()
        _zip(tmp_path / name / f"{name}.zip", text)
    csv_ingest.ingest_zip_csv(spark, str(tmp_path / "base"), lake)
    save, running = csv_ingest._save_schema, []

    def interleaved(*args):
        if not running:
            running.append(1)
            csv_ingest.ingest_zip_csv(spark, str(tmp_path / "two"), lake)
        save(*args)

    monkeypatch.setattr(csv_ingest, "_save_schema", interleaved)
    csv_ingest.ingest_zip_csv(spark, str(tmp_path / "one"), lake)
    assert csv_ingest.lake_schema(lake) == {"id": "bigint", "v": "double", "a": "string", "b": "bigint"}
    rows = {r.id: (r.v, r.a, r.b) for r in csv_ingest.read_csv_lake(spark, lake).collect()}
    assert rows == {1: (1.0, None, None), 2: (2.5, "x", None), 3: (3.0, None, 7)}


TYPES = st.dictionaries(st.sampled_from("abcdA"), st.sampled_from(["void", "bigint", "double", "boolean", "string"]), max_size=4)


@given(st.lists(TYPES, min_size=1, max_size=5), st.randoms())
@settings(max_examples=100, deadline=None)
def test_merging_schemas_has_no_order(parts, rng):
    from lakesmith.plans.csv_ingest import widened

    def merged(some):
        out = {}
        for p in some:
            out = widened(out, p)
        return {c.casefold(): t for c, t in out.items()}

    mixed = parts + rng.sample(parts, rng.randint(0, len(parts)))   # merged twice is merged once
    rng.shuffle(mixed)
    assert merged(mixed) == merged(parts)


def test_schema_files_of_earlier_versions(tmp_path):
    from lakesmith.plans import csv_ingest

    folder = tmp_path / "_schema"
    folder.mkdir()
    (folder / "00000000.json").write_text(json.dumps([["a", "bigint"]]))
    (folder / "00000001.json").write_text(json.dumps([["a", "double"], ["b", "string"]]))
    assert csv_ingest.lake_schema(str(tmp_path)) == {"a": "double", "b": "string"}
    schema, seen = csv_ingest._schema_log(str(tmp_path))
    csv_ingest._save_schema(str(tmp_path), schema | {"c": "bigint"}, seen)
    assert csv_ingest.lake_schema(str(tmp_path)) == {"a": "double", "b": "string", "c": "bigint"}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_link_table_follows_its_lake(spark, tmp_path):
    """Rounds of added, replaced and removed files equal the full rebuild; only changed files are read."""
    lake, state, rng = tmp_path / "lake", str(tmp_path / "state"), random.Random(3)
    texts = ["7", "007", " 8", "x", None, "NOT_FOUND;INVALID_JOURNAL", "1_000", *map(str, range(100, 160)), "99999999999999"]

    def deliver(name):
        rows = [(rng.choice(texts), rng.choice(["10.1/a", "10.1/b", None])) for _ in range(60)]
        shutil.rmtree(lake / name, ignore_errors=True)
        spark.createDataFrame(rows, "PMID string, DOI string").coalesce(1).write.parquet(str(lake / name))

    for n in range(4):
        deliver(f"f{n}")
    assert refresh_link_table(spark, str(lake), state, part_bytes=2000)["units"] == 4
    assert refresh_link_table(spark, str(lake), state) == {"units": 0, "parts": 0}
    first = read_link_table(spark, state)
    before = _rows(first)
    for step in range(3):
        assert _rows(read_link_table(spark, state)) == _rows(build_link_table(spark, str(lake)))
        deliver(f"f{step}")                                     # replaced
        deliver(f"g {step}%41[x]")                              # added
        if step:
            shutil.rmtree(lake / f"f{step + 1}", ignore_errors=True)
        assert refresh_link_table(spark, str(lake), state)["units"] == (3, 4, 3)[step]   # a replaced file is one gone and one new
    assert _rows(read_link_table(spark, state)) == _rows(build_link_table(spark, str(lake)))
    assert _rows(read_link_table(spark, state, distinct_after_cast=True)) == _rows(build_link_table(spark, str(lake), True))
    assert _rows(first) == before                               # an open reader keeps its version
    assert _rows(read_link_table(spark, state, 1)) == before
    remove_old_versions(state, keep=1)
    assert _rows(read_link_table(spark, state)) == _rows(build_link_table(spark, str(lake)))
    deliver("h")
    refresh_link_table(spark, str(lake), state)
    assert _rows(read_link_table(spark, state)) == _rows(build_link_table(spark, str(lake)))


def test_only_changed_inputs_and_touched_parts_are_read(spark, tmp_path):
    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    for n in range(3):
        spark.range(n * 1000, (n + 1) * 1000).selectExpr("CAST(id AS STRING) AS PMID", "'10.1/' || id AS DOI").coalesce(1).write.parquet(f"{lake}/f{n}")
    refresh_link_table(spark, lake, state, part_bytes=4000)
    parts = latest(state)[1]["support"]
    old = latest(state)[1]["units"]
    for gone in (f"{lake}/f0", f"{lake}/f1"):                    # unreadable from here on, but listed as before
        for p in __import__("pathlib").Path(gone).glob("*.parquet"):
            stat = p.stat()
            p.write_bytes(b"x" * stat.st_size)
            __import__("os").utime(p, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    spark.range(5000, 5100).selectExpr("CAST(id AS STRING) AS PMID", "'10.1/' || id AS DOI").coalesce(1).write.parquet(f"{lake}/new")
    told = refresh_link_table(spark, lake, state)
    after = latest(state)[1]["support"]
    assert told["units"] == 1 and 0 < told["parts"] < len(parts) and latest(state)[1]["units"] != old
    assert sum(after.get(k) == v for k, v in parts.items()) >= len(parts) - told["parts"]
    assert read_link_table(spark, state).count() == 3100


def test_a_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    from lakesmith.plans import linktable_incremental as li

    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    spark.createDataFrame([("1", "a"), ("2", "b")], "PMID string, DOI string").coalesce(1).write.parquet(f"{lake}/f")
    refresh_link_table(spark, lake, state)
    spark.createDataFrame([("3", "c")], "PMID string, DOI string").coalesce(1).write.parquet(f"{lake}/g")
    with monkeypatch.context() as m:
        m.setattr(li, "commit", lambda *a: (_ for _ in ()).throw(CommitConflict("other")))
        with pytest.raises(CommitConflict):
            refresh_link_table(spark, lake, state)
    assert read_link_table(spark, state).count() == 2
    assert refresh_link_table(spark, lake, state)["units"] == 1 and read_link_table(spark, state).count() == 3


def test_link_table_of_a_lake_with_commits(spark, tmp_path):
    import gzip

    from lakesmith.plans.xml_ingest import ingest_xml

    d, lake, state = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "state")
    d.mkdir()

    def put(name, *ids):
        lists = "".join(f'<ArticleIdList><ArticleId IdType="pubmed">{i}</ArticleId><ArticleId IdType="doi">10.1/{i}</ArticleId></ArticleIdList>' for i in ids)
        (d / f"{name}.xml.gz").write_bytes(gzip.compress(f"<r>{lists}</r>".encode()))

    put("a", 1, 2)
    put("b", 2, 3)
    ingest_xml(spark, str(d), lake)
    assert refresh_link_table(spark, lake, state)["units"] == 2
    put("a", 4)
    put("c", 5)
    ingest_xml(spark, str(d), lake, skip_present=False)
    refresh_link_table(spark, lake, state)
    assert _rows(read_link_table(spark, state)) == [(2, "10.1/2"), (3, "10.1/3"), (4, "10.1/4"), (5, "10.1/5")] == _rows(build_link_table(spark, lake))
    put("b")
    ingest_xml(spark, str(d), lake, skip_present=False)
    refresh_link_table(spark, lake, state)
    assert _rows(read_link_table(spark, state)) == [(4, "10.1/4"), (5, "10.1/5")]
    assert {r.unit for r in units(spark, lake).collect()} == {"a", "c"}
    assert clean_links(spark.createDataFrame([("1", "a")], "PMID string, DOI string")).count() == 1


def test_small_parts_share_files(spark, tmp_path):
    """The support's files follow its bytes, not the number of its parts, and its readers get the parts asked for."""
    from pathlib import Path

    from lakesmith.plans.linktable_incremental import _support

    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    spark.range(20_000).selectExpr("CAST(id AS STRING) AS PMID", "'10.1/' || id AS DOI").coalesce(1).write.parquet(f"{lake}/f")
    refresh_link_table(spark, lake, state, part_bytes=2000)
    parts = latest(state)[1]["support"]
    assert len(parts) > 50 and len(list(Path(state).glob("support-*/**/*.parquet"))) - len(list(Path(state).glob("support-*-delta/*.parquet"))) < len(parts) / 5
    some = {k: parts[k] for k in list(parts)[:3]}
    assert {str(r.part) for r in _support(spark, state, some).select("part").distinct().collect()} == set(some)
    spark.range(10, 20).selectExpr("CAST(id AS STRING) AS PMID", "'10.1/' || id AS DOI").coalesce(1).write.mode("overwrite").parquet(f"{lake}/f")
    refresh_link_table(spark, lake, state)
    assert len(latest(state)[1]["support"]) == 1 and read_link_table(spark, state).count() == 10


def test_one_refresh_of_a_lake_that_lost_all(spark, tmp_path):
    lake, state = tmp_path / "lake", str(tmp_path / "state")
    spark.createDataFrame([("1", "a"), ("1", "a"), (None, None)], "PMID string, DOI string").coalesce(1).write.parquet(str(lake / "f"))
    refresh_link_table(spark, str(lake), state)
    assert _rows(read_link_table(spark, state)) == [(1, "a")]
    for p in (lake / "f").glob("*.parquet"):
        p.unlink()
    assert refresh_link_table(spark, str(lake), state)["units"] == 1
    assert _rows(read_link_table(spark, state)) == []
