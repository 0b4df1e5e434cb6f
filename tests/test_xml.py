"""XML id-list scan and link extraction: the edge rows of an article file."""

import gzip

import pytest

from lakesmith.plans.xml_ingest import ingest_xml, xml_links


def _gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)
    return str(path)


ARTICLES = """<?xml version="1.0" encoding="utf-8"?>
<!DOCTYPE PubmedArticleSet PUBLIC "-//NLM//DTD PubMedArticle//EN" "pubmed.dtd">
<PubmedArticleSet>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed">1</ArticleId><ArticleId IdType="doi">10.1/a</ArticleId>
 </ArticleIdList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed">2</ArticleId><ArticleId IdType="pmc">PMC2</ArticleId>
 </ArticleIdList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed">3</ArticleId><ArticleId IdType="doi">10.1/first</ArticleId><ArticleId IdType="doi">10.1/second</ArticleId>
 </ArticleIdList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed">4</ArticleId><ArticleId IdType="doi"></ArticleId>
 </ArticleIdList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList></ArticleIdList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed">6</ArticleId><ArticleId IdType="doi">10.1/x&lt;y&amp;z</ArticleId>
 </ArticleIdList>
 <ReferenceList><Reference><Citation>c</Citation><ArticleIdList>
   <ArticleId IdType="pubmed">60</ArticleId><ArticleId IdType="doi">10.1/ref</ArticleId>
 </ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>
 <PubmedArticle><PubmedData><ArticleIdList>
   <ArticleId IdType="pubmed"> 7 </ArticleId><ArticleId IdType="doi"> 10.1/sp </ArticleId>
 </ArticleIdList></PubmedData></PubmedArticle>
</PubmedArticleSet>
"""


@pytest.fixture()
def article_dir(tmp_path):
    d = tmp_path / "xml"
    d.mkdir()
    _gz(d / "pubmed23n0001.xml.gz", ARTICLES)
    return str(d)


def test_links_any_depth(spark, article_dir):
    rows = {(r.PMID, r.DOI) for r in xml_links(spark, article_dir).collect()}
    assert rows == {
        ("1", "10.1/a"),            # both ids
        ("3", "10.1/first"),        # two DOIs: first wins
        ("6", "10.1/x<y&z"),        # escaped markup decoded
        ("60", "10.1/ref"),         # list nested under a reference list
        (" 7 ", " 10.1/sp "),       # outer spaces kept
    }                               # no DOI, empty DOI, empty list: dropped


def test_links_own_only(spark, article_dir):
    rows = {(r.PMID, r.DOI) for r in xml_links(spark, article_dir, own_only=True).collect()}
    assert ("60", "10.1/ref") not in rows
    assert ("6", "10.1/x<y&z") in rows and len(rows) == 4


def test_source_file_is_stem(spark, article_dir):
    names = {r.source_file for r in xml_links(spark, article_dir).collect()}
    assert names == {"pubmed23n0001"}


def test_ingest_writes_one_partition_per_file(spark, article_dir, tmp_path):
    _gz(f"{article_dir}/pubmed23n0002.xml.gz", ARTICLES.replace(">1<", ">11<"))
    lake = ingest_xml(spark, article_dir, str(tmp_path / "lake"))
    parts = sorted(p.name for p in (tmp_path / "lake").iterdir() if p.name.startswith("source_file="))
    assert parts == ["source_file=pubmed23n0001", "source_file=pubmed23n0002"]
    assert lake.count() == 10


def test_file_without_matches_gives_empty_result(spark, tmp_path):
    d = tmp_path / "none"
    d.mkdir()
    _gz(d / "empty.xml.gz", "<PubmedArticleSet><PubmedArticle/></PubmedArticleSet>")
    assert xml_links(spark, str(d)).count() == 0


def test_two_roots_raise(spark, tmp_path):
    d = tmp_path / "two"
    d.mkdir()
    one = "<PubmedArticleSet><PubmedArticle><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">1</ArticleId><ArticleId IdType=\"doi\">d</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"
    _gz(d / "two.xml.gz", one + "\n" + one.replace(">1<", ">2<"))
    with pytest.raises(Exception):
        xml_links(spark, str(d)).collect()


def test_malformed_raises(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    _gz(d / "bad.xml.gz", "<PubmedArticleSet><PubmedArticle><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">1</ArticleIdList>")
    with pytest.raises(Exception):
        xml_links(spark, str(d)).collect()


def test_ingest_skips_loaded_files_and_replaces_only_its_own(spark, article_dir, tmp_path):
    lake = str(tmp_path / "lake2")
    assert ingest_xml(spark, article_dir, lake).count() == 5
    _gz(f"{article_dir}/pubmed23n0002.xml.gz", ARTICLES.replace(">1<", ">11<"))
    df = ingest_xml(spark, article_dir, lake)          # only the new file is read
    assert df.count() == 10
    assert ingest_xml(spark, article_dir, lake).count() == 10   # rerun adds nothing
    # a re-delivered file replaces exactly its own partition
    _gz(f"{article_dir}/pubmed23n0002.xml.gz", ARTICLES.replace(">1<", ">12<"))
    df = ingest_xml(spark, article_dir, lake, skip_present=False)
    assert df.count() == 10
    assert {r.PMID for r in df.filter("source_file = 'pubmed23n0002'").collect()} >= {"12"}
    assert "11" not in {r.PMID for r in df.collect()}


def test_manifest_and_empty_files(spark, article_dir, tmp_path):
    from lakesmith.operators.tables import counts_by
    from lakesmith.plans.xml_ingest import load_manifest
    from lakesmith.streaming.ingest import stream_xml_links

    _gz(f"{article_dir}/empty.xml.gz", "<PubmedArticleSet><PubmedArticle/></PubmedArticleSet>")
    lake = str(tmp_path / "lake3")
    df = ingest_xml(spark, article_dir, lake)
    assert {r.source_file for r in load_manifest(spark, lake).collect()} == {"pubmed23n0001"}
    assert {r.source_file: r.rows for r in counts_by(df, "source_file").collect()} == {"pubmed23n0001": 5}
    assert stream_xml_links(spark, article_dir, lake) == 0        # nothing new: the empty file is not read again either
    assert load_manifest(spark, lake).count() == 1


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    for folder, first in (("a", ">1<"), ("b", ">91<")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        _gz(tmp_path / "in" / folder / "f.xml.gz", ARTICLES.replace(">1<", first))
        df = ingest_xml(spark, str(tmp_path / "in"), str(tmp_path / "lake"))      # the second comes later
    assert {r.source_file for r in df.collect()} == {"a/f", "b/f"} and df.count() == 10


def test_unpacked_copy_beside_its_archive_is_one_file(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "0007.xml").write_text(ARTICLES, encoding="utf-8")
    _gz(d / "0007.xml.gz", ARTICLES)
    df = ingest_xml(spark, str(d), str(tmp_path / "lake"))
    assert df.count() == 5 and {r.source_file for r in df.collect()} == {"0007"}


@pytest.mark.parametrize("stream_first", [True, False])
def test_batch_and_stream_share_a_lake(spark, tmp_path, stream_first):
    from lakesmith.plans.xml_ingest import load_manifest
    from lakesmith.streaming.ingest import stream_xml_links

    d, lake = tmp_path / "in", str(tmp_path / "lake")
    d.mkdir()
    loads = [lambda: stream_xml_links(spark, str(d), lake, str(tmp_path / "ck")), lambda: ingest_xml(spark, str(d), lake)]
    for i, load in enumerate(loads if stream_first else loads[::-1]):
        _gz(d / f"f{i}.xml.gz", ARTICLES.replace(">1<", f">{i}00<"))
        load()
    assert spark.read.parquet(lake).count() == 10
    assert {r.source_file for r in load_manifest(spark, lake).collect()} == {"f0", "f1"}


def test_plain_xml_files_are_read_too(spark, tmp_path):
    d = tmp_path / "plain"
    d.mkdir()
    (d / "pubmed23n0009.xml").write_text(ARTICLES, encoding="utf-8")
    _gz(d / "pubmed23n0010.xml.gz", ARTICLES)
    lake = ingest_xml(spark, str(d), str(tmp_path / "lk"))
    assert {r.source_file for r in lake.select("source_file").distinct().collect()} == {
        "pubmed23n0009", "pubmed23n0010"}
    assert lake.count() == 10


def test_remove_loaded_deletes_inputs_after_commit(spark, article_dir, tmp_path):
    import os

    lake = str(tmp_path / "lake4")
    df = ingest_xml(spark, article_dir, lake, remove_loaded=True)
    assert df.count() == 5
    assert not [f for f in os.listdir(article_dir) if f.endswith(".xml.gz")]
    assert ingest_xml(spark, article_dir, lake).count() == 5       # nothing left to load, lake intact


def _cut(path, text):
    """A gzip file that ends in the middle."""
    path.write_bytes(gzip.compress(text.encode())[:40])


def test_damaged_files_do_not_stop_a_load(spark, tmp_path):
    from lakesmith.plans.xml_ingest import dead_letters, load_manifest
    from lakesmith.streaming.ingest import stream_xml_links

    d, lake = tmp_path / "in", str(tmp_path / "lake")
    d.mkdir()
    for i in range(5):
        _gz(d / f"good{i} [x]{{%41}}+.xml.gz", ARTICLES.replace(">1<", f">{i}00<"))
    _cut(d / "cut.xml.gz", ARTICLES)
    _gz(d / "two.xml.gz", ARTICLES + "<PubmedArticleSet></PubmedArticleSet>")
    (d / "nogzip.xml.gz").write_text("no gzip at all")
    _gz(d / "none.xml.gz", "<PubmedArticleSet/>")
    assert stream_xml_links(spark, str(d), lake) == 1
    read = ingest_xml(spark, str(d), lake)
    assert read.count() == 25 and {r.source_file for r in read.collect()} == {f"good{i} [x]{{%41}}+" for i in range(5)}
    dead = {r.source_file: r for r in dead_letters(spark, lake).collect()}
    assert set(dead) == {"cut", "two", "nogzip"} and all(r.reason for r in dead.values())
    assert {r.source_file for r in load_manifest(spark, lake).collect()} == {f"good{i} [x]{{%41}}+" for i in range(5)}
    assert stream_xml_links(spark, str(d), lake) == 0           # not tried again as they are
    _gz(d / "cut.xml.gz", ARTICLES)
    assert stream_xml_links(spark, str(d), lake) == 1           # mended: read again
    assert ingest_xml(spark, str(d), lake).count() == 30 and {r.source_file for r in dead_letters(spark, lake).collect()} == {"two", "nogzip"}
    left = ingest_xml(spark, str(d), lake, remove_loaded=True)
    assert left.count() == 30 and {p.name for p in d.iterdir() if not p.name.startswith(".")} == {"two.xml.gz", "nogzip.xml.gz"}


def test_a_failed_delivery_keeps_the_rows_before(spark, tmp_path):
    from lakesmith.plans.xml_ingest import dead_letters

    d, lake = tmp_path / "in", str(tmp_path / "lake")
    d.mkdir()
    _gz(d / "a.xml.gz", ARTICLES)
    assert ingest_xml(spark, str(d), lake).count() == 5
    _cut(d / "a.xml.gz", ARTICLES)
    assert ingest_xml(spark, str(d), lake, skip_present=False).count() == 5
    assert [r.source_file for r in dead_letters(spark, lake).collect()] == ["a"]


def test_a_file_delivered_again_without_rows_has_none(spark, tmp_path):
    d, lake = tmp_path / "in", str(tmp_path / "lake")
    d.mkdir()
    _gz(d / "a.xml.gz", ARTICLES)
    _gz(d / "b.xml.gz", ARTICLES)
    assert ingest_xml(spark, str(d), lake).count() == 10
    _gz(d / "a.xml.gz", "<PubmedArticleSet/>")
    df = ingest_xml(spark, str(d), lake, skip_present=False)
    assert {r.source_file for r in df.collect()} == {"b"} and df.count() == 5
    assert spark.read.parquet(lake).count() == 5                # replaced rows are deleted, too


def test_a_load_that_ends_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    from lakesmith.plans import xml_ingest
    from lakesmith.plans.xml_ingest import read_link_partitions

    d, lake = tmp_path / "in", str(tmp_path / "lake")
    d.mkdir()
    _gz(d / "a.xml.gz", ARTICLES)
    ingest_xml(spark, str(d), lake)
    before = sorted(read_link_partitions(spark, lake).collect())
    _gz(d / "a.xml.gz", ARTICLES.replace(">1<", ">11<"))
    _gz(d / "b.xml.gz", ARTICLES)
    with monkeypatch.context() as m:
        m.setattr(xml_ingest, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            ingest_xml(spark, str(d), lake, skip_present=False)
    assert spark.read.parquet(lake).count() > 5                 # written, but no record names it
    assert sorted(read_link_partitions(spark, lake).collect()) == before
    with monkeypatch.context() as m:                            # ends between the commit and the removal
        m.setattr(xml_ingest, "_remove_replaced", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            ingest_xml(spark, str(d), lake, skip_present=False)
    after = read_link_partitions(spark, lake)
    assert after.count() == 10 and {r.PMID for r in after.where("source_file = 'a'").collect()} >= {"11"}
    assert ingest_xml(spark, str(d), lake, skip_present=False).count() == 10


def test_faults_of_the_cluster_are_raised(spark):
    from lakesmith.plans.xml_ingest import _bisected

    def write(paths):
        raise RuntimeError("No space left on device")

    with pytest.raises(RuntimeError):
        _bisected(["a", "b"], write)
