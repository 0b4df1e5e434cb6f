"""Article files read in pieces: unusual texts, and big files whose pieces are dealt to tasks."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from lakesmith.sources.xml import read_id_lists


def _id(kind, value):
    return f'<ArticleId IdType="{kind}">{value}</ArticleId>'


def _article(ids, attributes=""):
    return f"<PubmedArticle><PubmedData><ArticleIdList{attributes}>{ids}</ArticleIdList></PubmedData></PubmedArticle>"


# text below the root, lists at any depth, articles' own lists
TEXTS = {
    "plain": (_article(_id("pubmed", "1") + _id("doi", "d")), [[("pubmed", "1"), ("doi", "d")]], None),
    "blank": (_article(_id("pubmed", " \n") + _id("doi", "")), [[("pubmed", None), ("doi", None)]], None),
    "attributes": (_article("<ArticleId Z='\"' IdType='pubmed'>5</ArticleId>" + "<ArticleId>6</ArticleId>"), [[("pubmed", "5"), (None, "6")]], None),
    "list attribute": (_article(_id("pubmed", "1"), ' a="1"'), [[("pubmed", "1")]], None),
    "comment": (_article('<!-- </PubmedArticle><ArticleId IdType="doi">no</ArticleId> -->' + _id("pubmed", "7") + _id("doi", "a<!-- c -->b")),
                [[("pubmed", "7"), ("doi", "b")]], None),
    "cdata": (_article(_id("pubmed", "<![CDATA[8<&]]>") + _id("doi", "x<![CDATA[y]]>z")), [[("pubmed", "8<&"), ("doi", "xyz")]], None),
    "references": (_article(_id("pubmed", "&#65;&#x42;") + _id("doi", "&amp;lt;")), [[("pubmed", "AB"), ("doi", "&lt;")]], None),
    "named references": (_article(_id("pubmed", "&lt;&amp;gt;&quot;") + _id("doi", "é😀")), [[("pubmed", '<&gt;"'), ("doi", "é😀")]], None),
    "child": (_article('<ArticleId IdType="pubmed">a<b>c</b>d</ArticleId><Foo>1</Foo>' + _id("doi", "q")), [[("pubmed", "d"), ("doi", "q")]], None),
    "list in a list": (_article(_id("pubmed", "1") + f"<ArticleIdList>{_id('pubmed', '2')}</ArticleIdList>" + _id("doi", "4")), [[("pubmed", "1"), ("doi", "4")]], None),
    "line ends": ("\r\n" + _article(_id("doi", "4\r5")), [[("doi", "4\n5")]], None),
    "greater": (_article(_id("a>b", "1>2")), [[("a>b", "1>2")]], None),
    "two lists": (f"<PubmedArticle><PubmedData><ArticleIdList>{_id('pubmed', '1')}</ArticleIdList><ArticleIdList>{_id('pubmed', '2')}</ArticleIdList></PubmedData></PubmedArticle>",
                  [[("pubmed", "1")], [("pubmed", "2")]], [[("pubmed", "2")]]),
    "elsewhere": (f"<Other><PubmedData><ArticleIdList>{_id('pubmed', '1')}</ArticleIdList></PubmedData></Other><PubmedArticle><X><ArticleIdList>{_id('pubmed', '2')}</ArticleIdList></X></PubmedArticle>"
                  f"<G>{_article(_id('pubmed', '3'))}</G>", [[("pubmed", "1")], [("pubmed", "2")], [("pubmed", "3")]], [None, [("pubmed", "3")]]),
    "none": ("<PubmedArticle><PubmedData/></PubmedArticle><PubmedArticle/>" + _article(""), [None], [None, None, None]),
    "tags with spaces": (f"<PubmedArticle ><PubmedData ><ArticleIdList ><ArticleId  IdType = 'pubmed' >1</ArticleId ></ArticleIdList ></PubmedData ></PubmedArticle >", [[("pubmed", "1")]], None),
}


@pytest.mark.parametrize("own_only", [False, True])
def test_unusual_texts(spark, tmp_path, own_only):
    for name, (text, _, _) in TEXTS.items():
        with gzip.open(tmp_path / f"{name}.xml.gz", "wb") as f:
            f.write(f"<PubmedArticleSet>{text}</PubmedArticleSet>".encode())
    found: dict = {}
    for r in read_id_lists(spark, str(tmp_path), own_only).collect():
        found.setdefault(r.path.rsplit("/", 1)[1].replace("%20", " ")[:-7], []).append(r.ArticleId and [tuple(x) for x in r.ArticleId])
    assert found == {name: (any_depth if own is None or not own_only else own) for name, (_, any_depth, own) in TEXTS.items()}


def _big(path, n, between="", end="</PubmedArticleSet>"):
    """Some MB of articles with a reference each, whose compressed size is some MB too."""
    noise = random.Random(1)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write('<?xml version="1.0" encoding="utf-8"?>\n<PubmedArticleSet>\n')
        for i in range(n):
            f.write(f'<PubmedArticle>\n<PubmedData><ArticleIdList>{_id("pubmed", i)}{_id("doi", f"10.1/&lt;{i}")}</ArticleIdList>'
                    f'<ReferenceList><Reference><Citation>{noise.randbytes(300).hex()}</Citation><ArticleIdList>{_id("pubmed", -i)}{_id("doi", "r")}</ArticleIdList>'
                    f'</Reference></ReferenceList></PubmedData></PubmedArticle>{between}\n')
        f.write(end)


@pytest.mark.parametrize("own_only", [False, True])
def test_a_big_file_is_read_by_several_tasks(spark, tmp_path, own_only):
    _big(tmp_path / "big.xml.gz", 14_000)
    rows = read_id_lists(spark, str(tmp_path), own_only, spread=4).select(F.spark_partition_id().alias("task"), F.col("ArticleId")[0]["_VALUE"].cast("int").alias("id")).collect()
    assert sorted(r.id for r in rows) == sorted([*range(14_000), *([] if own_only else [-i for i in range(14_000)])])
    assert len({r.task for r in rows}) > 1


def test_a_load_deals_out_big_files_only(spark, tmp_path, monkeypatch):
    from lakesmith.plans import xml_ingest

    (tmp_path / "in").mkdir()
    _big(tmp_path / "in" / "big.xml.gz", 14_000)
    _big(tmp_path / "in" / "small.xml.gz", 10)
    spreads, write = [], xml_ingest._write
    monkeypatch.setattr(xml_ingest, "_write", lambda *a: (spreads.append(a[6:]), write(*a))[1])
    lake = xml_ingest.ingest_xml(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    assert {r.source_file: r["count"] for r in lake.groupBy("source_file").count().collect()} == {"big": 28_000, "small": 20}
    assert len(spreads) == 1 and spreads[0][0] > 1


@pytest.mark.parametrize("fault", ["none, but cuts in comments", "two roots", "cut off"])
def test_big_files_with_faults(spark, tmp_path, fault):
    """A file whose pieces are not well-formed alone is read whole; a damaged one is set aside."""
    from lakesmith.plans.xml_ingest import dead_letters, ingest_xml

    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "big.xml.gz"
    _big(path, 14_000, "<!-- </PubmedArticle> -->" if "comments" in fault else "", "</PubmedArticleSet>" + ("<PubmedArticleSet/>" if fault == "two roots" else ""))
    if fault == "cut off":
        path.write_bytes(path.read_bytes()[:-5000])
    lake = ingest_xml(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    whole = "comments" in fault
    assert lake.count() == (28_000 if whole else 0)
    assert dead_letters(spark, str(tmp_path / "lake")).count() == (0 if whole else 1)
