"""Main-text extraction by a site style tree.

The DOMs of a host's pages are merged: a style node is a path of tags with
their classes and ids.  A node's importance is composed of

* presentation: the entropy of the child layouts that its pages show, and
* content: one less the mean entropy of its texts over the pages that have it
  (a text that all pages repeat adds nothing, one of a single page adds all).

Branches of low importance go from every page of the host, inside a stated
article too, and so do branches whose tag states their role (menu, footer,
form, ...) or whose name is made of a role's words (advert, comments, sidebar,
...), whatever their texts; a name that only holds such a word lowers the
importance.  That a block lies in a stated article or beside
one only raises or lowers its importance; it decides alone where the host has
too few pages.  Single texts are not judged: one that many pages share stays
if its branch holds others.  The merged tree is built by partial aggregates (no host's pages
meet in one task); a page gets its host's pruned paths by a join.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.url_filter import host_path
from lakesmith.session import fresh_dir

#: composite importance below which a branch goes
LEAST_IMPORTANCE = 0.2
#: pages of a host with a branch from which on its statistics count
LEAST_PAGES = 5
#: importance of a branch that too few pages have
UNKNOWN = 0.3
#: what being in a stated article, or beside one, makes of an importance
INSIDE, OUTSIDE = 2.0, 0.5
#: what a stated role, or a name that only holds a role's word, makes of a branch's importance
STATED, HINTED = 0.0, 0.7
#: the same of a stated role on pages that have text nowhere else, where it is the main branch
MAIN_BRANCH = 0.25
#: parts that a host's pages are dealt to
SALTS = 64
#: share of a node's presentation in its importance, per number of its layouts
DAMPING = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
#: an element that starts ends an open one of these
CLOSES = {t: frozenset(["p"]) for t in BLOCK - {"html", "head", "body", "caption", "tbody", "thead", "tfoot", "tr", "option", "optgroup", "legend"}}
CLOSES |= {"li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]), "tr": frozenset(["tr", "td", "th", "p"]),
           "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]), "option": frozenset(["option"]), "body": frozenset(["head"])}
#: where the search for an open element to end stops
SCOPE = frozenset("html body table ul ol dl div article section aside nav main header footer form blockquote td th button".split())
NOISE_TAGS = frozenset("head nav footer aside form menu script style template noscript svg math button select textarea input dialog iframe object canvas audio video search".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar footer "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe share sharing social related recommended comment comments disqus respond login signup search".split()
)
#: those that a paragraph or an inline element of an article may have for a role, too
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo".split())
#: words beside a role word that leave the name a role's
ROLE_PARTS = frozenset("area bar block box btn button buttons container form group header icon icons inner item items link links list outer section slot unit widget wrap wrapper".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
CONTENT = frozenset(["article", "main"])
#: elements whose noise does not reach an article within them
FRAMES = frozenset(["form", "header"])
#: text itself, not a part of the page: its ids name what it says
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote hgroup".split())

#: possessive throughout: a tag whose quote is never closed fails at once
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")


def role_of(words: list[str], strict: bool, roles: frozenset = NOISE_WORDS) -> float:
    """What names make of an importance: those of role words (and ``ROLE_PARTS``) only state a role, others with one hint at it."""
    role = 1.0
    for w in words:
        parts = [p for p in re.split(r"[-_]+", w) if p]
        if any(p in roles for p in parts):
            if all(p in roles or p in ROLE_PARTS or p.isdigit() for p in parts):
                return STATED
            if not strict:
                role = HINTED
    return role


class Node:
    """An open element: its tag, style path, role and the layout of its children.

    ``noise``: 0, 1 in a form or page header, whose noise ends where an article
    begins, or 2.  ``role``: the factor of the importance; it is inherited, but
    not into a stated article.
    """

    __slots__ = ("tag", "path", "noise", "role", "content", "stated", "alone", "kids")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        classes, ids, label, noise = [], [], tag, tag in NOISE_TAGS
        within = parent is not None and parent.content
        content = tag in CONTENT
        if attributes:
            for name, *value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(value).lower()
                if name in ("class", "id"):
                    (classes if name == "class" else ids).extend(value.split())
                    label += "." + ".".join(sorted(value.replace("/", "|").split()))
                elif name == "role":
                    noise |= value in NOISE_ROLES
                    content |= value in ("main", "article")
                elif name in ("hidden", "aria-hidden"):
                    noise |= name == "hidden" or value == "true"
        inline = tag not in BLOCK
        if tag in ("html", "body", "main"):
            role = 1.0
        elif tag == "article":
            role = role_of(classes + ids, True)
            content = role == 1.0                              # <article class="comment"> is none
        elif inline or tag in TEXTUAL:
            role = role_of(classes, True, ADVERTS if within else NOISE_WORDS)
        else:
            role = role_of(classes + ids, False)
        content &= not noise
        level = (1 if tag in FRAMES else 2) if noise or (tag == "header" and not within) else 0
        if parent is not None:
            enters = content and not within
            level = max(level, 0 if enters and parent.noise == 1 else parent.noise)
            role = role if enters else min(role, parent.role)
        # of fixed size, however deep the page is
        self.tag, self.path = tag, hash64(f"{parent.path}/{label}" if parent else label)
        self.noise, self.role, self.content, self.kids = level, role, content or within, []
        self.stated = content and not within                   # where stated content begins
        #: an inline branch that is judged by itself
        self.alone = inline and parent is not None and not parent.noise and (level > 0 or role < parent.role)


def blocks(text: str):
    """Yields ``(node, text)`` for each block of text in page order, and ``(node, None)`` when an element closes."""
    root = Node("page", "", None)
    stack, buffer, at, opened = [root], [], 0, Counter()

    def pop():
        n = stack.pop()
        opened[n.tag] -= 1
        return n

    def flush():
        words = html.unescape("".join(buffer)).split()
        buffer.clear()
        return " ".join(words)

    def owner():
        for n in reversed(stack):
            if n.tag in BLOCK or n.alone or n is root:
                return n

    for m in TOKEN.finditer(text):
        if m.start() < at:                                     # inside raw text
            continue
        buffer.append(text[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                if (tag in BLOCK or _ends_alone(stack, tag)) and (t := flush()):
                    yield owner(), t
                while (n := pop()).tag != tag:
                    yield n, None
                yield n, None
            elif tag == "p" and (t := flush()):
                yield owner(), t
            continue
        if tag in BLOCK and (t := flush()):
            yield owner(), t
        ends = CLOSES.get(tag, ())
        while ends:
            k = len(stack) - 1
            while k > 0 and stack[k].tag not in ends and stack[k].tag not in SCOPE:
                k -= 1
            if k == 0 or stack[k].tag not in ends:
                break
            if any(n.alone for n in stack[k:]) and (t := flush()):
                yield owner(), t
            while len(stack) > k:
                yield pop(), None
        node = Node(tag, m[3], stack[-1])
        stack[-1].kids.append(node.path)
        if tag == "br" or tag in ("td", "th"):
            buffer.append(" ")
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        if node.alone and (t := flush()):                      # an inline branch that may go must not end up in its block
            yield owner(), t
        stack.append(node)
        opened[tag] += 1
    buffer.append(text[at:])
    if t := flush():
        yield owner(), t
    while stack:
        yield stack.pop(), None


def _ends_alone(stack: list[Node], tag: str) -> bool:
    """Whether the innermost open ``tag``, or an element left open in it, is judged by itself."""
    for n in reversed(stack):
        if n.alone or n.tag == tag:
            return n.alone
    return False


def _features(batches):
    """Distinct ``(host, path, kind, feature)`` of each page: texts (kind 0), child layouts (1), the node itself (2)."""
    for batch in batches:
        hosts, out = batch.column(0).to_pylist(), []
        for host, text in zip(hosts, batch.column(1).to_pylist(), strict=True):
            seen = set()
            for node, block in blocks(text or ""):
                if block is not None:
                    seen.add((node.path, 0, hash64(block)))
                else:
                    seen |= {(node.path, 1, hash64("|".join(map(str, sorted(set(node.kids)))))), (node.path, 2, 0)}
            out += [(host, *s) for s in seen]
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int8()), pa.array(cols[3], pa.int64())], names=["host", "path", "kind", "feature"])


def hash64(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def importance(features: DataFrame) -> DataFrame:
    """``(host, path, pages, importance)`` of each style node from its pages' features.

    A text that ``k`` of ``m`` pages repeat has entropy ``log k / log m``;
    layouts of shares ``p`` have ``-sum p log p / log m``, at most 1.
    """
    counts = features.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("k"))
    per = counts.groupBy("host", "path", "kind").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("k").alias("m"),
        F.sum(F.log("k")).alias("logs"), F.sum(F.col("k") * F.log("k")).alias("klogs"),
    )
    nodes = per.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 2, F.col("m"))).alias("pages"),
        F.max(F.when(F.col("kind") == 1, F.col("kinds"))).alias("layouts"),
        F.max(F.when(F.col("kind") == 1, F.log("m") - F.col("klogs") / F.col("m"))).alias("layout_entropy"),
        F.max(F.when(F.col("kind") == 0, F.col("kinds"))).alias("texts"),
        F.max(F.when(F.col("kind") == 0, F.col("logs"))).alias("text_logs"),
    )
    many = F.col("pages") > 1
    shape = F.when(many, F.least(F.lit(1.0), F.col("layout_entropy") / F.log("pages"))).otherwise(1.0)
    text = F.when(F.col("texts").isNull(), 0.0).when(many, 1 - F.least(F.lit(1.0), F.col("text_logs") / F.col("texts") / F.log("pages"))).otherwise(1.0)
    weight = F.pow(F.lit(DAMPING), F.col("layouts"))
    composite = F.when(F.col("texts").isNull(), shape).otherwise((1 - weight) * shape + weight * text)
    return nodes.select("host", "path", "pages", composite.alias("importance"), F.col("texts").isNotNull().alias("has_text"))


def _extract(batches):
    loose = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = []
        for packed, nodes in zip(batch.column("packed").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
            texts.append(main_text(loose(packed).decode() if packed is not None else "", {n["path"]: n["importance"] for n in nodes or ()}))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])


def main_text(text: str, known: dict[int, float]) -> str:
    """Blocks of enough importance, joined by newlines; ``known``: the importances of the host's style nodes.

    If none of a stated article's blocks has enough, as on copies of one page,
    they all stay.
    """
    found, mains, articles = [], 0, 0
    for node, block in blocks(text):
        if node.noise:
            continue
        if block is not None:
            found.append((node, block))
        elif node.stated:
            mains, articles = mains + (node.tag != "article"), articles + (node.tag == "article")
    size = [sum(len(b) for n, b in found if n.content == c) for c in (False, True)]
    # of several articles without a main element, which may be teasers or comments, only the larger part of the text is the stated one
    stated = size[1] > 0 and (mains > 0 or articles <= 1 or size[1] >= size[0])

    only = all(n.role == STATED for n, _ in found)   # nothing else has text: the named branch is the main one

    def kept(node: Node) -> bool:
        prior = (INSIDE if node.content else OUTSIDE) if stated else 1.0
        return known.get(node.path, UNKNOWN) * prior * (MAIN_BRANCH if only else node.role) >= LEAST_IMPORTANCE

    keep = [kept(n) for n, _ in found]
    if stated and not any(k and n.content for k, (n, _) in zip(keep, found, strict=True)):
        keep = [k or n.content and (only or n.role > STATED) for k, (n, _) in zip(keep, found, strict=True)]
    return "\n".join(b for k, (_, b) in zip(keep, found, strict=True) if k)


def _pack(batches):
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        packed = [squeeze(t.as_buffer()) if t.is_valid else None for t in b.column("html")]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), b.column("host"), pa.array(packed, pa.binary())], names=["id", "url", "host", "packed"])


def html_extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, ``url`` and ``text``, the main text's blocks joined by newlines.

    Character references are decoded, white space inside a block becomes one
    space, empty blocks go.  Null and empty html give an empty text.  Pages
    without a URL form one host.  Repeated rows are extracted one by one (they
    count in their host's statistics).  Unclosed and stray tags are repaired
    as browsers do for paragraphs, lists and table cells; unclosed quotes leave
    the rest as text.  Other columns are not read; an empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    path = fresh_dir(spark, "html_extract")
    host, _ = host_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).withColumn("host", F.coalesce(host, F.lit("")))
    tree = importance(rows.select("host", "html").mapInArrow(_features, "host string, path long, kind tinyint, feature long"))
    known = tree.where(F.col("has_text") & (F.col("pages") >= LEAST_PAGES))
    known.groupBy("host").agg(F.collect_list(F.struct("path", "importance")).alias("nodes")).write.parquet(f"{path}/known")       # bounded by a site's style nodes
    kind = pages.schema[id_col].dataType.simpleString()
    packed = rows.select("id", "url", "host", "html").mapInArrow(_pack, f"id {kind}, url string, host string, packed binary")
    # a host may hold a third of all pages: its pages are dealt to parts, and its short list goes to each
    known = spark.read.parquet(f"{path}/known").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = packed.withColumn("part", F.pmod(F.hash("id", "url"), F.lit(SALTS)))
    out = dealt.hint("merge").join(known, ["host", "part"], "left").mapInArrow(_extract, f"id {kind}, url string, text string")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
