"""Text columns: missing-value tokens, byte-order marks, JSONP unwrapping,
strict JSON parsing into VARIANT, Latin-1 decoding, HTML link extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesmith.functions._util import as_col

# The tokens a CSV reader with default settings reads as missing
# (pandas 1.5 ``read_csv`` default ``na_values``), in its documented order.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a",
    "nan", "null",
]

def na_to_null(col, tokens: list[str] | None = None) -> Column:
    """Null when the value is one of the missing-value tokens."""
    c = as_col(col)
    return F.when(~c.isin(*(NA_TOKENS if tokens is None else tokens)), c)


def strip_bom(col) -> Column:
    """Remove one leading U+FEFF byte-order mark."""
    return F.regexp_replace(as_col(col), "^\ufeff", "")


def unwrap_jsonp(col) -> Column:
    """Trim the character set ``\\(`` on the left and ``)`` on the right.

    Character-set semantics: every leading ``\\`` or ``(`` goes, every trailing
    ``)`` goes; a named callback or a trailing ``;`` is left in place (and the
    strict parse below then yields null).
    """
    left = F.regexp_replace(as_col(col), r"^[\\(]+", "")
    return F.regexp_replace(left, r"\)+\z", "")   # \z: the very end, not before a final newline


def strict_json(col) -> Column:
    """Parse JSON text into VARIANT; null unless the whole text is one JSON value.

    Spark's parser stops after the first value and ignores what follows, so the
    text is parsed as the only element of an array.  A text without ``]`` cannot
    end the array early; it is one value if the array has one element.  Other
    texts are parsed as the only value of an object, too: whatever ends the one
    early is a syntax error in the other, and both are whole exactly when the
    text is one value.  No pattern runs over the text, so its length does not
    matter (up to the size that a VARIANT can hold).
    """
    c = as_col(col)
    in_array = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    alone = F.try_variant_get(in_array, "$[1]", "variant").isNull()
    return F.when(~F.contains(c, F.lit("]")), F.when(alone, F.try_variant_get(in_array, "$[0]", "variant"))).otherwise(
        F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant")))


def latin1(col) -> Column:
    """Decode ISO-8859-1 bytes to a string."""
    return F.decode(as_col(col), "ISO-8859-1")


# HTML link extraction.  One alternation cuts a page into comments, script and
# style elements (whose text holds no markup; like comments they run to the end
# of the page if they are not closed) and tags; attributes are read inside tags
# only.  Groups that repeat are possessive, which Java runs as a loop: the number
# of attributes or characters costs no stack.
_IN_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
HTML_TAG = f"<[a-zA-Z]{_IN_TAG}"
HTML_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<script\b{_IN_TAG}.*?(?:</script\s*>|\z)|<style\b{_IN_TAG}.*?(?:</style\s*>|\z)|{HTML_TAG}"
# where a style sheet names a file, and a page that moves on its target
CSS_URL = r"""(?i)(?:url\(\s*+|@import\s++(?=["']))("[^"]*+"|'[^']*+'|[^)"'\s]++)"""
REFRESH_URL = r"""(?is)^[^;,]*+[;,]\s*+url\s*+=\s*+("[^"]*+"|'[^']*+'|.++)"""
# one attribute with a value quoted with " or ', or unquoted
HTML_ATTR = r"""\s([^\s=<>"'/]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
# The attributes an HTML parser reports as links (the link
# attribute set of lxml.html), in its documented order.
LINK_ATTRS = ["action", "archive", "background", "cite", "classid", "codebase", "data", "href",
              "longdesc", "profile", "src", "usemap", "dynsrc", "lowsrc", "formaction"]
# Named character references decoded in attribute values, '&amp;' last.
ENTITY_DECODE = [("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
# a numeric character reference at the start of a part
NUMERIC_REF = r"^&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));"


def raw_links(html) -> Column:
    """``array<string>`` of links as written (quotes and character references
    still in), in document order: the link attributes of each tag, then the
    target of a ``<meta http-equiv="refresh">``, the ``url()`` and ``@import``
    of a style element and those of a ``style`` attribute."""
    def of_token(t):
        tag = F.regexp_extract(t, f"^{HTML_TAG}", 0)
        attrs = F.regexp_extract_all(tag, F.lit(HTML_ATTR), 0)

        def values(wanted):
            return F.transform(F.filter(attrs, lambda a: wanted(F.lower(F.regexp_extract(a, HTML_ATTR, 1)), a)), lambda a: F.regexp_extract(a, HTML_ATTR, 2))

        links = values(lambda name, a: name.isin(*LINK_ATTRS))
        refreshes = F.size(F.filter(attrs, lambda a: a.rlike(r"""(?i)^\shttp-equiv\s*+=\s*+["']?refresh["']?$"""))) > 0
        moved = F.flatten(F.transform(values(lambda name, a: name == "content"), lambda v: F.regexp_extract_all(clean_link(v), F.lit(REFRESH_URL), 1)))
        sheet = F.regexp_extract_all(F.substring(t, F.length(tag) + 1, F.length(t)), F.lit(CSS_URL), 1)
        inline = F.flatten(F.transform(values(lambda name, a: name == "style"), lambda v: F.regexp_extract_all(clean_link(v), F.lit(CSS_URL), 1)))
        none = F.array().cast("array<string>")
        return F.when(F.startswith(t, F.lit("<!--")), none).otherwise(F.concat(
            links, F.when(t.rlike("(?i)^<meta\\b") & refreshes, moved).otherwise(none), F.when(t.rlike("(?i)^<style\\b"), sheet).otherwise(none),
            F.when(F.contains(F.lower(tag), F.lit("style")), inline).otherwise(none)))

    return F.flatten(F.transform(F.regexp_extract_all(as_col(html), F.lit(HTML_TOKEN), 0), of_token))


def _numeric_refs(value: Column) -> Column:
    """``&#47;`` and ``&#x2F;`` -> the character; a reference to no character stays as it is."""
    def spelt(part):
        ref = F.regexp_extract(part, NUMERIC_REF, 0)
        dec, hexa = F.regexp_extract(part, NUMERIC_REF, 1), F.regexp_extract(part, NUMERIC_REF, 2)
        code = F.when(dec != "", F.conv(dec, 10, 16)).otherwise(hexa)
        number = F.conv(code, 16, 10).cast("bigint")
        char = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        known = (ref != "") & (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(known, F.concat(char, F.substring(part, F.length(ref) + 1, F.length(part)))).otherwise(part)

    return F.when(F.contains(value, F.lit("&#")), F.array_join(F.transform(F.split(value, "(?=&#)"), spelt), "")).otherwise(value)


def clean_link(raw) -> Column:
    """One raw attribute value -> link: outer quotes off, references decoded."""
    x = as_col(raw)
    quoted = F.startswith(x, F.lit('"')) | F.startswith(x, F.lit("'"))
    v = _numeric_refs(F.when(quoted, F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x))
    for ent, ch in ENTITY_DECODE:
        v = F.replace(v, F.lit(ent), F.lit(ch))
    return v


def html_links(html) -> Column:
    """``array<string>`` of link targets in document order (repeats kept)."""
    return F.transform(raw_links(html), clean_link)
