from lakesmith.functions.ids import (
    DOI_ID_TYPE,
    PUBMED_ID_TYPE,
    PY_INT_PATTERN,
    SENTINEL_PMID,
    first_id_of_type,
    in_domain,
    in_domain_or_fail,
    not_equal_keep_null,
    python_int,
)
from lakesmith.functions.paths import (
    base_name,
    concat_url,
    has_suffix,
    join_url,
    lake_path,
    parent,
    strip_last_extension,
    strip_suffix,
)
from lakesmith.functions.text import (
    NA_TOKENS,
    clean_link,
    html_links,
    raw_links,
    latin1,
    na_to_null,
    strict_json,
    strip_bom,
    unwrap_jsonp,
)

__all__ = [
    "DOI_ID_TYPE", "PUBMED_ID_TYPE", "PY_INT_PATTERN", "SENTINEL_PMID", "first_id_of_type",
    "in_domain", "in_domain_or_fail", "not_equal_keep_null", "python_int", "base_name",
    "concat_url", "has_suffix", "join_url", "lake_path", "parent", "strip_last_extension",
    "strip_suffix", "NA_TOKENS", "clean_link", "html_links", "raw_links", "latin1", "na_to_null", "strict_json",
    "strip_bom", "unwrap_jsonp",
]
