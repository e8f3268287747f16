"""All registered queries of this subpackage."""

from tidemark.llm import (  # noqa: F401
    collocations,
    exact_dedup,
    language,
    mixing,
    neighbours,
    passages,
    pieces,
    quality,
    secret_scan,
    simhash,
    url_rules,
    vector_codes,
    warc,
)
from tidemark.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
