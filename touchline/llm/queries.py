"""All registered queries of this subpackage."""

from touchline.llm import (  # noqa: F401
    byte_bpe,
    chat_format,
    embedding_join,
    jaccard_join,
    lexical_search,
    line_dedup,
    merkle,
    packing,
    quality_crf,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_counts,
)
from touchline.llm.tables import QUERIES, SQL  # noqa: F401
