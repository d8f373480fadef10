"""The corpus operators as queries, with their SQL where SQL can express them."""

from windrose.llm import (
    chat_format,
    collocations,
    decontaminate,
    divergence,
    language_id,
    line_dedup,
    main_text,
    packing,
    simhash_dedup,
    source_mix,
    token_files,
    url_filter,
    vector_search,
)

_MODULES = [
    vector_search,
    url_filter,
    source_mix,
    simhash_dedup,
    decontaminate,
    token_files,
    main_text,
    chat_format,
    line_dedup,
    language_id,
    packing,
    divergence,
    collocations,
]

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
