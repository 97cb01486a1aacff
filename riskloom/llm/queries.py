"""Registered queries of the text operators: name, build function, SQL or None."""

from __future__ import annotations

from riskloom.llm import (
    q_chat,
    q_decontaminate,
    q_fill_in_middle,
    q_lattice,
    q_line_quality,
    q_periodic,
    q_reshard,
    q_simhash,
    q_substring,
    q_surrogates,
    q_token_files,
    q_toxicity,
    q_warc,
)

MODULES = (
    q_toxicity,
    q_chat,
    q_line_quality,
    q_reshard,
    q_lattice,
    q_surrogates,
    q_simhash,
    q_token_files,
    q_substring,
    q_decontaminate,
    q_periodic,
    q_fill_in_middle,
    q_warc,
)

QUERIES = {name: build for module in MODULES for name, build in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
