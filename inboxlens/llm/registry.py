"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from inboxlens.llm import (
    chat,
    embedding_dups,
    exact_dedup,
    fill_middle,
    hard_negatives,
    licenses,
    lm_scoring,
    main_text,
    mixing,
    near_dups,
    packing,
    resharding,
    toxicity,
)

MODULES = (
    lm_scoring,
    mixing,
    embedding_dups,
    chat,
    licenses,
    near_dups,
    exact_dedup,
    packing,
    resharding,
    toxicity,
    hard_negatives,
    main_text,
    fill_middle,
)


def queries() -> dict:
    import corpus_pipeline

    return {m.QUERY: m.query for m in MODULES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {m.QUERY: m.SQL for m in MODULES if m.SQL}
