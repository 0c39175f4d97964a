"""All operators of this package as queries over the given tables."""

from argulith.llm import (  # noqa: F401  (they register themselves)
    bpe,
    conversation_repair,
    embedding_dups,
    filter_audit,
    licenses,
    line_dedup,
    mixing,
    quality,
    sharding,
    simhash,
    stream_bpe,
    topk,
    toxicity,
)
from argulith.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
