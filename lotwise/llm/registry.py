"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from lotwise.llm import align, bwt_merge, chat, chunk_bpe, decontaminate, doubling, lexical, line_spread, merkle, mixing, quality, simhash_bk, wavelet

MODULES = (
    wavelet, simhash_bk, line_spread, doubling, chat, decontaminate, chunk_bpe, merkle, quality, bwt_merge, align,
    lexical, mixing,
)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
