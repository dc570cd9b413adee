"""The queries of this subpackage by name, and their counterparts in SQL."""

from __future__ import annotations

from floodmark.llm.chat_format import OP13_SQL, op13_chat_format
from floodmark.llm.collocations import OP12_SQL, op12_collocations
from floodmark.llm.decontamination import op3_decontamination
from floodmark.llm.graph_search import op8_graph_search
from floodmark.llm.licences import op1_licence_scan
from floodmark.llm.line_dedup import OP10_SQL, op10_line_dedup
from floodmark.llm.near_dedup import op5_near_dedup
from floodmark.llm.packing import op2_best_fit_packing
from floodmark.llm.quality import op6_quality
from floodmark.llm.sharding import op7_uniform_sharding
from floodmark.llm.token_counts import op9_token_counts
from floodmark.llm.toxicity import op4_toxicity
from floodmark.llm.whitening import op11_whitening

QUERIES = [
    op1_licence_scan,
    op2_best_fit_packing,
    op3_decontamination,
    op4_toxicity,
    op5_near_dedup,
    op6_quality,
    op7_uniform_sharding,
    op8_graph_search,
    op9_token_counts,
    op10_line_dedup,
    op11_whitening,
    op12_collocations,
    op13_chat_format,
]

ORACLES = {
    "op10_line_dedup": OP10_SQL,
    "op12_collocations": OP12_SQL,
    "op13_chat_format": OP13_SQL,
}


def all_queries():
    return {query.__name__: query for query in QUERIES}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
