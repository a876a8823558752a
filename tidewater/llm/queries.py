"""The production queries of the operators, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from tidewater.llm import (chat, collocations, forest, langid, mixing, pii, projections, signatures, substring, suffixtree, tiling, tokens,
                           urlfilter)

QUERIES = {f.__name__: f for f in (
    mixing.op1_mix_sources, langid.op2_language_id, tokens.op3_token_counts, substring.op4_substring_dedup,
    chat.op5_chat_format, projections.op6_embedding_dedup, forest.op7_jaccard_join, tiling.op8_decontaminate,
    urlfilter.op9_url_filter, pii.op10_pii, collocations.op11_collocations, signatures.op12_lexical_search, suffixtree.op13_lm_score)}

ORACLES = {
    "op1_mix_sources": mixing.SQL, "op4_substring_dedup": substring.SQL, "op5_chat_format": chat.SQL,
    "op6_embedding_dedup": projections.SQL, "op7_jaccard_join": forest.SQL, "op9_url_filter": urlfilter.SQL,
    "op11_collocations": collocations.SQL, "op12_lexical_search": signatures.SQL,
}
