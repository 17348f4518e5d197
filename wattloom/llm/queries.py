"""The registered queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
from wattloom.llm.brown import op2_lm_score
from wattloom.llm.chat import OP11_SQL, op11_chat_format
from wattloom.llm.convtrie import OP12_SQL, op12_conversation_trie
from wattloom.llm.decontaminate import OP4_SQL, op4_decontamination
from wattloom.llm.licenses import OP1_SQL, op1_license_scan
from wattloom.llm.mixing import op8_mixing
from wattloom.llm.phrases import OP13_SQL, op13_phrases
from wattloom.llm.quality import op7_quality_rules
from wattloom.llm.sharding import op6_sharding
from wattloom.llm.substrings import OP10_SQL, op10_substring_dedup
from wattloom.llm.toxicity import op9_toxicity
from wattloom.llm.triejoin import OP3_SQL, op3_ngram_jaccard
from wattloom.llm.urls import OP5_SQL, op5_url_filter

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_lm_score": op2_lm_score,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_decontamination": op4_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_phrases": op13_phrases,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op1_license_scan": OP1_SQL,
    "op3_ngram_jaccard": OP3_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_phrases": OP13_SQL,
}
