"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import maximus, maxscore, minhash, parity, sentences
from .attribution import op6_section_tokens
from .mainpage import op5_main_text
from .maximus import op13_hard_negatives
from .maxscore import op4_maxscore
from .minhash import op7_minhash_near_dedup
from .mixing import op9_mix_sources
from .parity import op12_ngram_jaccard_join
from .passages import op10_repeated_passages
from .pii import op3_pii
from .piece import op2_sentencepiece
from .quality import op8_quality_rules
from .sentences import op10_sentence_spans
from .spelling import op11_spelling_variants
from .toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_sentencepiece, op3_pii, op4_maxscore, op5_main_text, op6_section_tokens, op7_minhash_near_dedup,
    op8_quality_rules, op9_mix_sources, op10_sentence_spans, op10_repeated_passages, op11_spelling_variants, op12_ngram_jaccard_join,
    op13_hard_negatives)}

ORACLE_SQL: dict[str, str] = {
    "op4_maxscore": maxscore.ORACLE_SQL,
    "op7_minhash_near_dedup": minhash.ORACLE_SQL,
    "op10_sentence_spans": sentences.ORACLE_SQL,
    "op12_ngram_jaccard_join": parity.ORACLE_SQL,
    "op13_hard_negatives": maximus.ORACLE_SQL,
}
