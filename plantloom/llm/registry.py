"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from plantloom.llm.chat_format import OP3_SQL, op3_chat_format
from plantloom.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from plantloom.llm.language_id import op1_language_id
from plantloom.llm.mixing import op5_source_mix
from plantloom.llm.phrases import OP11_SQL, op11_phrases
from plantloom.llm.pii import op10_pii
from plantloom.llm.piece_bpe import op4_piece_encoding
from plantloom.llm.quality_ordinal import op6_quality_ordinal
from plantloom.llm.quality_rules import OP8_SQL, op8_quality_rules
from plantloom.llm.repeats import op12_repeats
from plantloom.llm.secret_scan import op2_secret_scan
from plantloom.llm.simhash import op9_simhash
from plantloom.llm.whitening import op13_whitening

QUERIES = {q.__name__: q for q in (
    op1_language_id, op2_secret_scan, op3_chat_format, op4_piece_encoding, op5_source_mix,
    op6_quality_ordinal, op7_exact_dedup, op8_quality_rules, op9_simhash, op10_pii, op11_phrases,
    op12_repeats, op13_whitening)}

ORACLE = {
    "op3_chat_format": OP3_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op8_quality_rules": OP8_SQL,
    "op11_phrases": OP11_SQL,
}
