"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, fill_middle, language_id, lexicon, line_dedup, mixing, near_dup, quality, secrets, spelling, token_output, top_k, url_rules

QUERIES = {
    "op1_secrets": secrets.op1,
    "op2_line_dedup": line_dedup.op2,
    "op3_token_output": token_output.op3,
    "op4_mixing": mixing.op4,
    "op5_top_k": top_k.op5,
    "op6_url_rules": url_rules.op6,
    "op7_decontaminate": decontaminate.op7,
    "op8_near_dup": near_dup.op8,
    "op9_language_id": language_id.op9,
    "op10_quality": quality.op10,
    "op11_imatch": lexicon.op11,
    "op12_spelling": spelling.op12,
    "op13_fill_middle": fill_middle.op13,
}

ORACLE_SQL = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_top_k": top_k.OP5_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
    "op13_fill_middle": fill_middle.OP13_SQL,
}
