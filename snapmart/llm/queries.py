"""Queries of this package, registered by the entry module, and their SQL where there is any."""

from __future__ import annotations

from snapmart.llm import exact_dedup, fill_in_middle, filter_audit, line_dedup
from snapmart.llm.decontamination import op4_decontamination
from snapmart.llm.exact_dedup import op7_exact_dedup
from snapmart.llm.fill_in_middle import op11_fill_in_middle
from snapmart.llm.filter_audit import op13_filter_audit
from snapmart.llm.html_wrappers import op6_html
from snapmart.llm.line_dedup import op12_line_dedup
from snapmart.llm.pii import op3_pii
from snapmart.llm.piece_encoding import op10_sentencepiece
from snapmart.llm.secrets import op8_secrets
from snapmart.llm.sharding import op1_sharding
from snapmart.llm.simhash import op5_simhash
from snapmart.llm.toxicity import op2_toxicity
from snapmart.llm.url_filter import op9_url_filter

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_html": op6_html,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_secrets": op8_secrets,
    "op9_url_filter": op9_url_filter,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_line_dedup": op12_line_dedup,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op7_exact_dedup": exact_dedup.SQL,
    "op11_fill_in_middle": fill_in_middle.SQL,
    "op12_line_dedup": line_dedup.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
