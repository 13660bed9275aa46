"""The queries of this folder by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .bpe_chunks import op4_bpe_roundtrip
from .collocations import ORACLE_SQL as PHRASE_SQL
from .collocations import op11_collocations
from .conversations import op12_conversation_repair
from .decontaminate import op6_decontaminate
from .html_text import op5_html_text
from .language_id import op9_language_id
from .line_dedup import op2_line_dedup
from .near_dedup import op1_near_dedup
from .quality_rules import op8_quality_rules
from .token_counts import op13_token_counts
from .token_ids import op3_token_ids
from .toxicity import op7_toxicity
from .url_filter import ORACLE_SQL as URL_SQL
from .url_filter import op10_url_filter

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_ids": op3_token_ids,
    "op4_bpe_roundtrip": op4_bpe_roundtrip,
    "op5_html_text": op5_html_text,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "op11_collocations": op11_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_counts": op13_token_counts,
}
ORACLE_SQL = {"op10_url_filter": URL_SQL, "op11_collocations": PHRASE_SQL}
