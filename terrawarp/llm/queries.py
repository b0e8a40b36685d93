"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .bpe import op8_byte_bpe
from .cover_topk import OP4_SQL, op4_cover_topk
from .graph_ann import op6_graph_ann
from .id_store import op7_id_store
from .line_dedup import OP3_SQL, op3_line_dedup
from .lm import op5_lm_score
from .mixing import OP1_SQL, op1_mix
from .simhash import op2_simhash
from .toxicity import op10_toxicity
from .url_filter import OP9_SQL, op9_url_filter

QUERIES = {"op1_mix": op1_mix, "op2_simhash": op2_simhash, "op3_line_dedup": op3_line_dedup, "op4_cover_topk": op4_cover_topk, "op5_lm_score": op5_lm_score, "op6_graph_ann": op6_graph_ann, "op7_id_store": op7_id_store, "op8_byte_bpe": op8_byte_bpe, "op9_url_filter": op9_url_filter, "op10_toxicity": op10_toxicity}
ORACLE_SQL = {"op1_mix": OP1_SQL, "op3_line_dedup": OP3_SQL, "op4_cover_topk": OP4_SQL, "op9_url_filter": OP9_SQL}
