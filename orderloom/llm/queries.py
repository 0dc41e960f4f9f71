"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from orderloom.llm.cross_tokens import op12_cross_tokens
from orderloom.llm.decontaminate import OP13_SQL, op13_decontaminate
from orderloom.llm.entropy_mix import op9_entropy_mix
from orderloom.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from orderloom.llm.hilbert_search import op8_hilbert_search
from orderloom.llm.language_mix import op10_language_mix
from orderloom.llm.merkle import op3_merkle
from orderloom.llm.ngram_join import OP7_SQL, op7_ngram_join
from orderloom.llm.pii_crf import op4_pii_crf
from orderloom.llm.piece_scan import op6_piece_scan
from orderloom.llm.resample import op2_resample
from orderloom.llm.url_filters import OP5_SQL, op5_url_filters
from orderloom.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_resample": op2_resample,
    "op3_merkle": op3_merkle,
    "op4_pii_crf": op4_pii_crf,
    "op5_url_filters": op5_url_filters,
    "op6_piece_scan": op6_piece_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_hilbert_search": op8_hilbert_search,
    "op9_entropy_mix": op9_entropy_mix,
    "op10_language_mix": op10_language_mix,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_cross_tokens": op12_cross_tokens,
    "op13_decontaminate": op13_decontaminate,
}
ORACLE_SQL = {
    "op1_warc": OP1_SQL,
    "op5_url_filters": OP5_SQL,
    "op7_ngram_join": OP7_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_decontaminate": OP13_SQL,
}
