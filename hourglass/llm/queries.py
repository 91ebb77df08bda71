"""Queries of the subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from hourglass.llm.byte_bpe import op13_byte_bpe
from hourglass.llm.decontaminate import op8_decontaminate
from hourglass.llm.embed_dedup import ORACLE_OP2, op2_embedding_dedup
from hourglass.llm.hard_negatives import ORACLE_OP11, op11_hard_negatives
from hourglass.llm.jaccard_join import ORACLE_OP1, op1_jaccard_join
from hourglass.llm.langid import op5_language_id
from hourglass.llm.license_scan import ORACLE_OP6, op6_license_scan
from hourglass.llm.sentencepiece_codec import op3_sentencepiece
from hourglass.llm.sharding import op7_sharding
from hourglass.llm.spelling import op12_spelling
from hourglass.llm.toxicity import op4_toxicity
from hourglass.llm.url_filter import ORACLE_OP9, op9_url_filter
from hourglass.llm.warc import ORACLE_OP10, op10_warc

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_sharding": op7_sharding,
    "op8_decontaminate": op8_decontaminate,
    "op9_url_filter": op9_url_filter,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLE = {
    "op1_jaccard_join": ORACLE_OP1,
    "op2_embedding_dedup": ORACLE_OP2,
    "op6_license_scan": ORACLE_OP6,
    "op9_url_filter": ORACLE_OP9,
    "op10_warc": ORACLE_OP10,
    "op11_hard_negatives": ORACLE_OP11,
}
