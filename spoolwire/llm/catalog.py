"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from .centroids import OP13_SQL, op13_centroids
from .chat_format import OP8_SQL, op8_chat_format
from .decontamination import OP6_SQL, op6_decontamination
from .embedding_dedup import OP3_SQL, op3_embedding_dedup
from .filter_audit import OP11_SQL, op11_filter_audit
from .jaccard_join import OP2_SQL, op2_ngram_jaccard
from .language_id import op4_language_id
from .license_scan import op1_license_scan
from .mixing import OP10_SQL, op10_mix
from .pii import op5_pii
from .quality import op12_quality
from .token_output import op7_token_output
from .warc import OP9_SQL, op9_warc_revisits

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_decontamination": op6_decontamination,
    "op7_token_output": op7_token_output,
    "op8_chat_format": op8_chat_format,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_mix": op10_mix,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality": op12_quality,
    "op13_centroids": op13_centroids,
}

ORACLE = {
    "op2_ngram_jaccard": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op6_decontamination": OP6_SQL,
    "op8_chat_format": OP8_SQL,
    "op9_warc_revisits": OP9_SQL,
    "op10_mix": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_centroids": OP13_SQL,
}
