"""The corpus operators' queries, each over its whole table, and SQL where it can express them."""

from __future__ import annotations

from hardcourt.llm.blocked_search import OP12_SQL, op12_ranked_search
from hardcourt.llm.count_rtree import OP11_SQL, op11_ngram_jaccard
from hardcourt.llm.cotraining import op1_cotraining
from hardcourt.llm.decontaminate import OP10_SQL, op10_decontaminate
from hardcourt.llm.license_scan import op4_license_alignment
from hardcourt.llm.media_avi import op8_avi_media
from hardcourt.llm.order_minhash import op6_order_minhash
from hardcourt.llm.packing import op7_vector_packing, packed_conversations
from hardcourt.llm.pii import op3_personal_data
from hardcourt.llm.rotated_codes import OP13_SQL, op13_hard_negatives
from hardcourt.llm.suffix_dedup import op2_sparse_suffixes
from hardcourt.llm.token_counts import op5_token_counts
from hardcourt.llm.url_reputation import OP9_SQL, op9_host_reputation

QUERIES = {
    f.__name__: f
    for f in (
        op1_cotraining,
        op2_sparse_suffixes,
        op3_personal_data,
        op4_license_alignment,
        op5_token_counts,
        op6_order_minhash,
        op7_vector_packing,
        op8_avi_media,
        op9_host_reputation,
        op10_decontaminate,
        packed_conversations,
        op11_ngram_jaccard,
        op12_ranked_search,
        op13_hard_negatives,
    )
}
ORACLES = {"op9_host_reputation": OP9_SQL, "op10_decontaminate": OP10_SQL, "op11_ngram_jaccard": OP11_SQL, "op12_ranked_search": OP12_SQL, "op13_hard_negatives": OP13_SQL}
