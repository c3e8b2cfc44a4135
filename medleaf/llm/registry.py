"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from medleaf.llm.ctph import op10_piecewise_hash
from medleaf.llm.html_text import op9_line_blocks
from medleaf.llm.interpolated_lm import op4_deleted_interpolation
from medleaf.llm.jaccard_join import op2_jaccard_join
from medleaf.llm.mixing import op1_pivotal_mix
from medleaf.llm.mpeg_audio import op3_mpeg_audio
from medleaf.llm.near_dedup import op11_circulant_minhash
from medleaf.llm.packing import op6_vector_best_fit
from medleaf.llm.pairs_sql import linked_sql
from medleaf.llm.phrases import OP13_SQL, op13_trie_collocations
from medleaf.llm.sharding import op7_ring_sharding
from medleaf.llm.spelling import op12_spelling_variants
from medleaf.llm.toxicity import op5_boosted_toxicity
from medleaf.llm.warc import OP8_SQL, op8_segment_reassembly

QUERIES = [
    op1_pivotal_mix,
    op2_jaccard_join,
    op3_mpeg_audio,
    op4_deleted_interpolation,
    op5_boosted_toxicity,
    op6_vector_best_fit,
    op7_ring_sharding,
    op8_segment_reassembly,
    op9_line_blocks,
    op10_piecewise_hash,
    op11_circulant_minhash,
    op12_spelling_variants,
    op13_trie_collocations,
]


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql():
    """The others draw by hash, learn, pack or parse: tests hold them against brute force instead."""
    return {
        "op2_jaccard_join": linked_sql(4, 85, "n_shingles component_id n_links"),
        "op8_segment_reassembly": OP8_SQL,
        "op11_circulant_minhash": linked_sql(5, 85, "n_shingles component_id kept"),
        "op13_trie_collocations": OP13_SQL,
    }
