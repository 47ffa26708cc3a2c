"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import additive, curriculum, hmm, kneser_ney, linkgraph, minhash_odd, mtree, packing, quotes, suffix_levels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_odd_sketch": minhash_odd.op1,
    "op2_mtree_top_k": mtree.op2,
    "op3_quotation_linking": quotes.op3,
    "op4_kneser_ney_quality": kneser_ney.op4,
    "op5_curriculum_mix": curriculum.op5,
    "op6_additive_quantisation": additive.op6,
    "op7_hidden_markov_lm": hmm.op7,
    "op8_suffix_levels": suffix_levels.op8,
    "op9_link_graph_filter": linkgraph.op9,
    "op10_grouping_ga_packing": packing.op10,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_odd_sketch": minhash_odd.OP1_SQL,
    "op2_mtree_top_k": mtree.OP2_SQL,
    "op3_quotation_linking": quotes.OP3_SQL,
    "op5_curriculum_mix": curriculum.OP5_SQL,
    "op6_additive_quantisation": additive.OP6_SQL,
    "op8_suffix_levels": suffix_levels.OP8_SQL,
    "op9_link_graph_filter": linkgraph.OP9_SQL,
}
