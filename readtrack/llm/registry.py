"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

from . import op1_mix, op2_license, op3_forest, op4_simhash, op5_toxic, op6_warc, op7_chat, op8_pack, op9_suffix, op10_topk, op11_rank, op12_cobucket, op13_language


def queries() -> dict:
    return {
        "op1_mix_sources": op1_mix.query,
        "op2_license_rules": op2_license.query,
        "op3_hash_prefix_forest": op3_forest.query,
        "op4_golay_simhash": op4_simhash.query,
        "op5_pu_toxicity": op5_toxic.query,
        "op6_arc_to_warc": op6_warc.query,
        "op7_perspective_rotation": op7_chat.query,
        "op8_harmonic_packing": op8_pack.query,
        "op9_column_suffixes": op9_suffix.query,
        "op10_exact_topk": op10_topk.query,
        "op11_max_tree_search": op11_rank.query,
        "op12_cobucket_pair": op12_cobucket.query,
        "op13_string_kernel_language": op13_language.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_rules": op2_license.ORACLE,
        "op6_arc_to_warc": op6_warc.ORACLE,
        "op7_perspective_rotation": op7_chat.ORACLE,
        "op10_exact_topk": op10_topk.ORACLE,
        "op11_max_tree_search": op11_rank.ORACLE,
    }
