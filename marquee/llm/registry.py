"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from marquee.llm import bpe, divergence, exact_dedup, fingerprints, jaccard_join, licenses, mixing, near_dedup, packing, phrases, sharding, substrings, toxicity


def queries():
    return {
        "op1_near_dedup": near_dedup.op1_near_dedup,
        "op2_mixing": mixing.op2_mixing,
        "op3_licenses": licenses.op3_licenses,
        "op4_substrings": substrings.op4_substrings,
        "op5_bpe": bpe.op5_bpe,
        "op6_sharding": sharding.op6_sharding,
        "op7_packing": packing.op7_packing,
        "op8_fingerprints": fingerprints.op8_fingerprints,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_jaccard_join": jaccard_join.op11_jaccard_join,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_collocations": phrases.op13_collocations,
    }


def oracle_sql():
    return {
        "op1_near_dedup": near_dedup.OP1_SQL,
        "op2_mixing": mixing.OP2_SQL,
        "op4_substrings": substrings.OP4_SQL,
        "op9_exact_dedup": exact_dedup.OP9_SQL,
        "op11_jaccard_join": jaccard_join.OP11_SQL,
        "op12_source_divergence": divergence.OP12_SQL,
        "op13_collocations": phrases.OP13_SQL,
    }
