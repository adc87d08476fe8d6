"""Registered corpus queries and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from salesmart.llm import bpe, exact_dedup, fertility, lattice, lm_score, merkle, minhash, mixing, pii, secret_scan, token_store, toxicity, trie


def registry():
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_deleted_interpolation": lm_score.op2_deleted_interpolation,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_token_store": token_store.op4_token_store,
        "op5_contextual_pii": pii.op5_contextual_pii,
        "op6_token_fertility": fertility.op6_token_fertility,
        "op7_circulant_minhash": minhash.op7_circulant_minhash,
        "op8_source_mix": mixing.op8_source_mix,
        "op9_byte_bpe": bpe.op9_byte_bpe,
        "op10_secret_forest": secret_scan.op10_secret_forest,
        "op11_prefix_trie": trie.op11_prefix_trie,
        "op12_merkle_manifest": merkle.op12_merkle_manifest,
        "op13_lattice_near_dup": lattice.op13_lattice_near_dup,
    }


def oracles():
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op11_prefix_trie": trie.ORACLE,
        "op12_merkle_manifest": merkle.ORACLE,
    }
