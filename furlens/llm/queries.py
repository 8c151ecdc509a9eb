"""Registered queries of this subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from furlens.llm import chat, exact_dedup, html_text, jaccard_join, language, lexical, licenses, mixing, packing, spelling, superminhash, topk, toxicity

REGISTERED = {
    "op1_license_windows": (licenses.op1_license_windows, licenses.OP1_SQL),
    "op2_nn_pu": (toxicity.op2_nn_pu, None),
    "op3_block_naming": (exact_dedup.op3_block_naming, exact_dedup.OP3_SQL),
    "op4_tag_paths": (html_text.op4_tag_paths, None),
    "op5_state_machine": (chat.op5_state_machine, chat.OP5_SQL),
    "op6_evidence": (language.op6_evidence, None),
    "op7_kd_trees": (topk.op7_kd_trees, topk.OP7_SQL),
    "op8_power_of_two": (packing.op8_power_of_two, None),
    "op9_temperature": (mixing.op9_temperature, mixing.OP9_SQL),
    "op10_metric_join": (jaccard_join.op10_metric_join, jaccard_join.OP10_SQL),
    "op11_superminhash": (superminhash.op11_superminhash, superminhash.OP11_SQL),
    "op12_reduced_alphabet": (spelling.op12_reduced_alphabet, spelling.OP12_SQL),
    "op13_dual_tree": (lexical.op13_dual_tree, lexical.OP13_SQL),
}
