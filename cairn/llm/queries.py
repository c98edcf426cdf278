"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, importance, lines, mixing, neardup, neighbours, pages, personal, quotes, repetition, spelling, substrings, toxicity

QUERIES = {
    "op1_quotation_linking": quotes.op1_quotation_linking,
    "op2_index_family": substrings.op2_index_family,
    "op3_factorization_machine": toxicity.op3_factorization_machine,
    "op4_repetition_coverage": repetition.op4_repetition_coverage,
    "op5_conditional_random_field": personal.op5_conditional_random_field,
    "op6_recurrent_labeller": pages.op6_recurrent_labeller,
    "op7_efraimidis_spirakis": mixing.op7_efraimidis_spirakis,
    "op8_fuzzy_lines": lines.op8_fuzzy_lines,
    "op9_tensored_minhash": neardup.op9_tensored_minhash,
    "op10_spaced_seeds": decontaminate.op10_spaced_seeds,
    "op11_importance_quickselect": importance.op11_importance_quickselect,
    "op12_inverted_multi_index": neighbours.op12_inverted_multi_index,
    "op13_partenum_variants": spelling.op13_partenum_variants,
}

ORACLES = {
    "op1_quotation_linking": quotes.ORACLE_SQL,
    "op2_index_family": substrings.ORACLE_SQL,
    "op4_repetition_coverage": repetition.ORACLE_SQL,
    "op7_efraimidis_spirakis": mixing.ORACLE_SQL,
    "op10_spaced_seeds": decontaminate.ORACLE_SQL,
    "op9_tensored_minhash": neardup.ORACLE_SQL,
    "op11_importance_quickselect": importance.ORACLE_SQL,
    "op13_partenum_variants": spelling.ORACLE_SQL,
}
