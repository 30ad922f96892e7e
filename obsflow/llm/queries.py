"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from . import bpe, covertree, langid, licenses, line_dedup, lm, packing, quality, repair, setm, simhash, suffix_dedup, warc

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_packing": packing.op3_packing,
    "op4_warc_revisits": warc.op4_warc_revisits,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_language_id": langid.op6_language_id,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_embedding_near_dedup": covertree.op8_embedding_near_dedup,
    "op9_lm_scoring": lm.op9_lm_scoring,
    "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    "op11_suffix_array_dedup": suffix_dedup.op11_suffix_array_dedup,
    "op12_phrase_mining": setm.op12_phrase_mining,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality.oracle(),
    "op4_warc_revisits": warc.ORACLE,
    "op7_license_scan": licenses.oracle(),
    "op8_embedding_near_dedup": covertree.ORACLE,
    "op11_suffix_array_dedup": suffix_dedup.ORACLE,
    "op12_phrase_mining": setm.oracle(),
    "op13_conversation_repair": repair.oracle(),
}
