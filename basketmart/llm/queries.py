"""The queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from basketmart.llm.alignment import op11_galloping_alignment
from basketmart.llm.decontamination import op10_string_tiling
from basketmart.llm.edit_counts import op7_edit_aware_counts
from basketmart.llm.licenses import op1_license_sentences, oracle
from basketmart.llm.minhash import op6_circulant_minhash
from basketmart.llm.packing import op9_bounded_packing
from basketmart.llm.pii import op8_deobfuscated_pii
from basketmart.llm.quality import op3_divergence_rules
from basketmart.llm.simhash import op12_simhash_blocks
from basketmart.llm.spelling import op13_prefix_suffix_tiles, spelling_oracle
from basketmart.llm.suffix_tree import op5_suffix_tree
from basketmart.llm.toxicity import op2_toxicity
from basketmart.llm.url_rules import op4_association_rules

QUERIES = {
    "op1_license_sentences": op1_license_sentences,
    "op2_toxicity": op2_toxicity,
    "op3_divergence_rules": op3_divergence_rules,
    "op4_association_rules": op4_association_rules,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_circulant_minhash": op6_circulant_minhash,
    "op7_edit_aware_counts": op7_edit_aware_counts,
    "op8_deobfuscated_pii": op8_deobfuscated_pii,
    "op9_bounded_packing": op9_bounded_packing,
    "op10_string_tiling": op10_string_tiling,
    "op11_galloping_alignment": op11_galloping_alignment,
    "op12_simhash_blocks": op12_simhash_blocks,
    "op13_prefix_suffix_tiles": op13_prefix_suffix_tiles,
}

ORACLES: dict[str, str] = {"op1_license_sentences": oracle(), "op13_prefix_suffix_tiles": spelling_oracle()}
