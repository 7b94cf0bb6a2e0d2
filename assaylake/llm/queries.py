"""The registered queries of the training-data operators and their SQL forms, where SQL can express them."""

from __future__ import annotations

from assaylake.llm.decontamination import OP1_SQL, op1_decontamination
from assaylake.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from assaylake.llm.language_id import op4_language_id, pages_language
from assaylake.llm.merkle_manifest import OP13_SQL, op13_merkle_manifest
from assaylake.llm.mixing import op5_mixing
from assaylake.llm.near_duplicates import op10_near_duplicates
from assaylake.llm.pii import op8_pii
from assaylake.llm.quality_classifier import op12_quality_classifier
from assaylake.llm.quality_rules import op9_quality_rules
from assaylake.llm.sharding import op7_sharding
from assaylake.llm.substring_dedup import op6_substring_dedup
from assaylake.llm.token_index import op2_token_index
from assaylake.llm.url_filters import OP3_SQL, op3_url_filters

QUERIES = {
    "op1_decontamination": (op1_decontamination, OP1_SQL),
    "op2_token_index": (op2_token_index, None),
    "op3_url_filters": (op3_url_filters, OP3_SQL),
    "op4_language_id": (op4_language_id, None),
    "op5_mixing": (op5_mixing, None),
    "op6_substring_dedup": (op6_substring_dedup, None),
    "op7_sharding": (op7_sharding, None),
    "op8_pii": (op8_pii, None),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_near_duplicates": (op10_near_duplicates, None),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_quality_classifier": (op12_quality_classifier, None),
    "op13_merkle_manifest": (op13_merkle_manifest, OP13_SQL),
    "pages_language": (pages_language, None),
}
