"""Imports every operator module, which registers its query."""

from basketgraph.llm import op1_warc, op2_decontaminate, op3_repair, op4_licenses, op5_suffix_dedup, op6_quality, op7_fingerprint, op8_packing, op9_neardup, op10_chat, op11_repair, op12_token_counts, op13_whitening  # noqa: F401
from basketgraph.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
