"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from starloom.llm import (bpe, conversations, exact, jaccard, lengths, packing, pii, quality, resampling,
                          setsketch, substrings, templates, toxicity)
from starloom.llm.frames import documents


def queries() -> dict:
    return {
        "op1_quality_ledger": lambda spark, d: quality.verdicts(documents(spark, d)),
        "op2_nnpu_toxicity": toxicity.query,
        "op3_recompression": substrings.query,
        "op4_line_templates": templates.query,
        "op5_jaccard_join": jaccard.query,
        "op6_cutting_stock": packing.query,
        "op7_heavy_hitters": exact.query,
        "op8_feistel_pseudonyms": pii.query,
        "op9_length_histogram": lengths.query,
        "op10_monoid_bpe": bpe.query,
        "op11_setsketch": setsketch.query,
        "op12_batch_concatenation": resampling.query,
        "op13_lr_repair": conversations.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_ledger": quality.SQL, "op3_recompression": substrings.SQL,
            "op4_line_templates": templates.SQL, "op5_jaccard_join": jaccard.SQL, "op7_heavy_hitters": exact.SQL,
            "op11_setsketch": setsketch.SQL, "op12_batch_concatenation": resampling.SQL,
            "op13_lr_repair": conversations.SQL}
