"""Registered queries of the text operators and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline

from . import alignment, chat, imatch, mixing, mixlm, pieces, quality, secret, sharding, shingle_join, spelling, token_counts, toxicity


def queries() -> dict[str, Callable]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_secrets": secret.op2_secrets,
        "op3_mixlm": mixlm.op3_mixlm,
        "op4_chat": chat.op4_chat,
        "op5_imatch": imatch.op5_imatch,
        "op6_pieces": pieces.op6_pieces,
        "op7_sharding": sharding.op7_sharding,
        "op8_mixing": mixing.op8_mixing,
        "op9_jaccard": shingle_join.op9_jaccard,
        "op10_quality": quality.op10_quality,
        "op11_token_counts": token_counts.op11_token_counts,
        "op12_spelling": spelling.op12_spelling,
        "op13_alignment": alignment.op13_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_chat": chat.OP4_SQL,
        "op5_imatch": imatch.OP5_SQL,
        "op8_mixing": mixing.OP8_SQL,
        "op9_jaccard": shingle_join.OP9_SQL,
        "op10_quality": quality.OP10_SQL,
    }
