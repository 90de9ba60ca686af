"""Queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tillroll.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    language,
    line_dedup,
    negatives,
    packing,
    repetition,
    sharding,
    simhash,
    token_ids,
    toxicity,
    warc,
)


def queries() -> dict:
    return {f.__name__: f for f in (
        repetition.op1_suffix_repetition,
        warc.op2_warc,
        decontaminate.op3_qgram_decontamination,
        token_ids.op4_token_ids,
        language.op5_language_cnn,
        toxicity.op6_subword_toxicity,
        simhash.op7_simhash,
        byte_bpe.op8_byte_bpe,
        line_dedup.op9_line_dedup,
        sharding.op10_kd_sharding,
        packing.op11_best_fit_packing,
        collocations.op12_phrase_collocations,
        negatives.op13_hard_negatives,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_repetition": repetition.OP1_SQL,
        "op2_warc": warc.OP2_SQL,
        "op9_line_dedup": line_dedup.OP9_SQL,
        "op12_phrase_collocations": collocations.OP12_SQL,
        "op13_hard_negatives": negatives.OP13_SQL,
    }
