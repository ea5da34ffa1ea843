"""Queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

from . import bpe, decontaminate, lengths, quality, simhash, substrings, suffixes, token_files, topk, warc

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_quality": quality.op2_quality,
    "op3_bpe": bpe.op3_bpe,
    "op4_suffix_dedup": suffixes.op4_suffix_dedup,
    "op5_token_counts": lengths.op5_token_counts,
    "op6_simhash": simhash.op6_simhash,
    "op7_warc": warc.op7_warc,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_substring_dedup": substrings.op10_substring_dedup,
}
ORACLE_SQL = {"op9_exact_topk": topk.SQL_OP9}
