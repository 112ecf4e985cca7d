"""The queries of this subpackage by name, and DuckDB statements for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import (
    bpe,
    exact,
    jaccard,
    langid,
    lexical,
    licenses,
    line_runs,
    middle,
    packing,
    pieces,
    secret_scan,
    topk,
    units,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_topk": topk.op2_topk,
        "op3_license": licenses.op3_license,
        "op4_bpe": bpe.op4_bpe,
        "op5_secrets": secret_scan.op5_secrets,
        "op6_exact_dedup": exact.op6_exact_dedup,
        "op7_ngram_join": jaccard.op7_ngram_join,
        "op8_langid": langid.op8_langid,
        "op9_line_hash": units.op9_line_hash,
        "op10_line_runs": line_runs.op10_line_runs,
        "op11_pieces": pieces.op11_pieces,
        "op12_middle": middle.op12_middle,
        "op13_search": lexical.op13_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_topk": topk.OP2_SQL,
        "op3_license": licenses.OP3_SQL,
        "op6_exact_dedup": exact.OP6_SQL,
        "op9_line_hash": units.OP9_SQL,
        "op10_line_runs": line_runs.OP10_SQL,
        "op12_middle": middle.OP12_SQL,
        "op13_search": lexical.OP13_SQL,
    }
