"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, forest, langid, linededup, merkle, mixing, phrases, probminhash, quality, secret_ledger, substring, toxicity, wrappers


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.query,
        "op2_forest": forest.query,
        "op3_mixing": mixing.query,
        "op4_quality_rules": quality.query,
        "op5_probminhash": probminhash.query,
        "op6_line_dedup": linededup.query,
        "op7_wrappers": wrappers.query,
        "op8_secret_ledger": secret_ledger.query,
        "op9_bpe": bpe.query,
        "op10_substring_dedup": substring.query,
        "op11_phrases": phrases.query,
        "op12_merkle": merkle.query,
        "op13_langid": langid.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_forest": forest.ORACLE_SQL,
        "op3_mixing": mixing.ORACLE_SQL,
        "op4_quality_rules": quality.ORACLE_SQL,
        "op6_line_dedup": linededup.ORACLE_SQL,
        "op10_substring_dedup": substring.ORACLE_SQL,
        "op11_phrases": phrases.ORACLE_SQL,
        "op12_merkle": merkle.ORACLE_SQL,
    }
