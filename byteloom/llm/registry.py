"""Queries of the text operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from byteloom.llm import (
    centroids,
    chat,
    common,
    decontaminate,
    exact,
    html,
    lm,
    mixing,
    resampling,
    sharding,
    simhash,
    substrings,
    tokenfiles,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def query(run: Query) -> Query:
    """`run` in a session whose Python workers find this package as the driver does."""

    def started(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.share_package(spark)
        return run(spark, sf_dir)

    return started


def queries() -> dict[str, Query]:
    named = {
        f.__name__: query(f)
        for f in (
            html.op1_html_extraction,
            substrings.op2_suffix_dedup,
            simhash.op3_simhash,
            toxicity.op4_toxicity,
            lm.op5_lm_scoring,
            decontaminate.op6_decontamination,
            tokenfiles.op7_token_files,
            sharding.op8_sharding,
            exact.op9_exact_dedup,
            mixing.op10_mixing,
            centroids.op11_centroid_clustering,
            chat.op12_chat_formatting,
            resampling.op13_importance_resampling,
        )
    }
    return named | {"pipeline": query(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontamination": decontaminate.OP6_SQL,
        "op9_exact_dedup": exact.OP9_SQL,
        "op10_mixing": mixing.OP10_SQL,
        "op11_centroid_clustering": centroids.OP11_SQL,
        "op12_chat_formatting": chat.OP12_SQL,
        "op13_importance_resampling": resampling.OP13_SQL,
    }
