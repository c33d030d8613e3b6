"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import chat, decontaminate, divergence, html, langid, middle, pieces, pii, quality, simhash, suffixes, urls, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_pieces": pieces.op2_pieces,
        "op3_chat": chat.op3_chat,
        "op4_quality": quality.op4_quality,
        "op5_pii": pii.op5_pii,
        "op6_langid": langid.op6_langid,
        "op7_suffixes": suffixes.op7_suffixes,
        "op8_warc": warc.op8_warc,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_html": html.op10_html,
        "op11_urls": urls.op11_urls,
        "op12_middle": middle.op12_middle,
        "op13_divergence": divergence.op13_divergence,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": chat.ORACLE_SQL, "op8_warc": warc.ORACLE_SQL, "op12_middle": middle.ORACLE_SQL, "op13_divergence": divergence.ORACLE_SQL}
