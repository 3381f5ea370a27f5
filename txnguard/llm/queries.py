"""The operators as registered queries, and SQL where SQL can state one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnguard.llm import (conv_repair, gumbel_pieces, lang_ppm, licence_rules, merkle, near_dups, nn_descent, packing, pii_anchors,
                          secrets_linked, tagpath, topk_taat, warc)
from txnguard.llm.common import table
from txnguard.session import prepare


def _over(name: str, report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report(table(prepare(spark), sf_dir, name))


QUERIES = {
    "op1_language_ppm": _over("documents", lang_ppm.report),
    "op2_nn_descent": _over("embeddings", nn_descent.report),
    "op3_tag_path_text": _over("pages", tagpath.report),
    "op4_best_fit_packing": _over("documents", packing.report),
    "op5_pii_anchors": _over("documents", pii_anchors.report),
    "op6_gumbel_segmentations": _over("conversations", gumbel_pieces.report),
    "op7_minhash_near_dups": _over("documents", near_dups.report),
    "op8_licence_rules": _over("documents", licence_rules.report),
    "op9_exact_top_k": _over("embeddings", topk_taat.report),
    "op10_linked_secrets": _over("documents", secrets_linked.report),
    "op11_conversation_repair": _over("conversations", conv_repair.report),
    "op12_merkle_manifest": _over("documents", merkle.report),
    "op13_warc_salvage": _over("pages", warc.report),
}

ORACLES = {
    "op7_minhash_near_dups": near_dups.REPORT_SQL,
    "op8_licence_rules": licence_rules.report_sql(),
    "op9_exact_top_k": topk_taat.REPORT_SQL,
    "op12_merkle_manifest": merkle.REPORT_SQL,
    "op13_warc_salvage": warc.REPORT_SQL,
}
