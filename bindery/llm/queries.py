"""The registered queries of this subpackage and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversations, imatch, langid, merkle, mixing, ngram_join, pii, suffix_dedup, tokencount, topk, toxicity, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(apply: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: apply(*(table(spark, sf_dir, n) for n in names))


def queries() -> dict[str, Query]:
    return {
        "op1_topk": _over(topk.op1_topk, "embeddings"),
        "op2_pii": _over(pii.op2_pii, "documents"),
        "op3_imatch": _over(imatch.op3_imatch, "documents"),
        "op4_langid": _over(langid.op4_langid, "documents"),
        "op5_toxicity": _over(toxicity.op5_toxicity, "documents", "labels"),
        "op6_suffix_dedup": _over(suffix_dedup.op6_suffix_dedup, "documents"),
        "op7_bpe": _over(bpe.op7_bpe, "documents"),
        "op8_ngram_join": _over(ngram_join.op8_ngram_join, "documents"),
        "op9_token_counts": _over(tokencount.op9_token_counts, "documents"),
        "op10_mixing": _over(mixing.op10_mixing, "documents"),
        "op11_merkle": _over(merkle.op11_merkle, "documents"),
        "op12_warc": _over(warc.op12_warc, "pages"),
        "op13_conversations": _over(conversations.op13_conversations, "conversations"),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": topk.OP1_SQL, "op8_ngram_join": ngram_join.OP8_SQL, "op10_mixing": mixing.OP10_SQL, "op11_merkle": merkle.OP11_SQL, "op12_warc": warc.OP12_SQL}
