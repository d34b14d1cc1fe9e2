"""The corpus operators bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listlens.llm import bpe_segtree, chat_format, conversation_repair, exact_dedup, lattice_lm, mixing_budget, multiset_hash, pii_feistel, simhash_bk, spelling_pivots, substring_cms, toxicity, warc_salvage
from listlens.llm.shared import table


def _over(fn: Callable[[DataFrame], DataFrame], name: str = "documents") -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": _over(exact_dedup.op1),
    "op2_warc": _over(warc_salvage.op2, "pages"),
    "op3_toxicity": toxicity.op3,
    "op4_simhash": _over(simhash_bk.op4),
    "op5_substring": _over(substring_cms.op5),
    "op6_pseudonyms": _over(pii_feistel.op6),
    "op7_lattice": _over(lattice_lm.op7),
    "op8_multiset_hash": _over(multiset_hash.op8),
    "op9_bpe": _over(bpe_segtree.op9),
    "op10_mixing": _over(mixing_budget.op10),
    "op11_conversation_repair": _over(conversation_repair.op11, "conversations"),
    "op12_spelling": _over(spelling_pivots.op12),
    "op13_chat_format": chat_format.op13,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL_OP1,
    "op2_warc": warc_salvage.SQL_OP2,
    "op10_mixing": mixing_budget.SQL_OP10,
    "op11_conversation_repair": conversation_repair.SQL_OP11,
    "op12_spelling": spelling_pivots.SQL_OP12,
    "op13_chat_format": chat_format.SQL_OP13,
}
