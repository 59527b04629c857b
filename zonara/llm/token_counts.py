"""Exact length histogram: what every context limit keeps, cuts and loses.

Documents are encoded once and counted by length. One row for each length that
occurs answers, as a context limit, how many documents fit, where it stands among
the quantiles and what truncation leaves; between two lengths all of these are
linear, so the rows answer every limit. The suffix sums run in two levels (within
blocks of lengths, then over the blocks), so no task gets the whole histogram.

`at` answers one limit, whether it occurs or not, and `quantile` one share.

Defined cases: a null text has length 0; an empty table gives no rows (sums of 0 for `at`, a
null for `quantile`); repeated rows count as often as they stand there; a text of any length is
encoded whole; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import cached_state, checkpointed, map_rows

BLOCK = 1024


def encoder(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens."""

    def start():
        encode = cached_state(("counts", ranks_path), lambda: encoder(ranks_path, pattern)).encode_ordinary
        return lambda ids, texts: ((i, len(encode(t)) if t else 0) for i, t in zip(ids, texts))

    return map_rows(docs, ["doc_id", "text"], "doc_id long, n_tokens long", start)


def histogram(counts: DataFrame) -> DataFrame:
    """n_tokens, n_docs."""
    return counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """For each length L that occurs, as a context limit: n_docs of that length, n_fit (length <= L), n_over, tokens_fit,
    truncated_total (sum of min(length, L)), tokens_lost, total_tokens, quantile (share of documents that fit) and
    token_quantile (share of tokens in them)."""
    hist = checkpointed(hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    below = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # a row for BLOCK lengths: longest length / BLOCK rows, whatever the number of documents
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(below), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(below), F.lit(0)).alias("t0"), F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy("n_tokens")
    out = hist.join(blocks, "block").withColumns({"n_fit": F.col("d0") + F.sum("n_docs").over(within), "tokens_fit": F.col("t0") + F.sum("tokens").over(within)})
    over = F.col("all_docs") - F.col("n_fit")
    kept = F.col("tokens_fit") + over * F.col("n_tokens")
    share = lambda a, b: F.when(b == 0, F.lit(1.0)).otherwise(F.round(a / b, 9))
    return out.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "n_fit", over.alias("n_over"), "tokens_fit", kept.alias("truncated_total"), (F.col("total_tokens") - kept).alias("tokens_lost"), "total_tokens",
        share(F.col("n_fit"), F.col("all_docs")).alias("quantile"), share(F.col("tokens_fit"), F.col("total_tokens")).alias("token_quantile"),
    )


def at(hist: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: n_fit, n_over, tokens_fit, truncated_total and tokens_lost."""
    fits = F.col("n_tokens") <= limit
    total = lambda x, when: F.coalesce(F.sum(F.when(when, x)), F.lit(0))
    tokens = F.col("n_tokens") * F.col("n_docs")
    out = hist.agg(total(F.col("n_docs"), fits).alias("n_fit"), total(F.col("n_docs"), ~fits).alias("n_over"), total(tokens, fits).alias("tokens_fit"), total(tokens, ~fits).alias("over"))
    cut = F.col("n_over") * limit
    return out.select(F.lit(limit).alias("context_limit"), "n_fit", "n_over", "tokens_fit", (F.col("tokens_fit") + cut).alias("truncated_total"), (F.col("over") - cut).alias("tokens_lost"))


def quantile(hist: DataFrame, share: float) -> DataFrame:
    """One row: the least length that this share of all documents doesn't exceed."""
    return limits(hist).filter(F.col("n_fit") >= F.lit(share) * (F.col("n_fit") + F.col("n_over"))).agg(F.min("context_limit").alias("length"))
