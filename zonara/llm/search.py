"""Exact BM25 top-k: an inverted index for each shard, block-max pruning, exact merge.

Document frequencies, the number of documents and the mean length are of the whole corpus,
so scores of all shards compare. Documents are dealt to shards by a hash; a shard's rows
reach one task in order, documents first, so that it builds its index once and then
streams any number of queries past it. A query sums the postings of its rare terms;
for its frequent terms the index holds the largest impact in each block of documents. A
document's bound is its rare terms' sum plus its block's largest impacts. The documents of
the largest bounds are scored first; of the others only those whose bound can reach the
k-th best score, as in block-max WAND.

Defined cases: a null text has no words, is counted as a document, never found and finds
nothing; equal scores (to DIGITS digits) rank by doc_id, null last; a query row repeated in
full is one query, while documents repeated are each found; without documents or without
queries there are no rows; a text of any length is one list of distinct words, in its
row; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import Hashes, cached_state, checkpointed, map_rows, tidy
from zonara.llm.licences import words

K1, B, DIGITS = 1.2, 0.75, 6
SHARD_WORDS, BLOCK, FREQUENT, FIRST = 6_000_000, 16, 8, 4
FLUSH = 2_000_000


def vectors(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Of each text: sorted hashes of the distinct words, how often each stands there, and the number of words."""
    h, sizes = cached_state("words of search", lambda: Hashes(words)).of(texts)
    ends = np.cumsum(sizes)
    return [(*np.unique(h[z - n : z].view(np.int64), return_counts=True), n) for z, n in zip(ends.tolist(), sizes.tolist())]


def statistics(docs: DataFrame) -> DataFrame:
    """term and its n (documents), summed within tasks before the shuffle; where term is null, docs and words."""
    names = ["term", "n", "docs", "words"]

    def run(batches):
        parts, held, docs, total = [], 0, 0, 0

        def counted():
            terms, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return terms, np.bincount(at, np.concatenate([p[1] for p in parts]), len(terms)).astype(np.int64)

        for batch in batches:
            for h, _, n in vectors(batch.column(0).to_pylist()):
                parts.append((h, np.ones(len(h))))
                held, docs, total = held + len(h), docs + 1, total + n
            if held > FLUSH:
                parts = [counted()]
                if (held := len(parts[0][0])) > FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(parts[0][0]), pa.array(parts[0][1]), *[pa.nulls(held, pa.int64())] * 2], names)
                    parts, held = [], 0
        if parts:
            terms, n = counted()
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n), *[pa.nulls(len(terms), pa.int64())] * 2], names)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (None, None, docs, total)], names)

    return docs.select("text").mapInArrow(tidy(run), "term long, n long, docs long, words long").groupBy("term").agg(*(F.sum(c).alias(c) for c in names[1:]))


class Index:
    """One shard."""

    def __init__(self, ids: list, vectors: list, mean: float):
        self.ids, n = ids, len(ids)
        sizes = np.array([v[2] for v in vectors], float)
        terms, doc = np.concatenate([v[0] for v in vectors]), np.repeat(np.arange(n, dtype=np.int32), [len(v[0]) for v in vectors])
        tf = np.concatenate([v[1] for v in vectors]).astype(float)
        impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
        order = np.argsort(terms, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.terms, self.start = np.unique(terms[order], return_index=True)
        self.stop = np.append(self.start[1:], len(terms))
        self.blocks = np.arange(0, n, BLOCK)
        often = np.flatnonzero(self.stop - self.start >= max(2, n // FREQUENT))
        self.row = np.full(len(self.terms), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((n, len(often)))
        for k, t in enumerate(often):
            self.dense[self.doc[self.start[t] : self.stop[t]], k] = self.impact[self.start[t] : self.stop[t]]
        self.top = np.maximum.reduceat(self.dense, self.blocks, axis=0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, float]]:
        """(place, score) of all documents that can be among the k best, the best first."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        there = self.terms[at] == terms
        at, weights = at[there], weights[there]
        rare = self.row[at] < 0
        score = np.zeros(len(self.ids))
        if rare.any():
            own, w = at[rare], weights[rare]
            parts = [slice(a, z) for a, z in zip(self.start[own].tolist(), self.stop[own].tolist())]
            each = np.repeat(w, self.stop[own] - self.start[own])
            score += np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.impact[p] for p in parts]) * each, len(score))
        w = np.zeros(self.dense.shape[1])
        w[self.row[at[~rare]]] = weights[~rare]
        bound = score + np.repeat(self.top @ w, BLOCK)[: len(score)]
        first = np.argpartition(-bound, FIRST * k)[: FIRST * k] if len(bound) > FIRST * k else np.arange(len(bound))
        full = score[first] + self.dense[first] @ w
        least, slack = np.sort(full)[-k] if len(full) >= k else 0.0, 10.0**-DIGITS
        bound[first] = -1
        rest = np.flatnonzero(bound >= max(least - slack, 0.0))
        full, docs = np.concatenate([full, score[rest] + self.dense[rest] @ w]), np.concatenate([first, rest])
        keep = np.flatnonzero((full > 0) & (full >= (np.sort(full)[-k] if len(full) >= k else 0.0) - slack))
        keep = keep[np.argsort(-full[keep], kind="stable")]
        return list(zip(docs[keep].tolist(), full[keep].tolist()))


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id, score: the k best documents for each row of queries (doc_id, text)."""
    stats = checkpointed(statistics(docs))
    n_docs, n_words = stats.filter("term is null").agg(F.sum("docs"), F.sum("words")).head()
    n_docs, n_words = n_docs or 0, n_words or 0
    mean, shards = max(1.0, n_words) / max(1, n_docs), max(1, -(-n_words // SHARD_WORDS))

    def start():
        return lambda ids, keys, texts: ((i, key, v[0]) for i, key, v in zip(ids, keys, vectors(texts)))

    asked = map_rows(queries.select("doc_id", F.xxhash64("text").alias("key"), "text"), ["doc_id", "key", "text"], "doc_id long, key long, terms array<long>", start)
    pairs = asked.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.explode("terms").alias("term")).join(stats.select("term", "n"), "term")
    weighed = pairs.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("term", F.log(1 + (n_docs - F.col("n") + 0.5) / (F.col("n") + 0.5)).alias("w")))).alias("q"))
    dealt = weighed.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), F.col("doc_id").alias("id"), "key", F.lit(None).cast("string").alias("text"), F.col("q.term").alias("terms"), F.col("q.w").alias("weights"))
    rows = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("key"), "text", F.lit(None).cast("array<long>").alias("terms"), F.lit(None).cast("array<double>").alias("weights"))

    def run(batches):
        shard, ids, held, index = None, [], [], None
        for batch in batches:
            out, made = [], vectors(batch.column(4).to_pylist())
            for s, kind, i, key, v, terms, weights in zip(*(c.to_pylist() for c in batch.columns[:4]), made, batch.column(5), batch.column(6)):
                if s != shard:
                    shard, ids, held, index = s, [], [], None
                if kind == 0:
                    if v[2]:
                        ids.append(i), held.append(v)
                elif ids:
                    if index is None:
                        index, held = Index(ids, held, mean), []
                    out += [(i, key, index.ids[d], x) for d, x in index.search(terms.values.to_numpy(), weights.values.to_numpy(), k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["query_id", "key", "doc_id", "score"])

    found = rows.unionByName(dealt).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind", "id").mapInArrow(tidy(run), "query_id long, key long, doc_id long, score double")
    best = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("score", F.round("score", DIGITS)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
