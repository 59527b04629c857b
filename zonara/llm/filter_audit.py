"""What five filters remove from each source, in every order in which they can be applied.

A null text is read as the empty one, a null source as the empty name. Each row is a document; rows of one doc_id count one by one, and
take its labels: good if any row of `labels` says quality = 1, toxic if any says toxic = 1, neither if none has the id. A null doc_id has
no labels, is smaller than nothing and larger than nothing. Words are taken of whole texts, in parts; a long text needs memory for its
distinct words. An empty table has no rows; other columns are not read. Texts are equal if their SHA-256 is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonara.llm.common import checkpointed, map_rows, tidy

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MASKS, STEPS = 1 << len(FILTERS), len(FILTERS)
#: Sources that a task holds before it sends their counts on.
HELD_PARTS = 4096
PART = 4 << 20
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

#: [order, step]: the filter applied there; [mask, filter]: whether it fails.
_APPLIED = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
_FAILS = (np.arange(MASKS)[:, None] >> np.arange(STEPS)) & 1 == 1
#: [mask, order]: the step of the first failed filter; STEPS if none fails.
FIRST = np.where(_FAILS.any(1)[:, None], _FAILS[:, _APPLIED].argmax(2), STEPS)

_CAPITALS, _SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
_GAP = b" \t\n\x0b\x0c\r"


def words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of those of some megabytes."""
    at = 0
    while at < len(data):
        end = at + PART
        while end < len(data) and data[end] not in _GAP:
            end += 1
        yield data[at:end].split()
        at = end


def text_mask(text: str, data: bytes) -> int:
    """Which of the filters A to D a text fails, as bits."""
    n, distinct = 0, set()
    for part in words(data):
        n += len(part)
        distinct.update(part)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return (n < 200) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 2 * len(text)) << 2 | any(s in data for s in _SYMBOLS) << 3


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (A to D), digest of the text."""

    def start():
        def each(ids, texts, sources):
            for doc_id, text, source in zip(ids, texts, sources):
                data = (text := text or "").encode("utf-8", "surrogatepass")
                yield doc_id, source or "", text_mask(text, data), hashlib.sha256(data).digest()

        return each

    return map_rows(docs, ["doc_id", "text", "source"], f"doc_id {dict(docs.dtypes)['doc_id']}, part string, mask int, digest binary", start)


def first_copies(rows: DataFrame) -> DataFrame:
    """doc_id, digest of the smallest id of each text, in one row; copies are reduced before the shuffle."""
    return rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))


def removals(cells: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS as [part, order, step] of cells [part, class, mask], where a class has bit 0 for good and bit 1 for toxic."""
    n = len(cells)
    removed = []
    for own in (cells.sum(1), cells[:, [1, 3]].sum(1), cells[:, [2, 3]].sum(1)):
        part, mask = own.nonzero()
        at = (part[:, None] * len(ORDERS) + np.arange(len(ORDERS))) * (STEPS + 1) + FIRST[mask]
        counts = np.bincount(at.ravel(), weights=np.repeat(own[part, mask], len(ORDERS)), minlength=n * len(ORDERS) * (STEPS + 1))  # exact below 2^53 rows
        removed.append(counts.astype(np.int64).reshape(n, len(ORDERS), STEPS + 1)[:, :, :STEPS])
    every = cells.sum(1)
    failing, alone = every @ _FAILS.astype(np.int64), every[:, 1 << np.arange(STEPS)]
    gone = removed[0]
    of_filter = np.zeros((n, STEPS), np.int64)
    for k in range(STEPS):
        of_filter[:, k] = gone[:, _APPLIED == k].sum(1)
    made = (every.sum(1)[:, None, None] - gone.cumsum(2), gone, failing[:, _APPLIED] - gone, alone[:, _APPLIED], *removed[1:], of_filter[:, _APPLIED])
    return dict(zip(COUNTS, made))


def partial_counts(rows: DataFrame) -> DataFrame:
    """part, at (order times STEPS and step), COUNTS of a task's rows (part, class, mask)."""
    schema = pa.schema([("part", pa.string()), ("at", pa.int32()), *((c, pa.int64()) for c in COUNTS)])

    def sent(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        names = list(held)
        for k in range(0, len(names), 64):
            some = names[k : k + 64]
            made = removals(np.stack([held[p] for p in some]))
            size = len(ORDERS) * STEPS
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, size)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(some))), *(pa.array(made[c].ravel()) for c in COUNTS)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            at = (parts.indices.to_numpy() * 4 + batch.column("class").to_numpy()) * MASKS + batch.column("mask").to_numpy()
            cells = np.bincount(at, minlength=len(parts.dictionary) * 4 * MASKS).reshape(-1, 4, MASKS)
            for name, own in zip(parts.dictionary.to_pylist(), cells):
                held[name] = held[name] + own if name in held else own
            if len(held) > HELD_PARTS:
                yield from sent(held)
                held = {}
        yield from sent(held)

    return rows.select("part", "class", "mask").mapInArrow(tidy(run), "part string, at int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and COUNTS, zeros included.

    Texts are read once, for small rows that are written and then joined: with the labels by id, and with the smallest id of each text
    by text and id together, so that no key gathers a group of copies. Each task looks its rows' first failed filters up in FIRST and
    counts them; the tasks' arrays are summed.
    """
    rows = checkpointed(measured(docs))
    marks = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = rows.join(first_copies(rows).withColumn("first", F.lit(True)), ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    klass = (F.coalesce("good", F.lit(0)) + 2 * F.coalesce("toxic", F.lit(0))).alias("class")
    partial = partial_counts(joined.select("part", klass, (F.col("mask") + F.when(copy, F.lit(MASKS // 2)).otherwise(F.lit(0))).alias("mask")))
    total = partial.groupBy("part", "at").agg(*(F.sum(c).alias(c) for c in COUNTS))
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.expr(f"at div {STEPS}").cast("int") + 1)
    return total.select("part", order.alias("filter_order"), (F.col("at") % STEPS + 1).cast("int").alias("step"), *COUNTS)
