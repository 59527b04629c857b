"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonara.operators import checkpointed

__all__ = ["BATCH_BYTES", "BATCH_ROWS", "Hashes", "Memo", "cached_state", "checkpointed", "crc32_of_id", "documents", "forget", "lean", "map_rows", "slices", "tidy"]

#: What a task handles at once: few rows, since one text can have many megabytes.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20
#: What Spark sends to a Python worker at once, whole rows, the last of which may go beyond.
SENT_BYTES = "4m"

_STATE: dict = {}
_USED: set = set()


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most BATCH_ROWS rows and, but for single rows, BATCH_BYTES bytes."""
    for batch in batches:
        parts = [batch]
        while parts:
            part = parts.pop()
            if (n := part.num_rows) > 1 and (n > BATCH_ROWS or part.nbytes > BATCH_BYTES):
                parts += [part.slice(n // 2), part.slice(0, n // 2)]
            elif n:
                yield part


def cached_state(key, build: Callable):
    """What build() makes, once in a Python worker; it stays while the worker's tasks use it and no other."""
    _USED.add(key)
    if key not in _STATE:
        forget()
        _STATE[key] = build()
    return _STATE[key]


def forget() -> None:
    """Of a worker that goes on with another stage: what earlier stages left in it. Freed pages go back to the system, since other
    workers and the executor share its memory."""
    if _STATE:
        _STATE.clear()
        with contextlib.suppress(OSError, AttributeError):  # no such call in other C libraries
            ctypes.CDLL(None).malloc_trim(0)


def lean(df: DataFrame) -> DataFrame:
    """The rows, in a session that sends them to Python in Arrow batches of SENT_BYTES. Its default is 64 MB, which the executor holds
    as vectors and as a message, beside its heap, and the worker once more, for each task."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", SENT_BYTES)
    return df


def tidy(run: Callable, keep: bool = True) -> Callable:
    """A task's function over Arrow batches, which it gets in small slices. Caches that the task didn't use go after it, without
    `keep` all of them; rows make no cycles, and each collection would go through the caches, so there is none meanwhile."""

    def held(batches):
        _USED.clear()
        gc.disable()
        try:
            yield from run(slices(batches))
        finally:
            gc.enable()
            if not (keep and _USED):
                forget()

    return held


class Memo(dict):
    """Numbers keys as they are looked up, and remembers what make(list of keys) gives for them: look up all keys of a batch,
    then index the list that `values` returns. It is emptied between batches when it holds too many keys or signs."""

    def __init__(self, make: Callable[[list], Iterable], size: int):
        super().__init__()
        self.make, self.size, self.new, self.made, self.held = make, size, [], [], 0

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def start(self) -> None:
        """Before a batch; numbers given earlier are no longer valid."""
        if len(self) > self.size or self.held > 64 * self.size:
            self.clear(), self.made.clear()
            self.held = 0

    def values(self) -> list:
        if self.new:
            self.held += sum(map(len, self.new))
            new, self.new = self.new, []
            self.made.extend(self.make(new))
        return self.made


class Hashes:
    """Word hashes, remembered by number. words: a text's words, as bytes."""

    def __init__(self, words: Callable[[str | None], list[bytes]], size: int = 400_000):
        self.words, self.memo, self.table = words, Memo(lambda new: map(xxhash.xxh3_64_intdigest, new), size), np.empty(0, np.uint64)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of all texts in a row, and how many each text has."""
        self.memo.start()
        if not self.memo:
            self.table = np.empty(0, np.uint64)
        numbers = [list(map(self.memo.__getitem__, self.words(t))) for t in texts]
        made, known = self.memo.values(), len(self.table)
        if len(made) > known:
            self.table = np.concatenate([self.table, np.array(made[known:], np.uint64)])
        sizes = np.array([len(own) for own in numbers], np.int64)
        return self.table[np.fromiter(chain.from_iterable(numbers), np.int64, int(sizes.sum()))], sizes


def map_rows(df: DataFrame, columns: list[str], schema: str, start: Callable[[], Callable[[list], Iterable[tuple]]], keep: bool = True) -> DataFrame:
    """Run start() in each task; its result maps the column lists of an Arrow batch to output rows. keep: as in `tidy`."""
    made = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for batch in batches:
            rows = list(each(*(column.to_pylist() for column in batch.columns)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), out.types)], schema=out)

    return lean(df).select(*columns).mapInArrow(tidy(run, keep), made)


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
