"""Packing by non-negative least squares over the histogram of piece lengths.

Each document is encoded once. Its full windows are pieces of WINDOW tokens; the
rest is one shorter piece, which keeps a checksum of each UNIT tokens, so that the
checksums of its parts follow without its ids. The histogram of lengths (WINDOW bins
at most) goes to the driver, which lists shallow combinations of lengths that fill a
window exactly, solves for how often to use each, and rounds down and tops up. What is
left of the histogram is packed greedily: the longest pieces that fit, and where none
fits, a longer one cut at a multiple of UNIT. A piece's rank among those of its length
is its place in its task's own count plus the counts of the tasks before, so a length
that a third of all pieces share is spread too.

Defined cases: a null text is an empty one and packs its end mark alone; documents
repeated in full are packed as often as they stand there; an empty table packs
nothing; a text of any length becomes pieces of WINDOW tokens and a rest; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonara.llm.common import Memo, cached_state, checkpointed, map_rows

WINDOW, END, UNIT = 4096, 2, 32
COLUMNS, DEPTH, STEPS, SEED, CACHE = 6000, 16, 400, 7, 200_000
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, blocks binary, task int, place long"
PLACE = "length long, lo long, hi long, part_start long, part_length long, sequence long, offset long, copies long, unit long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. The tokenizer drops white space and never joins across it, so parts between
    white space are encoded apart and remembered; signs after plain letters are words of their own to it."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        #: for words in lower case, of plain letters or of signs only: what the tokenizer does first is done for them
        self.merger = Tokenizer.from_str(tokenizer_json)
        self.merger.encode_special_tokens = True
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.of_word, self.of_part = Memo(self.words, CACHE), Memo(self.parts, CACHE)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """Each word ends with a token that says so."""
        out = []
        for k in range(0, len(words), 1000):
            own = words[k : k + 1000]
            ids = np.array(self.merger.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) == len(own):
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            else:
                out += map(self.plain, own)
        return out

    def parts(self, parts: list[str]) -> list[bytes]:
        """Of parts between white space."""
        self.of_word.start()
        of_word, at = self.of_word, []
        for p in parts:
            w = p.rstrip(SIGNS)
            if w.isalpha() and (w.isascii() or LATIN.fullmatch(w)):
                at.append((of_word[w.lower()], of_word[p[len(w) :]] if len(w) < len(p) else -1))
            else:
                at.append(None)
        made = of_word.values()
        return [self.plain(p) if x is None else made[x[0]] if x[1] < 0 else made[x[0]] + made[x[1]] for p, x in zip(parts, at)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self.of_part.start()
        number, end, at = self.of_part.__getitem__, END.to_bytes(4, "little"), []
        for t in texts:
            if t and ("\x1c" in t or "\x1d" in t or "\x1e" in t or "\x1f" in t):  # white space to Python alone
                at.append(None)
            else:
                at.append(list(map(number, (t or "").split())))
        made = self.of_part.values().__getitem__
        return [(self.plain(t) if own is None else b"".join(map(made, own))) + end for t, own in zip(texts, at)]


def encoder(spark: SparkSession, tokenizer_path: str):
    """For tasks: the Encoder, from a file that the driver reads and sends (its size is fixed)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    return lambda: cached_state(("packing", tokenizer_path), lambda: Encoder(sent.value))


def block_sums(data: bytes) -> bytes:
    """The checksums of each UNIT ids."""
    return b"".join([zlib.crc32(data[k : k + 4 * UNIT]).to_bytes(4, "little") for k in range(0, len(data), 4 * UNIT)])


def sum_of(blocks: bytes, start: int, length: int) -> int:
    """The checksum of `length` ids from `start`, a multiple of UNIT, by those of its blocks: a checksum of two parts in a row is
    that of the second, changed by the first as so many zeros would change it."""
    total, at = 0, start // UNIT
    for own in np.frombuffer(blocks, "<u4")[at : at - (-length // UNIT)].tolist():
        zeros = bytes(4 * min(UNIT, length))
        total = own ^ zlib.crc32(zeros, total) ^ zlib.crc32(zeros)
        length -= UNIT
    return total


def pieces(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    made = encoder(docs.sparkSession, tokenizer_path)

    def start():
        from pyspark import TaskContext

        encode, task, places = made().encode, TaskContext.get().partitionId(), [0] * (WINDOW + 1)

        def each(ids, texts):
            for i, b in zip(ids, encode(texts)):
                n = len(b) // 4
                for s in range(0, n, WINDOW):
                    part = b[4 * s : 4 * (s + WINDOW)]
                    length = len(part) // 4
                    yield i, s, length, zlib.crc32(part), n, block_sums(part) if length < WINDOW else None, task, places[length]
                    places[length] += 1

        return each

    return map_rows(docs, ["doc_id", "text"], PIECE, start)


def combinations(counts: np.ndarray) -> list[tuple[int, ...]]:
    """Shallow multisets of lengths that occur and sum to WINDOW. counts: by length, 0 to WINDOW."""
    rng, found = np.random.default_rng(SEED), {}
    sums = np.cumsum(counts[:WINDOW])
    if counts[WINDOW]:
        found[(WINDOW,)] = 1
    for a in range(1, WINDOW // 2 + 1):
        if counts[a] and counts[WINDOW - a] and (2 * a < WINDOW or counts[a] > 1):
            found[(a, WINDOW - a)] = 1
    for _ in range(COLUMNS):
        rest, parts = WINDOW, []
        while len(parts) < DEPTH and rest > 0:
            if counts[rest] and parts:
                parts, rest = [*parts, rest], 0
                break
            if not (most := sums[min(rest, WINDOW - 1)]):
                break
            a = int(np.searchsorted(sums, rng.integers(most), side="right"))
            parts.append(a)
            rest -= a
        if rest == 0 and parts:
            found[tuple(sorted(parts))] = 1
    return sorted(found)


def solve(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often to use each; together they use no length more often than it occurs."""
    combos = combinations(counts)
    if not combos:
        return []
    depth = max(map(len, combos))
    at = np.zeros((len(combos), depth), np.int64)  # bin 0 takes the padding
    for k, c in enumerate(combos):
        at[k, : len(c)] = c
    used = (at > 0).astype(float)
    goal, x = counts.astype(float), np.zeros(len(combos))
    load = np.bincount(at.ravel(), used.ravel(), WINDOW + 1)
    step = 1.0 / (used * load[at]).sum(1).max()  # 1 / a bound of the largest eigenvalue of A'A
    ahead, pace = x, 1.0
    for _ in range(STEPS):  # accelerated projected gradient
        miss = np.bincount(at.ravel(), (used * ahead[:, None]).ravel(), WINDOW + 1) - goal
        new = np.maximum(0.0, ahead - step * (used * miss[at]).sum(1))
        pace, last = (1 + (1 + 4 * pace * pace) ** 0.5) / 2, pace
        ahead, x = new + (last - 1) / pace * (new - x), new
    left, uses = counts.copy(), np.zeros(len(combos), np.int64)
    for topping in (False, True):
        for k in np.argsort(-x, kind="stable"):
            lengths, times = np.unique(at[k][at[k] > 0], return_counts=True)
            n = int((left[lengths] // times).min())
            n = n if topping else min(n, int(x[k]))
            left[lengths] -= n * times
            uses[k] += n
    return [(c, int(n)) for c, n in zip(combos, uses) if n]


class Pool:
    """Pieces that are not laid yet, by length: runs of ranks of pieces of an original length, from a start in them."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.runs = {a: [(a, 0, 0, int(n))] for a, n in enumerate(counts.tolist()) if n}  # original length, start, ranks from, to
        self.rows: list[tuple] = []
        self.sequences = 0

    def add(self, parts: list[tuple[int, int, int]], times: int) -> None:
        """Lay `times` sequences of parts (length, copies, tokens taken of each, from its start)."""
        offset = 0
        for length, copies, taken in parts:
            unit, runs, rest = 0, self.runs[length], []
            while unit < times * copies:
                a, s, lo, hi = runs.pop()
                n = min(hi - lo, times * copies - unit)
                if n < hi - lo:
                    runs.append((a, s, lo + n, hi))
                self.rows.append((a, lo, lo + n, s, taken, self.sequences, offset, copies, unit))
                if taken < length:
                    rest.append((a, s + taken, lo, lo + n))
                unit += n
            self.left[length] -= times * copies
            if rest:
                self.left[length - taken] += times * copies
                self.runs.setdefault(length - taken, []).extend(rest)
            offset += copies * taken
        self.sequences += times

    def fill(self) -> None:
        """Lay what is left: the longest that fit, then a part of a longer one."""
        while self.left.any():
            room, parts, used = WINDOW, [], {}
            while room:
                fit = np.flatnonzero(self.left[: room + 1])
                fit = fit[~np.isin(fit, list(used))]  # as many as fit of each length are taken at once
                if not len(fit):
                    break
                length = int(fit[-1])
                used[length] = min(room // length, int(self.left[length]))
                parts.append((length, used[length], length))
                room -= used[length] * length
            times = min(int(self.left[length]) // n for length, n in used.items())
            longer = np.flatnonzero(self.left > 0)
            longer = [x for x in longer[longer > room].tolist() if x not in used or self.left[x] > used[x]]
            if room >= UNIT and longer:
                length, taken = longer[-1], room // UNIT * UNIT
                if length in used:  # the part comes on top of whole ones of the same length
                    times = min(times, int(self.left[length]) // (used[length] + 1))
                else:
                    times = min(times, int(self.left[length]))
                parts.append((length, 1, taken))
            self.add(parts, times)


def placed(counts: np.ndarray) -> list[tuple]:
    """Rows of PLACE: which ranks of which length go where."""
    pool = Pool(counts)
    for combo, times in solve(counts):
        lengths, copies = np.unique(combo, return_counts=True)
        pool.add([(a, n, a) for a, n in zip(lengths.tolist(), copies.tolist())], times)
    pool.fill()
    return pool.rows


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece."""
    made = checkpointed(pieces(docs.select("doc_id", "text"), tokenizer_path))
    own = checkpointed(made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))  # WINDOW rows a task at most
    counts = np.zeros(WINDOW + 1, np.int64)
    for length, n in own.groupBy("length").agg(F.sum("n")).collect():  # WINDOW rows at most
        counts[length] = n
    columns = [pa.array(x, pa.int64()) for x in np.array(placed(counts), np.int64).reshape(-1, PLACE.count(",") + 1).T]
    # bounded by COLUMNS x DEPTH and the lengths, not by the corpus; as Arrow, since of a list executors would start workers of another kind
    place = docs.sparkSession.createDataFrame(pa.table(columns, names=[c.split()[0] for c in PLACE.split(", ")]))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = own.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranks = made.join(firsts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("place"))
    fits = (ranks["length"] == place["length"]) & (ranks["rank"] >= place["lo"]) & (ranks["rank"] < place["hi"])
    laid = ranks.join(F.broadcast(place), fits).withColumn("at", F.col("unit") + F.col("rank") - F.col("lo"))

    def start():
        def each(ids, starts, lengths, sums, tokens, blocks, part_starts, part_lengths, sequences, offsets):
            for i, s, n, crc, total, b, p, m, *where in zip(ids, starts, lengths, sums, tokens, blocks, part_starts, part_lengths, sequences, offsets):
                yield i, s + p, m, crc if m == n else sum_of(b, p, m), total, *where

        return each

    columns = [*(ranks[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "blocks")), "part_start", "part_length"]
    laid = laid.select(*columns, (F.col("sequence") + F.floor(F.col("at") / F.col("copies"))).alias("sequence_id"), (F.col("offset") + F.col("at") % F.col("copies") * F.col("part_length")).alias("offset"))
    return map_rows(laid, laid.columns, PACKED, start)
