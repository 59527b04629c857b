"""How far the sources of a language differ in their words: distances between all sources of a language, and each source's own terms.

A null text, language or source is read as the empty one; each row is a document, so repeated rows count again, whatever their ids
are; other columns are not read. An empty table has no rows; a language without kept terms has distances 0. Equal values are ranked by
the item's UTF-8 bytes. Texts are cut into words in parts, so a long text needs memory for its distinct words. Arithmetic is exact:
long integers, which overflow with an error above 9 * 10^15 occurrences of a language's kept terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import checkpointed, tidy

ONE, SMOOTH, LEAST_DOCS, TOP = 1_000_000_000, 5, 30, 50
#: Sources on each side of a tile, and about how many kept terms meet in a tile's task.
GROUPS, TERMS = 64, 4096
#: A term is heavy (dense) if at least one in HEAVY of the language's sources has it.
HEAVY = 4
#: A task sends its counts on when it holds so many, or has read so many bytes since.
HELD_COUNTS, HELD_BYTES, PART = 400_000, 128 << 20, 4 << 20
#: Numbers in a chunk of numpy work.
CHUNK = 1 << 18

#: A-Z become a-z; other letters and the bytes of other characters stay; everything else is a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of those of some megabytes."""
    data = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n occurrences, docs with it: counted within a task as far as its memory allows, so summed later."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def sent(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, own) in held.items():
            keys = list(n)
            for k in range(0, len(keys), 50_000):
                part = keys[k : k + 50_000]
                columns = [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([own[t] for t in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, read = {}, 0
        for batch in batches:
            for text, lang, source in zip(*(column.to_pylist() for column in batch.columns)):
                n, own = held.setdefault((lang, source), (Counter(), Counter()))
                distinct = set()
                for part in terms(text):
                    n.update(part)
                    distinct.update(part)
                own.update(distinct)
            read += batch.nbytes
            if read > HELD_BYTES or sum(len(n) for n, _ in held.values()) > HELD_COUNTS:
                yield from sent(held)
                held, read = {}, 0
        yield from sent(held)

    return docs.mapInArrow(tidy(run), "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, n, had: terms in enough documents of a language, and their count in each source that has them. One shuffle, by
    language and term; a row holds one number for each source, never one for each document."""
    by = counted(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = by.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("had"))
    return every.filter(F.col("docs") >= least_docs).drop("docs")


def share(count: str, total: str):
    """1 + floor(ONE * (count + SMOOTH) / total), three digits at a time, so that no product overflows."""
    rest, out = f"({count} + {SMOOTH})", "0"
    for _ in range(3):
        out, rest = f"({out} * 1000 + ({rest} * 1000) div {total})", f"(({rest} * 1000) % {total})"
    return F.expr(f"1 + {out}")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in numpy."""
    rest, out = count + SMOOTH, 0
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return 1 + out


def tile(zero: tuple[np.ndarray, np.ndarray], posts: tuple, heavy: tuple, n_terms: int) -> np.ndarray:
    """What some terms add to the distances between the sources of two blocks, beyond those of sources without any of them.

    zero: each source's share of an absent term, for both blocks. posts: for both blocks term (from 0), source (from 0) and share, in
    order of terms. heavy: which posts of each block are of heavy terms. Heavy terms are compared as dense tiles. Of the light ones,
    each post is compared with the absent share of every source of the other block, and pairs of posts of one term are set right.
    """
    left, right = zero
    base = np.abs(left[:, None] - right[None, :])
    out = np.zeros(base.shape, np.int64)
    (lt, lg, lp), (rt, rg, rp) = ([x[h] for x in own] for own, h in zip(posts, heavy))
    step = max(1, CHUNK // base.size)
    dense = np.unique(np.concatenate([lt, rt]))
    for k in range(0, len(dense), step):
        some = dense[k : k + step]
        a, b = np.repeat(left[None], len(some), 0), np.repeat(right[None], len(some), 0)
        for all_, t, g, p in ((a, lt, lg, lp), (b, rt, rg, rp)):
            lo, hi = np.searchsorted(t, [some[0], some[-1] + 1])
            all_[np.searchsorted(some, t[lo:hi]), g[lo:hi]] = p[lo:hi]
        out += (np.abs(a[:, :, None] - b[:, None, :]) - base).sum(0)
    (lt, lg, lp), (rt, rg, rp) = ([x[~h] for x in own] for own, h in zip(posts, heavy))
    for k in range(0, len(lt), step := max(1, CHUNK // len(right))):
        g, p = lg[k : k + step], lp[k : k + step]
        np.add.at(out, g, np.abs(p[:, None] - right[None, :]) - base[g])
    for k in range(0, len(rt), step := max(1, CHUNK // len(left))):
        g, p = rg[k : k + step], rp[k : k + step]
        np.add.at(out.T, g, np.abs(p[:, None] - left[None, :]) - base.T[g])
    starts = np.searchsorted(rt, np.arange(n_terms + 1))
    partners = starts[lt + 1] - starts[lt]
    for k in range(0, len(lt), step := max(1, CHUNK // len(right))):  # a post has no more partners than the block has sources
        own = partners[k : k + step]
        x = np.repeat(np.arange(k, k + len(own)), own)
        y = np.repeat(starts[lt[k : k + step]] - np.cumsum(own) + own, own) + np.arange(own.sum())
        g, h, p, q = lg[x], rg[y], lp[x], rp[y]
        np.add.at(out, (g, h), np.abs(p - q) - np.abs(p - right[h]) - np.abs(left[g] - q) + base[g, h])
    return out


def unit(key: tuple, posts: pd.DataFrame, blocks: pd.DataFrame, size: int) -> pd.DataFrame:
    """The partial distances of a task: a pair of blocks of `size` of one language's sources, and a part of its terms."""
    lang, i, j, part = key
    row = blocks.iloc[0]
    names, totals = zip(*([np.array([x[c] for x in side], kind) for c, kind in (("source", object), ("total", np.int64))] for side in (row.left_, row.right_)))
    if row.v == 0:
        out = np.zeros((len(names[0]), len(names[1])), np.int64)
    else:
        zero = tuple(shares(np.zeros(len(t), np.int64), t) for t in totals)
        out = row.v * np.abs(zero[0][:, None] - zero[1][None, :]) if part == 0 else 0
        term, distinct = pd.factorize(posts.term)
        order = np.argsort(term, kind="stable")
        term, own = term[order], posts.iloc[order]
        n, group, heavy = own.n.to_numpy(np.int64), own.number.to_numpy(np.int64), own.heavy.to_numpy(bool)
        sides, is_heavy = [], []
        for block, total in zip((i, j), totals):
            at = group // size == block
            g = group[at] % size
            sides.append((term[at], g, shares(n[at], total[g])))
            is_heavy.append(heavy[at])
        out = out + tile(zero, tuple(sides), tuple(is_heavy), len(distinct))
    a, b = np.triu_indices(len(names[0]), 1) if i == j else (x.ravel() for x in np.indices(out.shape))
    return pd.DataFrame({"lang": lang, "a": names[0][a], "b": names[1][b], "value": out[a, b]})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, size: int = GROUPS, of_terms: int = TERMS, heavy: int = HEAVY) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language all others by distance (part pair), and the `top` terms
    that it uses more than its language does (part term).

    Terms that many sources have are summed in dense tiles, rare ones as corrections of posts; tasks hold a part of a language's terms
    for two blocks of its sources, and their partial sums are added. Distances come once for each pair and are then listed both ways.
    size: sources of a block; of_terms: about how many terms a task holds; heavy: terms are dense from one source in so many on.
    """
    read = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    kept = checkpointed(kept_terms(read, least_docs))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    posts = kept.select("lang", "term", F.col("n").alias("lang_count"), F.size("had").alias("spread"), F.explode("had").alias("h")).select("lang", "term", "lang_count", "spread", "h.*")
    sizes = posts.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    v = F.coalesce("v", F.lit(0)).cast("long")
    groups = read.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    w = Window.partitionBy("lang")
    groups = checkpointed(groups.select(
        "lang", "source", v.alias("v"), (F.coalesce("own_n", F.lit(0)) + SMOOTH * v).alias("total"), (F.coalesce("lang_n", F.lit(0)) + SMOOTH * v).alias("lang_total"),
        (F.row_number().over(w.orderBy("source")) - 1).alias("number"), F.count(F.lit(1)).over(w).cast("int").alias("sources"),
    ))
    posts = posts.join(groups, ["lang", "source"])

    more = posts.select("lang", "source", "term", (share("n", "total") - share("lang_count", "lang_total")).alias("value")).filter("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    own = more.withColumnRenamed("term", "item").withColumn("rank", rank).filter(F.col("rank") <= top)

    side = groups.groupBy("lang", F.expr(f"number div {size}").cast("int").alias("block"), "v").agg(F.sort_array(F.collect_list(F.struct("number", "source", "total"))).alias("side"))
    last = F.expr(f"cast(v div {of_terms} as int)")
    units = side.withColumnsRenamed({"block": "i", "side": "left_"}).join(side.drop("v").withColumnsRenamed({"block": "j", "side": "right_"}), "lang").filter("i <= j")
    units = units.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    block, other = F.expr(f"number div {size}").cast("int"), F.col("other")
    spread = posts.select("lang", "term", "n", "number", (F.col("spread") * heavy >= F.col("sources")).alias("heavy"), F.pmod(F.xxhash64("term"), last + 1).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.expr(f"(sources - 1) div {size}").cast("int"))).alias("other"))
    spread = spread.select("lang", F.least(block, other).alias("i"), F.greatest(block, other).alias("j"), "part", "term", "n", "number", "heavy")
    keys = ["lang", "i", "j", "part"]
    partial = spread.groupBy(*keys).cogroup(units.groupBy(*keys)).applyInPandas(lambda key, posts, blocks: unit(key, posts, blocks, size), "lang string, a string, b string, value long")
    pairs = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value").select("lang", "p.*", "value")
    far = both.withColumn("rank", rank)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return columns(far, "pair").unionByName(columns(own, "term"))
