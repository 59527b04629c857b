"""N-gram Jaccard join with set-relation skipping, and the components of its links.

A document's set holds the hashes of its distinct WIDTH-word shingles. Equal sets are
one node. Shingles are ordered from rare to common by a fixed-size frequency sketch of
the whole corpus, which any order would do for right results; two sets that reach the
threshold share a shingle among their rarest few, so only these go into the index.

Skipping in the index: an index list is cut into blocks by the sizes of its sets. The
shingle's position in a set says how large a partner may be, so an entry meets only the
blocks of its list up to that size, and a list with many entries is many join keys.
A pair is looked at only if the positions, the sizes and the parity bitmaps of the two
sets leave room for the overlap it needs (all three are exact bounds). An entry without
any other set of a fitting size in its list is skipped before bitmaps are fetched.
Skipping in the answers: the set at the head of a list, the one with the fewest rarer
shingles, is compared with the others first. Sets that link to it share its component,
which is all that is asked, so pairs within a component are not looked at again; only
pairs across components are, and none of those is left out.

Defined cases: a text that is null or has no word has an empty set and links with
nothing; rows repeated are equal sets; an id that is null takes part in links but never
names a component (null if there is no other id); an empty table gives no rows; of equally
rare shingles the smaller hash comes first; a text of any length is one set; columns beside
doc_id and text are ignored by `clustered` and passed on by `keep_one`.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import Hashes, cached_state, checkpointed, lean, map_rows, tidy

BUCKETS, BLOCKS, FAN_IN = 1 << 21, 64, 64
WORDS = 16  # 64-bit words of a parity bitmap
BROADCAST_ROWS = 50_000
SIZE_BLOCKS = 4  # blocks of an index list for each doubling of the sets' size
SETS_KEPT = 32  # in a task, while pairs are verified
SEEN = 100_000  # digests of texts that a task remembers
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def combined(h: np.ndarray, take: int) -> np.ndarray:
    """Hashes of all runs of `take` words."""
    n = max(0, len(h) - take + 1)
    with np.errstate(over="ignore"):
        total = np.full(n, take, np.uint64)
        for k in range(take):
            total += h[k : k + n] * MIX[k % 4] + MIX[4] * np.uint64(k // 4)
        return mixed(total)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles; with fewer words the whole sequence is one. A task's words are more than
    are remembered, so the tasks here keep none for the next one: joins and sorts follow, and idle workers would hold them."""
    h, sizes = cached_state("words of shingles", lambda: Hashes(words)).of(texts)
    every, ends, out = combined(h, width), np.cumsum(sizes), []
    starts = ends - sizes
    for a, z in zip(starts.tolist(), ends.tolist()):
        if z - a >= width:
            every[a : z - width + 1].sort()
    fresh = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=fresh[1:])
    for a, z in zip(starts.tolist(), ends.tolist()):
        if z - a >= width:
            keep = fresh[a : z - width + 1]
            keep[0] = True
            out.append(every[a : z - width + 1][keep])
        else:
            out.append(combined(h[a:z], z - a) if z > a else np.empty(0, np.uint64))
    return out


def shingles(text: str | None, width: int) -> np.ndarray:
    return shingle_sets([text], width)[0]


def node(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def bitmap(s: np.ndarray) -> np.ndarray:
    """The parity of the number of members in each of WORDS * 64 classes."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) % (WORDS * 64), minlength=WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def need(a, b, percent: int):
    """The least overlap with which sizes a and b reach percent: 100 * o >= percent * (a + b - o)."""
    return -((-percent * (a + b)) // (100 + percent))


def profiled(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key (of its text), node, n, bits for each document; and, where block is not null, a task's shingle counts by block."""
    schema = "doc_id long, key long, node binary, n long, bits array<long>, block int, task int, counts binary"
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        task, counts, any_row = TaskContext.get().partitionId(), np.zeros(BUCKETS, np.uint32), False
        for batch in batches:
            nodes, sizes, bits = [], [], []
            sets = shingle_sets(batch.column(2).to_pylist(), width)
            np.add.at(counts, (np.concatenate(sets) >> np.uint64(43)).astype(np.int64), 1)
            for s in sets:
                nodes.append(node(s)), sizes.append(len(s)), bits.append(bitmap(s))
            none = pa.nulls(len(nodes))
            any_row = any_row or bool(nodes)
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip([batch.column(0), batch.column(1), pa.array(nodes), pa.array(sizes), pa.array(bits, types[4]), none, none, none], types)], names)
        if any_row:
            rows = [zlib.compress(b.tobytes(), 1) for b in counts.reshape(BLOCKS, -1)]
            none = pa.nulls(BLOCKS)
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip([none, none, none, none, none, pa.array(range(BLOCKS)), pa.array([task] * BLOCKS), pa.array(rows)], types)], names)

    return lean(docs).select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(tidy(run, keep=False), schema)


def sketch(profiles: DataFrame) -> np.ndarray:
    """A byte for each bucket of shingles, larger for more frequent ones: BUCKETS bytes whatever the corpus."""

    def added(key, table):
        total = sum(np.frombuffer(zlib.decompress(b), np.uint32).astype(np.uint64) for b in table.column("counts").to_pylist())
        out = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "counts": [zlib.compress(out.tobytes(), 1)]})

    parts = profiles.filter("block is not null").select("block", "task", "counts")
    tasks = 1 + (parts.agg(F.max("task")).head()[0] or 0)
    while tasks > 1:  # FAN_IN arrays of a fixed size at most meet in one task
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("block", "task").applyInArrow(added, "block int, task int, counts binary")
        tasks = -(-tasks // FAN_IN)
    counts = np.zeros((BLOCKS, BUCKETS // BLOCKS), np.uint32)
    for block, data in parts.select("block", "counts").collect():
        counts[block] = np.frombuffer(zlib.decompress(data), np.uint32)
    return np.minimum(255, np.round(8 * np.log2(counts.ravel() + 1.0))).astype(np.uint8)


def index(docs: DataFrame, width: int, percent: int, rank: np.ndarray) -> DataFrame:
    """token, node, pos, n: each set under its rarest shingles, of which linked sets share one."""
    sent = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches):
        seen = set()
        for batch in batches:
            parts, nodes, fresh = [[], [], []], [], []
            for t in batch.column(0).to_pylist():
                if (key := xxhash.xxh3_128_digest((t or "").encode("utf-8", "surrogatepass"))) in seen:
                    continue  # a copy's entries would be the same; later steps remove those of other tasks
                if len(seen) == SEEN:
                    seen.clear()
                seen.add(key)
                fresh.append(t)
            for s in shingle_sets(fresh, width) if fresh else ():
                if not (n := len(s)):
                    continue
                order = np.argsort(sent.value[(s >> np.uint64(43)).astype(np.int64)], kind="stable")[: n - -(-percent * n // 100) + 1]
                k = len(order)
                nodes += [node(s)] * k
                for part, x in zip(parts, (s[order].view(np.int64), np.arange(k, dtype=np.int32), np.full(k, n, np.int32))):
                    part.append(x)
            if nodes:
                tokens, places, sizes = (pa.array(np.concatenate(p)) for p in parts)
                yield pa.RecordBatch.from_arrays([tokens, pa.array(nodes, pa.binary()), places, sizes], ["token", "node", "pos", "n"])

    return lean(docs).select("text").mapInArrow(tidy(run, keep=False), "token long, node binary, pos int, n int")


def fitting(percent: int, x: str = "", y: str = "_h"):
    """Whether two entries of a list can belong to linked sets, by sizes and positions."""
    c = lambda name, side: F.col(f"{name}{side}")
    sizes = (100 * c("n", x) >= percent * c("n", y)) & (100 * c("n", y) >= percent * c("n", x))
    return sizes & (F.least(c("n", x) - c("pos", x), c("n", y) - c("pos", y)) >= least_overlap(percent, x, y))


def least_overlap(percent: int, x: str, y: str):
    return F.expr(f"-floor(-{percent} * (n{x} + n{y}) / {100 + percent})")


def alike(percent: int, x: str = "", y: str = "_h"):
    """Whether the bitmaps of two sets leave room for the overlap they need."""
    c = lambda name, side: F.col(f"{name}{side}")
    apart = sum((F.bit_count(c("bits", x)[k].bitwiseXOR(c("bits", y)[k])) for k in range(1, WORDS)), F.bit_count(c("bits", x)[0].bitwiseXOR(c("bits", y)[0])))
    return c("n", x) + c("n", y) - apart >= 2 * least_overlap(percent, x, y)


def reach(percent: int):
    """The largest set that an entry's set can link to by this shingle: with a larger one, what stands from its position on is
    less than the overlap it needs."""
    return F.expr(f"(({100 + percent} * (n - pos)) div {percent}) - n")


def size_block(n):
    """Never falls as n grows, which is all that right results need."""
    return F.floor(SIZE_BLOCKS * F.log2(n)).cast("int")


def block_pairs(sides: DataFrame, percent: int) -> DataFrame:
    """Pairs of entries of a list, columns of the larger set with suffix _h, from the blocks that the smaller set's entry
    reaches; roots differ, and sizes, positions and bitmaps fit."""
    low = sides.withColumn("_to", reach(percent)).filter("_to >= n").withColumn("_block", F.explode(F.sequence(size_block(F.col("n")), size_block(F.col("_to"))))).drop("_to")
    high = sides.select("token", size_block(F.col("n")).alias("_block"), *(F.col(c).alias(f"{c}_h") for c in ("node", "pos", "n", "bits", "root")))
    ordered = (F.col("n") < F.col("n_h")) | ((F.col("n") == F.col("n_h")) & (F.col("node") < F.col("node_h")))
    return low.join(high, ["token", "_block"]).filter(ordered & (F.col("root") != F.col("root_h")) & fitting(percent) & alike(percent))


def with_partners(lists: DataFrame, of: str, percent: int) -> DataFrame:
    """The entries whose list has a set of a fitting size under another value of `of`. Of a list in the order of sizes, the
    nearest such entry before or after decides; it stands where the run of equal values that holds the entry begins or ends."""
    marks = []
    for k, order in enumerate(((F.col("n"), F.col(of)), (F.col("n").desc(), F.col(of).desc()))):
        w = Window.partitionBy("token").orderBy(*order)
        lists = lists.withColumn(f"_b{k}", F.when(F.lag(of).over(w) != F.col(of), F.lag("n").over(w)))
        lists = lists.withColumn(f"_m{k}", F.last(f"_b{k}", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        marks += [f"_b{k}", f"_m{k}"]
    return lists.filter((100 * F.col("_m0") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("_m1"))).drop(*marks)


def texts_of(docs: DataFrame, profiles: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node, packed: one compressed text of each node asked for. A text is a third of its set's size, so it travels instead."""
    asked = checkpointed(profiles.join(nodes, "node", "left_semi").groupBy("node").agg(F.max(F.struct("doc_id", "key")).alias("one")).select("node", F.col("one.doc_id").alias("_id"), F.col("one.key").alias("_key")))
    if asked.count() <= BROADCAST_ROWS:
        keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
        found = keyed.join(F.broadcast(asked), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))

        def once():
            pack, done = zstandard.ZstdCompressor().compress, set()

            def each(ids, texts):
                for i, t in zip(ids, texts):
                    if i not in done:  # a row can stand in the table again; what other tasks repeat only repeats links
                        done.add(i)
                        yield i, pack(t.encode("utf-8", "surrogatepass"))

            return each

        return map_rows(found, ["node", "text"], "node binary, packed binary", once)

    def start():
        pack = zstandard.ZstdCompressor().compress

        def each(texts):
            for t, s in zip(texts, shingle_sets(texts, width)):
                if len(s):
                    yield node(s), pack(t.encode("utf-8", "surrogatepass"))

        return each

    return map_rows(docs, ["text"], "node binary, packed binary", start, keep=False).join(nodes, "node", "left_semi").dropDuplicates(["node"])


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v of the pairs whose sets, made again from their texts, reach the threshold."""
    x, y = texts.select(F.col("node").alias("u"), F.col("packed").alias("pu")), texts.select(F.col("node").alias("v"), F.col("packed").alias("pv"))

    def start():
        unpack = zstandard.ZstdDecompressor().decompress
        made = lru_cache(SETS_KEPT)(lambda packed: shingles(unpack(packed).decode("utf-8", "surrogatepass"), width))

        def each(us, vs, pus, pvs):
            for u, v, pu, pv in zip(us, vs, pus, pvs):
                a, b = made(pu), made(pv)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    yield u, v

        return each

    return map_rows(pairs.join(x, "u").join(y, "v"), ["u", "v", "pu", "pv"], "u binary, v binary", start, keep=False)


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each component, by large and small stars until nothing changes."""
    edges = checkpointed(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        to = large.join(least, "u")
        small = to.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = checkpointed(small)
        # a fixed point is a set of stars, whose edges the two steps give back
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0))).head()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def joined(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """A profile of each document (doc_id, key, node, n), and links u, v between nodes that span the same components as all
    links do."""
    docs = docs.select("doc_id", "text")
    raw = checkpointed(profiled(docs, width))
    profiles = raw.filter("block is null").select("doc_id", "key", "node", "n", "bits")
    maps = profiles.groupBy("node").agg(F.first("bits").alias("bits"))
    entries = index(docs, width, percent, sketch(raw)).repartition("token").distinct()
    head = F.first(F.struct("node", "pos", "n")).over(Window.partitionBy("token").orderBy("pos", "node"))
    lists = checkpointed(with_partners(entries, "node", percent).withColumn("h", head))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = checkpointed(pairs.select(F.greatest("node", "node_h").alias("u"), F.least("node", "node_h").alias("v")).distinct())
        nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
        return checkpointed(verified(pairs, checkpointed(texts_of(docs, profiles, nodes, width)), width, percent))

    near = lists.select("node", "pos", "n", *(F.col(f"h.{c}").alias(f"{c}_h") for c in ("node", "pos", "n")))
    near = near.filter((F.col("node") != F.col("node_h")) & fitting(percent)).select("node", "n", "node_h", "n_h").distinct()
    near = near.join(maps, "node").join(maps.select(F.col("node").alias("node_h"), F.col("bits").alias("bits_h")), "node_h")
    links = linked(near.filter(alike(percent)))
    roots = components(links)
    sides = lists.drop("h").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sides = checkpointed(with_partners(sides, "root", percent).join(maps, "node").select("token", "node", "pos", "n", "bits", "root"))
    return profiles.drop("bits"), links.union(linked(block_pairs(sides, percent)))


def all_links(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """A profile of each document (doc_id, key, node, n), and all links u, v between different sets: every entry meets every entry that
    it reaches, not only those of other components. The links are as many as there are, so of a group of near copies the square
    of its different sets; copies are one set. `joined` is for classes, this is for whoever wants each link."""
    docs = docs.select("doc_id", "text")
    raw = checkpointed(profiled(docs, width))
    profiles = raw.filter("block is null").select("doc_id", "key", "node", "n", "bits")
    maps = profiles.groupBy("node").agg(F.first("bits").alias("bits"))
    entries = with_partners(index(docs, width, percent, sketch(raw)).repartition("token").distinct(), "node", percent)
    sides = checkpointed(entries.join(maps, "node").select("token", "node", "pos", "n", "bits", F.col("node").alias("root")))
    pairs = checkpointed(block_pairs(sides, percent).select(F.greatest("node", "node_h").alias("u"), F.least("node", "node_h").alias("v")).distinct())
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    return profiles.drop("bits"), verified(pairs, checkpointed(texts_of(docs, profiles, nodes, width)), width, percent)


def link_counts(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_links: how many other documents each one links with, copies included."""
    profiles, links = all_links(docs, width, percent)
    profiles, links = checkpointed(profiles), checkpointed(links)
    copies = profiles.filter("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    ways = links.select(F.col("u").alias("node"), F.col("v").alias("other")).union(links.select(F.col("v").alias("node"), F.col("u").alias("other")))
    far = ways.join(copies.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("far"))
    own = copies.join(far, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    return profiles.join(own, "node", "left").select("doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def clustered(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id and key, a hash of its text."""
    profiles, links = joined(docs, width, percent)
    full = profiles.filter("n > 0").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = full.join(named, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "key")
    return out.union(profiles.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), "key"))


def keep_one(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One document of each component, with all its columns: the first by doc_id, then by its text's hash. In components without
    any id each text stays once; texts without words all stay."""
    found = clustered(docs, width, percent)
    first = found.filter("n_shingles > 0 and component_id is not null").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("f")).select("f.doc_id", "f.key")
    none = found.filter("n_shingles > 0 and component_id is null").select("doc_id", "key").distinct()
    empty = found.filter("n_shingles = 0").select("doc_id", "key").distinct()
    kept = first.union(none).withColumn("one", F.lit(True)).union(empty.withColumn("one", F.lit(False)))
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), F.struct(*docs.columns).alias("row")).alias("d")
    kept = kept.withColumnsRenamed({"doc_id": "k_id", "key": "k_key"})
    got = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("key") == F.col("k_key")))
    single = got.filter("one").dropDuplicates(["doc_id", "key"])
    return single.union(got.filter("not one")).select("row.*")
