"""The audits and the shards, by brute force."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonara.llm import filter_audit, sharding, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, part string, n long, slot string, row string"  # the last are extra columns
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fixture():
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{chr(97 + int(x))}é" for x in rng.zipf(1.4, 12) % 26), ["en", "de", None, ""][k % 4], f"s{k % 7}", "p", 1, "s", "r") for k in range(160)]
    odd = [
        (900, None, "en", "s0", None, None, None, None), (901, "", "en", "only empty", "p", 1, "s", "r"), (902, "1 2 3 !", "fr", "a", "p", 1, "s", "r"), (903, "x y z", "fr", "b", "p", 1, "s", "r"),
        (904, "Ünï Wa wa WA" * 3, "en", None, "p", 1, "s", "r"), (904, "Ünï Wa wa WA" * 3, "en", None, "p", 1, "s", "r"), (None, "wa wb | WC", "de", "s1", "p", 1, "s", "r"), (None, "wa wb | WC", "de", "s1", "p", 1, "s", "r"),
        (905, "one " * 3000 + "MORE CAPITALS HERE" * 40, "es", "hot", "p", 1, "s", "r"), (906, " ".join(f"n{k}" for k in range(400)), "es", "hot", "p", 1, "s", "r"), (3, rows[5][1], "en", "s1", "p", 1, "s", "r"),
    ]
    return rows + odd + [(1000 + k, rows[2][1], "en", "hot", "p", 1, "s", "r") for k in range(60)]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(fixture(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_divergence(rows, least, top):
    lower = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", WORD.findall((text or "").translate(lower))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        groups = {s: collections.Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        every = sum(groups.values(), collections.Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        shares, q = {s: p(c) for s, c in groups.items()}, p(every)
        for s in groups:
            far = sorted(((-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode(), o) for o in groups if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(far)]
            more = sorted((q[t] - shares[s][t], t.encode(), t) for t in kept if groups[s][t] and shares[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(more[:top])]
    return sorted(out)


@pytest.mark.parametrize("size, of_terms, heavy", [(64, 4096, 4), (2, 4, 1), (3, 5, 2), (2, 3, 100)])
def test_divergence_by_brute_force(mixed, size, of_terms, heavy):
    got = source_divergence.audit(mixed, 2, 4, size, of_terms, heavy)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_divergence(fixture(), 2, 4)


def test_divergence_of_an_empty_table_and_without_kept_terms(mixed, empty):
    assert source_divergence.audit(empty).count() == 0
    assert {(r.part, r.value) for r in source_divergence.audit(mixed, 10_000).collect()} == {("pair", 0)}


def test_divergence_cuts_long_texts_between_terms(monkeypatch):
    text = "Ab, cé9d " * 50 + "x" * 40
    whole = [t for part in source_divergence.terms(text) for t in part]
    monkeypatch.setattr(source_divergence, "PART", 7)
    parts = list(source_divergence.terms(text))
    assert len(parts) > 20 and [t for part in parts for t in part] == whole == [b"ab", "cé".encode(), b"d"] * 50 + [b"x" * 40]


def test_shares_are_exact_beyond_doubles(spark):
    pairs = [(0, 5), (10**12, 3 * 10**12 + 7), (8 * 10**15, 8 * 10**15 + 5), (123456789, 10**15)]
    want = [1 + 10**9 * (c + 5) // t for c, t in pairs]
    assert source_divergence.shares(*(np.array(x, np.int64) for x in zip(*pairs))).tolist() == want
    df = spark.createDataFrame(pairs, "c long, t long").select(source_divergence.share("c", "t").alias("p"))
    assert [r.p for r in df.collect()] == want


def brute_filters(rows, labels):
    out, first = collections.Counter(), {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good, toxic = ({i for i, *x in labels if x[k] == 1} for k in (0, 1))
    failed = []
    for doc_id, text, _, source, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": doc_id is not None and first[t] < doc_id}
        failed.append((source or "", f, doc_id in good, doc_id in toxic))
    for order in map("".join, itertools.permutations("ABCDE")):
        for part, f, g, x in failed:
            gone = False
            for k, c in enumerate(order):
                now = f[c] and not gone
                at = (part, order, k + 1)
                out[*at, "removed"] += now
                out[*at, "redundant"] += f[c] and gone
                out[*at, "unique_fails"] += f[c] and sum(f.values()) == 1
                out[*at, "good_lost"] += now and g
                out[*at, "toxic_lost"] += now and x
                out[part, c, "shapley"] += now
                gone = gone or f[c]
                out[*at, "kept"] += not gone
    return {(part, o, k + 1): tuple(out[part, o[k], c] if c == "shapley" else out[part, o, k + 1, c] for c in filter_audit.COUNTS) for part in {x[0] for x in failed} for o in filter_audit.ORDERS for k in range(5)}


def test_filters_by_brute_force(spark, mixed):
    labels = [(k, k % 3 == 0, k % 5 == 0) for k in range(160)] + [(904, 1, 0), (904, 0, 1), (905, None, 1), (None, 1, 1), (77_777, 1, 1)]
    labels = [(i, None if a is None else int(a), int(b)) for i, a, b in labels]
    got = filter_audit.audit(mixed, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == brute_filters(fixture(), [x for x in labels if x[0] is not None])


def test_filters_of_empty_tables(spark, mixed, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(mixed, labels).agg(F.sum("good_lost") + F.sum("toxic_lost")).head()[0] == 0


def test_first_failures_and_their_counts():
    for mask in range(32):
        for k, order in enumerate(filter_audit.ORDERS):
            hit = [s for s, c in enumerate(order) if mask >> "ABCDE".index(c) & 1]
            assert filter_audit.FIRST[mask, k] == (hit[0] if hit else 5)
    cells = np.random.default_rng(2).integers(0, 9, (3, 4, 32))
    whole, parts = filter_audit.removals(cells), [filter_audit.removals(c) for c in (cells // 2, cells - cells // 2)]
    assert all(np.array_equal(whole[c], parts[0][c] + parts[1][c]) for c in filter_audit.COUNTS)  # partial arrays add up
    every = cells.sum((1, 2))
    assert all(((whole["kept"][:, :, -1] == every[:, None] - whole["removed"].sum(2)).all(), (whole["kept"][:, :, -1] == cells[:, :, 0].sum(1)[:, None]).all()))


def test_filter_words_in_parts(monkeypatch):
    text = "Aé b\x0bc  d\r\n" * 30 + "e" * 50
    monkeypatch.setattr(filter_audit, "PART", 5)
    assert [w for part in filter_audit.words(text.encode()) for w in part] == [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]


def test_hypergeometric_draws_as_their_law(spark):
    n = 20_000
    for total, good, m in ((20, 7, 9), (11, 10, 2), (6, 3, 5)):
        got = collections.Counter(r.k for r in spark.range(n).select(sharding.hypergeometric(F.lit(total), F.lit(good), F.lit(m), F.col("id")).alias("k")).collect())
        want = {k: n * math.comb(good, k) * math.comb(total - good, m - k) / math.comb(total, m) for k in range(max(0, m - total + good), min(m, good) + 1)}
        assert set(got) <= set(want) and sum((got[k] - w) ** 2 / w for k, w in want.items()) < 40  # at most 8 degrees of freedom
    big = spark.range(300).select(sharding.hypergeometric(F.lit(4 * 10**9), F.lit(10**9), F.lit(2 * 10**5), F.col("id")).alias("k"))
    mean, std = big.agg(F.avg("k"), F.stddev("k")).head()
    sigma = math.sqrt(2e5 * 0.25 * 0.75)
    assert abs(mean - 5e4) < 5 * sigma / math.sqrt(300) and 0.8 < std / sigma < 1.25
    edges = spark.sql("select 0L as z, 5L as a, 3L as b").select(*(sharding.hypergeometric(F.col(t), F.col(g), F.col(m)).alias(t + g + m) for t, g, m in (("z", "z", "z"), ("a", "z", "b"), ("a", "b", "z"), ("a", "a", "b"), ("a", "b", "a")))).head()
    assert tuple(edges) == (0, 0, 0, 3, 3)


def test_matrix_keeps_rows_and_columns(spark):
    sizes = [(k, int(n)) for k, n in enumerate(np.random.default_rng(1).integers(1, 40, 700)) if k % 9] + [(5000, 3000)]  # several blocks, gaps, a large partition
    got = {r.part: r.take for r in sharding.matrix(spark.createDataFrame(sizes, "part long, n long"), 24).collect()}
    total = sum(n for _, n in sizes)
    assert {p: sum(t) for p, t in got.items()} == dict(sizes)
    assert np.sum(list(got.values()), 0).tolist() == [total // 24 + (j < total % 24) for j in range(24)]
    hot = np.array(got[5000])
    assert ((hot - 3000 / 24) ** 2 / (3000 / 24)).sum() < 70  # 23 degrees of freedom


def shards_of(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    return by


def test_shards_are_whole_even_and_gapless(spark, mixed, empty, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 3)  # a shard is ordered in several parts
    got = sharding.digest(mixed).collect()
    key = lambda x: (x[0] is None, x)
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in fixture()]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=key) == sorted(want, key=key)
    by = shards_of(got)
    assert set(by) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.digest(empty).count() == 0
    few = shards_of(sharding.digest(mixed.limit(3)).collect())
    assert sorted(map(len, few.values())) == [1, 1, 1]


def test_shuffle_keeps_columns_and_is_uniform(spark, mixed):
    assert sharding.shuffled(mixed).columns == [c for c in mixed.columns if c != "slot"] + ["shard", "slot"]
    seen, n = np.zeros((8, 4), int), 960
    for seed in range(5):
        for r in sharding.shuffled(spark.range(n, numPartitions=8), 4, seed).collect():
            seen[r.id // (n // 8), r.shard] += 1
    assert ((seen - 150) ** 2 / 150).sum() < 60  # 21 degrees of freedom
    one, other = ({r.id: (r.shard, r.slot) for r in sharding.shuffled(spark.range(n, numPartitions=8), 4, seed).collect()} for seed in (1, 1))
    assert one == other
    apart = np.mean([abs(one[k][1] - one[k + 1][1]) for k in range(n - 1) if one[k][0] == one[k + 1][0]])
    assert 55 < apart < 110  # neighbours do not stay near each other: 80 on average


def test_shards_as_files(spark, mixed, tmp_path):
    sharding.write(mixed, str(tmp_path / "s"), 5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == mixed.count() and set(shards_of(back.select("shard", "slot").collect())) == set(range(5))
