"""Columns and steps that the other tests leave open, by brute force; the pipeline's stages on odd tables."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonara.llm import jaccard_join, language_id, licences, quality, queries, token_counts, toxicity

SF = "/root/testdata/sf0.001"


def test_quality_posteriors_by_plain_em(spark):
    """kept and p_good of a whole table: the votes, the mixture's expectation-maximisation and the posterior, written out once more."""
    got = queries.op4_quality_rules(spark, SF).collect()
    rows = quality.measured(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"]).collect()
    pick = lambda bad, good: -1 if bad else 1 if good else 0
    votes = {}
    for r in rows:
        n, rep, sym, dup, chars, lines, up, let = r.n_words, r.n_repeat_words, r.n_symbols, r.n_dup_lines, r.word_chars, r.n_lines, r.n_upper, r.n_letters
        votes[r.doc_id] = (
            pick(n < 10, n >= 20), pick(rep > 0.2 * n, rep <= 0.05 * n), pick(10 * sym > n, 50 * sym <= n), pick(10 * dup > 3 * lines, dup == 0),
            pick(chars < 2 * n or chars > 14 * n, 3 * n <= chars <= 10 * n), pick(5 * up > 2 * let, 20 * up <= 3 * let), pick(2 * let < chars, 4 * let >= 3 * chars),
        )
    v = np.array(list(votes.values()))
    k = v.shape[1]
    prior = np.array([1 - quality.JUNK, *[quality.JUNK / k] * k])
    rate = np.array([[quality.GOOD] * k] + [[quality.CAUGHT if r == c else quality.OTHER for r in range(k)] for c in range(k)])
    low = np.array([[0.99] * k] + [[0.01] * k] * k)
    high = np.array([[0.9999] * k] + [[0.5 if r == c else 0.99 for r in range(k)] for c in range(k)])

    def posterior(share, good):
        logs = np.log(share) + (v == 1) @ np.log(good).T + (v == -1) @ np.log(1 - good).T
        p = np.exp(logs - logs.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    share, good = prior, rate
    for _ in range(quality.STEPS):
        p = posterior(share, good)
        share = quality.STRENGTH * prior + p.sum(0)
        share = share / share.sum()
        yes, no = quality.STRENGTH * rate + p.T @ (v == 1), quality.STRENGTH * (1 - rate) + p.T @ (v == -1)
        good = np.clip(yes / (yes + no), low, high)
    want = dict(zip(votes, posterior(share, good)[:, 0]))
    assert len({r.kept for r in got}) == 2
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert math.isclose(r.p_good, want[r.doc_id], abs_tol=1e-9) and r.kept == (not failed and want[r.doc_id] >= 0.5), r.doc_id


def test_every_column_of_the_limits(spark):
    lengths = [0, 0, 1, 3, 3, 3, 10, 1023, 1024, 1024, 5000]
    hist = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    total = sum(lengths)
    want = {}
    for limit in set(lengths):
        fit = [n for n in lengths if n <= limit]
        cut = sum(min(n, limit) for n in lengths)
        want[limit] = (lengths.count(limit), len(fit), len(lengths) - len(fit), sum(fit), cut, total - cut, total, round(len(fit) / len(lengths), 9), round(sum(fit) / total, 9))
    got = token_counts.limits(hist).collect()
    assert {r.context_limit: tuple(r)[1:] for r in got} == want
    assert token_counts.limits(hist).columns == ["context_limit", "n_docs", "n_fit", "n_over", "tokens_fit", "truncated_total", "tokens_lost", "total_tokens", "quantile", "token_quantile"]


def test_spans_labels_and_score_of_notices(spark):
    mit, bsd, gpl = (licences.NOTICES[k].split() for k in ("mit", "bsd", "gpl"))
    other = [f"w{k}" for k in range(40)]
    part = gpl[: len(gpl) * 2 // 3]
    texts = {
        1: other + mit + other + bsd, 2: other[:5] + part, 3: other + mit[:4], 4: mit[:20] + other[:3] + mit[20:], 5: mit[:20] + other + mit[20:], 6: ["MIT", "License"] + other, 7: mit + mit,
    }
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")).collect()}
    spans = {k: [(s.label, s.start, s.end, round(s.share, 6)) for s in r.spans] for k, r in got.items()}
    assert spans[1] == [("mit", 40, 40 + len(mit), 1.0), ("bsd", 80 + len(mit), 80 + len(mit) + len(bsd), 1.0)] and got[1].labels == "bsd,mit"
    assert spans[2] == [("gpl", 5, 5 + len(part), round(len(part) / len(gpl), 6))]
    assert spans[3] == [] and spans[6] == [] and spans[4] == [("mit", 0, len(mit) + 3, 1.0)]
    assert spans[5] == [] or all(s[3] < 1 for s in spans[5])  # 40 words between are too many for one chain
    assert [s[:3] for s in spans[7]] == [("mit", 0, len(mit)), ("mit", len(mit), 2 * len(mit))]
    share = lambda k: max((s[3] for s in spans[k]), default=0.0)
    for k, r in got.items():
        phrase = any(p in " ".join(texts[k]).lower() for p in licences.PHRASES)
        assert math.isclose(r.score, 1.0 if phrase else share(k), abs_tol=1e-6) and r.labels == ",".join(sorted({s[0] for s in spans[k]} | set(filter(None, r.base_labels.split(",")))))


def test_chosen_terms_by_fold(spark):
    rng = np.random.default_rng(3)
    sample = []
    for k in range(400):
        toxic, poor, fold = int(rng.random() < 0.3), None if k % 17 == 0 else int(rng.random() < 0.2), k % toxicity.FOLDS
        terms = {f"c{x}" for x in rng.integers(0, 9, 4)} | {f"t{x}" for x in rng.integers(0, 5, 2) if toxic and rng.random() < 0.6} | {f"p{x}" for x in rng.integers(0, 4, 2) if poor and rng.random() < 0.7}
        sample.append((fold, poor, toxic, sorted(terms | ({"fold zero"} if fold == 0 and toxic else set()))))
    got = toxicity.chosen(spark.createDataFrame(sample, "fold int, poor int, toxic int, terms array<string>"))
    want = {}
    for left_out, (c, name) in itertools.product((toxicity.ALL, *range(toxicity.FOLDS)), enumerate(toxicity.CATEGORIES, 1)):
        own = [r for r in sample if r[0] != left_out]
        n = [sum(r[c] == y for r in own) for y in (0, 1)]
        count = [collections.Counter(t for r in own if r[c] == y for t in r[3]) for y in (0, 1)]
        scored = []
        for t in set(count[1]):
            a0, a1 = count[0][t], count[1][t]
            share = (a0 + a1) / sum(n)
            z = round((a1 / n[1] - a0 / n[0]) / math.sqrt(max(share * (1 - share) * (1 / n[0] + 1 / n[1]), 1e-18)), 9)
            if a1 >= toxicity.LEAST_DOCS and a1 / n[1] >= 4 * a0 / n[0] and z >= toxicity.LEAST_Z:
                scored.append((-z, t))
        if scored:
            want[left_out, name] = [t for _, t in sorted(scored)]
    assert got == want
    assert "fold zero" in got[toxicity.ALL, "toxic"] and "fold zero" not in got[0, "toxic"]


def test_language_sample_is_of_labelled_windows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.toPandas()
    windows = collections.Counter()
    for i, t, lang in zip(rows.doc_id, rows.text, rows.lang):
        if t and lang and zlib.crc32(str(i).encode()) % 5:
            windows.update((t[k : k + language_id.SPAN].encode(), lang) for k in range(0, len(t), language_id.SPAN) if re.search(r"[^\W\d_]", t[k : k + language_id.SPAN]))
    assert collections.Counter(language_id.training_rows(docs, 10**9)) == windows  # every window, once
    few = language_id.training_rows(docs, 300)
    assert not collections.Counter(few) - windows
    assert all(200 < n < 400 for n in collections.Counter(lang for _, lang in few).values()) and few == language_id.training_rows(docs.repartition(7), 300)
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "lang"))
    assert language_id.training_rows(hidden) == []


def test_all_links_and_their_counts(spark):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(12):
        base = list(rng.choice(words, 50))
        texts += [base] + [base[: int(k)] + ["x"] * int(j) + base[int(k) :] for k, j in zip(rng.integers(0, 50, 6), rng.integers(0, 3, 6))]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(900, " ".join(texts[0])), (901, None), (902, ""), (903, "a b"), (904, "a b")]
    sets = {i: jaccard_set(t) for i, t in rows}
    want = {i: sum(1 for j in sets if j != i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])) for i in sets}
    got = {r.doc_id: r.n_links for r in jaccard_join.link_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and max(want.values()) > 3
    assert jaccard_join.link_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def jaccard_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()


ODD = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, " \n\t ", "en", "s", 4), (None, "no id here", "en", None, 10), (None, "no id here", "en", None, 10), (9004, "one " * 3, "en", "s", 12)]


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(ODD, docs.schema)
    return corpus_pipeline.STAGES, docs.limit(60).unionByName(docs.limit(20)).unionByName(odd).cache(), docs.limit(0)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_and_empty_tables(spark, stages, k):
    every, mixed, empty = stages
    name, stage = every[k]
    got, none = stage(spark, mixed, SF), stage(spark, empty, SF)
    assert none.count() == 0
    ids = collections.Counter(r.doc_id for r in mixed.collect())
    if name == "packing":
        pieces = got.toPandas()
        assert set(pieces.doc_id.dropna()) == {i for i in ids if i is not None} and pieces.doc_id.isna().sum() >= 2
        return
    assert got.columns == mixed.columns == none.columns
    rows = got.collect()
    kept = collections.Counter(r.doc_id for r in rows)
    assert not kept - ids
    if name == "toxicity":
        assert all(kept[i] in (0, n) for i, n in ids.items())  # repeated rows are judged alike
        assert {9001, 9002, 9003, 9004} <= set(kept) and kept[None] == 2
    if name == "quality":
        assert not {9001, 9002, 9003, 9004} & set(kept) and all(kept[i] in (0, n) for i, n in ids.items())
    if name == "jaccard_join":
        assert {9001, 9002, 9003, 9004} <= set(kept) and kept[None] == 1 and max(n for i, n in kept.items()) == 1  # of repeated rows one stays
    if name == "pii":
        assert kept == ids and {r.doc_id: r.text for r in rows if r.doc_id in (9001, 9002, 9003, 9004)} == {9001: None, 9002: "", 9003: " \n\t ", 9004: "one one one "}
