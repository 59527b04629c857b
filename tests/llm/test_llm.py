import base64
import collections
import hashlib
import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import tiktoken
from pyspark.sql import functions as F

from zonara.llm import bpe, jaccard_join, language_id, licences, packing, pii, quality, queries, search, token_counts, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n_words string, _id string, row string"  # extra columns, with names that results use
WS = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = [
    (1, "The cat sat on the mat and the cat sat on the mat and the cat sat on the mat", "en", "x", "y", "z"),
    (2, None, "en", None, None, None), (3, "", None, "x", "y", "z"), (4, " \n\t ", "en", "x", "y", "z"), (5, "MIT License apache license general public license " * 3, "en", "x", "y", "z"),
    (5, "MIT License apache license general public license " * 3, "en", "x", "y", "z"), (None, "mail a.b@c.de or +1 (168) 555-5254 or 4539 1488 0343 6467 at 10.0.0.255", None, "x", "y", "z"),
    (7, "word " * 30_000 + "end", "en", "x", "y", "z"), (8, "1234 " * 10, "de", "x", "y", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


def test_quality_measures_by_brute_force(spark, odd, none, small):
    got = quality.measured(spark.createDataFrame(pd.concat([small[["doc_id", "text"]], pd.DataFrame(ROWS)[[0, 1]].set_axis(["doc_id", "text"], axis=1).fillna({"doc_id": -1}).astype({"doc_id": int})])), ["doc_id", "text"]).collect()
    for r in got:
        t = r.text or ""
        w = WS.findall(t)
        c = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        inside = {k + d for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for d in range(5)}
        lines = [x for x in t.split("\n") if WS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)), r.doc_id
    assert quality.verdicts(odd).count() == len(ROWS) and quality.verdicts(none).count() == 0
    assert quality.keep(odd).columns == odd.columns


def test_em_finds_each_kind_of_junk():
    n = len(quality.rules())
    good = (1,) * n
    junk = [tuple(-1 if r == k else 1 for r in range(n)) for k in range(3)]
    model = quality.fit([(good, 1000), *((j, 30) for j in junk)], n)
    weights = quality.log_weights(model)
    assert quality.shares(good, weights)[0] > 0.9 and all(quality.shares(j, weights)[0] < 0.5 for j in junk)


def test_pii_by_whole_patterns(spark, odd, none, small):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def brute(t):
        for kind, p in patterns.items():
            for m in re.finditer(p, t or ""):
                d = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                    yield f"{kind}:{m.start()}:{m.end()}"

    rng = np.random.default_rng(3)
    texts = [*small.text, *(r[1] for r in ROWS), *("".join(rng.choice(list("a1.@_+-( )0é4"), 60)) for _ in range(3000))]
    for t in texts:
        assert [f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(t) if k in pii.BASE] == list(brute(t))
    assert pii.spans("1" * 200_000 + "a" * 200_000) == []
    out = pii.digest(pii.detect(odd)).toPandas()
    assert len(out) == len(ROWS) and out.base_sha256[1] == hashlib.sha256(b"").hexdigest()
    assert out[["n_email", "n_ip", "n_card", "n_phone"]].values.sum() == 4 and pii.detect(none).count() == 0
    assert pii.redacted(ROWS[6][1]) == "mail [EMAIL] or [PHONE] or [CARD] at [IP]"
    assert any(k == "iban" for k, *_ in pii.spans("my iban GB82 WEST 1234 5698 7654 32 ok")) and pii.redact(odd).columns == odd.columns


def test_iban_before_capital_letters():
    plain, spaced = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    for text, want in ((f"{plain} The rest", [plain]), (f"{spaced} BIC DEUTDEFF", [spaced]), (f"AB12 {plain} {spaced} OK", [plain, spaced]), (f"{plain[:-1]}1 The rest", [])):
        assert [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"] == want, text
    assert pii.redacted(f"to {plain} The rest") == "to [IBAN] The rest"


def test_licences_by_brute_force(odd, none, small):
    scanner = licences.Scanner()
    for t in [*small.text, *(r[1] for r in ROWS), "gnu general public license general public mit license mit license", licences.NOTICES["mit"].replace("software", "code", 1)]:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, v) for p, v in licences.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        n, n_base, first, last, base, labels, score, _ = scanner.report(t)
        assert (n, n_base, base) == (len(w), len(at), ",".join(sorted({v for _, v in at}))) and set(filter(None, base.split(","))) <= set(labels.split(","))
        assert (first, last) == ((min(at)[0], max(at)[0]) if at else (None, None)) and 0 <= score <= 1
    assert "mit" in scanner.report(licences.NOTICES["mit"].replace("merge", "join"))[5]
    assert licences.scan(odd).count() == len(ROWS) and licences.scan(none).count() == 0


def test_automaton_matching_statistics():
    rng = np.random.default_rng(5)
    templates = [[bytes([97 + x]) for x in rng.integers(0, 3, 30)] for _ in range(3)]
    parts = {tuple(t[a:b]) for t in templates for a in range(30) for b in range(a + 1, 31)}
    m = licences.Automaton(templates)
    text = [bytes([97 + x]) for x in rng.integers(0, 4, 400)]
    got = {at: n for at, _, n in m.read(text)}
    for at in range(len(text)):
        assert got.get(at, 0) == max((n for n in range(1, 31) if n <= at + 1 and tuple(text[at - n + 1 : at + 1]) in parts), default=0)


def test_token_lengths_of_odd_rows(spark, odd):
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    theirs = tiktoken.Encoding("t", pat_str=queries.pattern(), mergeable_ranks=bpe.ranks_of(open(path, "rb").read()), special_tokens={})
    got = collections.Counter((r.doc_id, r.n_tokens) for r in token_counts.lengths(odd, path, queries.pattern()).collect())
    assert got == collections.Counter((r[0], len(theirs.encode_ordinary(r[1] or ""))) for r in ROWS)


def test_token_limits(spark, none):
    counts = [3, 3, 0, 5000, 1024, 7]
    hist = token_counts.histogram(spark.createDataFrame([(k, n) for k, n in enumerate(counts)], "doc_id long, n_tokens long"))
    for r in token_counts.limits(hist).collect():
        assert (r.n_fit, r.truncated_total, r.total_tokens) == (sum(n <= r.context_limit for n in counts), sum(min(n, r.context_limit) for n in counts), sum(counts))
    for limit in (0, 2, 3, 4, 1023, 6000):
        r = token_counts.at(hist, limit).head()
        assert (r.n_fit, r.n_over, r.truncated_total, r.tokens_lost) == (sum(n <= limit for n in counts), sum(n > limit for n in counts), sum(min(n, limit) for n in counts), sum(max(0, n - limit) for n in counts))
    for q in (0.1, 0.5, 0.9, 1.0):
        assert token_counts.quantile(hist, q).head().length == np.quantile(counts, q, method="inverted_cdf")
    assert token_counts.at(hist.limit(0), 5).head().truncated_total == 0 and token_counts.quantile(hist.limit(0), 0.5).head().length is None
    assert token_counts.lengths(none, queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern()).count() == 0


def test_bpe_as_tiktoken(spark, odd, small):
    raw = open(queries.vocabulary("byte_bpe_multi_50k.tiktoken"), "rb").read()
    ranks = bpe.ranks_of(raw)
    own = bpe.Bpe(ranks, queries.pattern())
    theirs = tiktoken.Encoding("t", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(2)
    texts = [*small.text[:100], "a" * 3000, " x  y   z\n\n w", *("".join(rng.choice(list("ab c\n\t é你😀'1.²\x85\x1c "), 40)) for _ in range(1500))]
    for t in texts:
        ((n, ids, data),) = own.documents([t])
        assert ids.decode() == ",".join(map(str, theirs.encode_ordinary(t))) and data == t.encode() and n == len(theirs.encode_ordinary(t))
    assert [x[1] for x in own.documents(texts)] == [",".join(map(str, theirs.encode_ordinary(t))).encode() for t in texts]
    other = r"\w+|\W"  # a pattern that may not be cut at spaces
    whole, theirs = bpe.Bpe(ranks, other), tiktoken.Encoding("o", pat_str=other, mergeable_ranks=ranks, special_tokens={})
    assert [x[1].decode() for x in whole.documents(texts[:50])] == [",".join(map(str, theirs.encode_ordinary(t))) for t in texts[:50]]
    out = queries.bpe.encode_decode(odd, queries.vocabulary("byte_bpe_multi_50k.tiktoken"), queries.pattern()).toPandas()
    assert len(out) == len(ROWS) and out.n_tokens[1] == 0 and out.decoded_sha256[0] == hashlib.sha256(ROWS[0][1].encode()).hexdigest()
    assert base64.b64encode(own.tokens[0])


def test_bpe_of_long_pieces_is_linear():
    raw = open(queries.vocabulary("byte_bpe_multi_50k.tiktoken"), "rb").read()
    ranks = bpe.ranks_of(raw)
    own = bpe.Bpe(ranks, queries.pattern())
    theirs = tiktoken.Encoding("t", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(3)
    for letters in ("ab", "abcdefghijkl", "абвгдежз"):
        text = "".join(rng.choice(list(letters), 400_000))
        own.piece(text[:20_000])
        took = []
        for n in (100_000, 400_000):
            start = time.process_time()
            ids = own.piece(text[:n])
            took.append(time.process_time() - start)
        assert took[1] < 6 * took[0] + 0.2, (letters, took)
        assert own.piece(text[:20_000]) == theirs.encode_ordinary(text[:20_000]) and b"".join(own.tokens[i] for i in ids) == text.encode()


def test_packing_lays_every_id_once(spark, odd, none):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = packing.pack(odd, path).toPandas()
    e = packing.Encoder(open(path, encoding="utf-8").read())
    want = collections.Counter()
    for r in ROWS:
        ids = np.array(e.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [packing.END], "<u4")
        assert np.frombuffer(e.encode([r[1]])[0], "<u4").tolist() == ids.tolist()
        want[r[0], len(ids)] += len(ids)
    got = collections.Counter()
    for r in rows.itertuples():
        got[None if pd.isna(r.doc_id) else int(r.doc_id), r.doc_tokens] += r.length
    assert got == want
    s = rows.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all() and rows.groupby("sequence_id").length.sum().max() <= packing.WINDOW
    long = np.array(e.tokenizer.encode(ROWS[7][1], add_special_tokens=False).ids + [packing.END], "<u4")
    for r in rows[rows.doc_id == 7].itertuples():
        assert zlib.crc32(long[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert packing.pack(none, path).count() == 0


def test_packing_of_a_table(spark):
    path = queries.vocabulary("word_bpe_49k.json")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts, e = {r.doc_id: r.text for r in docs.collect()}, packing.Encoder(open(path, encoding="utf-8").read())
    rows = packing.pack(docs.repartition(7), path).toPandas().sort_values(["doc_id", "start"])
    for i, own in rows.groupby("doc_id"):
        ids = np.array(e.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [packing.END], "<u4")
        assert list(own.start) == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(own.start, own.length)] == list(own.ids_crc32)
    s = rows.sort_values(["sequence_id", "offset"])
    assert len(texts) == rows.doc_id.nunique() and (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    total = rows.groupby("sequence_id").length.sum()
    assert total.max() <= packing.WINDOW and rows.length.sum() / (packing.WINDOW * len(total)) > 0.995


@pytest.mark.parametrize("lengths", [np.random.default_rng(1).integers(1, 4096, 20_000), np.full(3000, 2100), np.full(9999, 3), np.full(500, 4096), np.random.default_rng(2).integers(2049, 4096, 3000), np.array([1])])
def test_packing_plan_lays_every_token_once(lengths):
    counts = np.bincount(lengths, minlength=packing.WINDOW + 1)
    laid, room = {a: np.zeros((n, a), bool) for a, n in enumerate(counts) if n}, collections.Counter()
    for a, lo, hi, start, length, sequence, offset, copies, unit in packing.placed(counts):
        assert not laid[a][lo:hi, start : start + length].any() and start % packing.UNIT == 0
        laid[a][lo:hi, start : start + length] = True
        for k in range(hi - lo):
            s, o = sequence + (unit + k) // copies, offset + (unit + k) % copies * length
            room[s] |= ((1 << length) - 1) << o
            assert o + length <= packing.WINDOW
    assert all(x.all() for x in laid.values()) and sum(x.bit_count() for x in room.values()) == lengths.sum()
    assert all(x & (x + 1) == 0 for x in room.values())  # no gaps
    assert lengths.sum() > 0.99 * packing.WINDOW * (len(room) - 1)


def test_checksums_of_parts():
    data = np.random.default_rng(0).integers(0, 2**32, 1000, dtype=np.uint32).tobytes()
    for start, n in ((0, 1000), (32, 64), (64, 936), (960, 40)):
        assert packing.sum_of(packing.block_sums(data), start, n) == zlib.crc32(data[4 * start : 4 * (start + n)])


def test_jaccard_components(spark, odd, none):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 500, 200)]
    texts = [" ".join(base)] * 3 + ["  ".join(base).upper()]
    for k in range(12):
        w = list(base)
        for p in rng.integers(0, 200, k):
            w[p] = f"n{k}_{p}"
        texts.append(" ".join(w))
    texts += ["a b", "A  b", "", None, "c"] + [" ".join(f"u{x}" for x in rng.integers(0, 9000, 60)) for _ in range(20)]
    docs = spark.createDataFrame([(k + 10, t) for k, t in enumerate(texts)], "doc_id long, text string")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for k, t in enumerate(texts):
        w = WS.findall((t or "").translate(low))
        sets[k + 10] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.clustered(docs).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in sets}
    assert sorted(r.doc_id for r in jaccard_join.keep_one(docs).collect()) == sorted({r for i, r in root.items()})
    assert jaccard_join.clustered(odd).count() == len(ROWS) and jaccard_join.clustered(none).count() == 0
    assert jaccard_join.keep_one(odd).columns == odd.columns


def test_blocks_lose_no_pair_that_fits(spark):
    rng = np.random.default_rng(7)
    rows = [(int(t), f"n{k}", int(rng.integers(0, max(1, n // 5))), int(n), [0] * 16, f"r{k % 50}") for k, (t, n) in enumerate(zip(rng.integers(0, 2, 400), rng.integers(1, 300, 400)))]
    sides = spark.createDataFrame(rows, "token long, node string, pos int, n int, bits array<long>, root string")
    fits = {
        tuple(sorted((a[1], b[1]))) for a in rows for b in rows
        if a[0] == b[0] and a[5] != b[5] and 100 * min(a[3], b[3]) >= 85 * max(a[3], b[3]) and min(a[3] - a[2], b[3] - b[2]) >= jaccard_join.need(a[3], b[3], 85)
    }
    got = [tuple(sorted((r.node, r.node_h))) for r in jaccard_join.block_pairs(sides, 85).collect()]
    assert fits and len(got) == len(set(got)) and set(got) == fits
    for r in sides.select("n", "pos", jaccard_join.reach(85).alias("to")).collect():
        assert all((jaccard_join.need(r.n, m, 85) <= r.n - r.pos) == (m <= r.to) for m in range(r.n, 2 * r.n + 5))


@pytest.mark.parametrize("rows", [0, 50_000])
def test_texts_are_fetched_alike(spark, monkeypatch, small, rows):
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", rows)
    docs = spark.createDataFrame(small[["doc_id", "text"]])
    got = {r.doc_id: r.component_id for r in jaccard_join.clustered(docs, 5, 80).collect()}
    sets = {i: set(jaccard_join.shingles(t, 5).tolist()) for i, t in zip(small.doc_id, small.text)}
    root = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in range(10):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert got == root


def test_language_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.95
    assert list(both.held_out) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]
    out = language_id.identify(odd, docs).toPandas()
    assert set(out.lang_pred[[1, 2, 3, 8]]) == {"und"} and out.score.between(0, 1).all()
    assert language_id.identify(none).count() == 0


def test_network_by_a_plain_forward_pass():
    net, text = language_id.Network(3, hidden=4, seed=5), bytes(np.random.default_rng(1).integers(32, 127, 700).tolist())
    sig = lambda x: 1 / (1 + np.exp(-x))

    def walk(data, d):
        h, out = np.zeros(4), []
        for b in data:
            z, r = np.split(sig(net.p[d + "e"][b] + h @ net.p[d + "u"]), 2)
            h = (1 - z) * h + z * np.tanh(net.p[d + "c"][b] + r * (h @ net.p[d + "v"]))
            out.append(h)
        return np.array(out)

    def mean(data):
        y = np.hstack([walk(data, "f"), walk(data[::-1], "b")[::-1]]) @ net.p["o"] + net.p["ob"]
        p = np.exp(y) / np.exp(y).sum(1, keepdims=True)
        return p

    row, c = language_id.ROW, language_id.CONTEXT
    want = np.vstack([mean(text[max(0, s - c) : s + row + c])[min(c, s) : min(c, s) + row] for s in range(0, len(text), row)])
    got = language_id.pooled(net, [text, text[:10]], 3)
    assert want.shape[0] == len(text) and np.allclose(got[0], want.mean(0), atol=1e-4) and np.allclose(got[1], mean(text[:10]).mean(0), atol=1e-4)


def test_gradients_by_differences():
    net = language_id.Network(3, hidden=4)
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    rng = np.random.default_rng(0)
    x, mask, label = rng.integers(0, 256, (5, 4)), np.ones((5, 4, 1)), np.array([0, 1, 2, 1])
    mask[3:, 2] = 0
    loss = lambda: -(np.log(net.labels(x, mask)[:, np.arange(4), label]) * mask[:, :, 0]).sum() / mask.sum()
    grads = net.gradients(x, mask, label)
    for name in net.p:
        at = (x[1, 0], 0) if name[1:] in ("e", "c") else tuple(0 for _ in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-2
        up = loss()
        net.p[name][at] = old - 1e-2
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-2 - grads[name][at]) < 2e-3, name


def test_toxicity_chain_by_plain_arithmetic():
    rng = np.random.default_rng(7)
    sets = [{w for w in "abcd" if rng.random() < 0.4} for _ in range(300)]
    poor, toxic = np.array([float("a" in s) for s in sets]), np.array([float("b" in s or "a" in s) for s in sets])
    poor[:20] = np.nan
    folds = np.arange(300) % toxicity.FOLDS
    terms = {(f, c): list("ab") for f in (toxicity.ALL, *range(toxicity.FOLDS)) for c in toxicity.CATEGORIES}
    chain = toxicity.Chain(terms, sets, {"poor": poor, "toxic": toxic}, folds)
    x = np.array([["a" in s, "b" in s] for s in sets], np.float32)
    known, out_of_fold = ~np.isnan(poor), np.zeros(300, np.float32)
    for f in range(toxicity.FOLDS):
        w = toxicity.logistic(x[known & (folds != f)], poor[known & (folds != f)].astype(np.float32))
        out_of_fold[folds == f] = 1 / (1 + np.exp(-(x[folds == f] @ w[:2] + w[2])))
    first, second = toxicity.logistic(x[known], poor[known].astype(np.float32)), toxicity.logistic(np.column_stack([x, out_of_fold]).astype(np.float32), toxic.astype(np.float32))
    p = 1 / (1 + np.exp(-(x @ first[:2] + first[2])))
    q = 1 / (1 + np.exp(-(np.column_stack([x, p]) @ second[:3] + second[3])))
    assert np.allclose(chain.predict(sets), np.column_stack([p, q]), atol=1e-4)
    assert ((q >= 0.5) == (toxic == 1)).all()


def test_toxicity_terms():
    assert toxicity.terms_of(None) == toxicity.terms_of("") == set()
    got = toxicity.terms_of("Alphabet alphabets ALPHA\nx x x x")
    assert {"alphabet", "alphabets", "alpha", "x", "^1 alph", "^2 alph", "^3 alph", "^1 alphab", "^2 alphab"} <= got and "^3 alphab" not in got
    assert {"#words 3", "#lines 8", "#symbols 0"} <= got and toxicity.terms_of(" \n\t ") == {"#words 1", "#distinct 0", "#top 0", "#lines 0", "#symbols 0", "#upper 0", "#letters 0"}


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    held = labels.filter(~half).withColumnRenamed("toxic", "y")
    got = toxicity.detect(docs.join(labels, "doc_id", "left_semi"), labels.filter(half)).join(held, "doc_id").toPandas()
    poor = got.quality == 0
    assert got[got.y == 1].toxic.mean() > 0.9 and got[got.y == 0].toxic.mean() < 0.01
    assert (got[poor].p_poor > 0.5).mean() > 0.9 and (got[~poor].p_poor > 0.5).mean() < 0.02


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.detect(docs, labels).join(labels.withColumnRenamed("toxic", "y"), "doc_id").toPandas()
    assert got[got.y == 0].toxic.mean() < 0.01 and got[got.y == 1].toxic.mean() > 0.7
    assert toxicity.keep(odd, labels).columns == odd.columns and toxicity.detect(none, labels).count() == 0
    assert not toxicity.detect(odd, labels.filter("toxic is null")).filter("toxic").count()


def test_search_against_brute_force(spark, odd, none, small):
    docs = spark.createDataFrame(small[["doc_id", "text"]])
    got = search.top_k(docs, docs.filter("doc_id % 20 = 0"), 5).toPandas()
    sets = {r.doc_id: collections.Counter(licences.words(r.text)) for r in small.itertuples()}
    size, df = {i: sum(c.values()) for i, c in sets.items()}, collections.Counter(w for c in sets.values() for w in c)
    mean, n = sum(size.values()) / len(sets), len(sets)
    for q, own in got.groupby("query_id"):
        score = {i: round(sum(np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in sets[q] if w in c), 6) for i, c in sets.items()}
        best = sorted(((-s, i) for i, s in score.items() if s > 0))[:5]
        assert np.allclose(own.sort_values("rank").score, [-s for s, _ in best], atol=2e-6)
    assert set(search.top_k(odd, odd, 3).toPandas().query_id.dropna()) == {1, 5, 7, 8} and search.top_k(none, none, 3).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.sql(queries.ORACLE_SQL[name]).df(), queries.QUERIES[name](spark, SF).toPandas()
    c = sorted(want.columns)
    assert sorted(got.columns) == c and len(want) == len(got) > 0
    got, want = (d[c].sort_values(c).reset_index(drop=True) for d in (got, want))
    assert all(got[k].equals(want[k].astype(got[k].dtype)) for k in c)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    assert not pii.detect(docs).filter("size(filter(spans, s -> s.kind in ('email', 'card', 'phone', 'ip'))) > 0").count()
    assert corpus_pipeline.pack(spark, docs, SF).select("doc_id").distinct().count() == n


def test_pipeline_drops_near_copies_of_80_percent(spark):
    import corpus_pipeline

    w = [f"w{k}" for k in range(100)]
    texts = [w, w + [f"a{k}" for k in range(20)], w + [f"b{k}" for k in range(30)]]
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    like = [len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
    assert 0.80 <= like[0] < 0.85 and like[1] < 0.80
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()) == [0, 2]
