"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample: the
whole texts of all labelled rows fall into windows of SPAN characters, and a hash draws
about PER_LANG of each language's windows, wherever they lie. It labels every byte; a
document's language is the largest mean of the labels' probabilities over all its bytes.

Texts are cut into rows of ROW bytes, so a text of any length takes a bounded batch at a
time; each row is read with CONTEXT bytes of the text on both sides, which count for the
states of the network and not for the mean. Defined cases: `und` with score 0 if the text is
null or has no letter, or if no row is labelled; ties go to the language that comes first;
repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonara.llm.common import crc32_of_id, tidy

PER_LANG, SPAN = 4000, 48
HIDDEN, EPOCHS, BATCH, RATE, SEED = 8, 3, 128, 0.02, 11
ROW, CONTEXT, AT_ONCE = 448, 32, 2048
LETTER = regex.compile(r"\p{L}")
HELD_OUT = 5


def sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """For each direction: byte tables of the gates (z, r) and the candidate, and their recurrent weights; one output layer."""

    def __init__(self, n_labels: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p |= {f"{d}e": draw(256, 2 * hidden, s=0.3), f"{d}c": draw(256, hidden, s=0.5), f"{d}u": draw(hidden, 2 * hidden, s=0.3), f"{d}v": draw(hidden, hidden, s=0.3)}
        self.p |= {"o": draw(2 * hidden, n_labels, s=0.3), "ob": np.zeros(n_labels, np.float32)}

    def states(self, x: np.ndarray, mask: np.ndarray | None, d: str, keep: list | None = None) -> np.ndarray:
        """x: bytes [time, rows]; mask: [time, rows, 1], or None if all are there. The state after each byte."""
        p, n, hidden = self.p, x.shape[1], self.hidden
        e, c, u, v = (p[d + k] for k in "ecuv")
        h, out = np.zeros((n, hidden), np.float32), np.empty((len(x), n, hidden), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            zr = np.take(e, x[t], axis=0)
            zr += h @ u
            zr = sigmoid(zr)
            z, r = zr[:, :hidden], zr[:, hidden:]
            hv = h @ v
            g = np.take(c, x[t], axis=0)
            g += r * hv
            np.tanh(g, out=g)
            new = g - h
            new *= z
            new += h
            if mask is not None:
                new *= mask[t]
            if keep is not None:
                keep.append((t, h, z, r, hv, g))
            h = out[t] = new
        return out

    def labels(self, x: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Probabilities [time, rows, labels]."""
        h, o = self.hidden, self.p["o"]
        y = self.states(x, mask, "f") @ o[:h]
        y += self.states(x, mask, "b") @ o[h:]
        y += self.p["ob"]
        y -= y.max(axis=-1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=-1, keepdims=True)
        return y

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all bytes, by backpropagation through time."""
        p, hidden = self.p, self.hidden
        grads = {k: np.zeros_like(w) for k, w in p.items()}
        kept = {"f": [], "b": []}
        both = np.concatenate([self.states(x, mask, d, kept[d]) for d in "fb"], axis=2)
        y = both @ p["o"] + p["ob"]
        y = np.exp(y - y.max(axis=-1, keepdims=True))
        y /= y.sum(axis=-1, keepdims=True)
        y[:, np.arange(x.shape[1]), label] -= 1
        y *= mask / mask.sum()
        flat = y.reshape(-1, y.shape[-1])
        grads["o"] = both.reshape(len(flat), -1).T @ flat
        grads["ob"] = flat.sum(0)
        into = y @ p["o"].T
        for d, part in (("f", into[:, :, :hidden]), ("b", into[:, :, hidden:])):
            u, v = p[d + "u"], p[d + "v"]
            dh = np.zeros((x.shape[1], hidden), np.float32)
            for t, h, z, r, hv, g in reversed(kept[d]):
                dh = (dh + part[t]) * mask[t]
                dg = dh * z * (1 - g * g)
                dz = dh * (g - h) * z * (1 - z)
                dr = dg * hv * r * (1 - r)
                dhv = dg * r
                dzr = np.concatenate([dz, dr], axis=1)
                np.add.at(grads[d + "e"], x[t], dzr)
                np.add.at(grads[d + "c"], x[t], dg)
                grads[d + "u"] += h.T @ dzr
                grads[d + "v"] += h.T @ dhv
                dh = dh * (1 - z) + dzr @ u.T + dhv @ v.T
        return grads

    def train(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> None:
        """Adam over EPOCHS passes."""
        rng = np.random.default_rng(SEED)
        m, s, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(label))
            rate = RATE * (1 - epoch / EPOCHS) + 0.001
            for k in range(0, len(order), BATCH):
                own = order[k : k + BATCH]
                step += 1
                for name, g in self.gradients(x[:, own], mask[:, own], label[own]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.999 * s[name] + 0.001 * g * g
                    self.p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def rows_of(data: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of `width` bytes (padded with 0), the bytes in each, and the text that each is from."""
    sizes = [-(-len(b) // width) for b in data]
    out = np.frombuffer(b"".join(b.ljust(n * width, b"\0") for b, n in zip(data, sizes)), np.uint8).reshape(-1, width)
    own = np.repeat(np.arange(len(data)), sizes)
    first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) if data else np.empty(0, np.int64)
    total = np.array([len(b) for b in data], np.int64)
    return out, np.minimum(width, total[own] - (np.arange(len(out)) - first) * width), own


def training_rows(docs: DataFrame, per_lang: int = PER_LANG) -> list[tuple[bytes, str]]:
    """(window, language) of the sample: about per_lang windows of SPAN characters for each language."""
    learn = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc32_of_id() % HELD_OUT != 0))
    n = F.ceil(F.length("text") / SPAN)
    size = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.sum(n).alias("n")).collect() if r["n"]}
    if not size:
        return []
    least = F.create_map(*(F.lit(x) for lang, own in sorted(size.items()) for x in (lang, int((1 << 31) * min(1.0, per_lang / own)))))
    drawn = F.filter(F.sequence(F.lit(0), n.cast("int") - 1), lambda k: F.pmod(F.xxhash64("doc_id", k), F.lit(1 << 31)) < least[F.col("lang")])
    picked = learn.filter("length(text) > 0").select("doc_id", "lang", "text", drawn.alias("k")).filter("size(k) > 0")
    got = picked.select("doc_id", "lang", F.transform("k", lambda k: F.substring("text", k * SPAN + 1, F.lit(SPAN))).alias("w")).collect()
    rows = sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["lang"], r["w"]))
    return [(w.encode("utf-8", "surrogatepass"), r["lang"]) for r in rows for w in r["w"] if LETTER.search(w)]


def fitted(docs: DataFrame) -> tuple[list[str], Network | None]:
    rows = training_rows(docs)
    names = sorted({lang for _, lang in rows})
    if not names:
        return [], None
    x, sizes, own = rows_of([w for w, _ in rows], SPAN)
    mask = (np.arange(SPAN)[:, None] < sizes).astype(np.float32)[:, :, None]
    network = Network(len(names))
    network.train(np.ascontiguousarray(x.T), mask, np.array([names.index(lang) for _, lang in rows])[own])
    return names, network


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of CONTEXT + ROW + CONTEXT bytes with the text around them; for each row where its text begins and ends in it, and the
    text that it is from."""
    first, own = [], []
    for k, t in enumerate(texts):
        starts = range(0, len(t), ROW)
        first += starts
        own += [k] * len(starts)
    width = ROW + 2 * CONTEXT
    padded = [bytes(CONTEXT) + t + bytes(width) for t in texts]
    x = np.frombuffer(b"".join([padded[k][s : s + width] for k, s in zip(own, first)]), np.uint8).reshape(-1, width)
    first, own = np.array(first, np.int64), np.array(own, np.int64)
    left = np.array([len(t) for t in texts], np.int64)[own] - first
    return x, np.where(first == 0, CONTEXT, 0), np.minimum(width, left + CONTEXT), own


def pooled(network: Network, texts: list[bytes], n_labels: int) -> np.ndarray:
    """The mean probability of each label over each text's bytes; texts are not empty."""
    x, begin, end, own = windows_of(texts)
    total = np.zeros((len(texts), n_labels))
    whole, place = (begin == 0) & (end == x.shape[1]), np.arange(x.shape[1])[:, None]
    for rows, masked in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
        for k in range(0, len(rows), AT_ONCE):
            own_rows = rows[k : k + AT_ONCE]
            mask = ((place >= begin[own_rows]) & (place < end[own_rows])).astype(np.float32)[:, :, None] if masked else None
            y = network.labels(np.ascontiguousarray(x[own_rows].T), mask)
            if masked:
                y *= mask
            np.add.at(total, own[own_rows], y[CONTEXT : CONTEXT + ROW].sum(axis=0))
    return total / np.array([len(t) for t in texts])[:, None]


def identify(docs: DataFrame, trained_on: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learns from trained_on (docs itself if it is None): doc_id, text, lang."""
    names, network = fitted(docs if trained_on is None else trained_on)

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lettered = [k for k, t in enumerate(texts) if t and LETTER.search(t)] if network else []
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            if lettered:
                p = pooled(network, [texts[k].encode("utf-8", "surrogatepass") for k in lettered], len(names))
                for k, best, x in zip(lettered, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    lang[k], score[k] = names[best], min(1.0, max(0.0, x))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", (crc32_of_id() % HELD_OUT == 0).alias("held_out"), "text").mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double")
