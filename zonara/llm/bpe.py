"""Byte-level BPE by backtracking, exact and in linear time.

Bytes stand as Latin-1 characters in an Aho-Corasick automaton of the vocabulary,
which gives the longest tokens of a piece from the left. If all neighbours may stand
side by side, these are the answer. Otherwise the encoder falls back to their longest
prefixes where two neighbours would have merged, and backtracks from a dead place, which
it never tries twice. Whether two tokens may stand side by side is decided once for each
pair, by the merges over the two, and remembered, as is the prefix that may.

Under a pattern that never matches across the border before a space that follows
something else (CUTTABLE), texts are cut at such spaces and the parts are remembered;
under any other pattern a text is matched as a whole.

Defined cases: a null text is an empty one (no ids); an empty table gives no rows; repeated
rows give repeated results; a piece of any length takes memory in proportion to it; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from zonara.llm.common import Memo, cached_state, map_rows

CACHE, PAIRS = 500_000, 400_000
#: Patterns under which a match begins at every space that follows something else.
CUTTABLE = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}
SAFE = re.compile(r"(?<=\S) ")


def ranks_of(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


#: How many ids, the ids joined by commas, and the bytes that they decode to.
Coded = tuple[int, bytes, bytes]


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pieces = ranks, regex.compile(pattern).findall
        self.tokens = {i: b for b, i in ranks.items()}
        self.size = {i: len(b) for i, b in self.tokens.items()}
        self.text = {i: str(i).encode() for i in self.tokens}
        self.cuts = pattern in CUTTABLE
        self.pairs: dict[tuple[int, int], bool] = {}
        self.fits: dict[int, dict[int, int]] = {i: {} for i in self.tokens}
        self.n_fits = 0
        self.left, self.right = {i: i for i in self.tokens}, {i: i for i in self.tokens}
        reached = [(b, i) for b, i in ranks.items() if self.reach(b) == i]
        self.longest = ahocorasick.Automaton()
        for b, i in reached:
            self.longest.add_word(b.decode("latin-1"), i)
        self.longest.make_automaton()
        self.most = max(len(b) for b, _ in reached)
        known = {b: i for b, i in reached}
        self.shorter = {i: next((known[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in known), -1) for b, i in reached}
        self.of_piece = Memo(lambda pieces: [self.coded([p]) for p in pieces], CACHE)
        self.of_part, self.bad = Memo(self.parts, CACHE), set()

    def reach(self, data: bytes) -> int:
        """The token that the merges by rank make of its bytes, or -1; keeps the two parts that the last merge joins."""
        parts, ranks, get = [data[k : k + 1] for k in range(len(data))], self.ranks, self.ranks.get
        while len(parts) > 2:
            found = [(r, k) for k in range(len(parts) - 1) if (r := get(parts[k] + parts[k + 1])) is not None]
            if not found:
                return -1
            _, at = min(found)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        token = ranks[data]
        if len(parts) == 2:
            self.left[token], self.right[token] = ranks[parts[0]], ranks[parts[1]]
        return token

    def beside(self, a: int, b: int) -> bool:
        """Whether the merges leave the two tokens side by side: no two neighbours across their border, at any step that made
        them, merge before that step."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._beside(a, b)
        return known

    def _beside(self, a: int, b: int) -> bool:
        get, tokens, limit = self.ranks.get, self.tokens, 1 << 60
        while (m := get(tokens[a] + tokens[b])) is None or m >= limit:
            if a > b:  # undo the later of the two last merges
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True
        return False

    def fitted(self, before: int, token: int) -> int:
        """The longest prefix of `token` that is a token and may stand after `before`, or -1."""
        known = token
        while known >= 0 and not self.beside(before, known):
            known = self.shorter[known]
        if self.n_fits > PAIRS:
            for own in self.fits.values():
                own.clear()
            self.n_fits = 0
        self.fits[before][token] = known
        self.n_fits += 1
        return known

    def piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        n, text, most, size, shorter, fits = len(data), data.decode("latin-1"), self.most, self.size, self.shorter, self.fits
        longest, at = {}, 0
        for _, token in self.longest.iter_long(text):
            longest[at] = token
            at += size[token]
        out, at, alive, token = [], 0, None, longest[0]
        while True:
            if out and token >= 0:
                fit = fits[out[-1]].get(token)
                token = self.fitted(out[-1], token) if fit is None else fit
            if token < 0:  # nothing fits at this place
                alive = alive or bytearray(b"\1") * (n + 1)
                alive[at] = 0
                token = out.pop()
                at -= size[token]
                token = shorter[token]
            elif alive and not alive[at + size[token]]:
                token = shorter[token]
            else:
                out.append(token)
                at += size[token]
                if at == n:
                    return out
                if (token := longest.get(at)) is None:
                    token = longest[at] = next(self.longest.iter_long(text[at : at + most]))[1]  # each byte is a token, so the first starts here

    def coded(self, pieces: Iterable[str]) -> Coded:
        ids = [i for p in pieces for i in self.piece(p)]
        return len(ids), b",".join([self.text[i] for i in ids]), b"".join([self.tokens[i] for i in ids])

    def parts(self, parts: list[str]) -> Iterable[Coded]:
        """Of parts that stand after a space."""
        self.of_piece.start()
        number = self.of_piece.__getitem__
        cut = [list(map(number, self.pieces(" " + p))) for p in parts]
        made = self.of_piece.values()
        for own in cut:
            if len(own) == 1:
                yield made[own[0]]
            else:
                sizes, ids, data = zip(*[made[k] for k in own])
                yield sum(sizes), b",".join(ids), b"".join(data)

    def documents(self, texts: list[str]) -> Iterable[Coded]:
        if not self.cuts:
            yield from (self.coded(self.pieces(t)) for t in texts)
            return
        self.of_part.start()
        cut, number = [t.split(" ") for t in texts], self.of_part.__getitem__
        at = [list(map(number, parts)) for parts in cut]
        bad = {k for k, p in zip(range(len(self.of_part) - len(self.of_part.new), len(self.of_part)), self.of_part.new) if not p or p[-1].isspace()}
        self.bad = bad | self.bad if len(self.of_part.new) < len(self.of_part) else bad
        if self.bad:  # runs of white space: cut only where a space follows something else
            for k, own in enumerate(at):
                if not self.bad.isdisjoint(own):
                    cut[k] = SAFE.split(texts[k])
                    at[k] = list(map(number, cut[k]))
        made = self.of_part.values().__getitem__
        for parts, own in zip(cut, at):
            first = self.coded(self.pieces(parts[0]))
            sizes, ids, data = zip(first, *map(made, own[1:]))
            yield sum(sizes), b",".join(ids if first[0] else ids[1:]), b"".join(data)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; the vocabulary is read on the driver and sent (its size is fixed)."""
    with open(ranks_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        bpe = cached_state(("bpe", ranks_path), lambda: Bpe(ranks_of(sent.value), pattern))

        def each(ids, texts):
            for i, (n, coded, decoded) in zip(ids, bpe.documents([t or "" for t in texts])):
                yield i, n, hashlib.sha256(coded).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return each

    return map_rows(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", start)
