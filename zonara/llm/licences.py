"""Licence scans by a generalised suffix automaton of licence tokens.

The automaton holds every template (notices and short phrases) as one token string
each. A document streams through it once and gives, at each word, the longest
suffix that is part of some template (its matching statistic). Occurrences of a
whole phrase and the maximal matches of the notices are read off that stream; the
matches are then chained, in order in both, into covered template spans.

Defined cases: a null text is an empty one; an empty table gives no rows; repeated rows give repeated
results; a text of any length is read once, and what is kept of it grows with its matches; of equal
chains the one that starts first counts; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from zonara.llm.common import cached_state, map_rows

# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Public licence notices, each under its own label.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "mit-line": "released under the mit license",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
}
#: Words of a match that is chained, words between two of a chain, and share of a template that a chain covers to count.
LEAST, GAP, COVER = 4, 12, 0.5

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEEP else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


class Automaton:
    """States are numbered from 0, the root; `end` is a place (template, last word) at which a state's strings occur."""

    def __init__(self, templates: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [(-1, -1)]
        for k, template in enumerate(templates):
            last = 0
            for at, word in enumerate(template):
                last = self._extend(last, word, (k, at))
        #: for each state, the places of each state below it in the tree of suffix links, its own included
        self.places: list[set] = [set() for _ in self.link]
        for k, template in enumerate(templates):
            state = 0
            for at, word in enumerate(template):
                state = s = self.next[state][word]
                while s > 0 and (k, at) not in self.places[s]:
                    self.places[s].add((k, at))
                    s = self.link[s]

    def _new(self, length: int, end: tuple[int, int], edges: dict, link: int) -> int:
        self.next.append(edges), self.length.append(length), self.end.append(end), self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        clone = self._new(self.length[p] + 1, self.end[q], dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: bytes, end: tuple[int, int]) -> int:
        if (q := self.next[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        cur, p = self._new(self.length[last] + 1, end, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return cur

    def read(self, text: list[bytes]):
        """(place, state, matched words) wherever a word of a template stands."""
        state = matched = 0
        step, link, length, root = self.next, self.link, self.length, self.next[0]
        for at, word in enumerate(text):
            if word not in root:
                state = matched = 0
                continue
            while (to := step[state].get(word)) is None:
                state = link[state]
                matched = length[state]
            state, matched = to, matched + 1
            yield at, state, matched


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES):
        self.labels = [*phrases.values(), *notices]
        self.templates = [words(t) for t in (*phrases, *notices.values())]
        self.n_phrases = len(phrases)
        self.machine = m = Automaton(self.templates)
        #: for each state, the phrases that end where it does, with their lengths
        whole = []
        for k, t in enumerate(self.templates[: self.n_phrases]):
            state = 0
            for word in t:
                state = m.next[state][word]
            whole.append(state)
        self.ends: list[list[tuple[int, int]]] = []
        for state in range(len(m.link)):
            up, s = set(), state
            while s > 0:
                up.add(s)
                s = m.link[s]
            self.ends.append([(k, len(self.templates[k])) for k, s in enumerate(whole) if s in up])

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Phrase occurrences (phrase, start), and maximal matches (start, end, template, start in it)."""
        base, long, before = [], [], (-1, 0, 0)
        ends = self.ends

        def close(at, state, matched):
            if matched >= LEAST:
                long.extend((at - matched + 1, at + 1, k, e - matched + 1) for k, e in sorted(self.machine.places[state]) if k >= self.n_phrases)

        for at, state, matched in self.machine.read(text):
            for k, n in ends[state]:
                if matched >= n:
                    base.append((k, at - n + 1))
            if before[2] >= LEAST and not (at == before[0] + 1 and matched == before[2] + 1):
                close(*before)
            before = (at, state, matched)
        close(*before)
        return base, long

    def chains(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, float]]:
        """(template, start, end, share covered): matches chained in order in the text and in the template, GAP words apart at most."""
        out = []
        by: dict[int, list] = {}
        for a, b, k, t in matches:
            by.setdefault(k, []).append((a, b, t))
        for k, own in by.items():
            size, open_ = len(self.templates[k]), []  # of chains: start, end, end in template, words
            for a, b, t in sorted(own):
                open_, gone = [c for c in open_ if a - c[1] <= GAP], [c for c in open_ if a - c[1] > GAP]
                out += [(k, c[0], c[1], c[3] / size) for c in gone]
                fit = [c for c in open_ if c[2] <= t + (c[1] - a if c[1] > a else 0) and c[1] < b]
                if fit:
                    c = max(fit, key=lambda c: (c[3], -c[0]))
                    over = max(0, c[1] - a, c[2] - t)
                    if b - a > over:
                        open_.append((c[0], b, t + b - a, c[3] + b - a - over))
                open_.append((a, b, t + b - a, b - a))
                # chains that end at the same places go on alike: the one with the most words stands for them
                alike: dict[tuple[int, int], tuple] = {}
                for c in open_:
                    if (c[3], -c[0]) > (alike[c[1:3]][3], -alike[c[1:3]][0]) if c[1:3] in alike else True:
                        alike[c[1:3]] = c
                out += [(k, c[0], c[1], c[3] / size) for c in set(open_) - set(alike.values())]
                open_ = list(alike.values())
            out += [(k, c[0], c[1], c[3] / size) for c in open_]
        best: dict[tuple, tuple] = {}
        for c in out:
            if c[3] >= COVER and c[3] > best.get((c[0], c[1]), (0, 0, 0, 0))[3]:
                best[c[0], c[1]] = c
        # a chain that lies within a better one of its template, as its rest, is no span of its own
        kept: list[tuple[int, int, int, float]] = []
        for c in sorted(best.values(), key=lambda c: (c[0], c[1], -c[2])):
            if not (kept and kept[-1][0] == c[0] and c[2] <= kept[-1][2] and c[3] <= kept[-1][3]):
                kept.append(c)
        return kept

    def report(self, text: str | None) -> tuple:
        w = words(text)
        base, long = self.scan(w)
        spans = self.chains(long)
        found = sorted({self.labels[k] for k, _ in base})
        more = sorted({*found, *(self.labels[k].removesuffix("-line") for k, *_ in spans)})
        starts = [s for _, s in base]
        # a stated phrase is sure; else the best share of a notice that is covered
        score = 1.0 if base else min(1.0, max((c[3] for c in spans), default=0.0))
        return len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(found), ",".join(more), score, [{"label": self.labels[k].removesuffix("-line"), "start": a, "end": b, "share": x} for k, a, b, x in spans]


def _start():
    scanner = cached_state("licences", Scanner)
    return lambda ids, texts: ((i, *scanner.report(t)) for i, t in zip(ids, texts))


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document, with the spans of the notices in words."""
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label string, start long, end long, share double>>"
    return map_rows(docs, ["doc_id", "text"], schema, _start)
