"""Personal data: patterns propose spans, checksums confirm them, words near by adjust a score.

Spans are code points, end exclusive. The base kinds (email, ip, card, phone) are
kept whenever their validator agrees; the added kinds (iban, ssn, national) need a
score of MIN_SCORE, which context words raise. Defined cases: a null text is an
empty one and has no spans; an empty table gives no rows; repeated rows give repeated
results; long runs of signs take time in proportion; columns beside doc_id and text are
ignored by `detect` and passed on by `redact`.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonara.llm.common import forget, lean, map_rows

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "national")
KINDS = (*BASE, *ADDED)
NEAR, MIN_SCORE = 48, 0.5
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start only: a match that begins within one could have begun there.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Z0-9])")
# Signs of a country's account number by the IBAN registry.
LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for c in cs.split()}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NATIONAL = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "national": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account"), "ssn": ("ssn", "social", "security"), "national": ("phone", "call", "tel", "mobile", "fax"),
}
WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """As the whole pattern finds them from the left, without its quadratic retries over long runs."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, end := m.end()))
        at = text.find("@", max(at + 1, end))
    return out


def ibans(text: str) -> list[tuple[int, int]]:
    """A candidate can run into the words after it: its country's length is tried first, then every word end from the last."""
    out, at = [], 0
    while m := IBAN.search(text, at):
        ends = [(k, m[0][: k - m.start()].replace(" ", "")) for k in range(m.end(), m.start(), -1) if k == m.end() or text[k] == " "]
        ends.sort(key=lambda e: len(e[1]) != LENGTH.get(m[0][:2]))
        end = next((k for k, s in ends if 15 <= len(s) <= 34 and mod97(s)), None)
        if end is not None:
            out.append((m.start(), end))
        at = end or m.start() + 1
    return out


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def found(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind that its validator confirms."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if not any(c in text for c in "0123456789"):
        return out
    out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out["card"] = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    out["iban"] = ibans(text)
    out["ssn"] = [m.span() for m in SSN.finditer(text) if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000"]
    out["national"] = [m.span() for m in NATIONAL.finditer(text)]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    near = set(WORD.findall(text[max(0, start - NEAR) : start].lower())) | set(WORD.findall(text[end : end + NEAR].lower()))
    return min(1.0, START[kind] + 0.25 * sum(w in near for w in CONTEXT[kind]))


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    if not text:
        return []
    scored = [(k, a, b, score(text, k, a, b)) for k, at in found(text).items() for a, b in at]
    return [s for s in scored if s[0] in BASE or s[3] >= MIN_SCORE]


def redacted(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; spans that overlap are joined under the first one's kind."""
    if not text or not (at := sorted((a, -b, k) for k, a, b, _ in spans(text))):
        return text
    out, end = [], 0
    for a, b, kind in at:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, -b)
    return "".join(out) + text[end:]


def _detect():
    def each(ids, texts):
        for i, t in zip(ids, texts):
            at = spans(t)
            yield i, [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in at]

    return each


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end, score>>."""
    return map_rows(docs, ["doc_id", "text"], "doc_id long, spans array<struct<kind string, start long, end long, score double>>", _detect)


def digest(detected: DataFrame) -> DataFrame:
    """Counts of the base kinds and the joined spans."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    count = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    top = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return detected.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), top.alias("max_score"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their texts redacted; all other columns stay."""

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        forget()
        return pa.array([redacted(t.as_py()) for t in texts], pa.string())

    return lean(docs).withColumn("text", made("text"))
