"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns (3 ** rules at most, whatever the corpus) estimates how
often each rule is right in either class; the posterior replaces "all must pass".

Defined cases: a null text has no words and fails the base rule; an empty table
gives an empty result; repeated rows are judged alike; a posterior of exactly 0.5 is kept; a text of any length is measured
whole, within its row; other columns are ignored by `verdicts` and passed on by `keep`. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonara.llm.common import checkpointed

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
#: EM starts with this share of junk; a rule votes good for so many of the good, of its own junk and of other junk.
JUNK, GOOD, CAUGHT, OTHER, STRENGTH, STEPS = 0.15, 0.995, 0.1, 0.8, 4.0, 60
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def bound(value: Column, then) -> Column:
    """Evaluate an array once and hand it to `then` as a lambda's variable."""
    return F.transform(F.array(value), then)[0]


def repeated(words: Column) -> Column:
    """Words within a WINDOW-word window that is found twice or more."""

    def covered(hashes):
        def marked(order):
            same = lambda k, d: order[k]["h"] == F.get(order, k + d)["h"]
            at = F.transform(order, lambda s, k: F.when(F.coalesce((k > 0) & same(k, -1), F.lit(False)) | F.coalesce(same(k, 1), F.lit(False)), s["i"]))
            return bound(F.sort_array(F.array_compact(at)), lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), marked)
        )

    def hashed(w):
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + d) for d in range(1, WINDOW)))), F.lit(1), F.size(w) - (WINDOW - 1))

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(bound(words, lambda w: bound(hashed(w), covered)))


def measured(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` and MEASURES. The word list stands in a projection of its own, so that it is made once a row."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    split = docs.select(*columns, t.alias("_t"), F.array_remove(F.split(t, SPACE), "").alias("_w"), F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    long = lambda c, name: c.cast("long").alias(name)
    return split.select(
        *columns,
        long(F.size("_w"), "n_words"), long(F.length(F.array_join("_w", "")), "word_chars"), long(without(F.col("_t"), "[#*$%&|<>]+"), "n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l")), "n_dup_lines"), repeated(F.col("_w")).alias("n_repeat_words"),
        long(F.size("_l"), "n_lines"), long(without(F.col("_t"), r"\p{Lu}+"), "n_upper"), long(without(F.col("_t"), r"\p{L}+"), "n_letters"),
    )


def vote(bad: str, good: str) -> Column:
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Thresholds in whole numbers, so that no rounding decides."""
    return {
        "length": vote("n_words < 10", "n_words >= 20"),
        "repetition": vote("100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
        "symbols": vote("100 * n_symbols > 10 * n_words", "100 * n_symbols <= 2 * n_words"),
        "dup_lines": vote("100 * n_dup_lines > 30 * n_lines", "n_dup_lines = 0"),
        "word_length": vote("word_chars < 2 * n_words or word_chars > 14 * n_words", "word_chars >= 3 * n_words and word_chars <= 10 * n_words"),
        "shouting": vote("100 * n_upper > 40 * n_letters", "100 * n_upper <= 15 * n_letters"),
        "letters": vote("100 * n_letters < 50 * word_chars", "100 * n_letters >= 75 * word_chars"),
    }


Model = list[tuple[float, list[float]]]


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> Model:
    """For each class its share and, for each rule, P(votes good | class, votes), by EM over pattern counts. Class 0 is good;
    class r + 1 is the junk that rule r is there to catch, since junk is mostly of one kind and passes the other rules."""
    start = [1 - JUNK, *[JUNK / n_rules] * n_rules]
    rates = [[GOOD] * n_rules] + [[CAUGHT if r == c else OTHER for r in range(n_rules)] for c in range(n_rules)]
    model = list(zip(start, rates))
    for _ in range(STEPS):
        up = [[STRENGTH * x for x in own] for own in rates]
        down = [[STRENGTH * (1 - x) for x in own] for own in rates]
        mass, weights = [STRENGTH * x for x in start], log_weights(model)
        for votes, n in patterns:
            for c, p in enumerate(shares(votes, weights)):
                mass[c] += p * n
                for r, v in enumerate(votes):
                    if v > 0:
                        up[c][r] += p * n
                    elif v < 0:
                        down[c][r] += p * n
        model = [(mass[c] / sum(mass), [limited(c, r, u / (u + d)) for r, (u, d) in enumerate(zip(up[c], down[c]))]) for c in range(n_rules + 1)]
    return model


def limited(c: int, r: int, rate: float) -> float:
    """A rule is right about 99 of 100 good documents at least, and about half of the junk that it is there for."""
    return min(0.9999, max(0.99, rate)) if c == 0 else min(0.5, max(0.01, rate)) if r == c - 1 else min(0.99, max(0.01, rate))


def log_weights(model: Model) -> list[tuple[float, list[tuple[float, float]]]]:
    return [(math.log(share), [(math.log(x), math.log(1 - x)) for x in own]) for share, own in model]


def shares(votes, weights: list[tuple[float, list[tuple[float, float]]]]) -> list[float]:
    """The posterior of each class, by the model's log_weights."""
    logs = [s + sum(w[0 if v > 0 else 1] for v, w in zip(votes, each) if v) for s, each in weights]
    top = max(logs)
    odds = [math.exp(x - top) for x in logs]
    return [x / sum(odds) for x in odds]


def judged(measures: DataFrame) -> DataFrame:
    """Adds base_failed, p_good and kept. The measures are read twice: checkpoint them before, or accept a second pass."""
    n = len(rules())
    voted = measures.withColumns({f"_v{i}": c for i, c in enumerate(rules().values())})
    counted = voted.groupBy(*(f"_v{i}" for i in range(n))).count().collect()  # 3 ** n rows at most
    model = log_weights(fit(sorted((tuple(r[:-1]), r[-1]) for r in counted), n))

    def odds(c: int) -> Column:
        """Of junk class c against good."""
        total = F.lit(model[c][0] - model[0][0])
        for i in range(n):
            (up, down), (up0, down0) = model[c][1][i], model[0][1][i]
            total = total + F.when(F.col(f"_v{i}") == 1, F.lit(up - up0)).when(F.col(f"_v{i}") == -1, F.lit(down - down0)).otherwise(F.lit(0.0))
        return F.exp(total)

    junk = sum((odds(c) for c in range(2, n + 1)), odds(1))
    failed = F.expr(BASE_FAILED)
    scored = voted.withColumns({"base_failed": failed, "p_good": F.lit(1.0) / (F.lit(1.0) + junk)}).drop(*(f"_v{i}" for i in range(n)))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def verdicts(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, the measures, base_failed, p_good, kept."""
    return judged(checkpointed(measured(docs, ["doc_id"])))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; rows go with their measures, so nothing is shuffled."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return judged(checkpointed(measured(rows, ["row"]))).filter("kept").select("row.*")
