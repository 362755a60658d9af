"""Quality rules as a learned decision list, in Spark expressions throughout.

Fixed base rules reject what is no prose at all. For the rest a decision list is learned from labelled
statistics by sequential covering: a rule grows by the threshold that gains most on one part of the
labelled rows, is pruned on the other part, and is kept if it still holds there; rows that it covers
are left out and the next rule begins. Every step is one aggregation whose result has a row per
statistic and threshold. The list is emitted as one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import BLANKS, blanks_to_spaces, settled, table

# The characters that count as symbols, and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Even quantiles of all labelled rows of each kind between which thresholds lie.
THRESHOLDS = 48
MOST_RULES = 8
MOST_CONDITIONS = 3
#: A rule must reject this share of bad rows among what it covers, on the rows it was not grown on.
LEAST_PRECISION = 0.9
#: A rule must cover this share of the remaining bad rows.
LEAST_COVER = 0.005
#: Of three labelled rows two grow rules and one prunes them.
FOLDS = 3
SMOOTH = 1.0

STATISTICS = {
    "n_words": F.col,
    "word_length": lambda _: F.try_divide("word_chars", "n_words"),
    "symbols_per_word": lambda _: F.try_divide("n_symbols", "n_words"),
    "dup_lines_per_100_words": lambda _: 100 * F.try_divide("n_dup_lines", "n_words"),
    "n_dup_lines": F.col,
    "repeated_share": lambda _: F.try_divide("n_repeat_words", "n_words"),
}


def statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) per document row.

    Null texts count as empty. Words end at ASCII white space. A word repeats if a window of three
    words that holds it occurs again in its text; windows are told apart by a 64-bit hash.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    plain = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"))
    words = plain.select(
        "doc_id",
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("lines"),
        F.filter(F.split(blanks_to_spaces(F.col("text")), " "), lambda x: x != "").alias("words"),
    )
    window = lambda x, i: F.xxhash64(x, F.get("words", i + 1), F.get("words", i + 2))
    windows = words.select(
        "doc_id", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))), window).alias("windows"),
    )
    # Most texts repeat no window, which costs one look at the distinct ones.
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    return windows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(some, _covered(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: windows are sorted with their places, and of equal
    neighbours the places are sorted again; each then adds the words up to the next one, three at most.
    """
    placed = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    held = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)  # noqa: E731  worked out once, then used by name

    def repeated(s: Column) -> Column:
        alike = lambda a, n: F.coalesce(a["x"] == F.get(s, n)["x"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda a, n: alike(a, n + 1) | alike(a, n - 1)), lambda a: a["i"]))

    def words(places: Column) -> Column:
        gaps = F.transform(places, lambda p, n: F.least(F.lit(3), F.coalesce(F.get(places, n + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    return held(held(placed, repeated), words)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = F.col(prefix + self.statistic) if prefix else STATISTICS[self.statistic](self.statistic)
        held = value > self.threshold if self.above else value <= self.threshold
        return F.coalesce(held, F.lit(False))

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, prefix: str = "s_") -> Column:
    held = F.lit(True)
    for c in rule:
        held = held & c.column(prefix)
    return held


def learn(
    labelled: DataFrame,
    bad: str = "bad",
    thresholds: int = THRESHOLDS,
    most_rules: int = MOST_RULES,
    most_conditions: int = MOST_CONDITIONS,
    least_precision: float = LEAST_PRECISION,
    least_cover: float = LEAST_COVER,
) -> list[Rule]:
    """Ordered rules that reject; ``labelled`` has doc_id, the statistics' inputs and a boolean ``bad``.

    All labelled rows count. Without labels, or without bad rows, the list is empty.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    rows = settled(
        labelled.select(
            F.col(bad).cast("boolean").alias("bad"), fold.alias("prune"), *[s(n).cast("double").alias(f"s_{n}") for n, s in STATISTICS.items()]
        ).filter("bad is not null")
    )
    steps = [i / thresholds for i in range(thresholds + 1)]
    spread = rows.groupBy("bad").agg(*[F.percentile_approx(f"s_{n}", steps, 10_000).alias(n) for n in STATISTICS]).collect()
    # Half-way between neighbouring quantiles of either kind, so that a threshold keeps off both.
    seen = {n: sorted({x for row in spread for x in row[n] or []}) for n in STATISTICS}
    cuts = {n: [(a + b) / 2 for a, b in zip(x, x[1:])] for n, x in seen.items() if len(x) > 1}
    rules: list[Rule] = []
    while cuts and len(rules) < most_rules:
        left = rows
        for done in rules:
            left = left.filter(~_all(done))
        rule = _grow(left.filter(~F.col("prune")), cuts, most_conditions)
        rule = _prune(left.filter("prune"), rule, least_precision, least_cover) if rule else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most_conditions: int) -> Rule:
    """Add the threshold with the highest gain in information until no bad row is lost or none helps."""
    rule: list[Condition] = []
    while len(rule) < most_conditions:
        counts = _counts(rows.filter(_all(tuple(rule))), cuts)
        bad, good = counts.pop("all")
        if not bad or not good:
            break
        now = math.log2((bad + SMOOTH) / (bad + good + 2 * SMOOTH))
        gains = [
            (b * (math.log2((b + SMOOTH) / (b + g + 2 * SMOOTH)) - now), c.statistic, c.above, c.threshold)
            for c, (b, g) in counts.items()
            if b
        ]
        best = max(gains, default=(0.0, "", True, 0.0))
        if best[0] <= 1e-9:
            break
        rule.append(Condition(*best[1:]))
    return tuple(rule)


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict:
    """Bad and good rows that each condition covers, and under "all" those of ``rows``."""
    cell = lambda n: F.struct(
        F.lit(n).alias("statistic"),
        # Thresholds below the value; few enough for a look at each.
        F.when(F.col(f"s_{n}").isNotNull(), F.aggregate(F.array(*map(F.lit, cuts[n])), F.lit(0), lambda a, t: a + (t < F.col(f"s_{n}")).cast("int"))).alias("cell"),
    )
    counted = rows.select("bad", F.explode(F.array(*[cell(n) for n in cuts])).alias("c")).groupBy("c.statistic", "c.cell")
    found = counted.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
    out: dict = {}
    for n, values in cuts.items():
        cells = {r["cell"]: (r["bad"], r["good"]) for r in found if r["statistic"] == n}
        total = [sum(x[i] for x in cells.values()) for i in (0, 1)]
        known = [sum(x[i] for k, x in cells.items() if k is not None) for i in (0, 1)]
        under = [0, 0]
        for k, t in enumerate(values):
            under = [under[i] + cells.get(k, (0, 0))[i] for i in (0, 1)]
            out[Condition(n, False, t)] = tuple(under)
            out[Condition(n, True, t)] = (known[0] - under[0], known[1] - under[1])
        out["all"] = tuple(total)
    return out if "all" in out else {"all": (0, 0)}


def _prune(rows: DataFrame, rule: Rule, least_precision: float, least_cover: float) -> Rule:
    """The shortest beginning of ``rule`` that is best on rows it was not grown on; empty if none holds."""
    sums = [
        F.struct(F.count_if(_all(rule[:k]) & F.col("bad")), F.count_if(_all(rule[:k]) & ~F.col("bad"))).alias(str(k))
        for k in range(1, len(rule) + 1)
    ]
    row = rows.agg(F.count_if("bad").alias("bad"), *sums).first()
    best: tuple[float, int] = (0.0, 0)
    for k in range(1, len(rule) + 1):
        bad, good = row[str(k)]
        precision = bad / (bad + good) if bad + good else 0.0
        worth = (bad - good) / (bad + good) if bad + good else -1.0
        if precision >= least_precision and bad >= max(1, least_cover * row["bad"]) and worth > best[0] + 1e-9:
            best = (worth, k)
    return rule[: best[1]]


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects, null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        held = F.lit(True)
        for c in rule:
            held = held & c.column()
        out = F.when(held, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, list[Rule]]:
    """Statistics, base_failed, rejected_by and kept per document row, and the rules learned.

    ``labels`` has doc_id and quality, 0 for bad; labels of documents that fail the base rules teach
    nothing. Documents without a label are judged like all others.
    """
    stats = settled(statistics(docs, text, doc_id))
    known = labels.filter("quality is not null").select("doc_id", (F.col("quality") == 0).alias("bad"))
    rules = learn(stats.filter(~base_failed()).join(known, "doc_id"))
    judged = stats.withColumns({"base_failed": base_failed(), "rejected_by": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()), rules


def query(spark, sf_dir: str) -> DataFrame:
    judged, _ = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged
