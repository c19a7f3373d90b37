"""Quality rules: text statistics and a learned decision list, all in DataFrame functions.

``text_statistics`` derives the figures of each whole text inside one projection.
``learn_decision_list`` fits ordered rules to labelled figures by sequential
covering: it grows a conjunction of thresholds that gains most in telling bad rows
from good, prunes it on rows held out from growing, removes what it covers, and
starts on the next. Spark counts; the driver sees histograms of a fixed size.
``DecisionList.column`` is the result as one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import Workspace
from .frames import double_array, with_own, with_settled

#: White space between words and the characters that count as symbols.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: A labelled sample has about this many rows at most; see ``labelled_sample``.
MAX_LABELLED = 20_000
_BUCKETS = 1 << 20

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of ``STATISTICS`` (all long) for each whole text.

    ``n_words`` counts runs of other characters than white space, ``word_chars`` their
    code points, ``n_symbols`` the characters of ``SYMBOLS``, ``n_lines`` the ``\\n``-split
    lines that have a word, ``n_dup_lines`` those equal to an earlier one, and
    ``n_repeat_words`` the words that lie in a window of three words found twice or
    more in the text, the first included. A null or empty text has zeros. Columns of
    the same names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(whole, f"[{WHITE}]+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    base = with_own(df, {"_q_words": words, "_q_lines": lines})
    hashes = F.transform(
        F.slice("_q_words", 1, F.greatest(F.size("_q_words") - (WINDOW - 1), F.lit(0))),
        lambda word, i: F.xxhash64(word, *(F.get("_q_words", i + k) for k in range(1, WINDOW))),
    )
    base = base.withColumn("_q_hashes", hashes)
    # Only texts with a repeated window pay for the sort.
    repeated = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    windows = F.sort_array(F.transform("_q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("_q_windows", F.when(repeated, windows))

    def is_twin(window: Column, k: Column) -> Column:
        def same(at: Column) -> Column:
            return F.coalesce(F.get("_q_windows", at)["h"] == window["h"], F.lit(False))

        return same(k - 1) | same(k + 1)

    starts = F.sort_array(F.transform(F.filter("_q_windows", is_twin), lambda window: window["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda state, at: F.struct(
            (state["total"] + at + WINDOW - F.greatest(state["end"], at)).alias("total"),
            (at + WINDOW).alias("end"),
        ),
        lambda state: state["total"],
    )
    figures = {
        "n_words": F.size("_q_words"),
        "word_chars": F.char_length(F.translate(whole, WHITE, "")),
        "n_symbols": F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, "")),
        "n_dup_lines": F.size("_q_lines") - F.size(F.array_distinct("_q_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("_q_lines"),
    }
    return with_settled(base, {name: column.cast("bigint") for name, column in figures.items()}).drop(
        "_q_words", "_q_lines", "_q_hashes", "_q_windows"
    )


def base_failed() -> Column:
    """The fixed rules: under 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _per(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def features() -> dict[str, Column]:
    """What the learned rules may test: sizes and shares, never null."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _per("word_chars", "n_words"),
        "symbols_per_word": _per("n_symbols", "n_words"),
        "dup_line_share": _per("n_dup_lines", "n_lines"),
        "repeat_word_share": _per("n_repeat_words", "n_words"),
        "words_per_line": _per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, value: Column | None = None) -> Column:
        value = features()[self.feature] if value is None else value
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row is bad by the first rule whose conditions all hold."""

    rules: tuple[tuple[Condition, ...], ...]

    def column(self) -> Column:
        """The number of the first rule that fires, from 1, or 0 for none."""
        chain = None
        for number, rule in enumerate(self.rules, 1):
            fires = reduce(Column.__and__, (c.column() for c in rule))
            chain = F.when(fires, number) if chain is None else chain.when(fires, number)
        return (F.lit(0) if chain is None else chain.otherwise(0)).cast("int")


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, bad) of about ``limit`` labelled documents at most, drawn by a hash of the id.

    Labels other than 0 and 1 and null ids are left out; a document with several labels
    counts as bad if one says so.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    share = min(1.0, limit / max(1, labels.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(_BUCKETS)) < int(share * _BUCKETS)
    return one.filter(drawn)


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def _counts(histogram: dict, feature: int, above: bool, cut: int, bins: int) -> dict[tuple[bool, bool], int]:
    """Rows by (bad, held out) that satisfy a literal."""
    chosen = range(cut + 1, bins) if above else range(cut + 1)
    return {
        (bad, held): sum(histogram.get((feature, b, bad, held), 0) for b in chosen)
        for bad in (True, False)
        for held in (True, False)
    }


def _midpoints(values: list[float]) -> list[float]:
    """Thresholds half way between neighbours, so that a rule keeps its distance to both sides."""
    return [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]


def learn_decision_list(
    labelled: DataFrame,
    cuts: int = 32,
    max_rules: int = 8,
    max_conditions: int = 4,
    min_precision: float = 0.95,
    min_covered: int = 4,
) -> DecisionList:
    """Fit the list to rows that have the ``STATISTICS`` and a boolean ``bad``.

    Each condition is chosen from thresholds of its own: they lie half way between the
    ``cuts`` quantiles and the least and largest values of the bad and of the good rows
    that the list so far leaves and the rule so far covers, so a rare kind of row has some
    too. A third of the rows, by a hash of their figures and id, only prune and judge: a
    rule stays if at least ``min_precision`` of the rows it covers are bad, in both parts,
    and it covers ``min_covered`` bad rows. With one class, or none, the list is empty.
    """
    names = list(features())
    with Workspace(labelled.sparkSession, "decision-list") as space:
        held_out = F.pmod(F.xxhash64(*STATISTICS, "doc_id"), F.lit(3)) == 0
        values = labelled.select("bad", held_out.alias("held"), *(c.alias(n) for n, c in features().items()))
        table = space.stage(values, "figures").frame
        steps = [k / (cuts + 1) for k in range(1, cuts + 1)]

        def rule_holds(rule: list[Condition]) -> Column:
            return reduce(Column.__and__, (c.column(F.col(c.feature)) for c in rule))

        def thresholds(rows: DataFrame) -> list[list[float]]:
            spread = (F.array(F.min(n), F.max(n)) for n in names)
            quantiles = (F.percentile_approx(n, steps, 10_000) for n in names)
            both = [F.concat(q, s).alias(n) for n, q, s in zip(names, quantiles, spread, strict=True)]
            classes = rows.groupBy("bad").agg(*both).collect()
            return [_midpoints(sorted({v for c in classes for v in c[n]})) for n in names]

        def histogram(rows: DataFrame, edges: list[list[float]]) -> dict:
            def code(name: str, cuts_of: list[float]) -> Column:
                return F.size(F.filter(double_array(cuts_of), lambda cut: cut < F.col(name)))

            codes = rows.select("bad", "held", F.posexplode(F.array(*map(code, names, edges))).alias("f", "b"))
            counted = codes.groupBy("f", "b", "bad", "held").count()
            return {(r["f"], r["b"], r["bad"], r["held"]): r["count"] for r in counted.collect()}

        def precision(bad: int, good: int) -> float:
            return bad / (bad + good) if bad + good else 0.0

        rules: list[list[Condition]] = []
        while len(rules) < max_rules:
            grown: list[tuple[Condition, dict]] = []
            rows = table
            for rule in rules:
                rows = rows.filter(~rule_holds(rule))
            while len(grown) < max_conditions:
                edges = thresholds(rows)
                seen = histogram(rows, edges)
                all_rows = _counts(seen, 0, False, len(edges[0]), len(edges[0]) + 1)
                bad0, good0 = all_rows[True, False], all_rows[False, False]
                if not bad0 or not good0:
                    break
                best = max(
                    (
                        (_gain(c[True, False], c[False, False], bad0, good0), -f, -cut, above, c)
                        for f, e in enumerate(edges)
                        for cut in range(len(e))
                        for above in (True, False)
                        for c in [_counts(seen, f, above, cut, len(e) + 1)]
                    ),
                    key=lambda item: item[:4],
                    default=(0.0,),
                )
                if best[0] <= 1e-9:
                    break
                condition = Condition(names[-best[1]], best[3], edges[-best[1]][-best[2]])
                grown.append((condition, best[4]))
                rows = rows.filter(rule_holds([condition]))
            if not grown:
                break
            held = [precision(c[True, True], c[False, True]) for _, c in grown]
            keep = held.index(max(held)) + 1
            counts = grown[keep - 1][1]
            fits = min(held[keep - 1], precision(counts[True, False], counts[False, False])) >= min_precision
            if not fits or counts[True, False] + counts[True, True] < min_covered:
                break
            rules.append([condition for condition, _ in grown[:keep]])
        return DecisionList(tuple(map(tuple, rules)))


def learn_from(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DecisionList:
    """Learn from the labelled documents that the fixed rules let through.

    The sample is broadcast: ``limit`` bounds it to about that many ids.
    """
    sample = F.broadcast(labelled_sample(labels, limit))
    known = docs.select("doc_id", "text").join(sample, "doc_id")
    return learn_decision_list(text_statistics(known).filter(~base_failed()))


def judge_quality(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``docs`` with the ``STATISTICS``, ``base_failed``, ``rule`` (number, 0 for none) and ``kept``.

    Null and empty texts fail the fixed rules. Columns of the same names are replaced.
    """
    judged = with_own(text_statistics(docs, text), {"base_failed": base_failed()})
    judged = with_own(judged, {"rule": F.when(F.col("base_failed"), F.lit(0)).otherwise(rules.column())})
    return with_own(judged, {"kept": ~F.col("base_failed") & (F.col("rule") == 0)})
