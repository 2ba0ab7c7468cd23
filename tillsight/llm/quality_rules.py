"""Quality rules: a learned decision list over text statistics (DataFrame functions only).

1. :func:`text_statistics` computes the statistics of every whole text inside its
   own row (arrays and higher-order functions, no shuffle, no Python).
2. :func:`learn_rules` learns from labelled statistics by sequential covering.  A
   rule is a conjunction of threshold tests; it is grown test by test on two thirds
   of the rows still uncovered (FOIL gain over candidate thresholds), cut back to
   the prefix with the best value on the other third, and accepted while its
   precision there is at least ``min_precision`` and, with Laplace's correction, so is
   that over all rows it covers.  Rows that the base rule rejects anyway teach nothing
   and are left out.  One aggregate per test returns a histogram (statistics x thresholds x classes) to the driver, nothing else.
   Fitting takes at most about ``max_rows`` labelled rows (chosen by a hash of the
   id); applying covers all rows.
3. :func:`keep_expression` emits the ordered list as one Spark conditional expression.

Defined cases: null or blank text has no words and fails the base rule; without
labels of both classes the list is empty and the base rule alone decides; labels
that are null or have no document are ignored; repeated ids are separate rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import BLANKS, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def text_statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per input row: the base statistics and a few character counts."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    rows = df.select(F.col(id_col).alias("doc_id"),
                     F.coalesce(F.col(text), F.lit("")).alias("__t"))
    rows = rows.select(
        "doc_id", words(F.col("__t")).alias("__w"), F.split("__t", "\n").alias("__lines"),
        F.length(F.translate("__t", BLANKS, "")).cast("long").alias("word_chars"),
        _without(F.col("__t"), SYMBOLS).cast("long").alias("n_symbols"),
        _without(F.col("__t"), upper).cast("long").alias("n_upper"),
        _without(F.col("__t"), "0123456789").cast("long").alias("n_digits"))
    rows = rows.withColumn("__lines", F.filter(
        "__lines", lambda x: F.length(F.translate(x, BLANKS, "")) > 0))
    starts = F.sequence(F.lit(1), F.size("__w") - (WINDOW - 1))
    has_window = F.size("__w") >= WINDOW
    rows = rows.withColumn("__h", F.when(has_window, F.transform(
        starts, lambda i: F.xxhash64(F.slice("__w", i, WINDOW)))))
    # only texts in which some window hash recurs compare the windows themselves
    recurs = has_window & (F.size(F.array_distinct("__h")) < F.size("__h"))
    rows = rows.withColumn("__sorted", F.when(recurs, F.sort_array(F.transform(
        starts, lambda i: F.struct(
            F.array_join(F.slice("__w", i, WINDOW), " ").alias("g"), i.alias("i"))))))
    twice = F.filter("__sorted", lambda x, k: (
        (k > 0) & (F.get("__sorted", k - 1)["g"] == x["g"]))
        | F.coalesce(F.get("__sorted", k + 1)["g"] == x["g"], F.lit(False)))
    rows = rows.withColumn("__at", F.when(
        F.col("__sorted").isNotNull(), F.sort_array(F.transform(twice, lambda x: x["i"]))))
    covered = F.aggregate(
        "__at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(
            i.alias("last"),
            (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return rows.select(
        "doc_id", F.size("__w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")
        .alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"), "n_upper", "n_digits")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_features() -> dict[str, Column]:
    """What rules may test: lengths and shares (0 where there is no word or line)."""
    per_word = lambda c: F.coalesce(F.col(c) / F.nullif("n_words", F.lit(0)), F.lit(0.0))
    per_char = lambda c: F.coalesce(F.col(c) / F.nullif("word_chars", F.lit(0)), F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "repeat_share": per_word("n_repeat_words"),
        "dup_line_share": F.coalesce(
            F.col("n_dup_lines") / F.nullif("n_lines", F.lit(0)), F.lit(0.0)),
        "upper_share": per_char("n_upper"),
        "digit_share": per_char("n_digits"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Test, ...]


def _best_test(hist: dict, thresholds: dict, used: set) -> tuple[float, tuple | None]:
    """The test with the largest FOIL gain from a histogram
    ``{(feature, code): [bad, good]}``; code = number of thresholds below the value."""
    best: tuple[float, tuple | None] = (0.0, None)
    for f, cuts in thresholds.items():
        cells = [hist.get((f, k), (0, 0)) for k in range(len(cuts) + 1)]
        bad, good = sum(c[0] for c in cells), sum(c[1] for c in cells)
        if not bad:
            continue
        prior, low_bad, low_good = log2(bad / (bad + good)), 0, 0
        for k in range(len(cuts)):
            low_bad, low_good = low_bad + cells[k][0], low_good + cells[k][1]
            for above, p, n in ((False, low_bad, low_good),
                                (True, bad - low_bad, good - low_good)):
                if p and (f, above, k) not in used:
                    gain = p * (log2(p / (p + n)) - prior)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, above, k))
    return best


def learn_rules(stats: DataFrame, bad: str, id_col: str = "doc_id", max_rows: int = 200_000,
                cuts: int = 16, max_rules: int = 8, max_tests: int = 3,
                min_precision: float = 0.95, min_support: int = 8) -> list[Rule]:
    """An ordered list of rules that describe the rows where ``bad`` is true."""
    features = rule_features()
    rows = stats.filter(F.col(bad).isNotNull()).select(
        F.col(bad).cast("boolean").alias("__bad"),
        F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1_000_000)).alias("__draw"),
        *[e.alias(f) for f, e in features.items()])
    rows = stored(rows, "rule-rows")
    n = rows.count()
    if n > max_rows:
        rows = rows.filter(F.col("__draw") < int(1_000_000 * max_rows / n))
    shares = [k / cuts for k in range(1, cuts)]
    found = rows.groupBy("__bad").agg(*[
        F.percentile_approx(f, shares, 10_000).alias(f) for f in features]).collect()
    if len(found) < 2:
        return []
    # candidate thresholds lie midway between neighbouring quantiles of either class
    levels = {f: sorted({v for r in found for v in r[f]}) for f in features}
    thresholds = {f: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)]
                  for f, v in levels.items()}
    codes = {f: sum(((F.col(f) > t).cast("int") for t in thresholds[f]), F.lit(0))
             for f in features}
    coded = stored(rows.select("__bad", (F.pmod("__draw", F.lit(3)) == 2).alias("__prune"),
                               *[c.alias(f) for f, c in codes.items()]), "rule-codes")

    def test(t: tuple) -> Column:
        f, above, k = t
        return F.col(f) > k if above else F.col(f) <= k

    def histograms(part: DataFrame) -> tuple[dict, dict]:
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("c"))
                                    for f in features]))
        out: tuple[dict, dict] = ({}, {})
        for r in part.select("__bad", "__prune", cells.alias("x")) \
                .groupBy("__bad", "__prune", "x.f", "x.c").count().collect():
            out[r["__prune"]].setdefault((r["f"], r["c"]), [0, 0])[0 if r["__bad"] else 1] \
                += r["count"]
        return out

    def held(hist: dict) -> tuple[int, int]:
        """(bad, good) of a histogram, read off its first feature."""
        f = next(iter(features))
        cells = [v for (g, _), v in hist.items() if g == f]
        return sum(c[0] for c in cells), sum(c[1] for c in cells)

    rules, left = [], coded
    for _ in range(max_rules):
        tests: list[tuple] = []
        prefixes: list[tuple[int, int]] = []
        all_rows: list[tuple[int, int]] = []
        part = left
        while True:
            grow, prune = histograms(part)
            prefixes.append(held(prune))
            p, g = held(grow)
            all_rows.append((p + prefixes[-1][0], g + prefixes[-1][1]))
            _, best = _best_test(grow, thresholds, set(tests)) if p and g else (0, None)
            if best is None or len(tests) == max_tests:
                break
            tests.append(best)
            part = part.filter(test(best))
        value = [(p - g) / (p + g + 1) for p, g in prefixes]
        length = max(range(1, len(tests) + 1), key=lambda k: (value[k], -k), default=0)
        if not length:
            break
        (p, g), (p_all, g_all) = prefixes[length], all_rows[length]
        if p_all + g_all < min_support or p < min_precision * (p + g) or not p \
                or (p_all + 1) / (p_all + g_all + 2) < min_precision:
            break
        rules.append(tuple(Test(f, above, float(thresholds[f][k]))
                           for f, above, k in tests[:length]))
        covered = test(tests[0])
        for t in tests[1:length]:
            covered = covered & test(t)
        left = left.filter(~covered)
    return rules


def keep_expression(rules: list[Rule]) -> Column:
    """The list as ``CASE WHEN rule THEN false ... ELSE true END``."""
    verdict = None
    for rule in rules:
        condition = rule[0].column()
        for t in rule[1:]:
            condition = condition & t.column()
        verdict = (F if verdict is None else verdict).when(condition, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict and learned verdict of every document."""
    stats = stored(text_statistics(docs), "text-statistics")
    marked = labels.filter(F.col("quality").isNotNull()) \
        .select(F.col("doc_id").alias("__id"), (F.col("quality") == 0).alias("__low"))
    rules = learn_rules(stats.join(marked, F.col("doc_id") == F.col("__id"))
                        .filter(~base_failed()), "__low")
    judged = stats.withColumn("base_failed", base_failed()) \
        .withColumns({f: e for f, e in rule_features().items() if f not in stats.columns})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & keep_expression(rules)).alias("kept"))
