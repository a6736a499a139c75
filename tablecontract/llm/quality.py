"""Quality rules combined by weak supervision: votes, accuracies by expectation-maximisation, a posterior."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import name_in, saved, without

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_stops", "n_chars_all")


def measure(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all of them by default) with what the rules look at.

    All of it stays in the row: windows of five words are hashed, and only where two hashes
    of a text are equal are they sorted with their places, to add up the words they cover.
    """
    rows = without(docs, (*BASE, *EXTRA))
    carry = rows.columns if carry is None else carry
    named = [name_in(rows, c) for c in carry]
    t = F.coalesce(name_in(rows, text).cast("string"), F.lit(""))
    words = F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, _SPACE, "") != "")
    removed = lambda signs: F.char_length(t) - F.char_length(F.translate(t, signs, ""))
    rows = rows.select(
        *named, words.alias("__words"), lines.alias("__lines"),
        (F.char_length(t) - removed(_SPACE)).cast("long").alias("word_chars"), removed(_SYMBOLS).cast("long").alias("n_symbols"),
        removed(".!?").cast("long").alias("n_stops"), F.char_length(t).cast("long").alias("n_chars_all"))
    windows = F.when(F.size("__words") >= 5, F.transform(
        F.sequence(F.lit(0), F.size("__words") - 5), lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(5)]))
    ).otherwise(F.array().cast("array<long>"))
    rows = rows.select(
        *[name_in(rows, c) for c in carry], *[x for x in ("word_chars", "n_symbols", *EXTRA[1:])],
        F.size("__words").cast("long").alias("n_words"), F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"), windows.alias("__windows"))
    rows = rows.withColumn("n_repeat_words", _repeated(F.col("__windows")))
    return rows.select(*[name_in(rows, c) for c in carry], *BASE, *EXTRA)


def _repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda x, i, k: F.coalesce(F.get(x, i + k)["h"] == F.get(x, i)["h"], F.lit(False))
    places = _bound(ordered, lambda x: F.array_sort(F.array_compact(
        F.transform(x, lambda s, i: F.when(same(x, i, 1) | same(x, i, -1), s["i"])))))
    cover = _bound(places, lambda p: F.transform(p, lambda s, i: F.least(F.coalesce(F.get(p, i + 1) - s, F.lit(5)), F.lit(5))))
    total = F.aggregate(cover, F.lit(0).cast("long"), lambda a, c: a + c)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) where ``good`` holds, -1 (bad) where ``bad`` does, and abstains elsewhere."""

    name: str
    good: str
    bad: str


#: Conditions on the columns of ``measure``. None of them is decisive alone.
RULES = (
    Rule("length", "n_words >= 30", "n_words < 10"),
    Rule("word_length", "word_chars between 3 * n_words and 9 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "20 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    Rule("density", "50 * n_symbols <= word_chars", "12 * n_symbols > word_chars"),
    Rule("lines", "5 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("repeats", "20 * n_repeat_words <= 3 * n_words", "5 * n_repeat_words > n_words"),
    Rule("stops", "n_stops > 0 and 2 * n_stops <= n_words", "n_stops = 0 and n_words >= 30"),
)


@dataclass(frozen=True)
class Model:
    """How often texts are good, and how rules vote on good and on bad ones: for each the chances of -1, 0 and 1."""

    prior: float
    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]

    def odds(self) -> Column:
        """Log-odds of good quality given the votes ``v0, v1, ...``."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, (g, b) in enumerate(zip(self.good, self.bad, strict=True)):
            weight = [math.log(x / y) for x, y in zip(g, b, strict=True)]
            v = F.col(f"v{j}")
            total = total + F.when(v < 0, weight[0]).when(v > 0, weight[2]).otherwise(weight[1])
        return total


def votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Column]:
    return [F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0).alias(f"v{j}") for j, r in enumerate(rules)]


def estimate(measured: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 12) -> Model:
    """Accuracies of the rules by expectation-maximisation, from how they agree on all texts; no labels are used.

    Votes of all texts are counted by pattern first: with seven rules 2,187 patterns at most,
    whatever the corpus. The rounds run over these counts in one expression. Rules are taken as
    independent given the quality. Each side starts from a belief that weighs as much as a
    fiftieth of the texts, so the sides keep their meaning: a rule condemns one good text in 200.
    """
    n = len(rules)
    patterns = measured.select(*votes(measured, rules)).groupBy(*[f"v{j}" for j in range(n)]).agg(F.count(F.lit(1)).cast("double").alias("n"))
    # Votes as places in a list of chances: rule j's vote v is at 3 j + v + 1.
    places = F.array(*[F.col(f"v{j}") + 3 * j + 1 for j in range(n)])
    seen = patterns.agg(F.collect_list(F.struct(places.alias("at"), F.col("n"))).alias("seen"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("all"))
    weight = F.col("all") / 50
    good, bad = ([x for _ in rules for x in start] for start in ((0.005, 0.195, 0.8), (0.4, 0.3, 0.3)))
    start = F.struct(F.lit(0.8).alias("prior"), _list(good).alias("good"), _list(bad).alias("bad"))

    def round_(model: Column, _: Column) -> Column:
        """Weights of good and bad by pattern, and the chances that follow from them."""
        odds = lambda s: F.aggregate(
            s["at"], F.log(model["prior"] / (1 - model["prior"])), lambda a, k: a + F.log(F.get(model["good"], k) / F.get(model["bad"], k)))
        weighed = F.transform(F.transform("seen", lambda s: F.struct(s["at"], s["n"], (1 / (1 + F.exp(-odds(s)))).alias("p"))), lambda s: F.struct(
            s["at"], (s["n"] * s["p"]).alias("good"), (s["n"] * (1 - s["p"])).alias("bad")))
        return _bound(weighed, lambda w: F.struct(
            ((_sum(w, "good") + 0.8 * weight) / (F.col("all") + weight)).alias("prior"), chances(w, "good", good).alias("good"), chances(w, "bad", bad).alias("bad")))

    def chances(weighed: Column, side: str, believed: list[float]) -> Column:
        return _bound(_sum(weighed, side), lambda total: F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)), lambda k: (
            _sum(F.filter(weighed, lambda s: F.array_contains(s["at"], k)), side) + weight * F.get(_list(believed), k)) / (total + weight)))

    fitted = F.when(F.col("all") > 0, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, round_)).otherwise(start)
    model = seen.select(fitted.alias("model")).first()["model"]
    thirds = lambda x: tuple(tuple(x[3 * j : 3 * j + 3]) for j in range(n))
    return Model(model["prior"], thirds(model["good"]), thirds(model["bad"]))


def _list(values: list[float]) -> Column:
    return F.array(*[F.lit(x) for x in values])


def _sum(items: Column, name: str) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, s: a + s[name])


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def judge(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, rules: tuple[Rule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """Documents with the measures, ``base_failed``, ``quality`` (the posterior probability of good quality) and ``kept``.

    The base limits are hard: fewer than 10 words, or more than a fifth of the words in
    repeated windows. All else is weighed: a document stays when ``quality`` is at least ``least``.
    Columns ``carry`` are kept, all by default. Measuring is the costly part and is done once;
    its result is written to the shared folder.

    Null text has no words and fails; equal rows get equal results; no documents give none.
    Input columns named like results are replaced.
    """
    rows = without(docs, ("base_failed", "quality", "kept"))
    carry = [c for c in rows.columns if carry is None or c in carry]
    carry = [c for c in carry if c.lower() not in {*BASE, *EXTRA}]
    measured = saved(measure(rows, text, carry), "measures")
    model = estimate(measured, rules)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = measured.select("*", *votes(measured, rules)).withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-model.odds()))})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    return out.drop(*EXTRA, *[f"v{j}" for j in range(len(rules))])
