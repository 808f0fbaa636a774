"""Quality rules: text statistics as Spark expressions and a decision list learned from labelled statistics."""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\u000b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words inside windows of `window` words that a text has twice or more, the first included; from the array of words.

    Windows are hashed; only texts in which some window repeats sort theirs: equal hashes then stand side by side, and
    the repeated places, sorted again, cover min(window, distance to the next) words each.
    """
    n = F.size(words) - window + 1
    grams = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(grams_: Column) -> Column:
        rows = F.sort_array(F.transform(grams_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(sorted_rows: Column) -> Column:
            same = lambda r, j: (F.get(sorted_rows, j - 1)["h"] == r["h"]) | (F.get(sorted_rows, j + 1)["h"] == r["h"])
            found = F.transform(sorted_rows, lambda r, j: F.when(F.coalesce(same(r, j), F.lit(False)), r["i"]))
            return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

        return let(rows, lambda s: let(places(s), lambda p: F.aggregate(F.transform(p, lambda i, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - i, F.lit(window)))), F.lit(0), lambda a, x: a + x)))

    return F.when(n < 2, F.lit(0)).otherwise(let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _free(docs: DataFrame, *names: str) -> None:
    taken = {c.lower() for c in docs.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"docs already has the columns {sorted(taken)}")


def with_statistics(docs: DataFrame, name: str = "stats") -> DataFrame:
    """docs with a struct column of that name: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and the shares rules are learned on.

    Null text: none of anything. All in one projection; texts aren't moved. Other columns may have any names but this one.
    """
    _free(docs, name)
    w, c, l = (f"{part}_{uuid.uuid4().hex}" for part in "wcl")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # what is neither white space nor a lower-case letter: short, so counts of single kinds are taken from it
    rest = F.regexp_replace(text, "[\\p{Ll}\\s]+", "")

    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        )

    def counted(rest_: Column) -> Column:
        count = lambda kinds: F.length(F.regexp_replace(rest_, f"[^{kinds}]+", "")).cast("long")
        return F.struct(count(re.escape(SYMBOLS)).alias("symbols"), count("\\p{Lu}").alias("upper"), count("!?").alias("marks"), count("0-9").alias("digits"), count(".").alias("stops"))

    out = docs.select(
        "*",
        let(words_of(text), measured).alias(w),
        let(rest, counted).alias(c),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias(l),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    stats = F.struct(
        F.col(f"{w}.n_words").alias("n_words"),
        F.col(f"{w}.word_chars").alias("word_chars"),
        F.col(f"{c}.symbols").alias("n_symbols"),
        F.col(f"{l}.dup").alias("n_dup_lines"),
        F.col(f"{w}.n_repeat_words").alias("n_repeat_words"),
        share(f"{w}.word_chars", f"{w}.n_words").alias("word_length"),
        share(f"{c}.symbols", f"{w}.n_words").alias("symbol_share"),
        share(f"{c}.upper", f"{w}.word_chars").alias("upper_share"),
        share(f"{c}.marks", f"{w}.n_words").alias("mark_share"),
        share(f"{c}.digits", f"{w}.word_chars").alias("digit_share"),
        share(f"{c}.stops", f"{w}.n_words").alias("stop_share"),
        share(f"{l}.dup", f"{l}.n").alias("dup_line_share"),
        share(f"{w}.n_repeat_words", f"{w}.n_words").alias("repeat_share"),
        share(f"{w}.n_distinct", f"{w}.n_words").alias("distinct_share"),
    )
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], stats.alias(name))


FEATURES = ["n_words", "word_length", "symbol_share", "upper_share", "mark_share", "digit_share", "stop_share", "dup_line_share", "repeat_share", "distinct_share"]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, "<=" or ">=", threshold); rows that meet all are rejected."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self, stats: str = "stats") -> Column:
        out = F.lit(True)
        for name, op, at in self.tests:
            value = F.col(f"{stats}.{name}")
            out = out & (value <= at if op == "<=" else value >= at)
        return out

    def holds(self, row: dict[str, float]) -> bool:
        return all(row[n] <= at if op == "<=" else row[n] >= at for n, op, at in self.tests)


def _grow(good: list[dict], bad: list[dict], cuts: dict[str, list[float]], most_tests: int) -> tuple:
    """Add the test of the largest information gain until no accepted row is left or nothing gains."""
    tests: tuple = ()
    while good and len(tests) < most_tests:
        base = math.log2(len(bad) / (len(bad) + len(good)))
        best = None
        for name, at in cuts.items():
            g, b = sorted(r[name] for r in good), sorted(r[name] for r in bad)
            i = j = 0
            for cut in at:
                while i < len(g) and g[i] <= cut:
                    i += 1
                while j < len(b) and b[j] <= cut:
                    j += 1
                # rows at the cut count below it; ">=" uses the next cut, which has the same rows above
                for op, p, n in (("<=", j, i), (">", len(b) - j, len(g) - i)):
                    if p and (p, n) != (len(b), len(g)):
                        gain = p * (math.log2(p / (p + n)) - base)
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, name, op, cut)
        if best is None or best[0] <= 0:
            break
        _, name, op, cut = best
        if op == ">":
            cut = min(r[name] for r in [*good, *bad] if r[name] > cut)
            op = ">="
        tests += ((name, op, cut),)
        rule = Rule(tests[-1:])
        good, bad = [r for r in good if rule.holds(r)], [r for r in bad if rule.holds(r)]
    return tests


def learn(rows: list[tuple[dict[str, float], bool]], precision: float = 0.95, most_rules: int = 12, most_tests: int = 3, n_cuts: int = 48) -> list[Rule]:
    """An ordered list of rules that reject, by sequential covering (incremental reduced-error pruning).

    rows: (statistics, whether to reject). Every third row prunes, the others grow. A rule is grown test by test, loses
    last tests while that doesn't hurt (p - n) / (p + n) on the pruning rows, and is kept while both parts reach the
    precision and it covers four rows to reject; rows it covers are then removed. Needs both kinds of rows, else there are no rules.
    """
    grow, prune = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    cuts = {}
    for name in FEATURES:
        values = sorted(r[name] for r, _ in grow)
        cuts[name] = sorted({values[(len(values) - 1) * k // n_cuts] for k in range(n_cuts + 1)}) if values else []
    part = lambda rs, kind: [r for r, k in rs if k == kind]
    rules: list[Rule] = []
    while len(rules) < most_rules:
        good, bad = part(grow, False), part(grow, True)
        if not bad or not good:
            break
        tests = _grow(good, bad, cuts, most_tests)
        if not tests:
            break

        def worth(t: tuple) -> tuple[float, int, int]:
            p, n = (sum(Rule(t).holds(r) for r in part(prune, k)) for k in (True, False))  # noqa: B023
            return ((p - n) / (p + n) if p + n else -1.0), p, n

        while len(tests) > 1 and worth(tests[:-1])[0] >= worth(tests)[0]:
            tests = tests[:-1]
        rule = Rule(tests)
        _, p, n = worth(tests)
        p2, n2 = sum(map(rule.holds, bad)), sum(map(rule.holds, good))
        if p + p2 < 4 or p < precision * (p + n) or p2 < precision * (p2 + n2):
            break
        rules.append(rule)
        grow = [r for r in grow if not rule.holds(r[0])]
        prune = [r for r in prune if not rule.holds(r[0])]
    return rules


def verdict(rules: list[Rule], stats: str = "stats") -> Column:
    """The decision list as one ordered conditional expression: the first rule that holds rejects; else kept."""
    if not rules:
        return F.lit(True)
    out = F.when(rules[0].column(stats), F.lit(False))
    for r in rules[1:]:
        out = out.when(r.column(stats), F.lit(False))
    return out.otherwise(F.lit(True))


def base_failed(stats: str = "stats") -> Column:
    return (F.col(f"{stats}.n_words") < 20) | (100 * F.col(f"{stats}.n_repeat_words") > 30 * F.col(f"{stats}.n_words"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, **options) -> list[Rule]:
    """Learn a decision list from labels (doc_id, quality 0/1) on at most `sample` labelled documents, those of the least hashes
    of doc_id: the documented bound on what is collected. Statistics are computed by Spark on these documents alone.
    Labels with a null doc_id or quality don't count; of a doc_id labelled twice the lower quality does; of rows that share a
    labelled doc_id the one whose text has the least hash counts, so no more than `sample` rows are collected."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64(F.lit(7), "_id"), "_id")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(chosen), "_id")
    features = [F.col(f"stats.{f}").cast("double").alias(f) for f in FEATURES]
    one = with_statistics(rows).groupBy("_id", (F.col("_quality") == 0).alias("reject")).agg(F.min(F.struct(F.xxhash64("text").alias("tie"), *features)).alias("r"))
    got = one.select("_id", "reject", "r.*").collect()
    got.sort(key=lambda r: (r["_id"] * 2654435761 % 4294967296, r["_id"]))
    return learn([({f: r[f] for f in FEATURES}, r["reject"]) for r in got], **options)


def judge(docs: DataFrame, labels: DataFrame, names: tuple[str, str, str] = ("stats", "base_failed", "kept"), **options) -> DataFrame:
    """docs with `stats`, `base_failed` and `kept`: false for documents under 20 words or with over 30 % of their words in
    repeated windows, else what the learned decision list says. One projection over the texts, no shuffle of them.

    Null text: no words, so rejected. Null doc_id: judged like any other. Repeated rows: judged each, alike. No rows: no
    rows. No usable labels: only the base rule rejects. Columns of docs stay, whatever their names; one of the three `names`
    among them is a ValueError.
    """
    _free(docs, *names)
    stats, failed, kept = names
    rules = fit(docs, labels, **options)
    out = with_statistics(docs, stats).withColumn(failed, base_failed(stats))
    return out.withColumn(kept, ~F.col(failed) & verdict(rules, stats))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that `judge` keeps, with their columns alone."""
    names = tuple(f"{n}_{uuid.uuid4().hex}" for n in ("stats", "failed", "kept"))
    return judge(docs, labels, names, **options).where(F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])
