"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule rejects a text. It needs measures, which are taken from parts of the text (its words, its lines). On a
sample, the cost of each part and measure (seconds a text) and the selectivity of each rule (share it rejects)
are estimated, and rules run by rejections per cost. A rejected text meets no later rule, and a part or measure
is computed at most once a text, by the first rule that needs it. The order changes only the time: a text is
kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that order the rules, and runs over them, of which the fastest counts (the first one compiles).
SAMPLE_TEXTS = 500
RUNS = 3

SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lines(text: Column) -> Column:
    """Lines with a word."""
    found = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(found, lambda line: F.length(F.translate(line, _SPACES, "")) > 0)


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), _SPACES, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def size(found: Column) -> Column:
    return F.size(found).cast("long")


def n_dup(found: Column) -> Column:
    """Items that equal an earlier one."""
    return (F.size(found) - F.size(F.array_distinct(found))).cast("long")


def n_like(pattern: str):
    """Items that a pattern finds something in."""
    return lambda found: F.size(F.filter(found, lambda x: x.rlike(pattern))).cast("long")


def _with(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def n_repeat_words(found: Column) -> Column:
    """Words in windows of eight words that occur again in the text.

    Windows are compared by hash first; only where hashes repeat, which is rare, are the
    windows themselves sorted, so that equal ones meet, and their places counted once.
    """

    def covered(found: Column) -> Column:
        # found: sorted places; a place covers its window up to the next place.
        return F.aggregate(
            F.transform(
                found,
                lambda at, i: F.when(i + 1 < F.size(found), F.least(F.lit(WINDOW), found[i + 1] - at)).otherwise(
                    F.lit(WINDOW)
                ),
            ),
            F.lit(0),
            lambda total, n: total + n,
        )

    def repeated(windows: Column) -> Column:
        # windows: structs (text, place), sorted.
        return F.array_sort(
            F.transform(
                F.filter(
                    windows,
                    lambda x, i: ((i > 0) & (F.get(windows, i - 1)["text"] == x["text"]))
                    | F.coalesce(F.get(windows, i + 1)["text"] == x["text"], F.lit(False)),
                ),
                lambda x: x["at"],
            )
        )

    def counted(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - WINDOW + 1)
        hashes = F.transform(places, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        exact = F.transform(
            places, lambda i: F.struct(F.array_join(F.slice(w, i, WINDOW), " ").alias("text"), i.alias("at"))
        )
        return F.when(
            _with(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h)),
            _with(F.sort_array(exact), lambda s: _with(repeated(s), covered)),
        ).otherwise(0)

    return F.when(F.size(found) > WINDOW, counted(found)).otherwise(0).cast("long")


@dataclass(frozen=True)
class Rule:
    """`rejects` is over the measures `needs`; shares need `least` of the first one to reject."""

    name: str
    needs: tuple[str, ...]
    limit: float
    kind: str
    least: int = 0

    def rejects(self, of: Mapping[str, Column]) -> Column:
        a = of[self.needs[0]]
        if self.kind == "below":
            return a < self.limit
        b = of[self.needs[1]]
        if self.kind == "share above":
            above = a * 100 > b * self.limit
            return above & (a >= self.least) if self.least else above
        return a * 100 < b * self.limit


# Parts of a text, and measures: what each is taken from, and how.
PARTS = {"words": ("text", words), "lines": ("text", lines)}
MEASURES = {
    "n_words": ("words", size),
    "word_chars": ("text", word_chars),
    "n_symbols": ("text", n_symbols),
    "n_lines": ("lines", size),
    "n_dup_lines": ("lines", n_dup),
    "n_repeat_words": ("words", n_repeat_words),
    "n_letter_words": ("words", n_like(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]")),
    "n_bullet_lines": ("lines", n_like(r"\A[\x20\x09-\x0D]*[-*\x{2022}]")),
    "n_open_lines": ("lines", n_like(r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z")),
}
_FROM = {**PARTS, **MEASURES}

BASE = (
    Rule("few words", ("n_words",), 20, "below"),
    Rule("repeated words", ("n_repeat_words", "n_words"), 30, "share above"),
)
# Shares are in percent; word lengths are characters in words for 100 words.
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "word_chars"), 15, "share above"),
    Rule("repeated lines", ("n_dup_lines", "n_lines"), 30, "share above"),
    Rule("long words", ("word_chars", "n_words"), 2000, "share above"),
    Rule("short words", ("word_chars", "n_words"), 200, "share below"),
    Rule("words without letters", ("n_letter_words", "n_words"), 50, "share below"),
    Rule("bullet lines", ("n_bullet_lines", "n_lines"), 90, "share above", least=5),
    Rule("lines that break off", ("n_open_lines", "n_lines"), 30, "share above", least=5),
)


def _needed(names: Iterable[str]) -> list[str]:
    """Names of parts and measures that `names` take, each once, parts first."""
    found: dict[str, None] = {}
    for name in names:
        source = _FROM[name][0]
        if source in PARTS:
            found[source] = None
        found[name] = None
    return list(found)


def _computed(names: Sequence[str], of: Mapping[str, Column], use) -> Column:
    """`use` of `of` with the parts and measures `names` added, each computed once."""
    for i, name in enumerate(names):
        if name not in of:
            source, how = _FROM[name]
            return _with(how(of[source]), lambda value: _computed(names[i + 1 :], {**of, name: value}, use))
    return use(of)


def first_rejection(rules: Sequence[Rule], of: Mapping[str, Column]) -> Column:
    """Name of the first rule that rejects, in the given order. `of` has "text" and what is known of it;
    what else a rule needs is computed where the rule is reached, and known to the later ones."""
    if not rules:
        return F.lit(None).cast("string")
    rule = rules[0]

    def judged(known: Mapping[str, Column]) -> Column:
        return F.when(rule.rejects(known), F.lit(rule.name)).otherwise(first_rejection(rules[1:], known))

    return _computed(_needed(rule.needs), of, judged)


def measured(df: DataFrame, names: Sequence[str] = tuple(MEASURES), text: str = "text") -> DataFrame:
    """Adds measures of `text`. Null has no words, symbols or lines."""
    return cascade(df, (), text, _VERDICT, names).drop(_VERDICT)


_VERDICT = "_verdict"


def ordered_rules(
    df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", known: Sequence[str] = ()
) -> list[tuple[Rule, float, float]]:
    """The rules by rejections per cost on a sample, with both. An empty table keeps the given order.

    The cost of a part or measure is shared by the rules that need it; measures in `known` cost nothing.
    """
    share = min(1.0, SAMPLE_TEXTS / max(df.count(), 1))
    sample = df.select(F.col(text).alias("t")).sample(share, seed=11).limit(SAMPLE_TEXTS).cache()
    try:
        n = max(sample.count(), 1)

        def seconds(names: Sequence[str]) -> float:
            last = names[-1] if names else "text"
            number = F.length if last == "text" else F.size if last in PARTS else F.abs
            done = _computed(names, {"text": F.col("t")}, lambda of: number(of[last]))
            query = sample.agg(F.sum(done))
            runs = []
            for _ in range(RUNS):
                began = time.perf_counter()
                query.first()
                runs.append(time.perf_counter() - began)
            return min(runs) / n

        needs = {rule.name: [x for x in _needed(rule.needs) if x not in _needed(known)] for rule in rules}
        users = Counter(x for names in needs.values() for x in names)
        nothing = seconds([])
        whole = {x: max(seconds(_needed([x])) - nothing, 0.0) for x in users}
        cost = {x: max(whole[x] - whole.get(_FROM[x][0], 0.0), 1e-7) for x in users}
        rejects = _computed(
            _needed(x for rule in rules for x in rule.needs),
            {"text": F.col("t")},
            lambda of: F.array(*(rule.rejects(of).cast("int") for rule in rules)),
        )
        shares = sample.select(rejects.alias("r")).select(*(F.sum(F.col("r")[i]) for i in range(len(rules)))).first()
    finally:
        sample.unpersist()
    found = [(rule, sum(cost[x] / users[x] for x in needs[rule.name]) or 1e-9, (rejected or 0) / n) for rule, rejected in zip(rules, shares)]
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    column: str = "rejected_by",
    report: Sequence[str] = (),
) -> DataFrame:
    """Adds `column`: the rule that rejected the text, null if it is kept. Rows and other columns stay as they are.

    `report` names measures to add as columns, for every row; rules use them without another look at the text.
    Other measures are taken only of texts that reach a rule that needs them. Null and empty texts have no words
    and fail "few words"; very long texts are judged whole. Repeated rows are judged alike; an empty table gives an
    empty result. Columns named like `column` or a reported measure are replaced.
    """
    order = [rule for rule, _, _ in ordered_rules(df, rules, text, report)] if rules else []

    def row(of: Mapping[str, Column]) -> Column:
        return F.struct(*(of[x].alias(x) for x in report), first_rejection(order, of).alias(_VERDICT))

    if not report:
        return df.withColumn(column, first_rejection(order, {"text": F.col(text)}))
    out = df.withColumn(column, _computed(_needed(report), {"text": F.col(text)}, row))
    out = out.withColumns({x: F.col(column)[x] for x in report})
    return out.withColumn(column, F.col(column)[_VERDICT])
