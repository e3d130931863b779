"""Quality rules as a cascade: the rules that reject most for their cost come first, the rest see what is left.

All measures are DataFrame functions of one row, so no text is shuffled and no rule needs Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.llm.common import OWN, SPACE, shielded

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A word that holds a letter; everything beyond ASCII counts as one.
LETTERED = r"[^\x20\x09-\x0D]*[A-Za-z\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*"
#: Words of a repeated window.
WINDOW = 3
#: Low bits of a packed window that hold its place; the others hold bits of its hash.
PLACE = 23

Columns = Mapping[str, Column]


def _windows(c: Columns) -> Column:
    """One number per window: bits of its hash above its place."""
    hashed = lambda w, i: F.xxhash64(w, *[F.get(c["words"], i + k) for k in range(1, WINDOW)])
    place = F.lit((1 << PLACE) - 1)
    return F.transform(_starts(c), lambda w, i: hashed(w, i).bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long")))


def _starts(c: Columns) -> Column:
    return F.slice(c["words"], 1, F.greatest(F.size(c["words"]) - (WINDOW - 1), F.lit(0)))


def _alike(a: Column, b: Column) -> Column:
    return F.shiftrightunsigned(a.bitwiseXOR(b), PLACE) == 0


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")


def _collides(c: Columns) -> Column:
    """Whether neighbours of the same hash bits are different windows, which the packed form cannot sort apart."""
    def differs(x: Column, i: Column) -> Column:
        y = F.get(c["echoes"], i + 1)
        same = F.lit(True)
        for k in range(WINDOW):
            same = same & (F.get(c["words"], _place(x) + k) == F.get(c["words"], _place(y) + k))
        return _alike(x, y) & ~same

    return F.size(F.filter(c["echoes"], differs)) > 0


def _sorted_windows(c: Columns) -> Column:
    """All windows with their places, sorted, of texts the packed form cannot hold; null for others."""
    windows = F.array_sort(F.transform(_starts(c), lambda w, i: F.struct(
        F.array(w, *[F.get(c["words"], i + k) for k in range(1, WINDOW)]).alias("window"), i.alias("place"))))
    return F.when((F.size(c["words"]) >= (1 << PLACE)) | _collides(c), windows)


def _places(c: Columns) -> Column:
    """Places of the repeated windows: neighbours in order that are equal."""
    def same(x: Column, i: Column) -> Column:
        return F.coalesce(x["window"] == F.get(c["exact"], i)["window"], F.lit(False))

    exact = F.transform(F.filter(c["exact"], lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["place"])
    return F.when(c["exact"].isNotNull(), exact).otherwise(F.transform(c["echoes"], _place))


def _shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda x: x + by)


def _count(c: Columns, pattern: str) -> Column:
    return F.regexp_count(c["body"], F.lit(pattern)).cast("long")


#: What is measured, and from what. Each step is a column of its own, so that none is computed twice.
STEPS: dict[str, tuple[tuple[str, ...], Callable[[Columns], Column]]] = {
    "trimmed": (("body",), lambda c: F.btrim(c["body"], F.lit(SPACE))),
    "words": (("trimmed",), lambda c: F.when(c["trimmed"] == "", F.array().cast("array<string>")).otherwise(
        F.split(c["trimmed"], BLANKS))),
    "n_words": (("words",), lambda c: F.size(c["words"]).cast("long")),
    "word_chars": (("body",), lambda c: F.length(F.translate(c["body"], SPACE, "")).cast("long")),
    "n_symbols": (("body",), lambda c: _count(c, SYMBOLS)),
    "lines": (("body",), lambda c: F.filter(F.split(c["body"], "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")),
    "n_lines": (("lines",), lambda c: F.size(c["lines"]).cast("long")),
    "n_dup_lines": (("lines",), lambda c: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long")),
    "windows": (("words",), lambda c: F.sort_array(_windows(c))),
    # Windows whose hash bits a neighbour shares: the repeated ones.
    "echoes": (("windows",), lambda c: F.filter(c["windows"], lambda x, i: F.coalesce(
        _alike(x, F.get(c["windows"], i + 1)), F.lit(False)) | F.coalesce(_alike(x, F.get(c["windows"], i - 1)), F.lit(False)))),
    "exact": (("echoes", "words"), _sorted_windows),
    "places": (("echoes", "exact"), _places),
    "n_repeat_words": (("places",), lambda c: F.size(F.array_distinct(F.flatten(F.array(*[
        _shifted(c["places"], k) for k in range(WINDOW)])))).cast("long")),
    "n_capitals": (("body",), lambda c: _count(c, "[A-Z]")),
    "n_small": (("body",), lambda c: _count(c, "[a-z]")),
    "n_lettered": (("body",), lambda c: _count(c, LETTERED)),
}


#: The work of each step that is more than a look at a column, by a text's characters and words: scans of a character by a
#: regular expression count ten, plain ones two; a word compared or hashed counts twenty.
WORK: dict[str, Callable[[Column, Column], Column]] = {
    "trimmed": lambda chars, words: 2 * chars, "words": lambda chars, words: 10 * chars, "word_chars": lambda chars, words: 2 * chars,
    "n_symbols": lambda chars, words: 10 * chars, "lines": lambda chars, words: 4 * chars, "n_dup_lines": lambda chars, words: 2 * chars,
    "windows": lambda chars, words: 20 * words * F.log2(words + 2), "echoes": lambda chars, words: 20 * words,
    "n_repeat_words": lambda chars, words: 20 * words, "n_capitals": lambda chars, words: 10 * chars,
    "n_small": lambda chars, words: 10 * chars, "n_lettered": lambda chars, words: 10 * chars}


@dataclass(frozen=True)
class Rule:
    """A reason to reject a text, from some of its measures."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Columns], Column]


#: A text must have enough words and not repeat itself.
BASE_RULES = (
    Rule("few words", ("n_words",), lambda c: c["n_words"] < 50),
    Rule("repeated words", ("n_repeat_words", "n_words"), lambda c: 100 * c["n_repeat_words"] > 50 * c["n_words"]),
)
RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("repeated lines", ("n_dup_lines", "n_lines"), lambda c: 2 * c["n_dup_lines"] > c["n_lines"]),
    Rule("word length", ("word_chars", "n_words"),
         lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"])),
    Rule("capitals", ("n_capitals", "n_small"), lambda c: c["n_capitals"] > c["n_small"]),
    Rule("words without letters", ("n_lettered", "n_words"), lambda c: 10 * c["n_lettered"] < 7 * c["n_words"]),
)


def _own(name: str) -> Column:
    return F.col(f"`{OWN}{name}`")


def _with_steps(df: DataFrame, names: Sequence[str], done: set[str], only: Column | None = None) -> DataFrame:
    """Add the named steps and what they need, where `only` holds if it is given; `done` learns of them."""
    for name in names:
        if name in done:
            continue
        needs, measure = STEPS[name]
        df = _with_steps(df, needs, done, only)
        value = measure({n: _own(n) for n in needs})
        df = df.withColumn(OWN + name, value if only is None else F.when(only, value))
        done.add(name)
    return df


def _body(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(f"{OWN}body", F.coalesce(F.col(f"`{text}`"), F.lit("")))


def measured(docs: DataFrame, measures: Sequence[str], text: str = "text") -> DataFrame:
    """The documents with the named measures, which replace columns of those names; a null text is an empty one."""
    docs, (text,), restored = shielded(docs, text)
    df = _with_steps(_body(docs, text), measures, {"body"})
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in measures]
    return restored(df.select(*kept, *[_own(m).alias(m) for m in measures]))


def _steps_of(names: Sequence[str], known: Sequence[str]) -> set[str]:
    """The steps that taking the named measures comes to, without those already known."""
    found: set[str] = set()
    for name in names:
        if name not in known and name in STEPS:
            found |= {name} | _steps_of(STEPS[name][0], known)
    return found


def cheapest_first(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 2000,
                   seed: int = 5, known: Sequence[str] = ()) -> list[Rule]:
    """The rules by rejections per work on a random sample of about `sample_rows` documents, best first; ties by name.

    One job counts, over the sample, the texts each rule rejects and the work of its measures as WORK has it, without those
    `known` already. Counted work, unlike seconds, does not depend on what else runs, so the same table gives the same order.
    The order is all the sample settles: rules are joined by "and", so every order keeps the same documents.
    """
    total = docs.count()
    if not total or not rules:
        return list(rules)
    sample = docs.select(F.col(f"`{text}`").cast("string").alias("text")).sample(min(1.0, sample_rows / total), seed)
    tried = _with_steps(_body(sample, "text"), sorted({"n_words", *[n for r in rules for n in r.needs]}), {"body"})
    chars, words = F.length(_own("body")).cast("double"), _own("n_words").cast("double")
    counts = []
    for i, rule in enumerate(rules):
        work = sum((WORK[step](chars, words) for step in sorted(_steps_of(rule.needs, known)) if step in WORK), F.lit(1.0))
        counts += [F.count_if(rule.rejects({n: _own(n) for n in rule.needs})).alias(f"rejected_{i}"), F.sum(work).alias(f"work_{i}")]
    found = tried.agg(*counts).first()
    worth = [(-found[f"rejected_{i}"] / (found[f"work_{i}"] or 1.0), rule.name, i) for i, rule in enumerate(rules)]
    return [rules[i] for _, _, i in sorted(worth)]


def cascade(docs: DataFrame, ordered: Sequence[Rule], text: str = "text", column: str = "kept",
            unless: Column | None = None, known: Sequence[str] = ()) -> DataFrame:
    """The documents with `column`: whether no rule rejects them. Replaces a column of that name.

    Rules run in the order given. Once one rejects a text, the measures of the later ones are not taken for
    it. Texts for which `unless` holds are rejected before the first. `known` names measures that `docs`
    already holds in columns of their names. A null text is an empty one, rows are judged one by one, and an empty table
    gives an empty result.
    """
    docs, (text,), restored = shielded(docs, text)
    df = _body(docs, text)
    done = {"body", *known}
    for name in known:
        df = df.withColumn(OWN + name, F.col(name))
    undecided = _own("undecided")
    df = df.withColumn(f"{OWN}undecided", F.lit(True) if unless is None else ~F.coalesce(unless, F.lit(False)))
    for rule in ordered:
        # A measure taken for some texts only is no use to a rule that sees others, but later rules see fewer.
        df = _with_steps(df, rule.needs, done, only=undecided)
        rejected = F.coalesce(rule.rejects({n: _own(n) for n in rule.needs}), F.lit(False))
        df = df.withColumn(f"{OWN}undecided", F.when(undecided, ~rejected).otherwise(False))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != column.lower()]
    return restored(df.select(*kept, undecided.alias(column)))


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = (*BASE_RULES, *RULES), text: str = "text", column: str = "kept") -> DataFrame:
    """The documents with `column`: whether they pass all rules, tried in the order a sample of them suggests.

    Null and empty texts have no words; whether they pass is for the rules to say (the default ones reject
    them). Repeated rows are judged alike. An empty table gives an empty result.
    """
    return cascade(docs, cheapest_first(docs, rules, text), text, column)


def base_and_verdict(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with the measures of the base rules and of all words, `base_failed` and `kept`.

    The base measures are taken for every text; the other rules form the cascade over those that pass the base.
    Added columns replace those of the same name. A null text is an empty one, repeated rows are judged alike, and an empty
    table gives an empty result.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    df = measured(docs, base, text)
    failed = F.lit(False)
    for rule in BASE_RULES:
        failed = failed | rule.rejects({n: F.col(n) for n in rule.needs})
    df = df.withColumn("base_failed", failed)
    return cascade(df, cheapest_first(docs, rules, text, known=base), text, "kept", unless=F.col("base_failed"), known=base)
