"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import SPACES, pick

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BULLET = r"^[\x20\x09-\x0D]*[-*•·]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*$"

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it on with as was are be this by an or at from "
    "le la les de des et un une du en que est pour dans qui au sur par pas plus "
    "der die das und den von zu mit sich auf ist im dem nicht ein eine als auch es "
    "el los las y del se por con una su para como al lo más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when `low <= metric <= high` doesn't hold; None is open."""

    metric: str
    low: float | None = None
    high: float | None = None


#: The threshold table. Ratios are of words, characters or lines that hold a word.
RULES = (
    Rule("n_words", low=20),
    Rule("mean_word_chars", low=1.5, high=40.0),
    Rule("symbol_ratio", high=0.2),
    Rule("stop_word_ratio", low=0.005),
    Rule("letter_word_ratio", low=0.7),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.95),
    Rule("ellipsis_line_ratio", high=0.6),
    Rule("repeat_word_ratio", high=0.3),
)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable isn't evaluated again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in the array.

    Window hashes come from three pairings (2, 4, 8 words). Only where two are
    equal are they sorted by position and the union of their spans summed.
    """

    def paired(h: Column, step: int) -> Column:
        n = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(F.slice(h, 1, n), F.slice(h, 1 + step, n), lambda a, b: F.xxhash64(a, b))

    def covered(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))

        def repeats(s: Column) -> Column:
            n = F.size(s)
            none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
            before = F.zip_with(s, F.concat(none, F.slice(s, 1, n - 1)), lambda a, b: F.struct(a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("t")))
            after = F.zip_with(before, F.concat(F.slice(s, 2, n - 1), none), lambda a, b: F.struct(a["i"].alias("i"), a["t"].alias("t"), b["h"].alias("n")))
            both = F.zip_with(after, s, lambda a, b: F.struct(a["i"].alias("i"), (a["t"] | F.coalesce(a["n"] == b["h"], F.lit(False))).alias("t")))
            return F.array_sort(F.transform(F.filter(both, lambda x: x["t"]), lambda x: x["i"]))

        def span(at: Column) -> Column:
            nexts = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.lit(None).cast("int")))
            gaps = F.zip_with(at, nexts, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

        return _let(F.array_sort(placed), lambda s: _let(repeats(s), span))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))

    one = F.transform(words, lambda w: F.xxhash64(w))
    return _let(one, lambda h1: _let(paired(h1, 1), lambda h2: _let(paired(h2, 2), lambda h4: _let(paired(h4, 4), counted)))).cast("long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with every count that the rules are made of.

    Null and empty text have no words and no lines; texts of any length are read
    whole, as one row's arrays. Only the id and text columns are read, so extra columns
    can't clash; equal rows give equal rows, an empty table none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        F.translate(text, SPACES, "").alias("bare"),
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )

    def count(column: str, test) -> Column:
        return F.size(F.filter(F.col(column), test)).cast("long")

    return step.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length("bare").cast("long").alias("word_chars"),
        (F.length("bare") - F.length(F.translate("bare", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        count("words", lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
        count("words", lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
        count("lines", lambda x: x.rlike(BULLET)).alias("n_bullet_lines"),
        count("lines", lambda x: x.rlike(ELLIPSIS)).alias("n_ellipsis_lines"),
    )


def _per(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """measured with base_failed, the names of the rules that failed and kept.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated
    windows. kept: not base_failed and no rule failed.
    """
    ratios = {
        "mean_word_chars": _per("word_chars", "n_words"),
        "symbol_ratio": _per("n_symbols", "word_chars"),
        "stop_word_ratio": _per("n_stop_words", "n_words"),
        "letter_word_ratio": _per("n_letter_words", "n_words"),
        "dup_line_ratio": _per("n_dup_lines", "n_lines"),
        "bullet_line_ratio": _per("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": _per("n_ellipsis_lines", "n_lines"),
        "repeat_word_ratio": _per("n_repeat_words", "n_words"),
    }

    def failed(rule: Rule) -> Column:
        value = ratios.get(rule.metric, F.col(rule.metric))
        out = F.lit(False)
        if rule.low is not None:
            out = out | (value < rule.low)
        if rule.high is not None:
            out = out | (value > rule.high)
        return F.when(out, F.lit(rule.metric))

    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fails = F.array_compact(F.array(*[failed(r) for r in rules]))
    out = measured.withColumns({"base_failed": base, "failed_rules": F.concat_ws(",", fails)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every document, in one pass without a shuffle; edge cases as in measure."""
    return judge(measure(docs, id_col, text_col), rules)
