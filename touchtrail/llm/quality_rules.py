"""Quality rules: a table of thresholds compiled into one Spark projection.

Every feature is a built-in expression; the verdict is the conjunction of the
table's rows. No user functions, no shuffle: one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import free_name, let, texts

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]+"
CAPITALS = "[A-Z]+"

# Languages whose stop words the list holds.
STOP_WORD_LANGUAGES = ("en", "fr", "es", "de")
STOP_WORDS = (
    "a all an and are as at be by for from have in is it not of on or that the this to was were with "
    "au avec ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "al con como del el es lo los las más no para por se su una y "
    "auf das dem den der die ein eine für ich im ist mit nicht sich sie und von zu"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when ``feature`` lies outside [at_least, at_most].

    A rule with ``languages`` is not applied to texts that are not known to be in one of them.
    """

    feature: str
    at_least: float | None = None
    at_most: float | None = None
    applies_from: float = 0  # smallest n_words the rule is applied to
    languages: tuple[str, ...] = ()


# Ratios follow the usual published heuristics for web text (length, symbol, stop-word,
# and line rules); a feature without a value (no words, no letters) passes.
RULES: tuple[Rule, ...] = (
    Rule("n_words", at_least=50),
    Rule("repeat_ratio", at_most=0.5),
    Rule("mean_word_chars", at_least=2, at_most=15),
    Rule("symbol_ratio", at_most=0.1),
    Rule("stop_word_ratio", at_least=0.02, applies_from=50, languages=STOP_WORD_LANGUAGES),
    Rule("dup_line_ratio", at_most=0.5),
    Rule("capital_ratio", at_most=0.4),
)


def _count_of(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the list.

    Windows are sorted as (hash, position); those next to an equal hash repeat. The
    covered words then follow from the gaps between their sorted positions.
    """

    def of_windows(windows: Column) -> Column:
        repeated = F.filter(
            F.transform(
                windows,
                lambda w, i: F.when(
                    (w["h"] == F.get(windows, i - 1)["h"]) | (w["h"] == F.get(windows, i + 1)["h"]),
                    w["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            F.array_sort(repeated),
            lambda at: F.aggregate(
                F.transform(
                    at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))
                ),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def hashed(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)),
        )

    def counted(hashes: Column) -> Column:
        # Most texts have no repeated window: sort only those that do.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(
                F.array_sort(
                    F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
                of_windows,
            )
        )

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashed(words), counted))


def features(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: str | None = None,
    lang_col: str | None = None,
) -> DataFrame:
    """doc_id, language, and the counts and ratios the rules speak of, in one projection.

    ``carried`` names a column to pass on. Without a ``lang_col`` languages are NULL.
    """
    lang = F.lit(None).cast("string") if lang_col is None else F.lower(F.col(lang_col))
    kept = [] if carried is None else [carried]
    carry = [*kept, "language"]
    text = F.col("text")
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stop_words = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    counted = texts(docs, id_col, text_col, [*kept, lang.alias("language")]).select(
        "doc_id",
        *carry,
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count_of(text, CAPITALS).cast("long").alias("n_capitals"),
        let(
            lines,
            lambda ls: F.struct(
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("_lines"),
        let(
            words,
            lambda ws: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                F.size(F.filter(ws, lambda w: w.isin(*stop_words)))
                .cast("long")
                .alias("n_stop_words"),
                _repeat_words(ws).cast("long").alias("n_repeat_words"),
            ),
        ).alias("_words"),
    )
    n_words = F.col("_words.n_words")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b)

    return counted.select(
        "doc_id",
        *carry,
        "_words.*",
        "_lines.*",
        "n_symbols",
        ratio(F.col("_words.word_chars"), n_words).alias("mean_word_chars"),
        ratio(F.col("n_symbols"), n_words).alias("symbol_ratio"),
        ratio(F.col("_words.n_stop_words"), n_words).alias("stop_word_ratio"),
        ratio(F.col("_words.n_repeat_words"), n_words).alias("repeat_ratio"),
        ratio(F.col("_lines.n_dup_lines"), F.col("_lines.n_lines")).alias("dup_line_ratio"),
        ratio(F.col("n_capitals"), F.col("_words.word_chars")).alias("capital_ratio"),
    )


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """True where every rule of the table holds."""
    kept = F.lit(True)
    for rule in rules:
        value = F.col(rule.feature)
        inside = F.lit(True)
        if rule.at_least is not None:
            inside = inside & (value >= rule.at_least)
        if rule.at_most is not None:
            inside = inside & (value <= rule.at_most)
        free = F.col("n_words") < rule.applies_from
        if rule.languages:
            free = free | ~F.coalesce(F.col("language").isin(*rule.languages), F.lit(False))
        kept = kept & (F.coalesce(inside, F.lit(True)) | free)
    return kept


def apply_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """Features of every document and ``kept``, the verdict of the table.

    One row per input row. An empty or NULL text has no words and is not kept under
    the default table; no text is too long. Rules for some languages ask for a column that
    names the language; a text of another or of no known one is judged by the other rules.
    Ties and repeated rows do not matter: rows are independent.
    """
    return features(docs, id_col, text_col, lang_col=lang_col).withColumn("kept", verdict(rules))


def kept_rows(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """The input rows, with all their columns, that every rule of the table keeps."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(*columns, F.struct(*columns).alias(free_name(docs, "_whole")))
    carried = whole.columns[-1]
    # Under a name of its own: features are named too.
    judged = features(whole, id_col, text_col, carried, lang_col).where(verdict(rules))
    return judged.select(F.col(carried).alias("_row")).select("_row.*")
