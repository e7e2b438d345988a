"""Quality rules: a threshold table compiled into one projection of text measures.

Every measure is a Spark SQL expression over the words of a text, so a scan, one projection and the
verdict are the whole plan: no shuffle, no user function, no limit on text length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape.shared import evaluated

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Function words of the four corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his are this or from at",
    "de": "der die das und in zu den mit von für auf ist im dem nicht ein eine als auch es an sich",
    "fr": "le la les de des et un une en du que est pour qui dans par sur pas plus au ce il ne se",
    "es": "el la los las de y que en un una por con para es se no del al lo como su más o",
}


@dataclass(frozen=True)
class Rule:
    """Reject when 100 * numerator is below ``low`` or above ``high`` times the denominator."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def broken(self) -> Column:
        value, unit = F.col(self.numerator) * 100, F.col(self.denominator)
        tests = [value < unit * self.low] if self.low is not None else []
        tests += [value > unit * self.high] if self.high is not None else []
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


THRESHOLDS = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbol_ratio", "n_symbols", "n_words", high=25),
    Rule("stop_words", "n_stop_words", "n_words", low=1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda variable is never expanded."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text, the first included.

    Windows are sorted by (hash, position) packed in one long. Equal neighbours are compared word
    by word, so a shared hash prefix is never taken for a repeat. The covered words follow from the
    gaps between the positions of repeated windows.
    """

    def of(w: Column, high: Column) -> Column:
        windows = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
            .bitwiseAND(high).bitwiseOR(i.cast("long")),
        )

        def at(v: Column) -> Column:
            return v.bitwiseAND(F.bitwise_not(high)).cast("int")

        def same(v: Column, u: Column) -> Column:
            equal = v.bitwiseXOR(u).bitwiseAND(high) == 0
            for k in range(3):
                equal = equal & (F.get(w, at(v) + k) == F.get(w, at(u) + k))
            return equal

        def positions(s: Column) -> Column:
            twice = F.filter(s, lambda v, j: same(v, F.get(s, j - 1)) | same(v, F.get(s, j + 1)))
            return F.sort_array(F.transform(twice, at))

        def covered(p: Column) -> Column:
            gaps = F.transform(
                F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))),
                lambda x, i: F.least(F.lit(3), x - F.get(p, i)),
            )
            total = F.aggregate(gaps, F.lit(3).cast("long"), lambda a, x: a + x)
            return F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(total)

        return let(F.sort_array(windows), lambda s: let(positions(s), covered))

    bits = F.ceil(F.log2(F.size(words) + 2)).cast("int")
    ones = F.call_function("shiftleft", F.lit(-1).cast("long"), bits)
    return let(ones, lambda high: of(words, high))


def stop_forms() -> list[str]:
    """All stop words, also with a capital."""
    listed = {w for words in STOP_WORDS.values() for w in words.split()}
    return sorted(listed | {w.capitalize() for w in listed})


def measures(text: Column) -> Column:
    """All measures of one text as a struct of longs; a null text has no words."""
    stop = stop_forms()
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        line_counts = let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        )
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.size(F.split(text, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            line_counts.alias("lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
        )

    return let(F.filter(F.split(text, WORD_BREAK), lambda x: x != ""), of)


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_stop_words",
)


def judged(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[Rule, ...] = THRESHOLDS,
    least_words: int = 50,
    most_repeated: int = 50,
    as_column: str = "quality",
) -> DataFrame:
    """``docs`` with a struct of measures, ``failed`` rule names, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` per cent of
    them in repeated three-word windows. ``kept``: not ``base_failed`` and no rule broken.

    A null or empty text has no words and fails the base; repeated rows are judged alike; an empty
    table stays empty; all other columns pass, whatever their names (the struct is one column).
    """
    # A step that filters do not cross: pushed below, a filter on the verdict would compute every measure anew.
    inner = measures(F.col(text)).alias("m")
    taken = evaluated(docs.select(F.struct(*docs.columns).alias("row"), inner))
    m = taken.select(
        "row",
        F.col("m.n_words"), F.col("m.word_chars"), F.col("m.n_symbols"),
        F.col("m.lines.dup").alias("n_dup_lines"), F.col("m.n_repeat_words"),
        F.col("m.lines.n").alias("n_lines"), F.col("m.n_stop_words"),
    )
    base = (F.col("n_words") < least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated
    )
    failed = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    verdict = m.select(
        "row",
        F.struct(
            *MEASURES, base.alias("base_failed"), failed.alias("failed"),
            (~base & (F.size(failed) == 0)).alias("kept"),
        ).alias(as_column),
    )
    return verdict.select("row.*", as_column)


def kept(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    name = "quality"
    while name in docs.columns:
        name += "_"
    return judged(docs, text, as_column=name, **settings).where(F.col(name)["kept"]).drop(name)
