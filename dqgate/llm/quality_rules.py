"""Line-first quality rules.

Each line of a document is judged on its own; lines that fail go, and a document that
loses too much of its text that way is rejected. Everything is one projection: no
shuffle, no Python.

Defined results: a null or empty text has no words and fails the base rules. Blank lines
are neither judged nor kept. Repeated rows are judged each for itself. Only `doc_id`
and `text` are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import SPACE, let, text_or_empty, words

SYMBOLS = "#*$%&|<>"
# A line of prose ends with one of these, perhaps followed by blanks.
TERMINAL = r"""[.!?…:;"'”’»)\]。！？]"""
NAVIGATION = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "next", "previous", "back",
    "search", "contact", "about", "about us", "sitemap", "read more", "share", "top",
)
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "enable javascript", "click here", "subscribe to", "powered by", "licensed under the",
    "released under the", "copyright ©", "lorem ipsum",
)
# Every phrase above holds one of these: fewer searches clear most texts.
STEMS = ("policy", "terms of", "rights reserved", "javascript", "under the", "copyright", "click here",
         "subscribe", "powered by", "lorem")
WINDOW = 5


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 10
    # Largest share, in percent, of words inside repeated five-word windows.
    max_repeat_pct: int = 20
    # Largest share, in percent, of a line's characters that are symbols or doubled marks.
    max_noise_pct: int = 5
    # Largest share, in percent, of the text that failing lines may take along.
    max_lost_pct: int = 50


def _word_windows(w: Column) -> Column:
    """Hash of each five-word window."""
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    return F.when(
        F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window)
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """Number of words inside windows with these (ascending) starts."""
    step = lambda acc, p: F.struct(
        (p + WINDOW).alias("end"),
        (acc["n"] + F.least(F.lit(WINDOW), p + WINDOW - acc["end"])).alias("n"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def _repeat_words(windows: Column) -> Column:
    """Number of words that lie in a window found at least twice."""

    def starts(s: Column) -> Column:
        # Equal windows are neighbours after sorting by hash.
        same = lambda k: (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (
            F.get(s, k)["h"] == F.get(s, k + 1)["h"]
        )
        found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.coalesce(same(k), F.lit(False)))
        return F.array_sort(F.transform(found, lambda k: F.get(s, k)["p"]))

    pairs = F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
        _covered(let(F.sort_array(pairs), starts))
    )


def removed_length(text: Column, pattern: str) -> Column:
    """Number of characters that match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _any(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(or_, [text.contains(p) for p in phrases])


def suspects(text: Column) -> Column:
    """Which rules any line of the text can fail at all: most texts need no closer look."""
    return F.struct(
        text.rlike(r"[#*$%&|<>]|[!?]{2}").alias("noise"),
        _any(F.lower(text), STEMS).alias("phrase"),
    )


def line_passes(line: Column, suspect: Column, rules: QualityRules) -> Column:
    """Punctuation, navigation and boilerplate rules over one line that has a word."""
    noise = removed_length(line, r"[#*$%&|<>]+|[!?]{2,}")
    menu = "|".join(NAVIGATION)
    return (
        (line.endswith(".") | line.rlike(f"{TERMINAL}[{SPACE}]*$"))
        & (~suspect["noise"] | (noise * 100 <= F.length(line) * rules.max_noise_pct))
        & ~line.rlike(f"^(?i)[{SPACE}]*({menu})([{SPACE}]*[|>/·.]*[{SPACE}]*({menu}))*[{SPACE}.|>/·]*$")
        & (~suspect["phrase"] | ~_any(F.lower(line), BOILERPLATE))
    )


def judge(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:  # noqa: B008
    """One row per document: counts, verdicts and the cleaned text."""
    text = text_or_empty("text")
    has_word = lambda line: line.rlike(f"[^{SPACE}]")

    def line_stats(lines: Column) -> Column:
        return let(
            let(suspects(text), lambda s: F.filter(lines, lambda line: line_passes(line, s, rules))),
            lambda good: F.struct(
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                F.size(lines).cast("long").alias("n_lines"),
                F.size(good).cast("long").alias("n_good_lines"),
                F.length(F.array_join(lines, "")).cast("long").alias("n_line_chars"),
                F.length(F.array_join(good, "")).cast("long").alias("n_good_chars"),
                F.array_join(good, "\n").alias("clean_text"),
            ),
        )

    def word_stats(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(_word_windows(w), _repeat_words).cast("long").alias("n_repeat_words"),
        )

    judged = docs.select(
        F.col("doc_id"),
        removed_length(text, r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        let(words(F.col("text")), word_stats).alias("w"),
        let(F.filter(F.split(text, "\n"), has_word), line_stats).alias("l"),
    ).select("doc_id", "n_symbols", "w.*", "l.*")
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")
    )
    lost = F.col("n_line_chars") - F.col("n_good_chars")
    return judged.withColumns(
        {
            "base_failed": base_failed,
            "kept": ~base_failed & (lost * 100 <= F.col("n_line_chars") * rules.max_lost_pct),
        }
    )


def clean(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:  # noqa: B008
    """The documents that are kept, with their lines cleaned; columns as given."""
    packed = docs.select(F.struct("*").alias("doc"), "doc_id", "text")
    kept = _with_row(packed, rules).where("kept")
    fresh = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return kept.select(*[fresh.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def _with_row(packed: DataFrame, rules: QualityRules) -> DataFrame:
    judged = judge(packed.select(F.struct("doc", "doc_id").alias("doc_id"), "text"), rules)
    return judged.select("doc_id.doc", "kept", "clean_text")
