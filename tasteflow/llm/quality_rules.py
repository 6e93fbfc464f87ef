"""Line-first quality rules, with DataFrame expressions only.

Each line is judged first.  Punctuation: symbol-heavy and shouted lines, lines
of marks alone and short lines that break off with an ellipsis go.  Navigation:
menu bars go, and in any script runs of short lines without a sentence end; a
heading on its own stays.  Boilerplate: short lines with a known phrase go.  A
document is rejected when it fails the base rules (too short, too repetitive) or
when the removed lines held too large a share of its words.  All work is one projection per row: no
shuffle, no Python, memory bounded by one text.

Defined results: null and empty texts have no words, so they fail the base
rules and are rejected; repeated rows are judged independently; other columns
are passed through untouched whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import let, words

#: Characters counted as symbols, and those that separate menu entries.
SYMBOLS = "#*$%&|<>"
BARS = "|"
#: Lower-case phrases that mark a boilerplate line.
PHRASES = ("all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use",
           "javascript is disabled", "enable javascript", "click here to", "sign up for our newsletter", "lorem ipsum")

#: A letter or digit of any script; what ends a teaser; what ends a sentence or clause, maybe closed by a quote.
SPEECH = r"[\p{L}\p{N}]"
TEASER = r"(\.\.\.|…)[\x20\x09-\x0D]*\z"
ENDING = r"[.!?…,;:。！？；：、।؟۔][\"'”’»)\]]*[\x20\x09-\x0D]*\z"


@dataclass(frozen=True)
class Rules:
    """Limits, as integer percentages so that every engine decides alike."""

    min_words: int = 50
    max_repeat_pct: int = 50
    line_symbols_pct: int = 50      # symbol characters per 100 words of a line
    line_bars_pct: int = 25         # menu bars per 100 words of a line
    line_shouts_pct: int = 100      # exclamation marks per 100 words of a line, from two marks on
    phrase_max_words: int = 30      # a line with a boilerplate phrase and at most this many words is boilerplate
    teaser_max_words: int = 12      # a line of at most this many words that ends in an ellipsis is a teaser
    link_max_words: int = 4         # a line of at most this many words without a sentence end looks like a link
    menu_lines: int = 3             # so many such lines in a row are a menu
    max_lost_pct: int = 30          # share of a document's words in removed lines


def _count(text: Column, characters: str) -> Column:
    """Occurrences of any of ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def judged_lines(text: Column, rules: Rules = Rules()) -> Column:
    """array<struct<line, n, symbols, bad, link>>: each \\n-split line, its words and symbols, whether a rule removes it."""

    def marks(line: Column, n: Column, marked: Column) -> Column:
        """``marked``: symbols and shouts together; most lines have none and need no further pass."""
        symbols = F.when(marked == 0, 0).otherwise(_count(line, SYMBOLS))
        return let(symbols, lambda s: F.struct(
            line.alias("line"), n.alias("n"), s.alias("symbols"),
            ((n > 0) & (
                (s * 100 > n * rules.line_symbols_pct)
                | ((s > 0) & (_count(line, BARS) * 100 >= n * rules.line_bars_pct) & F.contains(line, F.lit(BARS)))
                | ((marked - s >= 2) & ((marked - s) * 100 >= n * rules.line_shouts_pct))
                | ((n <= rules.phrase_max_words) & F.lower(line).rlike("|".join(PHRASES)))
                | ((n <= rules.teaser_max_words) & line.rlike(TEASER))
                | ~line.rlike(SPEECH)
            )).alias("bad"),
            ((n > 0) & (n <= rules.link_max_words) & ~line.rlike(ENDING)).alias("link")))

    def judge(line: Column) -> Column:
        return let(F.size(words(line)), lambda n: let(
            _count(line, SYMBOLS + "!"), lambda marked: marks(line, n, marked)))

    def menus(lines: Column) -> Column:
        """Links in runs are bad too; most texts have too few links and need no second pass."""
        run = range(rules.menu_lines)

        def linked(i: Column) -> Column:
            link = {k: F.coalesce(F.get(lines, i + k)["link"], F.lit(False)) for k in range(-run[-1], run[-1] + 1)}
            return reduce(or_, [reduce(and_, [link[k - back] for k in run]) for back in run])

        marked = F.transform(lines, lambda x, i: F.struct(
            x["line"].alias("line"), x["n"].alias("n"), x["symbols"].alias("symbols"),
            (x["bad"] | (x["link"] & linked(i))).alias("bad"), x["link"].alias("link")))
        return F.when(F.size(F.filter(lines, lambda x: x["link"])) < rules.menu_lines, lines).otherwise(marked)

    return let(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), judge), menus)


def repeated_words(text_words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Sorted 64-bit window hashes give the repeated ones.  The windows that hold
    them are found by a plain lookup while they are few, else by sorting the
    windows with their positions; the covered words are then counted from the
    gaps between the positions.  n log n in the length of the text.
    """

    def hashes(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        return F.transform(F.arrays_zip(*[F.slice(w, k, n).alias(f"w{k}") for k in (1, 2, 3)]), lambda z: F.xxhash64(z))

    def twice(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.array_distinct(
            F.filter(s, lambda x, k: F.coalesce(x == F.get(s, k - 1), F.lit(False)))))

    def by_lookup(h: Column, found: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(found, x), i)), lambda i: i.isNotNull())

    def by_sorting(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b)

    def count(h: Column, found: Column) -> Column:
        return F.when(F.size(found) == 0, F.lit(0).cast("bigint")).when(
            F.size(found) <= 24, let(by_lookup(h, found), covered)).otherwise(let(by_sorting(h), covered))

    return let(text_words, lambda w: let(hashes(w), lambda h: let(twice(h), lambda found: count(h, found))))


def scores(text: Column, rules: Rules = Rules()) -> Column:
    """Struct of a text's counts, its verdict and its cleaned form."""
    text = F.coalesce(text, F.lit(""))
    lines = judged_lines(text, rules)

    def of(w: Column, n_words: Column, n_repeat: Column, ls: Column) -> Column:
        real = F.filter(ls, lambda x: x["n"] > 0)
        lost = F.aggregate(ls, F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["bad"], x["n"]).otherwise(0))
        base_failed = (n_words < rules.min_words) | (n_repeat * 100 > n_words * rules.max_repeat_pct)
        return F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.aggregate(ls, F.lit(0).cast("bigint"), lambda a, x: a + x["symbols"]).alias("n_symbols"),
            (F.size(real) - F.size(F.array_distinct(F.transform(real, lambda x: x["line"])))).cast("bigint")
            .alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            F.size(F.filter(ls, lambda x: x["bad"])).cast("bigint").alias("n_bad_lines"),
            lost.alias("n_lost_words"),
            (~base_failed & (lost * 100 <= n_words * rules.max_lost_pct)).alias("kept"),
            F.array_join(F.transform(F.filter(ls, lambda x: ~x["bad"]), lambda x: x["line"]), "\n").alias("cleaned"),
        )

    return let(words(text), lambda w: let(F.size(w).cast("bigint"), lambda n: let(
        repeated_words(w), lambda r: let(lines, lambda ls: of(w, n, r, ls)))))


def _once(struct: Column) -> Column:
    """The struct's fields as columns of a generator, which no later filter or projection evaluates again."""
    return F.inline(F.array(struct))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed``, ``kept`` and the ``cleaned`` text."""
    return docs.select(F.col(id_col), _once(scores(F.col(text_col), rules)))


def clean(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
          rules: Rules = Rules()) -> DataFrame:
    """The kept documents, same columns, each text without its removed lines (``length_col`` follows the text)."""
    columns = docs.columns
    judged = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"),
                         _once(scores(docs[text_col], rules))).where("kept")
    out = []
    for c in columns:
        if c == text_col:
            out.append(F.col("cleaned").alias(c))
        elif c == length_col:
            out.append(F.when(F.col("n_bad_lines") == 0, F.col(f"row.`{c}`"))
                       .otherwise(F.length("cleaned").cast(docs.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return judged.select(*out)
