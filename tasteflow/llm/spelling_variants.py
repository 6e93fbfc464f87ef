"""Grouping of spelling variants: words one edit apart, and the common form each rare word leads to.

Asymmetric chunks and grams.  Two words are near if one inserted, deleted or
replaced code point tells them apart.  The shorter word (of ``length`` code
points) contributes two disjoint chunks, its halves; the other contributes its
positional grams of the chunks' lengths.  One edit leaves one of the two chunks
whole, at its place or one further, so near words share a chunk that is a gram
within shift one, the shift being the difference of the lengths.

Narrowing.  Half a word is a weak key: thousands of words begin alike.  The
half that holds the edit is therefore cut in two again by the same rule, until
a part has at most ``PART`` code points (at most ``HALVINGS`` times), and the
join asks for the chunk and the preserved parts of the other half together:
everything but the part with the edit.  No near pair is lost by it.

Verification.  Joined words agree outside one part, so only that part is
compared.  A replacement lies in exactly one part.  An insertion is counted in
the part where the two words first differ, so every pair appears once.

Forms.  A word's form is its near word of largest count, if that is ``ratio``
times the word's own; counts grow along forms, so following them ends, after at
most log(largest count) / log(ratio) steps, which pointer doubling covers.

Scale: runs are counted within each task before any shuffle.  Only distinct
words are joined, as equi-joins that split hot keys; pairs are reduced per word
within each task.  Nothing passes through the driver or Python.

Defined results: null texts have no words; a null id writes as the empty text;
repeated rows count again; an empty table gives no rows; very long runs are
words like any other.  Words are compared by their UTF-8 bytes, which is
code-point order.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import written

LETTERS = "A-Za-z\\u00C0-\\u00FF"
PART = 3        # code points of the part that holds the edit, at most, while HALVINGS allow
HALVINGS = 4


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                min_count: int = 2, slip: int | None = None) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased, of at least ``min_length`` code points and ``min_count`` uses.

    ``slip``: where the checksum of ``<id>:<run>`` is a multiple of it, the run loses the code point at that
    checksum modulo its length (typing slips, made up from the data).
    """
    found = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[{LETTERS}]{{{min_length},}}"),
                                       F.lit(0))).alias("run"))
    found = found.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("word"))
    if slip:
        check = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        found = found.select("word", check.alias("h"), F.length("word").alias("size"))
        at = F.pmod(F.col("h"), F.col("size")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2, F.col("size")))
        found = found.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("word")).alias("word")).where(
            F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _parts(length: Column) -> Column:
    """In how many parts a word of that length is halved: 2, 4, 8 or 16."""
    parts = F.lit(1 << HALVINGS)
    for k in range(HALVINGS - 1, 0, -1):
        parts = F.when(length <= PART << k, F.lit(1 << k)).otherwise(parts)
    return parts


def _side(words: DataFrame, shift: int, min_length: int) -> DataFrame:
    """(length, lo, rest, gap, n): each word without one part, the one from ``lo``, cut as its shorter partner would be.

    Shift 0 gives a word's own chunks and parts; shift 1 the grams that a word shorter by one can share.
    """
    length = F.length("word") - shift
    cut = words.where(length >= min_length).select("word", "n", length.alias("length"), _parts(length).alias("parts"))
    cut = cut.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    bound = lambda part: F.expr(f"length * {part} div parts").cast("int")
    cut = cut.select("word", "n", "length", bound("part").alias("lo"), (bound("(part + 1)") + shift).alias("hi"))
    return cut.select("length", "lo", F.concat(F.substr("word", F.lit(1), F.col("lo")),
                                               F.substr("word", F.col("hi") + 1, F.length("word"))).alias("rest"),
                      F.substr("word", F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("gap"), "n")


def near_pairs(words: DataFrame, min_length: int = 2) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words one edit apart, once.

    ``words`` (word, n) holds each word once, of ``min_length`` code points or more; two at least, for two chunks.
    """
    if min_length < 2:
        raise ValueError("words of one code point have no two chunks")
    key = ["length", "lo", "rest"]
    chunks = _side(words, 0, min_length).select(*key, F.col("gap").alias("a_gap"), F.col("n").alias("a_n"))

    def joined(shift: int) -> DataFrame:
        grams = _side(words, shift, min_length).select(*key, F.col("gap").alias("b_gap"), F.col("n").alias("b_n"))
        last = F.col("lo") + F.length("a_gap") == F.col("length")
        first_here = (last | ~F.startswith("b_gap", "a_gap")) if shift else F.col("a_gap") < F.col("b_gap")
        found = chunks.join(grams, key).where(first_here & (F.levenshtein("a_gap", "b_gap", 1) == 1))
        head, tail = F.substr("rest", F.lit(1), F.col("lo")), F.substr("rest", F.col("lo") + 1, F.length("rest"))
        return found.select(F.concat(head, "a_gap", tail).alias("a"), "a_n", F.concat(head, "b_gap", tail).alias("b"), "b_n")

    return joined(0).unionByName(joined(1))


def with_forms(words: DataFrame, ratio: int = 10, min_length: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n): near words counted, and the common one among them, if any."""
    pairs = near_pairs(words, min_length).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("p")).select("p.*")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.max("other_n").alias("top"),
                                     F.min(F.struct(-F.col("other_n"), "other")).alias("best"))
    common = F.col("top") >= F.col("n") * ratio
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(common, F.col("best.other")).alias("form"), F.when(common, F.col("top")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: the last one reached, by pointer doubling."""
    at = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = at.join(ahead, "root")
        if further.isEmpty():
            return at
        at = written(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
             ratio: int = 10, slip: int | None = None) -> DataFrame:
    """Per word: ``form`` and ``root`` (the word itself without a form), ``n``, ``n_near`` and ``form_n``."""
    words = written(word_counts(docs, id_col, text_col, min_length, min_count, slip), "spelling-words")
    forms = written(with_forms(words, ratio, min_length), "spelling-forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
