"""Benchmark decontamination with one Aho-Corasick automaton.

The test items' normalised words are cut into windows; every distinct word gets
a few letters, the digits of its number, so a window is a short string and a
document becomes one (with a filler for words that no item has).  Each digit
place has letters of its own, so a window matches at whole words only, and a node
of the automaton has at most ``BASE`` children, however many words there are.  The
automaton scans that string once; hits are word positions, which map back to
byte offsets of the original text.

Documents never move: one pass, no shuffle.  The items reach the tasks as a
broadcast of a checked size: they are dealt into as many blocks as keep each
below ``block_words``, and beyond one block the documents are scanned block by
block and the hits merged.

Normalised: ASCII letters lower-cased; a word is a run of ASCII letters,
digits and non-ASCII characters.

Defined results: null and empty texts have no words and no hits; items without
words never match; items sharing an id count once; a null item id is written
as the empty string; an empty benchmark leaves every document clean; repeated
documents are judged independently.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls

_WORD_BYTES = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Byte table: upper case to lower case, everything outside words to a space.
NORMAL = bytes(b if b in set(_WORD_BYTES) else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
FIRST_LETTER = 0x1000  # letters are code points from here on; the filler is below
FILLER = "\x01"
BASE = 512              # letters of a digit place


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def word_offsets(text: bytes) -> list[tuple[int, int]]:
    """Start and end byte of each normalised word in the original text."""
    return [m.span() for m in re.finditer(rb"\S+", text.translate(NORMAL))]


class Windows:
    """The automaton over one block of items: (item id, text bytes) pairs."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, base: int = BASE) -> None:
        split = [(item, normal_words(text)) for item, text in items]
        words = sorted({w for _, ws in split for w in ws})
        self.places = 1
        while base ** self.places < len(words):
            self.places += 1
        self.letters = {w: "".join(chr(FIRST_LETTER + p * base + i // base ** p % base) for p in range(self.places))
                        for i, w in enumerate(words)}
        owners: dict[str, set[str]] = {}
        for item, ws in split:
            coded = self._coded(ws)
            for i in range(max(len(ws) - window + 1, 1) if ws else 0):
                owners.setdefault(coded[i * self.places:(i + window) * self.places], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in owners.items():
            self.automaton.add_word(pattern, (len(pattern) // self.places, tuple(sorted(ids))))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def _coded(self, words: list[bytes]) -> str:
        """The letters of each word, the filler for one that no item has."""
        get = self.letters.get
        other = FILLER * self.places
        return "".join([get(w, other) for w in words])

    def hits(self, words: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        """(first word, word after the last, item ids) of each occurrence."""
        if self.empty:
            return []
        found = (((end + 1) // self.places, n, ids) for end, (n, ids) in self.automaton.iter(self._coded(words)))
        return [(end - n, end, ids) for end, n, ids in found]


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> list[DataFrame]:
    """The items dealt by a hash into blocks of about ``block_words`` words (measured, not assumed)."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             blob(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * block_words)))  # about six bytes a word
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _scan(docs: DataFrame, carried: list[str], benchmark: DataFrame, text_col: str, id_col: str,
          item_text_col: str, window: int, block_words: int) -> DataFrame:
    """The carried columns as ``row``, then ``n_words``, ``hit_words``, ``hit_bytes``, ``hit_items``."""
    span = "array<struct<start:bigint,end:bigint>>"
    out = docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), F.lit(0).cast("bigint").alias("n_words"),
                      F.array().cast(span).alias("hit_words"), F.array().cast(span).alias("hit_bytes"),
                      F.array().cast("array<string>").alias("hit_items"), blob(text_col).alias("text"))
    dealt = blocks(benchmark, id_col, item_text_col, block_words)
    for k, block in enumerate(dealt):
        shared = docs.sparkSession.sparkContext.broadcast([(r.item, bytes(r.text)) for r in block.collect()])
        kept = len(out.columns) - (k + 1 == len(dealt))  # only a further block needs the text again

        def kernel(batches: Iterator[pa.RecordBatch], shared=shared, kept=kept) -> Iterator[pa.RecordBatch]:
            windows = Windows(shared.value, window)
            for batch in calls(batches, "text"):
                columns = [batch.column(i) for i in range(batch.num_columns)]
                n_words, spans, places, found = [], [], [], []
                for old, old_bytes, old_items, text in zip(*(c.to_pylist() for c in columns[2:])):
                    words = normal_words(text)
                    n_words.append(len(words))
                    hits = windows.hits(words)
                    if hits:
                        merged = _merge([(a, b) for a, b, _ in hits] + [(s["start"], s["end"]) for s in old])
                        at = word_offsets(text)
                        old = [{"start": a, "end": b} for a, b in merged]
                        old_bytes = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in merged]
                        old_items = sorted({i for _, _, ids in hits for i in ids}.union(old_items))
                    spans.append(old)
                    places.append(old_bytes)
                    found.append(old_items)
                columns[1] = pa.array(n_words, pa.int64())
                for i, values in enumerate((spans, places, found), 2):
                    columns[i] = pa.array(values, columns[i].type)
                yield pa.RecordBatch.from_arrays(columns[:kept], names=batch.schema.names[:kept])

        out = out.select(*out.columns).mapInArrow(kernel, out.select(*out.columns[:kept]).schema)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id",
         item_text_col: str = "text", window: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """The documents as struct ``row``, then ``n_words``, ``hit_words`` array<struct<start,end>> (merged word
    spans), ``hit_bytes`` (the same as bytes of the original text) and ``hit_items`` array<string>."""
    return _scan(docs, docs.columns, benchmark, text_col, id_col, item_text_col, window, block_words)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window; same columns."""
    return scan(docs, benchmark, **options).where(F.size("hit_items") == 0).select("row.*")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           window: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """Per document: words, words inside an occurring window, items with one, their ids' digest, the verdict."""
    found = _scan(docs, [id_col], benchmark, text_col, "item_id", "text", window, block_words)
    return found.select(
        f"row.{id_col}", "n_words",
        F.aggregate("hit_words", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_items") > 0).alias("contaminated"))
