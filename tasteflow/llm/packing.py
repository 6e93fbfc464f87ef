"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

A document's tokens end with a separator.  Whole multiples of the sequence
length become sequences of their own; the tails are dealt by a hash into groups
and each group is packed on its own: the cost of a tail is ``a n + b n^2``
(linear layers plus attention), tails go in descending order to the cheapest
sequence with room, and a tail that fits nowhere whole is cut into the cheapest
gaps.  A group opens as many sequences as its tokens need, so only its last
few tokens are padding.

Scale: tokenising needs no shuffle; the tails' ids (two bytes each when the
vocabulary allows) are shuffled once.  The number of groups follows the row
count, and a task packs its sorted rows in chunks of at most ``chunk``
documents, so a hot group changes neither memory nor result of others.

Defined results: null and empty texts are the separator alone; repeated rows are
packed once each; an empty table gives no pieces.  Texts are tokenised whole, in
segments cut where the vocabulary's splitting pattern always cuts.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls

TAILS = ("key string, doc_id bigint, n bigint, full array<bigint>, tail binary")
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
#: Strings that the vocabulary reads as one id wherever they stand, as its tokenizer does when loaded.
SPECIAL = {"<|endoftext|>": 50256}


class ByteBpe:
    """Byte-level BPE ids of whole texts, from a public rank file.

    The splitting pattern never joins a space between two non-spaces with what
    stands before it, so a very long text is encoded in segments cut there.
    """

    def __init__(self, ranks_path: str, pattern: str, segment: int = 1 << 20, special: dict[str, int] = SPECIAL) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.segment = segment

    def ids(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            end = self._cut(text, at + self.segment)
            parts.append(self.encoding.encode_to_numpy(text[at:end], allowed_special="all"))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)

    @staticmethod
    def _cut(text: str, least: int) -> int:
        """The first place from ``least`` on where a single space stands between non-spaces, else the end."""
        at = text.find(" ", least)
        while 0 < at < len(text) - 1:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
            at = text.find(" ", at + 1)
        return len(text)


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def tokenised(docs: DataFrame, ranks_path: str, pattern: str, length: int, separator: int,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: a key of its values, token count, CRCs of its whole sequences, ids of its tail."""
    rows = docs.select(F.md5(F.concat_ws("\x00", F.col(id_col).cast("string"), F.col(text_col))).alias("key"),
                       F.col(id_col).cast("bigint").alias("doc_id"), blob(text_col).alias("text"))
    small = separator < 1 << 16

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(ranks_path, pattern)
        for batch in calls(batches, "text"):
            n, full, tail = [], [], []
            for text in batch.column(2).to_pylist():
                ids = np.append(bpe.ids(text.decode("utf-8", "replace")), np.uint32(separator)).astype("<u4")
                whole = len(ids) // length * length
                n.append(len(ids))
                full.append([crc(ids[i:i + length]) for i in range(0, whole, length)])
                rest = ids[whole:]
                wide = not small or (len(rest) and int(rest.max()) >= 1 << 16)
                tail.append((b"\x04" if wide else b"\x02") + rest.astype("<u4" if wide else "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())),
                 pa.array(tail, pa.binary())], names=["key", "doc_id", "n", "full", "tail"])

    return rows.mapInArrow(kernel, TAILS)


def tail_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[0] == 4 else "<u2", offset=1).astype("<u4")


@dataclass(frozen=True)
class Cost:
    """Estimated cost of attending over n tokens of one document."""

    linear: float = 1.0
    quadratic: float = 1.0 / 2048

    def of(self, n):
        return self.linear * n + self.quadratic * n * n


def pack(lengths: list[int], length: int, cost: Cost = Cost()) -> list[tuple[int, int, int, int]]:
    """(item, start, n, sequence) pieces: descending items to the cheapest sequence with room, leftovers cut."""
    total = sum(lengths)
    n_seq = -(-total // length)
    room = np.full(n_seq, length, dtype=np.int64)
    spent = np.zeros(n_seq)
    pieces, left = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        if not n:
            continue
        open_ = np.where(room >= n, spent, np.inf)
        s = int(open_.argmin())
        if open_[s] == np.inf:
            left.append(i)
            continue
        room[s] -= n
        spent[s] += cost.of(n)
        pieces.append((i, 0, n, s))
    gaps = sorted((s for s in range(n_seq) if room[s]), key=lambda s: (spent[s], s))
    at = 0
    for i in left:
        start = 0
        while start < lengths[i]:
            s = gaps[at]
            n = min(int(room[s]), lengths[i] - start)
            pieces.append((i, start, n, s))
            room[s] -= n
            start += n
            at += room[s] == 0
    return pieces


def packed(docs: DataFrame, ranks_path: str, pattern: str, length: int = 2048, separator: int = 1,
           id_col: str = "doc_id", text_col: str = "text", group_rows: int = 4096, chunk: int = 8192,
           cost: Cost = Cost()) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    groups = max(1, -(-docs.count() // group_rows))
    tails = tokenised(docs, ranks_path, pattern, length, separator, id_col, text_col).withColumn(
        "group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    dealt = tails.repartition("group").sortWithinPartitions("group", "key")

    def emit(group: int, first: int, rows: list[tuple]) -> tuple[pa.RecordBatch, int]:
        ids = [tail_ids(r[3]) for r in rows]
        out, used = [], first
        for (doc, n, full, _) in rows:
            for k, value in enumerate(full):
                out.append((doc, k * length, length, value, n, (group << 31) + used, 0))
                used += 1
        filled: dict[int, int] = {}
        for i, start, n, s in pack([len(x) for x in ids], length, cost):
            doc, total, full, _ = rows[i]
            out.append((doc, len(full) * length + start, n, crc(ids[i][start:start + n]), total,
                        (group << 31) + used + s, filled.get(s, 0)))
            filled[s] = filled.get(s, 0) + n
        columns = list(zip(*out)) if out else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                 "sequence_id", "offset"]), used + len(filled)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first, rows = None, 0, []
        for batch in batches:
            for g, doc, n, full, tail in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if rows and (g != group or len(rows) >= chunk):
                    result, first = emit(group, first, rows)
                    rows = []
                    yield result
                if g != group:
                    group, first = g, 0
                rows.append((doc, n, full, tail))
        if rows:
            yield emit(group, first, rows)[0]

    return dealt.select("group", "doc_id", "n", "full", "tail").mapInArrow(kernel, PIECES)
