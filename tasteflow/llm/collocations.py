"""Phrase collocations, mined with counting quotient filters.

1. Tokens.  A task lower-cases A-Z, cuts the texts into pieces and words and
   writes them as chunks: numbers into the chunk's own word list, and that list
   with its counts.  Texts are read once.
2. Word ids.  The lists are summed over all chunks by (language, word).  A phrase
   found ``min_count`` times has words found as often, so only those words get
   an id; ids are dense, one per language and word, so an id implies its
   language.  Each chunk is joined with the ids of its own words.
3. Filters.  A task packs each run of 2 and 3 ids that lies in a piece into
   one number and permutes it invertibly (Feistel rounds).  The permuted number
   is cut into a quotient and the full remainder; a counting quotient filter
   keeps the sorted remainders of each quotient and exact counters, and nothing
   is lost: remainder and quotient give the words back.
4. Merge.  Filters are cut at the quotients' leading bits into shards, a few
   bits a pass, and the sorted sections of a shard are merged into one filter.
   Phrases of at least ``min_count`` occurrences leave the last one, decoded.
5. Scores.  Each cut of a phrase compares its count with those of its two parts, in
   exact decimal arithmetic; parts are as frequent as the phrase, so all are there.

Scale: ``Sizes`` bounds the tokens and words of a chunk, the n-grams of a task's
filter and those of a shard; a hot phrase is one entry of each filter, and the
permutation spreads all phrases evenly.  No word list is broadcast; the driver sees one number per
partition of the word table and one total.

Defined results: a null text has no words; a null language is ``und``; repeated rows
count again; a piece shorter than a phrase has none; an empty table gives no rows;
a very long text spans chunks, with the phrases across the seam counted.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls, written
from tasteflow.operators.topk import top_k_per_key

CALL = 2 << 20          # bytes of text handled at once
MAX_BITS = 42           # of a word id: three ids and their halves fit two 64-bit numbers
UNKNOWN = "und"
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(string.ascii_uppercase.encode() + b"\t" + _SEPARATORS,
                         string.ascii_lowercase.encode() + b" " + b"\n" * len(_SEPARATORS))
_KEYS = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_CUT = re.compile(rb"[ \n]")
_CHUNK = "chunk string, lang string, context int, size bigint, tokens binary, words array<string>, counts array<bigint>"
_SECTION = "n int, shard bigint, packed binary"
_FOUND = "n int, w1 bigint, w2 bigint, w3 bigint, a bigint"


@dataclass(frozen=True)
class Sizes:
    """What a task holds at once; results do not depend on it."""

    chunk_tokens: int = 1 << 19
    chunk_words: int = 1 << 17
    shard_tokens: int = 1 << 20
    flush: int = 1 << 20  # n-grams of one length that a task gathers into a filter
    step: int = 10        # bits by which one pass cuts filters into shards
    slice: int = 1 << 20  # bytes of one text


# ---- counting quotient filters ----------------------------------------------------------

def _mixed(x: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    x = (x + key) * _KEYS[1]
    x = (x ^ (x >> np.uint64(31))) * _KEYS[2]
    return (x ^ (x >> np.uint64(29))) >> np.uint64(64 - bits)


class Permutation:
    """An invertible map of numbers of ``high`` + ``low`` bits (each 1 to 63), kept as two halves."""

    def __init__(self, high: int, low: int) -> None:
        self.high, self.low = high, low

    def forth(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i in range(0, len(_KEYS), 2):
            a = a ^ _mixed(b, _KEYS[i], self.high)
            b = b ^ _mixed(a, _KEYS[i + 1], self.low)
        return a, b

    def back(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i in reversed(range(0, len(_KEYS), 2)):
            b = b ^ _mixed(a, _KEYS[i + 1], self.low)
            a = a ^ _mixed(b, _KEYS[i], self.high)
        return a, b


class PackedNgrams:
    """Packs ``n`` word ids of ``bits`` bits into one permuted number in two halves, and back."""

    def __init__(self, n: int, bits: int) -> None:
        if n not in (2, 3) or not 1 <= bits <= MAX_BITS:
            raise ValueError(f"{n} words of {bits} bits")
        self.n, self.bits = n, bits
        self.split = 0 if n == 2 else bits // 2  # bits of the middle word that go to the low half
        self.halves = (bits * (n - 1) - self.split, bits + self.split)
        self.permutation = Permutation(*self.halves)

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids = [i.astype(np.uint64) for i in ids]
        if self.n == 2:
            return self.permutation.forth(ids[0], ids[1])
        cut, rest = np.uint64(self.split), np.uint64(self.bits - self.split)
        high = (ids[0] << rest) | (ids[1] >> cut)
        low = ((ids[1] & np.uint64((1 << self.split) - 1)) << np.uint64(self.bits)) | ids[2]
        return self.permutation.forth(high, low)

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        high, low = self.permutation.back(high, low)
        if self.n == 2:
            return [high, low]
        cut, rest, bits = np.uint64(self.split), np.uint64(self.bits - self.split), np.uint64(self.bits)
        middle = ((high & np.uint64((1 << (self.bits - self.split)) - 1)) << cut) | (low >> bits)
        return [high >> rest, middle, low & np.uint64((1 << self.bits) - 1)]


def _as_bytes(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(raw: bytes, at: int, n: int, width: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
    return wide.view("<u8").reshape(n)


def _runs(bits: tuple[int, int], high: np.ndarray, low: np.ndarray, counts: np.ndarray | None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers with summed counts."""
    if sum(bits) <= 64 and counts is None:  # both halves in one number: a plain sort
        cut = np.uint64(bits[1])
        whole, sums = np.unique((high << cut) | low, return_counts=True)
        return whole >> cut, whole & np.uint64((1 << bits[1]) - 1), sums
    order = np.argsort((high << np.uint64(bits[1])) | low, kind="stable") if sum(bits) <= 64 else np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) if len(high) else np.zeros(0, np.int64)
    if counts is None:
        sums = np.diff(np.r_[first, len(high)])
    else:
        sums = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    return high[first], low[first], sums


class QuotientFilter:
    """Exact counters of numbers of ``high`` + ``low`` bits, ``quotient`` leading bits of which are not stored.

    Entries are sorted by (quotient, remainder).  As in a quotient filter, one
    bit per quotient tells whether it has entries and one bit per entry ends its run;
    the remainder is kept whole.  Counters take one byte up to 254, eight more beyond.
    Here ``high`` and ``low`` are the sorted halves that the bits stand for, of ``bits`` bits each.
    """

    def __init__(self, bits: tuple[int, int], high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> None:
        self.bits, self.high, self.low, self.counts = bits, high, low, counts

    @classmethod
    def counted(cls, bits: tuple[int, int], high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None
                ) -> QuotientFilter:
        """The filter of unsorted numbers, each counted once (or ``counts`` times)."""
        return cls(bits, *_runs(bits, high, low, counts))

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the sums of the counters."""
        return cls.counted(filters[0].bits, *(np.concatenate([getattr(f, x) for f in filters]) for x in ("high", "low", "counts")))

    def sections(self, shard_bits: int) -> Iterator[tuple[int, bytes]]:
        """(shard, bytes) of the entries with the same ``shard_bits`` leading bits."""
        shard = self.high >> np.uint64(self.bits[0] - shard_bits) if shard_bits else np.zeros(len(self.high), np.uint64)
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
        for at, end in zip(first, np.r_[first[1:], len(shard)]):
            part = QuotientFilter(self.bits, self.high[at:end], self.low[at:end], self.counts[at:end])
            yield int(shard[at]), part.dump(shard_bits)

    def dump(self, shard_bits: int) -> bytes:
        """The bytes of a filter whose numbers share their ``shard_bits`` leading bits."""
        high_bits, low_bits = self.bits
        n = len(self.high)
        free = high_bits - shard_bits
        quotient_bits = min(free, max(0, n.bit_length() - 1))
        rest = np.uint64(free - quotient_bits)
        inner = self.high & np.uint64((1 << free) - 1)
        quotient = (inner >> rest).astype(np.int64)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotient] = True
        ends = np.r_[quotient[1:] != quotient[:-1], True] if n else np.zeros(0, bool)
        large = self.counts >= 255
        counters = np.where(large, 255, self.counts).astype(np.uint8)
        head = np.array([n, quotient_bits, int(self.high[0]) >> free if n else 0], "<u8").tobytes()
        return b"".join([
            head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
            _as_bytes(inner & np.uint64((1 << int(rest)) - 1), -(-int(rest) // 8)), _as_bytes(self.low, -(-low_bits // 8)),
            counters.tobytes(), self.counts[large].astype("<i8").tobytes()])

    @classmethod
    def load(cls, raw: bytes, bits: tuple[int, int], shard_bits: int) -> QuotientFilter:
        high_bits, low_bits = bits
        n, quotient_bits, shard = (int(x) for x in np.frombuffer(raw, "<u8", 3))
        free = high_bits - shard_bits
        rest, at = free - quotient_bits, 24
        size = -(-(1 << quotient_bits) // 8)
        occupied = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, size, at))[:1 << quotient_bits])
        at += size
        ends = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), at))[:n]
        at += -(-n // 8)
        run = np.cumsum(ends) - ends  # the run an entry belongs to
        width = -(-rest // 8)
        high = _from_bytes(raw, at, n, width)
        at += n * width
        low = _from_bytes(raw, at, n, -(-low_bits // 8))
        at += n * -(-low_bits // 8)
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        large = counts == 255
        counts[large] = np.frombuffer(raw, "<i8", int(large.sum()), at + n)
        quotient = occupied[run].astype(np.uint64) if n else np.zeros(0, np.uint64)
        return cls(bits, high | (quotient << np.uint64(rest)) | np.uint64(shard << free), low, counts)


# ---- tokens and word ids -------------------------------------------------------------------

class _Numbers(dict):
    """Numbers of words in order of appearance; 0 ends a piece, 1 is no word."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class _Chunk:
    """Tokens of one language gathered by a task; the first ``context`` ones repeat the end of the chunk before."""

    def __init__(self, context: list[bytes]) -> None:
        self.numbers, self.context = _Numbers(), len(context)
        self.parts = [np.array([self.numbers[w] for w in context], np.int32)]
        self.size = 0

    def add(self, text: bytes) -> None:
        tokens = text.replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(found[found != 1])
        self.size += len(self.parts[-1])

    def full(self, sizes: Sizes) -> bool:
        return self.size > sizes.chunk_tokens or len(self.numbers) > sizes.chunk_words

    def tail(self) -> list[bytes]:
        """The last words of an unfinished piece that phrases may still begin in."""
        last = np.concatenate(self.parts[-3:])[-2:].tolist()
        last = last[last.index(0) + 1:] if 0 in last else last
        last = last[last.index(0) + 1:] if 0 in last else last
        words = list(self.numbers)
        return [words[t] for t in last]

    def row(self, name: str, lang: str) -> pa.RecordBatch:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens[self.context:], minlength=len(self.numbers))[2:]
        words = [w.decode() for w in list(self.numbers)[2:]]
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([lang]), pa.array([self.context], pa.int32()), pa.array([int(counts.sum())]),
             pa.array([tokens.tobytes()], pa.binary()), pa.array([words], pa.list_(pa.string())),
             pa.array([counts], pa.list_(pa.int64()))],
            names=["chunk", "lang", "context", "size", "tokens", "words", "counts"])


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """A text in slices that end before a blank or separator, so that no word is cut."""
    at = 0
    while len(text) - at > size and (spot := _CUT.search(text, at + size)):
        yield text[at:spot.start()]
        at = spot.start()
    yield text[at:]


def chunked(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """Chunks of one language each: token numbers (0 ends a piece), the words they number from 2 on, and their counts."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, _Chunk] = {}

        def send(lang: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return held.pop(lang).row(f"{task}-{made}", lang)

        for batch in calls(batches, "text", CALL):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _slices(text.translate(_TABLE), sizes.slice):
                    chunk = held.setdefault(lang, _Chunk([]))
                    chunk.add(part)
                    if chunk.full(sizes):
                        context = chunk.tail()
                        yield send(lang)
                        held[lang] = _Chunk(context)
                held[lang].parts.append(np.zeros(1, np.int32))
            while (sum(c.size for c in held.values()) > 2 * sizes.chunk_tokens
                   or sum(len(c.numbers) for c in held.values()) > 2 * sizes.chunk_words):
                yield send(max(held, key=lambda k: held[k].size))
        for lang in list(held):
            yield send(lang)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), blob(text_col).alias("text"))
    return rows.mapInArrow(kernel, _CHUNK)


def word_ids(chunks: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, n, id): words of at least ``min_count`` uses in their language, numbered densely from 0."""
    uses = chunks.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
    frequent = uses.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    stored = written(frequent.withColumn("serial", F.monotonically_increasing_id()), "collocation-words")
    part, place = F.shiftright("serial", 33), F.col("serial").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("size"))  # a row per partition
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return written(stored.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "lang", "word", "n", (F.col("offset") + place).alias("id")), "collocation-ids")


# ---- counting ----------------------------------------------------------------------------------

def _chunk_ids(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """(context, tokens, at, id) per chunk: ``id[k]`` is the id of the chunk's word number ``at[k]``."""
    uses = chunks.select("chunk", "lang", F.posexplode("words").alias("pos", "word"))
    mine = uses.join(ids.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(
        F.collect_list(F.struct(F.col("pos").alias("pos"), F.col("id").alias("id"))).alias("known"))
    return chunks.select("chunk", "context", "tokens").join(mine, "chunk").select(
        "context", "tokens", F.col("known.pos").alias("at"), F.col("known.id").alias("id"))


def _ngrams(g: np.ndarray, n: int, context: int, packer: PackedNgrams) -> tuple[np.ndarray, np.ndarray]:
    """Permuted n-grams of a chunk; ``g`` holds id + 1, or 0 where no phrase can pass."""
    size = len(g) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    inside = np.ones(size, bool)
    for i in range(n):
        inside &= g[i:i + size] > 0
    inside[:max(0, context - n + 1)] = False  # counted in the chunk before
    at = np.flatnonzero(inside)
    return packer.pack([g[at + i] - 1 for i in range(n)])


def _sections(n: int, filter_: QuotientFilter, shard_bits: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for shard, raw in filter_.sections(shard_bits):
        held.append((n, shard, raw))
        size += len(raw)
        if size > 8 << 20:
            yield _section_batch(held)
            held, size = [], 0
    if held:
        yield _section_batch(held)


def _section_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    n, shard, packed = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(shard, pa.int64()), pa.array(packed, pa.binary())],
                                      names=["n", "shard", "packed"])


def _counted(rows: DataFrame, packers: dict[int, PackedNgrams], shard_bits: int, flush: int) -> DataFrame:
    """Sections of each task's filters."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in packers}
        sizes = dict.fromkeys(packers, 0)

        def send(n: int) -> Iterator[pa.RecordBatch]:
            high, low = (np.concatenate(x) for x in zip(*held[n]))
            held[n], sizes[n] = [], 0
            yield from _sections(n, QuotientFilter.counted(packers[n].halves, high, low), shard_bits)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                tokens = np.frombuffer(row.column(1)[0].as_py(), np.int32)
                known = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
                known[np.asarray(row.column(2)[0].values) + 2] = np.asarray(row.column(3)[0].values) + 1
                g = known[tokens]
                for n, packer in packers.items():
                    high, low = _ngrams(g, n, row.column(0)[0].as_py(), packer)
                    held[n].append((high, low))
                    sizes[n] += len(high)
                    if sizes[n] > flush:
                        yield from send(n)
        for n in packers:
            if sizes[n]:
                yield from send(n)

    return rows.mapInArrow(kernel, _SECTION)


def _recut(rows: DataFrame, packers: dict[int, PackedNgrams], from_bits: int, to_bits: int, flush: int) -> DataFrame:
    """Sections of a shard merged and cut at more bits: memory holds ``flush`` entries, however large a shard is."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, None
        for batch in batches:
            for n, shard, raw in zip(*(batch.column(i) for i in range(3))):
                mine = (n.as_py(), shard.as_py())
                if held and (mine != key or size > flush):
                    yield from _sections(key[0], QuotientFilter.merged(held), to_bits)
                    held, size = [], 0
                key = mine
                held.append(QuotientFilter.load(raw.as_py(), packers[key[0]].halves, from_bits))
                size += len(held[-1].counts)
        if held:
            yield from _sections(key[0], QuotientFilter.merged(held), to_bits)

    return rows.repartition("n", "shard").sortWithinPartitions("n", "shard").mapInArrow(kernel, _SECTION)


def phrase_counts(chunks: DataFrame, ids: DataFrame, min_count: int, sizes: Sizes = Sizes()) -> DataFrame:
    """(n, w1, w2, w3, a): runs of 2 and 3 word ids (w3 null for 2) that occur ``min_count`` times or more in pieces."""
    bits = max(1, ids.count().bit_length())
    total = chunks.agg(F.sum("size")).first()[0] or 0
    packers = {n: PackedNgrams(n, bits) for n in (2, 3)}
    shard_bits = min((total // sizes.shard_tokens).bit_length(), bits)  # a number's high half has ``bits`` bits at least

    done = min(sizes.step, shard_bits)
    rows = _counted(_chunk_ids(chunks, ids), packers, done, sizes.flush)
    while done < shard_bits:
        more = min(done + sizes.step, shard_bits)
        rows, done = _recut(rows, packers, done, more, sizes.flush), more

    def merge(table: pa.Table) -> pa.Table:
        n = table["n"][0].as_py()
        packer = packers[n]
        whole = QuotientFilter.merged([QuotientFilter.load(raw.as_py(), packer.halves, done) for raw in table["packed"]])
        often = whole.counts >= min_count
        ids_ = packer.unpack(whole.high[often], whole.low[often])
        columns = [pa.array(x.astype(np.int64)) for x in ids_] + [pa.nulls(int(often.sum()), pa.int64())] * (3 - n)
        return pa.table([pa.array(np.full(int(often.sum()), n, np.int32)), *columns, pa.array(whole.counts[often])],
                        names=["n", "w1", "w2", "w3", "a"])

    return rows.groupBy("n", "shard").applyInArrow(merge, _FOUND)


# ---- scores ------------------------------------------------------------------------------------

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly; counts up to 1e15."""
    exact = lambda c: c.cast("decimal(16,0)")
    top = (exact(a) * exact(a)).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (exact(left) * exact(right)).cast("decimal(38,0)"))


def scored(found: DataFrame, ids: DataFrame, share: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one with ``share`` percent of their count holds.

    ``found``: a stored table of :func:`phrase_counts`.
    """
    word = lambda i: ids.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("n").alias(f"n{i}"),
                                *([F.col("lang")] if i == 1 else []))
    pairs = found.where("n = 2").select("w1", "w2", "a")
    triples = found.where("n = 3").select("w1", "w2", "w3", "a")
    held = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = held.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    free = pairs.join(longest, ["w1", "w2"], "left").where(F.coalesce("longer", F.lit(0)) * 100 < F.col("a") * share)
    two = free.join(word(1), "w1").join(word(2), "w2").select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))
    head = pairs.select("w1", "w2", F.col("a").alias("head"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"))
    cuts = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    first, second = _score(F.col("a"), F.col("n1"), F.col("tail")), _score(F.col("a"), F.col("head"), F.col("n3"))
    three = cuts.withColumn("early", first <= second).select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        F.when(F.col("early"), F.col("n1")).otherwise(F.col("head")).alias("l"),
        F.when(F.col("early"), F.col("tail")).otherwise(F.col("n3")).alias("r"))
    return two.unionByName(three).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 10, share: int = 50,
                 k: int = 2000, sizes: Sizes = Sizes()) -> DataFrame:
    """Each language's first ``k`` phrases by score, count and phrase: lang, rank, phrase, a, l, r, n, score."""
    chunks = written(chunked(docs, lang_col, text_col, sizes), "collocation-chunks")
    ids = word_ids(chunks, min_count)
    found = written(phrase_counts(chunks, ids, min_count, sizes), "collocation-phrases")
    ranked = top_k_per_key(scored(found, ids, share), "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], k)
    totals = chunks.groupBy("lang").agg(F.sum("size").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
                                              "score")
