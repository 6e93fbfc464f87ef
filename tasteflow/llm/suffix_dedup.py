"""Exact substring deduplication across documents with a sparse suffix array.

A byte is removed when a ``length``-byte string over it also starts in a
document with a smaller id.  Sorting every suffix would move the text tens of
times, so suffixes are thinned by content first: of each ``length``-byte
string, the ``GRAM``-byte gram with the smallest hash is its anchor.  Equal
strings have equal anchors, so only strings whose anchors meet can match.

1. Anchors are range-partitioned by the gram's 64-bit hash code (not in suffix
   order), with splitters from a bounded sample of documents.  Equal codes fall
   into one range, so ranges are not compared.  Each is sorted; codes found in two or more documents survive and get a home: the
   smallest such document and the anchor's place in it.
2. Back at the documents, runs of surviving anchors with one home become
   segments of text, each sent to its home's bucket.
3. A bucket sorts the runs' strings most significant first, by lexsort rounds of
   eight bytes.  A run equal to one of a smaller document is removed whole.
   Where a gram has several different runs, all their ``length``-byte
   suffixes are sorted the same way and equal neighbours compared.
4. The removed spans go back to the documents, are merged and cut out.

Whole copies of a text are found by digest first and cost one row each.
Anchors that a sample finds in very many documents skip steps 1 to 3: their
runs and windows are compared by joins on 128-bit digests, which AQE splits.

Scale: the text is shuffled once (both uses share the exchange), anchors as eight
bytes each in blocks.  Bucket numbers follow the row count; a bucket holds a
few megabytes.  Copies are dropped within each task before the shuffle.

Defined results: null texts are empty; texts shorter than ``length`` never
change; documents of equal id never remove each other's bytes; a null id counts
as larger than every id (null ids among themselves: by a hash of the text);
repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls, written

GRAM = 20
BLOCK = 1 << 16         # window starts handled at once
POSITION = (1 << 17) - 1
PLACE_BITS = 12         # anchors within 4096 bytes of their home share it
FLUSH = 1 << 20         # anchors gathered before they are sent
SEGMENT = "home int, ord bigint, mark bigint, start bigint, segment binary"
HOT = 1 << 16           # hot codes at most
UNIT = "digest binary, ord bigint, mark bigint, start bigint, segment binary"
WINDOW = "digest binary, ord bigint, mark bigint, start bigint"
SPAN = "ord bigint, mark bigint, start bigint, end bigint"
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as little-endian numbers."""
    return np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))


def _grams(data: np.ndarray) -> np.ndarray:
    """64-bit code of the GRAM bytes from each position."""
    w = _words(data)
    n = len(data) - GRAM + 1
    h = w[:n] * _C1
    h ^= h >> np.uint64(32)
    h += w[8:8 + n]
    h *= _C2
    h ^= h >> np.uint64(29)
    h += w[GRAM - 8:GRAM - 8 + n]
    h *= _C3
    h ^= h >> np.uint64(32)
    return h


class Runs:
    """Maximal runs of windows with one anchor: window starts ``first``..``last``, ``code`` and ``anchor`` place."""

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.data = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
        self.begin = np.cumsum([0, *map(len, texts)])
        width = length - GRAM + 1
        found = [self._block(at, length, width) for at in range(0, max(len(self.data) - length + 1, 0), BLOCK)]
        self.first, self.last, self.anchor, self.code = (
            np.concatenate(parts) if found else np.zeros(0, np.uint64 if i == 3 else np.int64)
            for i, parts in enumerate(zip(*found) if found else [()] * 4))
        self.text = np.searchsorted(self.begin, self.first, side="right") - 1

    def _block(self, at: int, length: int, width: int) -> tuple[np.ndarray, ...]:
        data = self.data[at:at + BLOCK + length - 1]
        code = _grams(data)
        low = (code & ~np.uint64(POSITION)) | np.arange(len(code), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        place = (low & np.uint64(POSITION)).astype(np.int64)
        # windows that start less than ``length`` before a later text's begin would cross into it
        inside = np.ones(len(place) + 1, dtype=np.int8)
        inside[-1] = 0
        near = self.begin[1:-1]
        for b in near[(near > at) & (near < at + len(place) + length)] - at:
            inside[max(0, b - length + 1):max(0, b)] = 0
        ok = inside[:-1].astype(bool)
        change = np.r_[True, place[1:] != place[:-1]] | np.r_[True, ~ok[:-1]]
        start = np.flatnonzero(change & ok)
        stop = np.flatnonzero(np.r_[change[1:], True] & ok | (ok & ~np.r_[ok[1:], False]))
        return start + at, stop + at, place[start] + at, code[place[start]]


def equal_strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Group numbers of equal strings (of equal initial group and size), by lexsort rounds, most significant first.

    A character is eight bytes.  Strings still tied after one character are sorted by the
    next; strings without a tie are done.
    """
    words = _words(data)
    _, group = np.unique(group, return_inverse=True)
    group = group.astype(np.int64)
    out, fresh = np.full(len(start), -1, dtype=np.int64), 0
    live, offset = np.arange(len(start)), 0
    while len(live):
        done = size[live] <= offset
        if done.any():  # the whole string was equal to its group's
            ended, live = live[done], live[~done]
            _, number = np.unique(group[ended], return_inverse=True)
            out[ended] = number + fresh
            fresh += int(number.max()) + 1
            if not len(live):
                break
        word = words[start[live] + np.minimum(offset, size[live] - 8)]
        order = np.lexsort((word, size[live], group[live]))
        live = live[order]
        g, w, s = group[live], word[order], size[live]
        new = np.r_[True, (g[1:] != g[:-1]) | (w[1:] != w[:-1]) | (s[1:] != s[:-1])]
        group[live] = np.cumsum(new)
        alone = new & np.r_[new[1:], True]
        out[live[alone]] = np.arange(int(alone.sum())) + fresh
        fresh += int(alone.sum())
        live = live[~alone]
        offset += 8
    return out


def _smallest(group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row, the smallest id of its group."""
    order = np.lexsort((ids, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    out = np.empty_like(ids)
    out[order] = np.repeat(ids[order][first], np.diff(np.r_[first, len(g)]))
    return out


def repeated_spans(ids: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of the bytes of segments that smaller ids hold too."""
    runs = Runs(texts, length)
    owner = ids[runs.text]
    size = runs.last - runs.first + length
    same = equal_strings(runs.data, runs.first, size, runs.code)
    least = _smallest(same, owner)
    whole = least < owner
    # grams with several different runs: compare every window of each run's smallest holder
    heads = np.flatnonzero(~whole)
    _, gram = np.unique(runs.code, return_inverse=True)
    kinds = np.unique(np.column_stack([gram, same]), axis=0)[:, 0] if len(gram) else gram
    several = np.bincount(kinds, minlength=len(gram) + 1) > 1
    heads = heads[several[gram[heads]]]
    n = (runs.last - runs.first + 1)[heads]
    window = np.repeat(runs.first[heads], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    offset = np.repeat(runs.anchor[heads], n) - window
    group = np.repeat(gram[heads], n) * length + offset
    equal = equal_strings(runs.data, window, np.full(len(window), length), group)
    holder = np.repeat(owner[heads], n)
    window = window[_smallest(equal, holder) < holder]
    start = np.r_[runs.first[whole], window]
    end = np.r_[runs.last[whole] + length, window + length]
    number = np.searchsorted(runs.begin, start, side="right") - 1
    order = np.argsort(start, kind="stable")
    number, start, end = number[order], start[order], end[order]
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.r_[True, (start[1:] > reach[:-1]) | (number[1:] != number[:-1])] if len(start) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    number, start = number[head], start[head]
    end = np.maximum.reduceat(end, head) if len(head) else end
    base = runs.begin[number]
    return number, start - base, end - base


def _order(id_: Column, text: Column) -> Column:
    """The id; a null id counts as larger than every id."""
    return F.coalesce(id_.cast("bigint"), F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62))


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([len(arrays[0]).to_bytes(8, "little"), *(a.tobytes() for a in arrays)])


def _unpack(blobs: list[bytes], *types: str) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in types]
    for b in blobs:
        n, at = int.from_bytes(b[:8], "little"), 8
        for i, t in enumerate(types):
            parts[i].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(p) if p else np.zeros(0, t) for p, t in zip(parts, types)]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _split(rows: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The row numbers of each bucket."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    for at, end in zip(first, np.r_[first[1:], len(b)]):
        yield int(b[at]), rows[order[at:end]]


def _splitters(texts: DataFrame, rows: int, buckets: int, length: int, sample: int = 2000) -> np.ndarray:
    """Codes that cut the leading tokens of about ``sample`` documents into equal ranges (balance only)."""
    if buckets == 1:
        return np.zeros(0, np.uint64)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "text"):
            code = np.unique(Runs(batch.column(0).to_pylist(), length).code)
            yield _batch("code bigint", code[:: max(1, len(code) // 1000)].view(np.int64))

    found = texts.select("text").sample(min(1.0, sample / max(rows, 1)), seed=7).mapInArrow(codes, "code bigint")
    codes_ = np.sort(np.array([r.code for r in found.collect()], dtype=np.int64).view(np.uint64))
    if len(codes_) < buckets:
        return np.linspace(0, 2 ** 64, buckets + 1)[1:-1].astype(np.uint64)
    return codes_[np.linspace(0, len(codes_), buckets + 1)[1:-1].astype(int)]


def _hot(texts: DataFrame, rows: int, buckets: int, bucket_rows: int, length: int) -> np.ndarray:
    """Sorted codes that a sample finds in very many documents (balance only: either way of comparing is exact)."""
    if buckets == 1:
        return np.zeros(0, np.uint64)
    share = min(1.0, max(2000, rows // 100_000) / rows)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "text"):
            runs = Runs(batch.column(0).to_pylist(), length)
            by = np.lexsort((runs.text, runs.code))
            code, text = runs.code[by], runs.text[by]
            new = np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])] if len(by) else by > 0
            yield _batch("code bigint", code[new].view(np.int64))

    # the same share of the documents at every size, until one home would get too many strings
    many = max(bucket_rows / 4, min(rows / 100, bucket_rows * 32))
    found = (texts.select("text").sample(share, seed=11).mapInArrow(codes, "code bigint").groupBy("code").count()
             .where(F.col("count") >= max(8, int(many * share))).orderBy(F.desc("count"), "code").limit(HOT))
    return np.sort(np.array([r.code for r in found.collect()], dtype=np.int64).view(np.uint64))


def _within(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Which values the sorted array holds."""
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _hot_spans(texts: DataFrame, hot: np.ndarray, length: int) -> DataFrame:
    """Removed spans of windows with a hot anchor, by joins on digests, so no code or passage is one group.

    Neighbouring hot runs are cut into units where their codes say so.  A unit equal to one of a smaller document goes
    whole.  Of each different unit the smallest holder's runs are compared in the same way, and of each different run
    the windows: a change in a near copy opens only the runs that it touches.
    """

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "text", 1 << 20):
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            runs = Runs(rows, length)
            at = np.flatnonzero(_within(runs.code, hot))
            if not len(at):
                continue
            chain = np.r_[True, (np.diff(at) > 1) | (np.diff(runs.text[at]) > 0)]
            ends = np.r_[chain[1:], True]
            cut = chain | ends | np.r_[False, chain[:-1] | (runs.code[at][:-1] % np.uint64(4) == 0)]
            first = np.flatnonzero(cut)
            last = np.r_[first[1:], len(at)] - 1
            out, marks = [], {}
            for f, e in zip(at[first], at[last]):
                t = int(runs.text[f])
                a, b = int(runs.first[f] - runs.begin[t]), int(runs.last[e] - runs.begin[t]) + length
                if t not in marks:
                    marks[t] = _mark(rows[t])
                unit = rows[t][a:b]
                out.append((xxhash.xxh3_128_digest(unit), ids[t], marks[t], a, unit))
            yield _batch(UNIT, *zip(*out))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "segment", 1 << 18):
            ords, marks, starts, rows = (batch[c].to_pylist() for c in ("ord", "mark", "start", "segment"))
            runs = Runs(rows, length)
            out = []
            for t, a, b in zip(runs.text.tolist(), (runs.first - runs.begin[runs.text]).tolist(),
                               (runs.last - runs.begin[runs.text] + length).tolist()):
                run = rows[t][a:b]
                out.append((xxhash.xxh3_128_digest(run), ords[t], marks[t], starts[t] + a, run))
            yield _batch(UNIT, *zip(*out))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "segment", 1 << 18):
            out = [(xxhash.xxh3_128_digest(unit[k:k + length]), o, mark, a + k)
                   for o, mark, a, unit in zip(*(batch[c].to_pylist() for c in ("ord", "mark", "start", "segment")))
                   for k in range(len(unit) - length + 1)]
            yield _batch(WINDOW, *zip(*out))

    def with_least(df: DataFrame) -> DataFrame:
        return df.join(df.groupBy("digest").agg(F.min("ord").alias("least")), "digest")

    def holders(df: DataFrame) -> DataFrame:
        return df.where("ord = least").select("ord", "mark", "start", "segment")

    def whole(df: DataFrame) -> DataFrame:
        return df.where("ord > least").select("ord", "mark", "start", (F.col("start") + F.octet_length("segment")).alias("end"))

    judged = with_least(written(texts.mapInArrow(units, UNIT), "suffix-units", 1024))
    opened = with_least(written(holders(judged).mapInArrow(parts, UNIT), "suffix-runs", 1024))
    single = with_least(written(holders(opened).mapInArrow(windows, WINDOW), "suffix-windows", 1024))
    return whole(judged).unionByName(whole(opened)).unionByName(
        single.where("ord > least").select("ord", "mark", "start", (F.col("start") + length).alias("end")))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
            bucket_rows: int = 2048, carried: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Per row: ``row`` (id and carried columns), ``n_bytes``, ``n_removed``, ``n_spans`` and ``rest``, the bytes left.

    ``as_text``: ``rest`` is a string instead; bytes of a character that was cut in two are left out.
    """
    total = docs.count()
    buckets = max(1, -(-total // bucket_rows))
    carried = tuple(dict.fromkeys((id_col, *carried)))
    order = _order(docs[id_col], docs[text_col])
    texts = docs.select(order.alias("ord"), blob(text_col).alias("text"))
    splitters = _splitters(texts, total, buckets, length)
    hot = _hot(texts, total, buckets, bucket_rows, length)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, ...]] = []

        def send() -> pa.RecordBatch:
            code, owner, place = (np.concatenate(x) for x in zip(*held))
            bucket = np.searchsorted(splitters, code, side="right")
            out = [(b, _pack(code[i], owner[i], place[i])) for b, i in _split(np.arange(len(code)), bucket)]
            return _batch("bucket int, packed binary", *zip(*out))

        n = 0
        for batch in calls(batches, "text"):
            ids, chosen = [], []
            for o, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                digest = xxhash.xxh3_128_digest(text)
                if len(text) < length or seen.get(digest, 1 << 63) <= o:
                    continue  # a copy of an earlier text of this task: step 1 needs the smallest only
                seen[digest] = o
                ids.append(o)
                chosen.append(text)
            runs = Runs(chosen, length)
            if not len(runs.code):
                continue
            place = ((runs.anchor - runs.begin[runs.text]) >> PLACE_BITS).astype(np.uint32)
            cold = ~_within(runs.code, hot)
            held.append((runs.code[cold], np.array(ids, dtype=np.int64)[runs.text][cold], place[cold]))
            n += int(cold.sum())
            if n >= FLUSH:
                yield send()
                held.clear()
                n = 0
        if n:
            yield send()

    def meet(table: pa.Table) -> pa.Table:
        code, owner, place = _unpack(table["packed"].to_pylist(), "<u8", "<i8", "<u4")
        by = np.lexsort((place, owner, code))
        code, owner, place = code[by], owner[by], place[by]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        n = np.diff(np.r_[first, len(code)])
        several = owner[first] != owner[first + n - 1]
        home = np.repeat(_home(owner[first], place[first], buckets), n)
        keep = np.repeat(several, n) & np.r_[True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]
        code, owner, home = code[keep], owner[keep], home[keep]
        out = [(b, _pack(owner[i], code[i], home[i])) for b, i in
               _split(np.arange(len(code)), _doc_bucket(owner, buckets))]
        return pa.Table.from_batches([_batch("bucket int, packed binary", *(zip(*out) if out else ((), ())))])

    def segments(key, left: pa.Table, right: pa.Table) -> pa.Table:
        copies = _Copies(right)
        homes = _Homes(*_unpack([p for p in right["packed"].to_pylist() if p is not None], "<i8", "<u8", "<i4"))
        out: list[tuple] = []
        ids = left["ord"].to_pylist()
        column = left["text"]
        chosen = [i for i, o in enumerate(ids) if _has(homes.known, o) and not copies.hold(o, column[i])]
        for at in _groups(chosen, [column[i].as_buffer().size for i in chosen]):
            texts = [column[i].as_py() for i in at]
            runs = Runs(texts, length)
            who = np.array([ids[i] for i in at], dtype=np.int64)
            marks = [_mark(t) for t in texts]
            place = homes.find(who, runs)
            new = np.r_[True, (place[1:] != place[:-1]) | (runs.text[1:] != runs.text[:-1])] if len(place) else place > 0
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(place)] - 1
            for f, e in zip(first[place[first] >= 0], last[place[first] >= 0]):
                t = runs.text[f]
                a, b = int(runs.first[f] - runs.begin[t]), int(runs.last[e] - runs.begin[t]) + length
                out.append((int(place[f]), int(who[t]), marks[t], a, texts[t][a:b]))
        return pa.Table.from_batches([_batch(SEGMENT, *(zip(*out) if out else ((),) * 5))])

    def compare(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["ord"])
        number, start, end = repeated_spans(ids, table["segment"].to_pylist(), length)
        base = np.asarray(table["start"])[number]
        return pa.Table.from_batches([_batch(SPAN, ids[number], np.asarray(table["mark"])[number], start + base,
                                             end + base)])

    doc_bucket = F.pmod(F.col("ord"), F.lit(buckets)).cast("int")
    met = texts.mapInArrow(anchors, "bucket int, packed binary").groupBy("bucket").applyInArrow(
        meet, "bucket int, packed binary")
    least = texts.where(F.octet_length("text") >= length).select(F.md5("text").alias("digest"), "ord")
    copies = least.join(least.groupBy("digest").agg(F.min("ord").alias("least"), F.count("*").alias("n"))
                        .where("n > 1"), "digest").where("ord > least").select("ord", "digest").distinct()
    copies = copies.select(doc_bucket.alias("bucket"), F.col("ord").alias("copy"), "digest")

    rows = docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), order.alias("ord"), blob(text_col).alias("text")
                       ).withColumn("bucket", doc_bucket)
    found = met.unionByName(copies, allowMissingColumns=True)
    sent = rows.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(segments, SEGMENT)
    spans = sent.groupBy("home").applyInArrow(compare, SPAN)
    if len(hot):
        spans = spans.unionByName(_hot_spans(texts, hot, length))
    verdicts = spans.select("*", doc_bucket.alias("bucket")).unionByName(copies, allowMissingColumns=True)
    rest = "string" if as_text else "binary"
    shape = rows.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("rest", rest)
    return rows.groupBy("bucket").cogroup(verdicts.groupBy("bucket")).applyInArrow(
        lambda left, right: _cut(left, right, as_text), shape)


def _home(owner: np.ndarray, place: np.ndarray, buckets: int) -> np.ndarray:
    h = (owner.astype(np.uint64) * _C1 + place) * _C2
    return ((h ^ (h >> np.uint64(31))) % np.uint64(buckets)).astype(np.int32)


def _doc_bucket(owner: np.ndarray, buckets: int) -> np.ndarray:
    return np.mod(owner, buckets).astype(np.int32)


def _mark(text: bytes) -> int:
    """Tells texts of one id apart."""
    return xxhash.xxh3_64_intdigest(text) >> 1


class _Homes:
    """Homes of a bucket's surviving anchors, looked up by owner and whole code."""

    def __init__(self, owner: np.ndarray, code: np.ndarray, home: np.ndarray) -> None:
        self.known, self.codes = np.unique(owner), np.unique(code)
        rank = self._rank(owner, code)
        by = np.argsort(rank)
        self.rank, self.home = rank[by], home[by]

    def _rank(self, owner: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (np.searchsorted(self.known, owner) << 32) | np.searchsorted(self.codes, code)

    def find(self, ids: np.ndarray, runs: Runs) -> np.ndarray:
        """The home of each run; -1 where its anchor did not survive.  ``ids`` (of the texts) are known."""
        if not len(self.rank):
            return np.full(len(runs.code), -1, dtype=np.int32)
        mine = self._rank(ids[runs.text], runs.code)
        spot = np.minimum(np.searchsorted(self.rank, mine), len(self.rank) - 1)
        alive = self.codes[np.minimum(mine & 0xFFFFFFFF, len(self.codes) - 1)] == runs.code
        return np.where((self.rank[spot] == mine) & alive, self.home[spot], -1)


class _Copies:
    """The rows of a bucket that copy a text of a smaller id."""

    def __init__(self, table: pa.Table) -> None:
        self.known = {(c, d) for c, d in zip(table["copy"].to_pylist(), table["digest"].to_pylist()) if c is not None}
        self.ids = {c for c, _ in self.known}

    def hold(self, id_: int, text: pa.Scalar | bytes) -> bool:
        if id_ not in self.ids:
            return False
        return (id_, hashlib.md5(text if isinstance(text, bytes) else text.as_py()).hexdigest()) in self.known


def _has(sorted_: np.ndarray, value: int) -> bool:
    at = int(np.searchsorted(sorted_, value))
    return at < len(sorted_) and int(sorted_[at]) == value


def _groups(rows: list[int], sizes: list[int], limit: int = 4 << 20) -> Iterator[list[int]]:
    """Rows in portions of about ``limit`` bytes."""
    part, total = [], 0
    for r, n in zip(rows, sizes):
        if part and total + n > limit:
            yield part
            part, total = [], 0
        part.append(r)
        total += n
    if part:
        yield part


def _cut(left: pa.Table, right: pa.Table, as_text: bool) -> pa.Table:
    """The texts without their spans."""
    copies = _Copies(right)
    spans: dict[int, list[tuple[int, int, int]]] = {}
    for o, mark, a, b in zip(*(right[c].to_pylist() for c in ("ord", "mark", "start", "end"))):
        if o is not None:
            spans.setdefault(o, []).append((a, b, mark))
    n_bytes, n_removed, n_spans, rest = [], [], [], []
    for o, text in zip(left["ord"].to_pylist(), left["text"].to_pylist()):
        cuts = [(0, len(text))] if copies.hold(o, text) else []
        if not cuts and o in spans:
            mine = _mark(text)
            cuts = sorted((a, b) for a, b, mark in spans[o] if mark == mine)
        kept, at, gone, count = [], 0, 0, 0
        for a, b in cuts:
            if b <= at:
                continue
            if a > at or not count:
                kept.append(text[at:a])
                count += 1
            gone += b - max(a, at)
            at = b
        kept.append(text[at:])
        left_over = b"".join(kept)
        n_bytes.append(len(text))
        n_removed.append(gone)
        n_spans.append(count)
        rest.append(left_over.decode("utf-8", "ignore") if as_text else left_over)
    return pa.table({"row": left["row"], "n_bytes": pa.array(n_bytes, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
                     "rest": pa.array(rest, pa.string() if as_text else pa.binary())})


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Per document: bytes, removed bytes, removed spans, SHA-256 of the remaining bytes."""
    return removed(docs, id_col, text_col, length).select(
        f"row.{id_col}", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256).alias("kept_sha256"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
          length: int = 50) -> DataFrame:
    """The documents with repeated strings cut out, same columns; documents with nothing left go."""
    others = tuple(c for c in docs.columns if c != text_col)
    cut = removed(docs, id_col, text_col, length, carried=others, as_text=True).where(
        "n_removed = 0 or n_removed < n_bytes")
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("rest").alias(c))
        elif c == length_col:
            out.append(F.when(F.col("n_removed") == 0, F.col(f"row.`{c}`"))
                       .otherwise(F.length("rest").cast(docs.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return cut.select(*out)
