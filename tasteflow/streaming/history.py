"""Each user's newest ratings, rated set and newest event, kept in Spark's state store.

``transformWithState`` keyed by a bucket of users, on the RocksDB store.  A micro-batch reads
and writes the state of its own users' buckets only, so its cost follows the batch and
not the stored ratings.  Spark checkpoints the state with the stream's offsets:
a restarted query goes on where it stopped, a replayed batch starts from the
state before it.

Every access is a call to the store and every row crosses from the JVM to Python alone, so rows travel packed: a
bucket's events, its users' ``recent_k`` newest ratings, rated items as 64-bit words, and newest events that asked for a
list are arrays of fixed records, one value each.  Stored ratings enter once, as the initial state, one row per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tasteflow.operators import realtime

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 4096        # fixed: the checkpoints of a query are keyed by it
PACKED = 1_000_000    # events held before they are packed by bucket
ASKED = ("uid int, mid int, score double, timestamp bigint, recent array<struct<timestamp:bigint,mid:int,score:double>>, "
         "rated array<struct<word:bigint,bits:bigint>>")

EVENT = np.dtype([("uid", "<i4"), ("known", "u1"), ("mid", "<i4"), ("timestamp", "<i8"), ("score", "<f8")])
WORD = np.dtype([("uid", "<i4"), ("word", "<i8"), ("bits", "<u8")])
LIST = np.dtype([*EVENT.descr, ("n_recent", "<i4"), ("n_rated", "<i4")])
FIELDS = ("timestamp", "mid", "score")   # bit i of ``known``: the i-th is not null
ASKS = 8


def bucket_of(uid: str = "uid") -> Column:
    return F.pmod(F.xxhash64(F.col(uid).cast("int")), F.lit(BUCKETS)).cast("int").alias("bucket")


def _events(batch: pa.RecordBatch) -> np.ndarray:
    """Records of the columns ``uid``, ``FIELDS`` and, if there, ``asks``."""
    out = np.zeros(batch.num_rows, EVENT)
    out["uid"] = batch.column("uid").to_numpy()
    for i, name in enumerate(FIELDS):
        column = batch.column(name)
        out[name] = column.fill_null(0).to_numpy()
        out["known"] |= column.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8) << i
    if "asks" in batch.schema.names:
        out["known"] |= batch.column("asks").fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8) * ASKS
    return out


def _age(events: np.ndarray) -> list[np.ndarray]:
    """Keys of ``np.lexsort``, last first: by time, item, score; nulls are smallest, NaN greatest, as in Spark."""
    keys = []
    for i in (2, 1, 0):
        keys += [events[FIELDS[i]], events["known"] >> i & 1]
    return keys


def _last(events: np.ndarray, *later: np.ndarray) -> np.ndarray:
    """Position of each user's newest event, by user; equal ones by ``later``."""
    order = np.lexsort([*later, *_age(events), events["uid"]])
    uid = events["uid"][order]
    return order[np.flatnonzero(np.r_[uid[1:] != uid[:-1], True])] if len(uid) else order


def _newest(events: np.ndarray, k: int) -> np.ndarray:
    """Each user's ``k`` newest, newest first, by user."""
    events = events[np.lexsort([*_age(events), -events["uid"].astype(np.int64)])[::-1]]
    uid = events["uid"]
    first = np.searchsorted(uid, uid, "left")
    events = events[np.arange(len(uid)) - first < k]
    events["known"] &= ASKS - 1
    return events


def _words(events: np.ndarray) -> np.ndarray:
    rated = events[events["known"] >> 1 & 1 == 1]
    out = np.zeros(len(rated), WORD)
    mid = rated["mid"].astype(np.int64)
    out["uid"], out["word"] = rated["uid"], mid // realtime.WORD
    out["bits"] = np.left_shift(np.uint64(1), (mid % realtime.WORD).astype(np.uint64))
    return out


def _merged(words: np.ndarray) -> np.ndarray:
    """Each word of a user once, by user and word."""
    words = words[np.lexsort([words["word"], words["uid"]])]
    if not len(words):
        return words
    first = np.flatnonzero(np.r_[True, (words["uid"][1:] != words["uid"][:-1]) | (words["word"][1:] != words["word"][:-1])])
    out = words[first]
    out["bits"] = np.bitwise_or.reduceat(words["bits"], first)
    return out


def _binary(records: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive records as binary values, cut at ``ends``."""
    offsets = (np.r_[0, ends] * records.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(records.tobytes())])


def _ends(keys: np.ndarray) -> np.ndarray:
    return np.r_[np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]


def _packed_events(keep: bool):
    """Kernel from events with their ``bucket`` to (bucket, events).  Unless all are kept, of a user's asking ones the newest."""

    def packed(held):
        bucket, events = (np.concatenate(x) for x in zip(*held))
        if not keep:
            asks = events["known"] & ASKS > 0
            at = np.flatnonzero(asks)
            pick = np.r_[np.flatnonzero(~asks), at[_last(events[at])]]
            bucket, events = bucket[pick], events[pick]
        order = np.argsort(bucket, kind="stable")
        bucket, events = bucket[order], events[order]
        ends = _ends(bucket)
        return pa.RecordBatch.from_arrays([pa.array(bucket[ends - 1]), _binary(events, ends)], ["bucket", "events"])

    def kernel(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("bucket").to_numpy(), _events(batch)))
                n += batch.num_rows
            if n >= PACKED:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return kernel


def _packed_state(recent_k: int):
    """Kernel from rows by bucket, ratings (``bits`` null) and words (``timestamp`` is the word), to (bucket, recent, rated)."""

    def row(parts):
        events, words = (np.concatenate(x) for x in zip(*parts))
        return _newest(events, recent_k).tobytes(), _merged(words).tobytes()

    def split(batch):
        events, is_word = _events(batch), batch.column("bits").is_valid().to_numpy(zero_copy_only=False)
        words = np.zeros(int(is_word.sum()), WORD)
        words["uid"], words["word"] = events["uid"][is_word], events["timestamp"][is_word]
        words["bits"] = batch.column("bits").fill_null(0).to_numpy()[is_word].view(np.uint64)
        return events[~is_word], words

    def kernel(batches):
        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, at, out = batch.column("bucket").to_numpy(), 0, []
            for end in _ends(bucket):
                if parts and bucket[at] != key:
                    out.append((key, *row(parts)))
                    parts = []
                key = int(bucket[at])
                parts.append(split(batch.slice(at, int(end) - at)))
                at = int(end)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))],
                                                 ["bucket", "recent", "rated"])
        if parts:
            recent, rated = row(parts)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([recent], pa.binary()),
                                              pa.array([rated], pa.binary())], ["bucket", "recent", "rated"])

    return kernel


def _field(records: np.ndarray, name: str) -> pa.Array:
    known = records["known"] >> FIELDS.index(name) & 1
    return pa.array(np.ascontiguousarray(records[name]), mask=known == 0)


def _unpacked(batches):
    """Kernel from a bucket's lists and histories to the rows of ``ASKED``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists, recent, rated = (np.concatenate([np.frombuffer(x, kind) for x in batch.column(name).to_pylist()]) for name, kind in (
            ("lists", LIST), ("recent", EVENT), ("rated", WORD)))
        offsets = lambda n: pa.array(np.r_[0, np.cumsum(lists[n])].astype(np.int32))
        events = pa.StructArray.from_arrays([_field(recent, c) for c in FIELDS], list(FIELDS))
        words = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rated["word"])),
                                            pa.array(np.ascontiguousarray(rated["bits"]).view(np.int64))], ["word", "bits"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(lists["uid"])), _field(lists, "mid"), _field(lists, "score"), _field(lists, "timestamp"),
             pa.ListArray.from_arrays(offsets("n_recent"), events), pa.ListArray.from_arrays(offsets("n_rated"), words)],
            ["uid", "mid", "score", "timestamp", "recent", "rated"])


def initial_history(ratings: DataFrame, recent_k: int) -> DataFrame:
    """(bucket, recent, rated): the state of every user of the stored ratings, packed by bucket."""
    ratings = ratings.select("uid", "mid", "score", "timestamp").where("uid is not null")
    newest = realtime.top_k_per_key(ratings, "uid", [F.desc(c) for c in realtime.NEWEST_FIRST], recent_k)
    rows = newest.select(bucket_of(), "uid", "mid", "score", "timestamp").unionByName(
        realtime.rated_words(ratings).select(bucket_of(), "uid", F.col("word").alias("timestamp"), "bits"), allowMissingColumns=True)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _packed_state(recent_k), "bucket int, recent binary, rated binary")


def _order(event: tuple) -> tuple:
    """Newest first means greatest: by time, item, score; nulls are smallest, NaN greatest, as in Spark and :func:`_age`."""
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in event)


class UserHistory(StatefulProcessor):
    """Events of a bucket of users in, at most one row out: of each user the newest event that asks for a list, and the histories.

    ``keep``: the batch's asking events join the history, after the row is made (an event does not see itself).
    Rows with ``asks`` false always join it, before.
    """

    def __init__(self, recent_k: int, keep: bool) -> None:
        self.recent_k, self.keep = recent_k, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent, self.rated, self.newest = (handle.getValueState(x, "records binary") for x in ("recent", "rated", "newest"))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        for state, name in ((self.recent, "recent"), (self.rated, "rated")):
            if initialState[name]:
                state.update((bytes(initialState[name]),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        events = np.concatenate([np.frombuffer(r["events"], EVENT) for r in rows])
        asks = events["known"] & ASKS > 0
        asking, told = events[asks], events[~asks]
        history = None
        if len(told):
            history = self._join(self._read(self.recent, EVENT), self._read(self.rated, WORD), told)
        newest = self._read(self.newest, EVENT)
        both, new = np.r_[newest, asking], np.r_[np.zeros(len(newest), bool), np.ones(len(asking), bool)]
        last = _last(both, new)
        lists, out = both[last[new[last]]], None
        if len(lists):
            self.newest.update((both[last].tobytes(),))
            if history is None:
                history = self._read(self.recent, EVENT), self._read(self.rated, WORD)
            out = self._lists(lists, *history)
        if self.keep and len(asking):
            self._join(*(history or (self._read(self.recent, EVENT), self._read(self.rated, WORD))), asking)
        if out is not None:
            yield out

    @staticmethod
    def _read(state, kind: np.dtype) -> np.ndarray:
        value = state.get()
        return np.frombuffer(value[0], kind) if value else np.zeros(0, kind)

    def _join(self, recent: np.ndarray, rated: np.ndarray, events: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The histories with more events, as they are from now on."""
        recent, rated = _newest(np.r_[recent, events], self.recent_k), _merged(np.r_[rated, _words(events)])
        self.recent.update((recent.tobytes(),))
        self.rated.update((rated.tobytes(),))
        return recent, rated

    @staticmethod
    def _lists(events: np.ndarray, recent: np.ndarray, rated: np.ndarray) -> Row:
        lists = np.zeros(len(events), LIST)
        for name in EVENT.names:
            lists[name] = events[name]
        uid, picked = events["uid"], []
        for count, records in (("n_recent", recent), ("n_rated", rated)):
            of = records["uid"]
            lists[count] = np.searchsorted(of, uid, "right") - np.searchsorted(of, uid, "left")
            picked.append(records[np.isin(of, uid)].tobytes())
        return Row(lists=lists.tobytes(), recent=picked[0], rated=picked[1])

    def close(self) -> None:
        pass


def asked(events: DataFrame, stored: DataFrame | None, recent_k: int, keep: bool) -> DataFrame:
    """Streaming (uid, mid, score, timestamp, asks) -> a row per asking user of the batch, with the user's history."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    start = None if stored is None else initial_history(stored, recent_k).groupBy("bucket")
    packed = events.where("uid is not null").select(bucket_of(), "uid", *FIELDS, "asks").mapInArrow(
        _packed_events(keep), "bucket int, events binary")
    return packed.groupBy("bucket").transformWithState(
        UserHistory(recent_k, keep), "lists binary, recent binary, rated binary", "Update", "None",
        initialState=start).mapInArrow(_unpacked, ASKED)


def recent_of(asked_: DataFrame) -> DataFrame:
    """(uid, rn, mid, score) of the users' newest ratings, as :func:`realtime.recent_ratings`."""
    return asked_.select("uid", F.posexplode("recent").alias("at", "r")).select(
        "uid", (F.col("at") + 1).cast("int").alias("rn"), F.col("r.mid").alias("mid"), F.col("r.score").alias("score"))


def words_of(asked_: DataFrame) -> DataFrame:
    """(uid, word, bits) of the users' rated sets, as :func:`realtime.rated_words`."""
    return asked_.select("uid", F.inline("rated"))


def rated_counts(asked_: DataFrame) -> DataFrame:
    """The rows with ``n_rated``, how many items the user has rated: each user is one row, whose words need no shuffle."""
    return asked_.withColumn("n_rated", F.aggregate("rated", F.lit(0), lambda n, w: n + F.bit_count(w["bits"])))
