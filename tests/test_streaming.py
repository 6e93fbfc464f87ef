"""Log filter rules, keyed upsert semantics, and stream == batch."""

import os
import random
import time

import pytest

from tasteflow.operators import realtime
from tasteflow.streaming import history, sink
from tasteflow.streaming.logs import filter_rating_logs, rating_events_from_logs
from tasteflow.streaming.recommender import RealtimeRecommender

M = "MOVIE_RATING_PREFIX:"


def test_log_filter_rules(spark):
    values = [
        f"INFO x {M}370|2770|4.0|835355511",       # forwarded
        "INFO click user=3",                         # no marker: dropped
        f"{M}",                                      # empty payload: quarantined
        f"{M}   ",                                   # blank payload: quarantined
        f"a{M} 1|2|3.0|4 {M}9|9|9|9",               # second marker ends the payload
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    out = filter_rating_logs(df)
    fwd = sorted((r.key, r.value) for r in out.forwarded.collect())
    assert fwd == [("logProcessor", "1|2|3.0|4"), ("logProcessor", "370|2770|4.0|835355511")]
    assert all(r.ingest_time is not None for r in out.forwarded.collect())  # wall-clock event time
    assert sorted(r.reason for r in out.rejects.collect()) == ["empty_payload", "empty_payload"]
    events = rating_events_from_logs(df)
    assert sorted(tuple(r) for r in events.rows.collect()) == [(1, 2, 3.0, 4), (370, 2770, 4.0, 835355511)]


def batch(spark, data):
    return spark.createDataFrame(data, "uid int, recs array<struct<mid:int,score:double>>, event_time long, event_mid int, event_score double")


def table_rows(spark, path):
    return sorted((r.uid, [x.mid for x in r.recs], r.event_time) for r in sink.newest_lists(spark, path).collect())


def test_newest_list_wins_and_a_replay_changes_nothing(spark, tmp_dir):
    t = os.path.join(tmp_dir, "recs")
    sink.append_lists(batch(spark, [(1, [(5, 1.0)], 10, 5, 4.0), (2, [(6, 1.0)], 10, 6, 4.0), (3, [], 10, 7, 4.0)]), t, 0)
    second = [(1, [(8, 2.0)], 20, 8, 4.0), (2, [(9, 1.0)], 5, 9, 4.0)]  # uid 2 event is older
    sink.append_lists(batch(spark, second), t, 1)
    want = [(1, [8], 20), (2, [6], 10), (3, [], 10)]
    assert table_rows(spark, t) == want
    sink.append_lists(batch(spark, second), t, 1)  # replay
    assert table_rows(spark, t) == want and spark.read.parquet(t).count() == 5
    sink.compact(spark, t, t + "-compact")
    assert table_rows(spark, t + "-compact") == want and spark.read.parquet(t + "-compact").count() == 3


EVENTS = "uid int, mid int, score double, timestamp long, asks boolean"


def run_history(spark, source, checkpoint, stored, keep, seen, recent_k=3):
    """One run over what is there: the asked rows as {uid: (event, recents, rated items)}; ``seen`` gets the row counts."""
    out = {}

    def take(df, batch_id):
        rows = df.collect()
        seen.append(len(rows))
        for r in rows:
            rated = {w["word"] * 64 + i for w in r.rated for i in range(64) if w["bits"] >> i & 1}
            out[r.uid] = ((r.timestamp, r.mid, r.score), [tuple(x) for x in r.recent], rated)

    events = spark.readStream.schema(EVENTS).parquet(source)
    query = history.asked(events, stored, recent_k, keep).writeStream.foreachBatch(take).outputMode("update").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return out, query


def test_histories_equal_the_batch_operators_after_every_batch_and_restart(spark, tmp_dir):
    """Late and repeated events, ratings told by others, restarts from the checkpoint, against all rows so far."""
    rnd = random.Random(4)
    row = lambda: (rnd.randint(1, 6), rnd.choice([0, 5, 63, 64, 200, 10**6]), rnd.choice([1.0, 3.0, 5.0]), rnd.randint(1, 40))
    stored = [row() for _ in range(40)]
    known, newest, source, ck = list(stored), {}, os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "ck")
    seen = []
    for turn in range(3):
        events = [(*row(), rnd.random() < 0.6) for _ in range(12)]
        events += events[:2]  # repeated
        spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(source)
        got, _ = run_history(spark, source, ck, spark.createDataFrame(stored, RATINGS), True, seen)
        known += [e[:4] for e in events if not e[4]]
        want = {}
        for u in {e[0] for e in events if e[4]}:
            last = max((e[3], e[1], e[2]) for e in events if e[0] == u and e[4])
            if u in newest and newest[u] > last:
                continue  # older than what the user has
            newest[u] = last
            mine = sorted(((t, m, s) for v, m, s, t in known if v == u), reverse=True)
            want[u] = (last, mine[:3], {m for _, m, _ in mine})
        assert got == want
        known += [e[:4] for e in events if e[4]]
    recents = realtime.recent_ratings(spark.createDataFrame(known, RATINGS), k=3).collect()
    assert {(r.uid, r.mid) for r in recents} == {(u, m) for u in {k[0] for k in known} for _, m, _ in sorted(
        ((t, m, s) for v, m, s, t in known if v == u), reverse=True)[:3]}


def test_a_batch_writes_its_own_users_state(spark, tmp_dir):
    """Stored ratings of many users enter once; the next batch touches one user."""
    source, ck = os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "ck")
    stored = spark.range(3000).selectExpr("CAST(id % 1000 AS INT) uid", "CAST(id AS INT) mid", "4.0D score", "id AS timestamp")
    done = []
    for m in (1, 2):
        spark.createDataFrame([(7, m, 5.0, 10**6 + m, True)], EVENTS).write.mode("append").parquet(source)
        _, query = run_history(spark, source, ck, stored, True, done)
        progress = [p for p in query.recentProgress if p["numInputRows"]][-1]
        state = progress["stateOperators"][0]
        # the one user's value and words are written, not the 1,000 users' state
        assert m == 1 or state["numRowsUpdated"] <= 20, state
    assert done == [1, 1]


def test_order_of_events_is_sparks(spark):
    data = [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, 2.0), (2, 0, 0.0)]
    df = spark.createDataFrame(data, "t long, m int, s double").orderBy("t", "m", "s")
    assert [repr(tuple(r)) for r in df.collect()] == [repr(x) for x in sorted(data, key=history._order)]


def test_stream_result_equals_batch(spark):
    from tasteflow.plans import registry

    sf = "/root/testdata/sf0.001"
    stream = registry.realtime_stream_upsert(spark, sf)
    batch_df = registry.realtime_lists(spark, sf)
    key = ["uid", "rank", "mid", "score"]
    assert sorted(tuple(r) for r in stream.select(*key).collect()) == sorted(tuple(r) for r in batch_df.select(*key).collect())


SIMS = "mid int, sim_mid int, score double"
RATINGS = "uid int, mid int, score double, timestamp long"


def stored(spark, data):
    return spark.createDataFrame(data, RATINGS)


def lists(spark, job):
    return {r.uid: [x.mid for x in r.recs] for r in sink.newest_lists(spark, job.table).collect()}


def say(spark, folder, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def test_ratings_are_live_between_batches_and_restarts(spark, tmp_dir):
    sims = spark.createDataFrame([(100, 200, 0.9), (100, 201, 0.8), (200, 10, 0.8), (201, 10, 0.7)], SIMS)
    events, told, ck = (os.path.join(tmp_dir, x) for x in ("events", "told", "ck"))
    os.makedirs(told)

    def run():
        job = RealtimeRecommender(sims, stored(spark, [(1, 10, 4.0, 1)]), os.path.join(tmp_dir, "recs"))
        try:
            job.start(spark, events, ck, trigger={"availableNow": True}, ratings_source=told).awaitTermination()
            return lists(spark, job)
        finally:
            job.close()

    say(spark, events, "1|100|5.0|9")
    assert run() == {1: [200, 201]}
    say(spark, told, "1|200|2.0|10")  # another writer stores a rating
    say(spark, events, "1|100|5.0|11")
    assert run() == {1: [201]}
    say(spark, events, "1|100|5.0|8")  # late: older than the newest list
    assert run() == {1: [201]}


@pytest.mark.parametrize("keep,want", [(False, [200, 300]), (True, [300])])
def test_events_count_as_ratings_if_asked(spark, tmp_dir, keep, want):
    sims = spark.createDataFrame([(100, 200, 0.9), (100, 300, 0.8), (200, 10, 0.8), (300, 10, 0.7)], SIMS)
    events, bad, times = (os.path.join(tmp_dir, x) for x in ("events", "bad", "times"))
    say(spark, events, "1|200|5.0|9", "1|100|oops|9")
    job = RealtimeRecommender(sims, stored(spark, [(1, 10, 4.0, 1)]), os.path.join(tmp_dir, "recs"), store_ratings=keep,
                              rejects_to=bad, metrics_to=times)
    job.start(spark, events, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}).awaitTermination()
    job.rejects.awaitTermination()
    say(spark, events, "1|100|5.0|10")
    job.start(spark, events, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}).awaitTermination()
    job.rejects.awaitTermination()
    assert lists(spark, job) == {1: want}
    assert [(r.value, r.reason) for r in spark.read.parquet(bad).collect()] == [("1|100|oops|9", "bad_score")]
    job.close()
    assert [r.batch for r in spark.read.parquet(times).where("rows > 0 and batch_ms >= add_ms").orderBy("batch").collect()] == [0, 1]


def test_closing_leaves_no_table_behind(spark, tmp_dir):
    before = {t.name for t in spark.catalog.listTables()}
    job = RealtimeRecommender(spark.createDataFrame([(100, 200, 0.9), (200, 10, 0.8)], SIMS), stored(spark, [(1, 10, 4.0, 1)]),
                              os.path.join(tmp_dir, "recs"))
    job.refresh(spark.createDataFrame([(100, 300, 0.9), (300, 10, 0.7)], SIMS))
    say(spark, os.path.join(tmp_dir, "events"), "1|100|5.0|9")
    job.start(spark, os.path.join(tmp_dir, "events"), os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}).awaitTermination()
    assert lists(spark, job) == {1: [300]}
    job.close()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_default_trigger_runs_until_stopped(spark, tmp_dir):
    from tasteflow.plans.streaming_job import start_recommender

    events = os.path.join(tmp_dir, "events")
    spark.createDataFrame([("1|100|5.0|9",)], "value string").write.text(events)
    ratings = stored(spark, [(1, 10, 4.0, 1)])
    query, job = start_recommender(spark, events, spark.createDataFrame([(100, 200, 0.9), (200, 10, 0.8)], SIMS), ratings,
                                   os.path.join(tmp_dir, "recs"), os.path.join(tmp_dir, "ck"))
    for _ in range(120):
        if query.lastProgress and query.lastProgress["numInputRows"]:
            break
        time.sleep(0.5)
    assert query.isActive
    job.close()
    assert not query.isActive and lists(spark, job) == {1: [200]}


def test_event_parser_stream_with_rejects(spark, tmp_dir):
    from tasteflow.streaming.logs import start_event_parser

    src = os.path.join(tmp_dir, "logs")
    spark.createDataFrame([(f"{M}1|2|3.5|4",), (f"{M}1|x|3.5|4",), ("noise",)], "value string").write.text(src)
    out, bad = os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "bad")
    q, rq = start_event_parser(spark, src, out, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}, rejects_sink=bad)
    q.awaitTermination()
    rq.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, 2, 3.5, 4)]
    assert [(r.value, r.reason) for r in spark.read.parquet(bad).collect()] == [("1|x|3.5|4", "bad_mid")]


def test_list_string_forms(spark):
    from tasteflow.functions.lists import format_recs

    df = spark.createDataFrame([(1, [(5, 4.5), (7, 0.1234567)]), (2, [])], "uid int, recs array<struct<mid:int,score:double>>")
    got = {r.uid: r.s for r in df.select("uid", format_recs("recs").alias("s")).collect()}
    assert got == {1: "5:4.5|7:0.1234567", 2: ""}
    fixed = {r.uid: r.s for r in df.select("uid", format_recs("recs", decimals=3).alias("s")).collect()}
    assert fixed == {1: "5:4.500|7:0.123", 2: ""}


def test_streaming_job_wiring(spark, tmp_dir):
    from tasteflow.plans.streaming_job import start_forwarder, start_recommender

    logs = os.path.join(tmp_dir, "logs")
    spark.createDataFrame([(f"INFO {M}1|100|5.0|9",), ("INFO click user=1",)], "value string").write.text(logs)
    fwd_out = os.path.join(tmp_dir, "fwd")
    q = start_forwarder(spark, logs, fwd_out, os.path.join(tmp_dir, "ck1"), trigger={"availableNow": True})
    q.awaitTermination()
    assert [(r.key, r.value) for r in spark.read.parquet(fwd_out).collect()] == [("logProcessor", "1|100|5.0|9")]

    events = os.path.join(tmp_dir, "events")
    spark.createDataFrame([("1|100|5.0|9",)], "value string").write.text(events)
    sims = spark.createDataFrame([(100, 200, 0.9), (200, 10, 0.8)], SIMS)
    table = os.path.join(tmp_dir, "recs")
    q, job = start_recommender(spark, events, sims, stored(spark, [(1, 10, 4.0, 1)]), table,
                               os.path.join(tmp_dir, "ck2"), min_sim=0.6, trigger={"availableNow": True})
    q.awaitTermination()
    assert lists(spark, job) == {1: [200]}
    job.close()


def test_stream_result_independent_of_arrival_order(spark, tmp_dir):
    """Later events land (and are processed) first; newest-wins still gives the batch result."""
    from tasteflow.functions.lists import lists_to_ranked
    from tasteflow.plans import registry
    from tasteflow.sources import compose

    sf = "/root/testdata/sf0.001"
    ratings, sims = registry._realtime_inputs(spark, sf)
    lines = compose.rating_event_lines(ratings)
    cut = ratings.approxQuantile("timestamp", [0.5], 0.0)[0]
    src = os.path.join(tmp_dir, "events")
    lines.where(lines.event_time > cut).select("value").coalesce(1).write.text(src)
    time.sleep(1.1)  # the file source orders files by modification time
    lines.where(lines.event_time <= cut).select("value").coalesce(1).write.mode("append").text(src)
    table = os.path.join(tmp_dir, "recs")
    job = RealtimeRecommender(sims, ratings, table, min_sim=registry.PAIR_THRESHOLD)
    q = job.start(spark, src, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    job.close()
    key = ["uid", "rank", "mid", "score"]
    got = lists_to_ranked(sink.newest_lists(spark, table), "uid").select(*key)
    want = registry.realtime_lists(spark, sf).select(*key)
    r = lambda df: sorted((a, b, c, round(d, 6)) for a, b, c, d in df.collect())
    assert r(got) == r(want)


def test_factor_similarity_gives_the_lists_of_the_stored_table(spark, tmp_dir):
    """Batches compute the rows that they read, in which every list is as from the whole table."""
    import numpy as np

    from tasteflow.operators import similarity
    from tasteflow.streaming.recommender import FactorSimilarity

    rng = np.random.default_rng(4)
    factors = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)], "id int, features array<double>")
    ratings = stored(spark, [(u, int(m), float(m % 5 + 1), t) for u in range(6) for t, m in enumerate(rng.integers(0, 60, 12))])
    events = os.path.join(tmp_dir, "events")
    say(spark, events, *(f"{u}|{m}|4.0|{100 + u}" for u, m in enumerate((3, 9, 27, 41, 999))))
    pairs = similarity.cosine_pairs(factors, 0.1)
    got = {}
    for name, source in (("table", pairs), ("factors", FactorSimilarity(factors, 0.1))):
        job = RealtimeRecommender(source, ratings, os.path.join(tmp_dir, name), min_sim=0.1)
        job.start(spark, events, os.path.join(tmp_dir, f"{name}-ck"), trigger={"availableNow": True}).awaitTermination()
        got[name] = {r.uid: [(x.mid, round(x.score, 9)) for x in r.recs] for r in sink.newest_lists(spark, job.table).collect()}
        job.close()
    assert got["factors"] == got["table"] and sum(map(len, got["table"].values())) > 20
    reach = spark.createDataFrame([(5, 2), (5, 3), (7, 1), (99, 4)], "mid int, reach int")
    some = similarity.similar_lists(factors, 0.1, reach=reach).collect()
    whole = similarity.similar_lists(factors, 0.1).where("(mid = 5 and rank <= 3) or (mid = 7 and rank <= 1)").collect()
    assert sorted(map(tuple, some)) == sorted(map(tuple, whole)) and len(some) == 4


def test_users_share_a_row_of_state(spark, tmp_dir, monkeypatch):
    """Stored ratings of 1,000 users enter as a row per bucket, and each list is of its own user."""
    monkeypatch.setattr(history, "BUCKETS", 16)
    kept = spark.range(3000).selectExpr("CAST(id % 1000 AS INT) uid", "CAST(id AS INT) mid", "4.0D score", "id AS timestamp")
    source = os.path.join(tmp_dir, "ev")
    spark.createDataFrame([(u, 70, 5.0, 10**6, True) for u in range(0, 1200, 3)], EVENTS).write.parquet(source)
    seen = []
    got, query = run_history(spark, source, os.path.join(tmp_dir, "ck"), kept, False, seen, recent_k=2)
    assert seen == [400] and set(got) == set(range(0, 1200, 3))
    for u, (event, recent, rated) in got.items():
        mine = [] if u >= 1000 else [u + 2000, u + 1000, u]
        assert event == (10**6, 70, 5.0) and recent == [(m, m, 4.0) for m in mine[:2]] and rated == set(mine)
    assert [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]["numRowsTotal"] <= 3 * 16


def test_packed_events_go_by_age_as_sparks_rows(spark):
    import numpy as np
    import pyarrow as pa

    values = [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, 2.0), (2, 0, 0.0), (-3, -70, -1.0)]
    columns = [pa.array([7] * len(values), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*values), (pa.int64(), pa.int32(), pa.float64())))]
    events = history._events(pa.RecordBatch.from_arrays(columns, ["uid", *history.FIELDS]))
    order = sorted(range(len(values)), key=lambda i: history._order(values[i]))
    assert np.lexsort(history._age(events)).tolist() == order and history._last(events).tolist() == order[-1:]
    assert [history._newest(events, k).tobytes() for k in (1, 3, 9)] == [events[order[::-1][:k]].tobytes() for k in (1, 3, 9)]
    words = history._merged(history._words(events))
    assert {int(w["word"]) * 64 + i for w in words for i in range(64) if int(w["bits"]) >> i & 1} == {1, 0, -70}


def test_a_batch_gives_the_same_lists_where_few_items_are_known(spark, tmp_dir):
    """Users whose item is in no pair get an empty list; the batch's tables have no row per shuffle partition."""
    sims = spark.createDataFrame([(100, 200, 0.9), (100, 201, 0.8), (200, 10, 0.8), (201, 10, 0.7)], SIMS)
    events = os.path.join(tmp_dir, "events")
    say(spark, events, "1|100|5.0|9", "2|7|5.0|9", "3|100|4.0|9")
    job = RealtimeRecommender(sims, stored(spark, [(1, 10, 4.0, 1), (3, 10, 2.0, 1), (3, 200, 3.0, 0)]), os.path.join(tmp_dir, "recs"))
    job.start(spark, events, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}).awaitTermination()
    assert lists(spark, job) == {1: [200, 201], 2: [], 3: [201]}
    known = spark.read.parquet(f"{job.batch}/known").orderBy("uid").collect()
    assert [(r.uid, r.n_rated) for r in known] == [(1, 1), (3, 2)]
    job.close()
