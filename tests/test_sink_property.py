"""Appended lists over random batch sequences vs a dict with newest-wins."""

import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from tasteflow.streaming import sink

SCHEMA = "uid int, recs array<struct<mid:int,score:double>>, event_time long, event_mid int, event_score double"
event = st.tuples(st.integers(0, 6), st.integers(0, 4), st.integers(0, 3), st.sampled_from([1.0, 4.0]))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(event, min_size=1, max_size=6), min_size=1, max_size=3))
def test_batch_sequence_matches_newest_wins_model(spark, batches):
    folder = tempfile.mkdtemp(prefix="tasteflow-sink-")
    path, model = os.path.join(folder, "t"), {}
    for number, rows in enumerate(batches):
        data = [(u, [(m, s)], t, m, s) for u, t, m, s in rows]
        for _ in range(1 + number % 2):  # every other batch comes twice
            sink.append_lists(spark.createDataFrame(data, SCHEMA), path, number)
        for u, t, m, s in rows:
            if u not in model or (t, m, s) >= model[u]:
                model[u] = (t, m, s)
    sink.compact(spark, path, os.path.join(folder, "c"))
    for table in ("t", "c"):
        got = {r.uid: (r.event_time, r.event_mid, r.event_score) for r in sink.newest_lists(spark, os.path.join(folder, table)).collect()}
        assert got == model
