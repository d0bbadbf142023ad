"""Property: the set-wise upsert of many slices equals applying the slices one by one with the
strict newer-timestamp guard (a plain-Python model of MERGE)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headway.operators import collapse_slices, latest_per_key, upsert_latest

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 5), st.integers(1, 4),
                          st.integers(0, 99)), min_size=1, max_size=12)
target_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "e"]), st.integers(0, 5), st.integers(0, 99)),
                       max_size=3, unique_by=lambda r: r[0])


def merge_model(target: dict, slices: dict) -> dict:
    state = dict(target)
    for day in sorted(slices):
        src = {}
        for key, ts, value in slices[day]:  # the slice's own dedupe: newest ts, then highest value
            if key not in src or (ts, value) > (src[key][0], src[key][1]):
                src[key] = (ts, value)
        for key, (ts, value) in src.items():
            if key not in state or ts > state[key][0]:
                state[key] = (ts, value)
    return state


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, target_rows)
def test_setwise_upsert_equals_sequential_merge(spark, src_rows, tgt_rows):
    from pyspark.sql import functions as F

    slices: dict = {}
    for key, ts, day, value in src_rows:
        slices.setdefault(day, []).append((key, ts, value))
    expected = merge_model({k: (ts, v) for k, ts, v in tgt_rows}, slices)

    src = spark.createDataFrame(src_rows, "k string, ts int, day int, v int")
    # within a day: newest ts then highest value (as the model); across days: newest ts, then earliest day
    per_day = latest_per_key(src, ["k", "day"], "ts", tiebreak=[F.col("v").desc()])  # dedupe inside each day
    collapsed = collapse_slices(per_day.select("k", "ts", "day", "v"), ["k"], "ts", "day").select("k", "ts", "v")
    target = spark.createDataFrame(tgt_rows, "k string, ts int, v int") if tgt_rows else None
    got = {r.k: (r.ts, r.v) for r in upsert_latest(target, collapsed, ["k"], "ts").collect()}
    assert got == expected
