"""Property tests on random inputs (kept small: each example runs Spark jobs)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changelake.operators.audit import capture_changes
from changelake.operators.rowevents import lookup_table_map

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

records = st.lists(
    st.tuples(st.integers(0, 300), st.integers(1, 4), st.booleans()), min_size=1, max_size=60,
    unique_by=lambda t: t[0],
)


@SETTINGS
@given(recs=records, width=st.sampled_from([1, 7, 50, 1 << 20]), levels=st.integers(0, 3))
def test_asof_equals_brute_force(spark, recs, width, levels):
    maps = [(p, k, f"d{k}", f"t{p}") for p, k, is_map in recs if is_map]
    evs = [(p, k) for p, k, is_map in recs if not is_map]
    if not evs:
        return
    ev_df = spark.createDataFrame(evs, "position long, table_id long")
    mp_df = spark.createDataFrame(maps, "position long, table_id long, database string, table string")
    got = {r.position: (r.database, r.table) for r in lookup_table_map(ev_df, mp_df, bucket_width=width, levels=levels).collect()}
    for p, k in evs:
        cands = [m for m in maps if m[1] == k and m[0] <= p]
        best = max(cands, key=lambda m: m[0]) if cands else None
        assert got[p] == ((best[2], best[3]) if best else ("unknown_db", "unknown_table"))


table = st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.text("abc", max_size=3)), max_size=25)


@SETTINGS
@given(old=table, new=table)
def test_capture_replayed_on_old_gives_new(spark, old, new):
    schema = "id long, v string"
    o = spark.createDataFrame(sorted(old.items()), schema)
    n = spark.createDataFrame(sorted(new.items()), schema)
    state = dict(old)
    ops = {}
    for r in capture_changes(o, n, "id", version="v1").collect():
        key = int(r.record_id)
        ops[key] = r.operation
        if r.operation == "D":
            del state[key]
        else:
            state[key] = json.loads(r.new_data)["v"]
    assert state == new
    # exactly the changed keys produce a row
    changed = {k for k in old.keys() | new.keys() if old.get(k, "<absent>") != new.get(k, "<absent>")
               or (k in old) != (k in new)}
    assert set(ops) == changed
