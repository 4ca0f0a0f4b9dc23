"""Late table-map records and observed counts."""

import random

import pytest

from changelake.streaming.metrics import counted_batches, read_counts
from changelake.streaming.table_map_late import answer_log, current_answers, late_map_batch

SCHEMA = "position long, event_type string, table_id long, rows array<array<string>>, rows_after array<array<string>>, database string, `table` string"


def record(pos, table_id, name=None):
    kind = "TABLE_MAP" if name else "INSERT"
    return (pos, kind, table_id, None if name else [["x"]], None, f"db{table_id}" if name else None, name)


def records():
    rnd = random.Random(4)
    out = []
    for pos in range(400):
        table_id = 7 if rnd.random() < 0.4 else rnd.choice([1, 2, 3, None])
        out.append(record(pos, table_id, f"t{pos}" if rnd.random() < 0.1 else None))
    return out


def brute(rows):
    out = []
    for r in rows:
        if r[1] != "TABLE_MAP":
            known = [m for m in rows if m[1] == "TABLE_MAP" and m[2] is not None and m[2] == r[2] and m[0] <= r[0]]
            best = max(known, default=None)
            out.append((r[0], r[2], best[5] if best else "unknown_db", best[6] if best else "unknown_table"))
    return sorted(out, key=str)


def answers(spark, root):
    return sorted(map(tuple, current_answers(spark, root).collect()), key=str)


def run(spark, root, batches):
    for k, rows in enumerate(batches):
        late_map_batch(spark.createDataFrame(rows, SCHEMA).repartition(2), k, root, bucket_width=50)


def test_any_order_gives_the_lookup_over_all(spark, tmp_path):
    rows = records()
    mixed = rows[:]
    random.Random(9).shuffle(mixed)
    run(spark, f"{tmp_path}/a", [mixed[:150], mixed[150:160], mixed[160:]])
    assert answers(spark, f"{tmp_path}/a") == brute(rows)
    log = answer_log(spark, f"{tmp_path}/a")
    assert log.where("change < 0").count() > 0 and log.where("batch_id = 0 and change < 0").count() == 0


def test_records_in_order_take_nothing_back(spark, tmp_path):
    rows = records()
    run(spark, f"{tmp_path}/a", [rows[:200], rows[200:]])
    assert answers(spark, f"{tmp_path}/a") == brute(rows) and answer_log(spark, f"{tmp_path}/a").where("change < 0").count() == 0


def test_replayed_batch_and_repeated_events(spark, tmp_path):
    first = [record(10, 1), record(10, 1), record(20, 1), record(30, None)]
    late = [record(5, 1, "early"), record(15, 1, "mid")]
    root = f"{tmp_path}/a"
    run(spark, root, [first, late])
    late_map_batch(spark.createDataFrame(late, SCHEMA), 1, root, bucket_width=50)
    assert answers(spark, root) == brute(first + late)
    late_map_batch(spark.createDataFrame([record(12, 1, "last")], SCHEMA), 2, root, bucket_width=50)
    late_map_batch(spark.createDataFrame([], SCHEMA), 3, root, bucket_width=50)
    assert answers(spark, root) == brute(first + late + [record(12, 1, "last")])


def test_counts_are_stored_by_batch_and_replayed(spark, tmp_path):
    path, out = f"{tmp_path}/counts", f"{tmp_path}/out"

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/{batch_id}")

    counted = counted_batches(write, path, "kind", ("row", "ignored"))
    rows = spark.createDataFrame([("row",), ("row",), ("ignored",), ("what",), (None,)], "kind string")
    counted(rows, 0)
    counted(rows.where("kind = 'row'"), 1)
    counted(rows, 0)
    got = {(r["batch_id"], r["kind"]): r["n"] for r in read_counts(spark, path).collect()}
    assert got == {(0, "row"): 2, (0, "ignored"): 1, (0, "other"): 2, (1, "row"): 2, (1, "ignored"): 0, (1, "other"): 0}

    def broken(df, batch_id):
        raise OSError("no sink")

    with pytest.raises(OSError):
        counted_batches(broken, path, "kind", ("row",))(rows, 2)
    assert read_counts(spark, path).where("batch_id = 2").count() == 0
