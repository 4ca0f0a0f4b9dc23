"""Line dedup and its SQL agree on what a document is; filters are made segment by segment."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from changelake.llm import line_dedup
from changelake.llm.oracle import LINES
from changelake.llm.queries import op9_line_dedup

LONG, OTHER = "a line of more than forty code points, é, everywhere", "another line of more than forty code points, in few rows"


@pytest.mark.parametrize("rows", [
    [],
    [(1, LONG)] * 5 + [(2, f"{LONG}\nown")],
    [(1, LONG)] * 4 + [(2, OTHER)] * 4,
    [(7, LONG), (7, f"x\n{LONG}\n{LONG}"), (3, f" {LONG.upper()} \n"), (None, LONG), (None, f"{LONG}\ny"), (5, None), (6, "")],
    [(None, LONG)] * 6,
])
def test_repeated_and_missing_ids(spark, tmp_path, rows):
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}), f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({LINES})").fetchall(), key=str)
    got = sorted(map(tuple, op9_line_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == want


def test_many_segments_hold_every_repeated_hash(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEGMENT_LINES", 500)
    h = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 20_000)
    hashes = spark.createDataFrame([(int(x), False) for x in h] + [(int(x), False) for x in h[:300]] + [(int(x), True) for x in h[300:400]],
                                   "h long, repeated boolean")
    segments, size, filters = line_dedup.twice_seen(hashes, 20_400, 1 << 20)
    rows = filters.collect()
    assert segments == 41 and len(rows) == len({r.segment for r in rows}) == 41
    bits = {r.segment: np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8)) for r in rows}
    u = h.view(np.uint64)
    held = [all(bits[int(s)][int(p)] for p in (a, b))
            for s, a, b in zip(line_dedup._segment(u, segments), *line_dedup._places(u, size))]
    assert all(held[:400]) and np.mean(held[400:]) < 0.1
