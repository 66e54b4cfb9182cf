import zlib

import numpy as np
import pytest

from cantora.llm import checks, sharding
from tests.parity import duck

SF = "/root/testdata/sf0.001"


def test_curve_visits_every_cell_once_in_unit_steps():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index) == list(range(side**dims))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("shards", [1, 8, 20])
def test_law_rows(odd_docs, shards):
    rows = sharding.hilbert_shards(odd_docs, shards).collect()
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 12
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    }
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_empty(no_docs):
    assert sharding.hilbert_shards(no_docs).count() == 0


def test_curve_equals_sql_and_runs_follow_it(spark):
    rows = sharding.hilbert_shards(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    expected = {r[0]: r[5] for r in duck(SF).execute(checks.hilbert_sql()).fetchall()}
    assert {r["doc_id"]: r["hilbert"] for r in rows} == expected
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["hilbert"], r["text_crc32"], r["doc_id"]) for r in order]
    assert keys == sorted(keys)


def test_shards_prune(spark, tmp_path):
    sharded = sharding.hilbert_shards(spark.read.parquet(f"{SF}/documents.parquet"))
    ranges = sharding.manifest(sharded).collect()
    skipped = sum(not r["min_lang"] <= lang <= r["max_lang"] for r in ranges for lang in ("de", "en", "es", "fr"))
    assert skipped >= 8  # of 32: a filter on a language reads three shards in four at most
    sharding.write_shards(sharded, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == sharded.count()
