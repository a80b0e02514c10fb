"""Jump hashing against the published loop, and the law of growth."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from txscore.llm.queries import QUERIES
from txscore.llm.sharding import jump_hash, place, write_shards


def loop(key: int, shards: int) -> int:
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


@settings(max_examples=80, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.integers(1, 2000))
def test_matches_the_loop(key, shards):
    assert jump_hash(np.array([key], np.uint64), shards).tolist() == [loop(key, shards)]


def test_query_obeys_the_law(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_jump_hash"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for i, text in documents:
        raw = (text or "").encode()
        assert (rows[i].size, rows[i].text_crc32, rows[i].law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert rows[i].grown_shard in (rows[i].shard, 16)
    check_slots(rows.values(), 16)
    moved = sum(r.grown_shard != r.shard for r in rows.values())
    assert 0 < moved < 3 * len(rows) / 17


def check_slots(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


@pytest.mark.parametrize("shards", [1, 5])
def test_edges(edge_docs, no_docs, shards):
    rows = place(edge_docs.repartition(3), shards).collect()
    assert len(rows) == edge_docs.count()
    check_slots(rows, shards)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].size == 1 and by_id[1].text_crc32 == 0 and by_id[2].size == 1
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert place(no_docs, shards).collect() == []


def test_written_shards_hold_whole_rows(spark, edge_docs, tmp_path):
    write_shards(edge_docs.drop("own_shard"), str(tmp_path / "out"), 4, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    placed = {r.doc_id: r.shard for r in place(edge_docs, 4).collect()}
    assert back.count() == edge_docs.count() and set(edge_docs.columns) <= set(back.columns)
    assert all(r.own_shard == placed[r.doc_id] for r in back.select("doc_id", "own_shard").collect())
