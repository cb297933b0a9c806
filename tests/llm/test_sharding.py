from __future__ import annotations

import zlib

import numpy as np
import pytest

from agora.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 24, 100, 4096, 4097, 70_001])
def test_permutation_of_whole_range(n):
    out = sharding.permute(np.arange(n), n, seed=5)
    assert sorted(out.tolist()) == list(range(n))
    assert np.array_equal(out, sharding.permute(np.arange(n), n, seed=5))
    if n > 100:
        assert not np.array_equal(out, sharding.permute(np.arange(n), n, seed=6))
        assert abs(np.corrcoef(np.arange(n), out)[0, 1]) < 0.1


def test_shards(spark):
    rows = [(i, f"text {i} é") for i in range(101)] + [(None, None), (7, "text 7 é"), (3, "")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                               "doc_id long, text string, shard int, _p int")
    got = sharding.shard(df.repartition(5), shards=24).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r["size"], r.text_crc32) for r in got) == sorted(
        (i is not None, i, len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard(df.repartition(2), shards=24).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # shard and slot follow from the row number alone
    for r in got:
        p = int(sharding.permute(np.array([r.row_number]), len(rows), 20)[0])
        assert (r.shard, r.slot) == (p % 24, p // 24)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(df).collect() == []
