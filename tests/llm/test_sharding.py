import hashlib
from collections import defaultdict

import pytest

from annoflow.llm import sharding as S
from annoflow.llm.common import read


def brute(rows, limit):
    """(doc_id, bytes) with distinct ids -> shard bits, by splitting one bucket after the other."""
    address = {d: bin(int(hashlib.md5(str(d).encode()).hexdigest(), 16))[2:].zfill(128) for d, _ in rows}
    out, todo = {}, [("", rows)]
    while todo:
        prefix, part = todo.pop()
        if max(sum(b for _, b in part), len(part)) <= limit or len(part) == 1:
            out.update({d: (prefix, sum(b for _, b in part), len(part)) for d, _ in part})
            continue
        for bit in "01":
            todo.append((prefix + bit, [r for r in part if address[r[0]][len(prefix)] == bit]))
    return out


@pytest.mark.parametrize("limit", [1 << 20, 40_000, 3_000, 0])
def test_whole_table(spark, sf001, limit):
    docs = read(spark, sf001, "documents")
    rows = [(r.doc_id, len((r.text or "").encode())) for r in docs.collect()]
    want = brute(rows, limit)
    got = S.assign_shards(docs, limit).collect()
    assert {r.doc_id: (r.shard[1:], r.shard_bytes, r.shard_rows) for r in got} == want
    assert all(r.depth == len(r.shard) - 1 for r in got)


def test_pages_repeats_and_nulls(spark, odd, empty):
    same = [(1, "x" * 10)] * 40 + [(None, "y" * 10)] * 40 + [(None, None)] * 5 + [(2, "z" * 100)]
    got = S.assign_shards(spark.createDataFrame(same, "doc_id long, text string"), 30).collect()
    assert len(got) == 86
    size = defaultdict(list)
    for r in got:
        size[r.shard].append(r.n_bytes)
    assert all(sum(b) <= 30 or len(b) == 1 for b in size.values())
    assert sum(r.n_bytes == 100 for r in got) == 1
    shards = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert S.assign_shards(odd, 10).count() == odd.count()
    assert S.assign_shards(empty).count() == 0


def test_files(spark, sf001, tmp_path):
    docs = read(spark, sf001, "documents")
    S.write_shards(docs, str(tmp_path / "out"), 50_000)
    back = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())


def test_files_of_null_and_repeated_ids(spark, tmp_path):
    rows = [(1, "x" * 10)] * 4 + [(1, "w" * 10)] + [(None, "y" * 10)] * 4 + [(None, None), (2, "z" * 100)]
    docs, out = spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "out")
    S.write_shards(docs, out, 30)
    back = spark.read.parquet(out)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(rows, key=str)
    got = S.written_shards(spark, out, docs.schema).collect()
    assert len(got) == len(rows) and all(r.shard_bytes <= 30 or r.shard_rows == 1 for r in got)


def test_rows_without_bytes_are_split(spark):
    rows = [(i, None if i % 2 else "") for i in range(500)]
    got = S.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 30).collect()
    assert len(got) == 500 and max(r.shard_rows for r in got) <= 30 and {r.shard_bytes for r in got} == {0}


def test_clashing_columns_stay(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 20, f"own{i}", "e", 5) for i in range(12)], "doc_id long, text string, Shard string, entry string, n_bytes long")
    out = str(tmp_path / "out")
    S.write_shards(docs, out, 50)
    assert sorted((r.doc_id, r.Shard, r.n_bytes) for r in spark.read.parquet(out).collect()) == [(i, f"own{i}", 5) for i in range(12)]
    got = S.written_shards(spark, out, docs.schema).collect()
    assert len(got) == 12 and all(r.shard.startswith("s") and r.shard_bytes <= 50 for r in got)
