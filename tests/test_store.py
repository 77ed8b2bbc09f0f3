"""The ingest store: cost of a batch, copies of other days, repeated and failed batches, quarantine."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from annoflow.plans import parse as parse_plan
from annoflow.sources import raw
from annoflow.streaming import ingest

DAYS = ["Wed Aug 27 13:08:45 +0000 2008", "Thu Aug 28 13:08:45 +0000 2008"]


def status(i, text="hi", day=0, **extra):
    return {"id": i, "id_str": str(i), "text": text, "created_at": DAYS[day], "user": {"id_str": "u"}, **extra}


def lines(spark, rows, path="/x/tweets-20200101120000-a.jsonl"):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r), path) for r in rows], "value string, source_file string")


def batch(n):
    """Ten statuses with the next ids; some answer earlier ones, of the batch before at most."""
    return [status(i, f"t{i}", **({"in_reply_to_status_id_str": str(i - 7)} if i % 3 == 0 and i > 10 else {})) for i in range(n * 10, n * 10 + 10)]


def test_rows_read_by_a_batch_do_not_grow(spark, tmp_path, monkeypatch):
    read_parts, read = ingest._read_parts, []
    monkeypatch.setattr(ingest, "_read_parts", lambda *a: (df := read_parts(*a), read.append(df.count()))[0])
    store, cost, everything = str(tmp_path / "s"), [], []
    for n in range(8):
        read.clear()
        everything += batch(n)
        ingest.merge_batch(lines(spark, batch(n)), store, span=10)
        cost.append(sum(read))
    assert max(cost[5:]) <= max(cost[2:5]) < 40, cost  # a batch has three or four answers
    parsed, _ = parse_plan.parse(lines(spark, everything).withColumn("day", raw.day_from_path("source_file")))
    want = sorted((r.id, r.text, r.num_replies) for r in parsed.collect())
    assert sorted((r.id, r.text, r.num_replies) for r in ingest.read_store(spark, store).collect()) == want


def rows(spark, store):
    return sorted((r.id, r.text, str(r.created_day), r.num_retweets, r.num_replies) for r in ingest.read_store(spark, store).collect())


@pytest.mark.parametrize("others", [[], [status(3, "stays")]])
def test_a_better_copy_of_another_day_leaves_one_row(spark, tmp_path, others):
    """The embedded copy tells another day than the original; its day is emptied, or keeps its other rows."""
    store = str(tmp_path / "s")
    ingest.merge_batch(lines(spark, [status(2, "RT", 1, retweeted_status=status(1, "short", 0)), *others]), store, span=5)
    assert ("1", "short", "2008-08-27", 1, 0) in rows(spark, store)
    ingest.merge_batch(lines(spark, [status(1, "whole", 1)]), store)
    want = [("1", "whole", "2008-08-28", 1, 0), ("2", "short", "2008-08-28", 0, 0)] + [("3", "stays", "2008-08-27", 0, 0)] * len(others)
    assert rows(spark, store) == want
    assert (tmp_path / "s" / "statuses" / "created_day=2008-08-27").exists() == bool(others)
    ingest.merge_batch(lines(spark, [status(2, "RT", 1, retweeted_status=status(1, "short", 0))]), store)
    assert rows(spark, store) == want


def test_a_batch_that_failed_anywhere_is_merged_when_it_is_repeated(spark, tmp_path, monkeypatch):
    """The second batch fails before or after it wrote the log (1), the statuses (2) or the locator (3)."""
    first = [status(2, "RT", 1, retweeted_status=status(1, "short", 0)), status(4, "x")]
    second = [status(1, "whole", 1), status(5, "reply", in_reply_to_status_id_str="4"), status(6, "reply", in_reply_to_status_id_str="1")]
    want = [("1", "whole", "2008-08-28", 1, 1), ("2", "short", "2008-08-28", 0, 0), ("4", "x", "2008-08-27", 0, 1),
            ("5", "reply", "2008-08-27", 0, 0), ("6", "reply", "2008-08-27", 0, 0)]
    overwrite = ingest._overwrite
    ingest.merge_batch(lines(spark, first), str(tmp_path / "first"), batch_id="a", span=3)
    for broken, after in ((1, True), (2, False), (2, True), (3, True)):
        store, writes = str(tmp_path / f"s{broken}{after}"), []
        shutil.copytree(tmp_path / "first", store)

        def fails(*a):
            writes.append(a)
            if len(writes) - 1 != broken or after:
                overwrite(*a)
            if len(writes) - 1 == broken:
                raise RuntimeError("executor lost")

        monkeypatch.setattr(ingest, "_overwrite", fails)
        with pytest.raises(RuntimeError):
            ingest.merge_batch(lines(spark, second), store, batch_id="b")
        monkeypatch.setattr(ingest, "_overwrite", overwrite)
        ingest.merge_batch(lines(spark, second), store, batch_id="b")
        assert rows(spark, store) == want
    ingest.merge_batch(lines(spark, second), store, batch_id="c")
    assert rows(spark, store) == want


def test_odd_ids_lines_and_spans(spark, tmp_path):
    store = str(tmp_path / "s")
    odd = [{"id": 7, "id_str": "x-7", "text": "a", "created_at": "no date", "user": {}}, status(8, "b", in_reply_to_status_id_str="x-7"),
           status(9, "c", in_reply_to_status_id_str="99999999999999999999999999"), "{broken", '{"limit": 1}']
    ingest.merge_batch(lines(spark, odd), store, batch_id="a")
    assert rows(spark, store) == [("8", "b", "2008-08-27", 0, 0), ("9", "c", "2008-08-27", 0, 0), ("x-7", "a", "None", 0, 1)]
    assert [r.value for r in ingest.read_quarantine(spark, store).collect()] == ["{broken"]
    ingest.merge_batch(lines(spark, [status(-3, "neg")]), store)
    assert "n-1" in {p.name.split("=")[1] for p in (tmp_path / "s" / "locator").iterdir() if p.is_dir()}
    ingest.merge_batch(lines(spark, []), store)
    assert len(rows(spark, store)) == 4
    with pytest.raises(ValueError):
        ingest.merge_batch(lines(spark, []), store, span=17)


def test_buckets(spark):
    df = spark.createDataFrame([("0",), ("9",), ("10",), ("-1",), ("-10",), ("-11",), ("-9223372036854775808",), ("abc",), ("12345678901234567890",), ("1e3",)], "id string")
    got = [r[0] for r in df.select(ingest.bucket_of("id", 10)).collect()]
    assert got[:7] == ["n0", "n0", "n1", "n-1", "n-1", "n-2", "n-922337203685477581"] and {g[0] for g in got[7:]} == {"h"}
