"""Plan-shape checks: pruning, pushdown, no row-at-a-time Python, no single-partition windows."""

import __spark_entry__ as entry

SF001 = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotation_scan_prunes_columns(spark):
    p = plan_of(entry.queries()["label_majority"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in p
    assert "l_shipdate" not in p and "l_extendedprice" not in p


def test_no_row_at_a_time_python(spark):
    for name in ("normalize_text", "parse_statuses", "label_majority", "random_sample"):
        p = plan_of(entry.queries()[name](spark, SF001))
        assert "BatchEvalPython" not in p, name


def test_no_unpartitioned_window_in_consensus(spark):
    p = plan_of(entry.queries()["label_majority"](spark, SF001))
    assert "SinglePartition" not in p


def test_date_window_partition_pruning(spark, tmp_path):
    from pyspark.sql import functions as F

    from annoflow.sources.parsed import read_parsed
    df = spark.range(40).select(F.col("id").cast("string").alias("id"),
                                F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 4).cast("int"))
                                .alias("created_day"), (F.col("id") % 2 == 0).alias("contains_keywords"))
    df.write.partitionBy("created_day").parquet(str(tmp_path / "parsed"))
    r = read_parsed(spark, str(tmp_path / "parsed"), "2020-01-02", "2020-01-04", usecols=["id", "contains_keywords"],
                    contains_keywords=True)
    p = plan_of(r)
    assert "PartitionFilters: [isnotnull(created_day" in p and "PushedFilters: [IsNotNull(contains_keywords)" in p
    assert sorted(int(x.id) for x in r.collect()) == [i for i in range(40) if i % 4 in (1, 2) and i % 2 == 0]
    assert r.columns == ["id"]
