"""Posting lists of fingerprints: 35 keys a fingerprint, which Spark would size by the fingerprints."""

from __future__ import annotations

from stayledger.llm import simhash


def test_sizes_of_lists_are_not_broadcast(spark, tmp_path):
    # Stored, as they are in a run: Spark knows the size of the file.
    spark.createDataFrame([(n << 20,) for n in range(64)], "fp bigint").write.parquet(str(tmp_path / "fps"))
    fps = spark.read.parquet(str(tmp_path / "fps"))
    plan = simhash._lists(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in plan


def test_lists_hold_the_members_of_shared_postings(spark):
    # The first two differ in the last byte only, so they share all 35 postings; the third has none of theirs.
    fps = spark.createDataFrame([(1,), (1 | 1 << 56,), (0x7FFEFDFCFBFAF9F8,)], "fp bigint")
    lists = simhash._lists(fps).collect()
    assert len(lists) == 2 * 35
    assert {row.fp for row in lists} == {1, 1 | 1 << 56}
