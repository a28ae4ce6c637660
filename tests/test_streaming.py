from __future__ import annotations

from conftest import texts
from pairloom.operators import rules
from pairloom.streaming.arrivals import process_arrivals


def test_only_new_files_are_processed(spark, pairs_of, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    first = pairs_of([("hello there", "good day"), ("a", "b"), ("same text", "same text")])
    second = pairs_of([("next one <b>", "something"), (None, "x")])
    first.write.mode("append").parquet(source)
    process_arrivals(spark, source, target, checkpoint)
    assert texts(spark.read.parquet(target)) == [("hello there", "good day")]
    second.write.mode("append").parquet(source)
    process_arrivals(spark, source, target, checkpoint)
    got = texts(spark.read.parquet(target))
    assert got == texts(rules.rule_filter(first.unionByName(second), scope=()))
    process_arrivals(spark, source, target, checkpoint)
    assert texts(spark.read.parquet(target)) == got
