"""Processing of newly arrived files only: the incremental skip, file by file.

The manifest skips whole datasets.  Here the checkpoint of a file stream remembers which
files were processed, so a dataset that grows by files is never read twice.  The stages
that look at one pair at a time run unchanged; deduplication across batches belongs to the
merge, which sees everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairloom.model import PAIR_SCHEMA
from pairloom.operators.rules import RuleOptions, drop_blank, normalise, pairwise_rules


def rules_per_pair(df: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """The rule filter without its distinct step."""
    return df.transform(pairwise_rules, options).transform(normalise, options).transform(drop_blank)


def process_arrivals(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = rules_per_pair,
) -> None:
    """Read the Parquet files of pairs that arrived in ``source`` since the last call, write
    what ``transform`` leaves of them to ``target``, and return."""
    arrived = spark.readStream.schema(PAIR_SCHEMA).parquet(source)
    writer = transform(arrived).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    query = writer.option("path", target).partitionBy("dataset").trigger(availableNow=True).start()
    query.awaitTermination()
