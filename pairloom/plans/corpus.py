"""A whole run: catalog -> stages -> datasets on disk -> merged corpus.

Nothing loops over datasets: all datasets of the catalog go through one plan, keyed by
their name.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from pairloom.operators.language import LanguageDetector, detect_languages, language_report
from pairloom.operators.quality import corpus_quality, score_quality
from pairloom.operators.rules import RuleOptions
from pairloom.operators.sampling import row_cap
from pairloom.plans.manifest import dataset_metadata, latest_metadata, merged_summary, still_to_do
from pairloom.plans.merge import finished_pairs, included_datasets, merge_corpus, merge_metadata
from pairloom.plans.stages import COUNTS, Stage, flag_stages, stage_funnel, with_total
from pairloom.session import cut_lineage
from pairloom.sinks import files
from pairloom.sources.catalog import Entry, named_entries, read_catalog


@dataclass(frozen=True)
class Output:
    root: str
    src_lang: str
    tgt_lang: str
    save_format: str = "parquet"
    checkpoint_dir: str | None = None

    @property
    def lang_pair(self) -> str:
        return f"{self.src_lang}-{self.tgt_lang}"

    @property
    def pairs(self) -> str:
        return f"{self.root}/pairs"

    @property
    def text(self) -> str:
        return f"{self.root}/text"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"


def read_manifest(spark: SparkSession, output: Output) -> DataFrame:
    """Datasets of the language pair that a run has committed; empty before the first run."""
    if not files.folder_exists(spark, output.manifest):
        return spark.createDataFrame([], files.MANIFEST)
    return files.read_metadata(spark, output.manifest, files.MANIFEST).where(F.col("lang_pair") == output.lang_pair)


def committed_runs(manifest: DataFrame) -> list[Row]:
    """(dataset_name, run) of the newest row of each dataset: as many rows as catalogs have had entries."""
    return latest_metadata(manifest).select("dataset_name", "run").collect()


def read_output(spark: SparkSession, output: Output) -> DataFrame:
    """The pairs of all datasets that runs have committed."""
    return files.read_runs(spark, output.pairs, output.src_lang, output.tgt_lang, committed_runs(read_manifest(spark, output)))


def read_output_lines(spark: SparkSession, output: Output) -> DataFrame:
    """(lang, dataset, value): the lines of the text files of all datasets that runs have committed."""
    return files.read_run_lines(spark, output.text, output.src_lang, output.tgt_lang, committed_runs(read_manifest(spark, output)))


def clean_output(spark: SparkSession, output: Output, keep: Sequence[str] = ()) -> list[str]:
    """Remove the files of runs that no dataset is read from any more, and of runs that failed; not while
    another run goes on, unless its id is among those to ``keep``."""
    runs = committed_runs(read_manifest(spark, output))
    gone = [files.remove_unread_runs(spark, root, output.src_lang, output.tgt_lang, runs, keep) for root in (output.pairs, output.text)]
    return sorted(set(gone[0] + gone[1]))


def new_run() -> str:
    """An id that sorts by time and is never taken for a number."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def process_datasets(
    spark: SparkSession,
    entries: Sequence[Entry],
    output: Output,
    stages: Sequence[Stage],
    rules: RuleOptions | None = RuleOptions(),
    quality_table: DataFrame | None = None,
    from_cache: bool = True,
    cap: int | None = None,
    report: tuple[LanguageDetector, LanguageDetector] | None = None,
) -> DataFrame:
    """Process what is not finished yet; returns the summary with its TOTAL row, in which
    ``cached`` marks the datasets of earlier runs.

    Files go to a folder of this run.  The manifest rows, written last and at once, make it the
    run that these datasets are read from; a run that fails before leaves everything as it was.

    ``cap`` limits the rows read in this run.  A dataset that it cuts short is committed with the
    rows it has, but not as complete: the next run reads it again.  One that it does not reach is not
    committed at all.  ``report`` writes the languages that two detectors find on either side of what was kept.
    """
    files.check_format(output.save_format)
    named = named_entries(entries)
    listed = spark.createDataFrame([(name, entry.kind) for _, name, entry in named], "dataset string, source string")
    # Names of catalog entries: a list as long as the catalog.
    done = latest_metadata(read_manifest(spark, output)).where("complete")
    todo = listed if not from_cache else still_to_do(listed, done)
    processed = [r.dataset for r in todo.select("dataset").collect()]
    if processed:
        skip = {name for _, name, _ in named} - set(processed)
        pairs = whole = read_catalog(spark, entries, output.src_lang, output.tgt_lang, skip=skip)
        if cap is not None:
            pairs = row_cap(pairs, cap)
        run = new_run()
        # Scored once, written to the shared folder; output, counts and quality read that.
        # Of rows that were lost only the dataset and the stage are kept.
        survives = F.col("passed") == len(stages)
        flagged = flag_stages(pairs, stages, rules)
        flagged = flagged.withColumns({c: F.when(survives, F.col(c)) for c in ("src", "tgt")})
        flagged = cut_lineage(flagged, output.checkpoint_dir)
        kept = flagged.where(survives).drop("passed")
        # Merging reads Parquet; text files are written beside it.
        files.write_run(kept, output.pairs, output.src_lang, output.tgt_lang, run)
        if output.save_format == "text":
            files.write_aligned_text(kept, output.text, output.src_lang, output.tgt_lang, run=run)
        if report is not None:
            write_language_report(kept, output, report)
        kinds = listed.where(F.col("dataset").isin(processed))
        counts = stage_funnel(pairs, flagged, stages)
        # A dataset of which no row was read counts zero, and is finished as well.
        funnel = kinds.join(counts, "dataset", "left").na.fill(0, list(COUNTS))
        if cap is None:
            funnel = funnel.withColumn("complete", F.lit(True))
        else:
            rows = whole.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
            funnel = funnel.join(rows, "dataset", "left").na.fill(0, ["rows"])
            funnel = funnel.withColumn("complete", F.col("original") == F.col("rows")).where("complete OR original > 0").drop("rows")
        if quality_table is None:
            summary = funnel.withColumn("quality_score", F.lit(None).cast("double"))
        else:
            summary = funnel.join(corpus_quality(score_quality(kept, quality_table)), "dataset", "left")
        commit(summary, output, run)
    wanted = [name for _, name, _ in named]
    latest = latest_metadata(read_manifest(spark, output).where(F.col("dataset_name").isin(wanted)))
    new = F.col("dataset_name").isin(processed) if processed else F.lit(False)
    rows = merged_summary(latest.where(~new), latest.where(new)).withColumnRenamed("dataset_name", "dataset").drop("source")
    # What a cap did not reach has no row in the manifest.
    rows = listed.join(rows, "dataset", "left").na.fill(0, list(COUNTS)).na.fill(False, ["cached", "complete"])
    totals = with_total(rows.select("dataset", *COUNTS), rows.select("dataset", "quality_score"))
    summary = totals.join(rows.select("dataset", "source", "cached", "complete"), "dataset", "left")
    files.write_summary_csv(summary, f"{output.root}/summary")
    return summary


def commit(summary: DataFrame, output: Output, run: str) -> None:
    """The rows of ``summary`` (dataset, source, counts, quality_score, complete) as manifest rows of ``run``:
    one file, which is there as a whole or not at all."""
    complete = summary.select(F.col("dataset").alias("dataset_name"), "complete")
    metadata = dataset_metadata(summary, output.lang_pair, F.current_timestamp()).join(complete, "dataset_name")
    files.write_metadata(metadata.withColumn("run", F.lit(run)), output.manifest)


def write_language_report(
    kept: DataFrame, output: Output, detectors: tuple[LanguageDetector, LanguageDetector]
) -> None:
    """Share of each detected language per side and dataset, as JSON under root/languages."""
    detected = detect_languages(kept, *detectors)
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_lang.code").alias("code")) for s in ("src", "tgt")])
    found = detected.select("dataset", F.inline(sides)).withColumn("part", F.struct("side", "dataset"))
    report = language_report(found, "code", by="part").select("part.*", "code", "rows", "share")
    files.write_metadata(report, f"{output.root}/languages/{output.lang_pair}", mode="overwrite")


def merge_datasets(
    spark: SparkSession,
    output: Output,
    test: DataFrame | None = None,
    dedup: bool = True,
    excluded: Sequence[str] = (),
    include_excluded: bool = False,
    near: float | None = None,
    least_quality: float | None = None,
) -> DataFrame:
    """Merge all finished datasets, write the corpus and its metadata, return the metadata.

    ``excluded`` datasets are set aside unless ``include_excluded``; with ``least_quality``
    those are, too, whose stored quality is lower or unknown.  ``near``: see ``merge_corpus``.
    """
    latest = latest_metadata(read_manifest(spark, output))
    aside = F.col("dataset_name").isin(list(excluded))
    if least_quality is not None:
        aside = aside | ~F.coalesce(F.col("quality_score") >= least_quality, F.lit(False))
    latest = latest.withColumn("excluded", aside)
    pairs = finished_pairs(read_output(spark, output), latest, include_excluded)
    merged, final = merge_corpus(pairs, test, dedup, near, lambda df: cut_lineage(df, output.checkpoint_dir))
    path = files.write_merged(final, output.root, output.src_lang, output.tgt_lang)
    written = spark.read.parquet(path)
    included = included_datasets(pairs, latest)
    metadata = cut_lineage(
        merge_metadata(included, output.lang_pair, merged, written, F.current_timestamp()), output.checkpoint_dir
    )
    files.write_metadata(metadata, f"{path}_metadata", mode="overwrite")
    return metadata
