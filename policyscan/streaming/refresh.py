"""Keeping results and mappings current when pages change.

``content_hash`` of the stored results tells which documents are new or different.
Only those are matched again.  The mapping table is always resolved over all
results: a page that arrives late may have an earlier path than the one that won.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from policyscan import fixed
from policyscan.functions.paths import relative_to
from policyscan.functions.text import sha256_16
from policyscan.operators.database import first_wins
from policyscan.operators.documents import process_documents, result_mappings
from policyscan.session import stage
from policyscan.sources.files import read_documents, scan


def text_hashes(documents: DataFrame) -> DataFrame:
    return documents.select("path", sha256_16(F.col("content")).alias("text_hash"))


def changed_documents(documents: DataFrame, previous: DataFrame) -> DataFrame:
    """Documents that are new or differ from previous(path, text_hash).

    Only paths and hashes are shuffled to find them; the changed paths are stored, and
    texts are read again for those alone.
    """
    known = previous.select("path", "text_hash")
    changed = text_hashes(documents).join(known, ["path", "text_hash"], "left_anti")
    return documents.join(stage(changed.distinct(), "changed-paths"), "path")


def refresh(documents: DataFrame, previous: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Results after a change: changed documents matched again, the others kept.

    ``previous`` is the result table of the last run with its ``text_hash``.  Results of
    documents that are gone are dropped, as in a full run, unless ``keep_missing``.  The
    fresh results are staged, so each changed text is matched once although its path is
    needed twice.
    """
    fresh = stage(process_documents(changed_documents(documents, previous)), "fresh")
    kept = previous.join(fresh.select("path"), "path", "left_anti")
    if not keep_missing:
        kept = kept.join(documents.select("path"), "path", "left_semi")
    return kept.unionByName(fresh.select(*previous.columns))


def refreshed_mappings(documents: DataFrame, previous: DataFrame) -> DataFrame:
    return first_wins(result_mappings(refresh(documents, previous)))


def latest_results(log: DataFrame) -> DataFrame:
    """Newest result of every path in an append-only log with ``run``."""
    columns = [c for c in log.columns if c not in ("path", "run")]
    newest = F.max_by(F.struct(*columns), "run")
    return log.groupBy("path").agg(newest.alias("r")).select("path", "r.*")


def start_refresh(
    spark: SparkSession,
    source: str,
    results_path: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame] = process_documents,
    extensions: list[str] | None = None,
    ignore: list[str] | None = None,
    max_mb: float = fixed.PIPELINE_MAX_MB,
) -> StreamingQuery:
    """Watch a folder and append the results of new files to a log of results.

    The stream sees every file name once: edited and removed files are the business of
    ``refresh``.  Paths and selection rules are those of the batch scan.

    Each micro-batch writes its own run folder and overwrites it when the batch is
    repeated, so a restart never doubles rows.  ``latest_results`` over
    ``results_path`` then feeds ``first_wins``.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .load(source)
    )
    files = scan(
        files.withColumn("path", relative_to(F.col("path"), source)),
        extensions or fixed.PIPELINE_EXTENSIONS,
        ignore or fixed.PIPELINE_IGNORE,
        max_mb,
    )

    def write(batch: DataFrame, run: int) -> None:
        results = process(read_documents(batch))
        results.write.mode("overwrite").parquet(f"{results_path}/run={run}")

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
