"""A run of the pipeline with its counters taken while the results are written.

The counters are observed on the way: what is read, and what is written, in the one job
that writes the results.  Nothing is read a second time, and the clock runs over that
job alone.  A task that is repeated after its executor was lost may be counted twice in
an observation; the written table is what counts then (``statistics.run_statistics``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from policyscan.operators.documents import process_documents
from policyscan.operators.statistics import has_matches, succeeded
from policyscan.sources import files


@dataclass(frozen=True)
class Measured:
    """Counters and times of one run; sizes in bytes, times in seconds."""

    total_files_found: int
    files_read: int
    files_failed: int
    total_files_processed: int
    successful_extractions: int
    failed_extractions: int
    files_with_matches: int
    total_matches: int
    total_bytes_processed: int
    started: float
    ended: float

    @property
    def duration_seconds(self) -> float:
        return self.ended - self.started

    @property
    def files_per_second(self) -> float:
        return self.total_files_processed / self.duration_seconds if self.duration_seconds > 0 else 0.0

    @property
    def mb_per_second(self) -> float:
        return self.total_bytes_processed / (1 << 20) / self.duration_seconds if self.duration_seconds > 0 else 0.0

    def row(self) -> dict[str, float]:
        rates = {n: getattr(self, n) for n in ("duration_seconds", "files_per_second", "mb_per_second")}
        return asdict(self) | rates


def _written_counters() -> list[Column]:
    def many(condition: Column) -> Column:
        return F.coalesce(F.count_if(condition), F.lit(0))

    return [
        F.count(F.lit(1)).alias("total_files_processed"),
        many(succeeded()).alias("successful_extractions"),
        many(~succeeded()).alias("failed_extractions"),
        many(has_matches()).alias("files_with_matches"),
        F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("total_matches"),
        F.coalesce(F.sum(F.when(F.col("file_size") > 0, F.col("file_size"))), F.lit(0)).alias("total_bytes_processed"),
    ]


def measured_run(
    found: DataFrame,
    target: str,
    process: Callable[[DataFrame], DataFrame] = process_documents,
    files_found: int | None = None,
) -> Measured:
    """Read and process the files ``found`` and write their results to ``target``.

    ``files_found`` is the size of a listing taken before; files of it that vanished or
    cannot be read have failed.  Without one, all rows of ``found`` count.
    """
    read, written = Observation(), Observation()
    seen = found.observe(
        read, F.count(F.lit(1)).alias("files"), F.coalesce(F.count_if(files.is_readable()), F.lit(0)).alias("readable")
    )
    results = process(files.read_documents(seen)).observe(written, *_written_counters())
    started = time.time()
    results.write.mode("overwrite").parquet(target)
    ended = time.time()
    listed = read.get["files"] if files_found is None else files_found
    return Measured(
        total_files_found=listed,
        files_read=read.get["readable"],
        files_failed=listed - read.get["readable"],
        started=started,
        ended=ended,
        **written.get,
    )
