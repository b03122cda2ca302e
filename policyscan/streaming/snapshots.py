"""A store of results and mappings kept current from listings.

The store remembers the last listing (file, length, modification time).  A run compares
the next listing with it and reads the files that are new or edited, and no others.

    snapshots/run=N     the listing of run N; the last complete one counts
    pending/run=N       files and identifiers of a run that has not ended
    results/bucket=b    result rows, by a hash of their path
    found/bucket=b      (checkov_id, severity, path), by a hash of the identifier
    mappings/bucket=b   per identifier: severity, first file, agreeing and conflicting files

Changes retract: an edited or removed page's old rows leave ``found``, fresh rows enter, and
the identifiers either touches are resolved again; all others keep their state.  Only the
buckets that a change touches are read and written back (dynamic partition overwrite).
A bucket keeps a marker row (path or identifier null), so that an emptied bucket is
overwritten too.

A run that dies can simply be repeated: a table is written from staged rows, ``found`` and
``mappings`` before ``results`` (which still tells the old identifiers), the snapshot last.
What the dead run may have touched is pending and counts as changed in the next one, also
where the folder has changed once more.  Buckets of a hot identifier are written by several
tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import SALTS
from policyscan.operators import database as db
from policyscan.operators.documents import process_documents, result_mappings
from policyscan.session import stage
from policyscan.sources import files

BUCKETS = 256
LISTED = ["file", "path", "length", "modificationTime"]
STATE = ["checkov_id", "severity", "first_file", "agreeing", "conflicting"]


@dataclass(frozen=True)
class Run:
    """What a run did."""

    number: int
    listed: int
    new: int
    edited: int
    removed: int
    identifiers: int


def changes(listing: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Files that are new, edited or removed since ``previous``: file, path, change.

    Both sides are listings (``LISTED``); no content is read.
    """
    now = listing.select(*LISTED)
    if previous is None:
        return now.select("file", "path", F.lit("new").alias("change"))
    then = previous.select("file", *[F.col(c).alias(f"old_{c}") for c in LISTED[1:]])
    both = now.join(then, "file", "full_outer")
    same = (F.col("length") == F.col("old_length")) & F.col("modificationTime").eqNullSafe(F.col("old_modificationTime"))
    change = F.when(F.col("old_path").isNull(), "new").when(F.col("path").isNull(), "removed").when(~same, "edited")
    return both.select("file", F.coalesce("path", "old_path").alias("path"), change.alias("change")).filter("change IS NOT NULL")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Store:
    """Results and mappings of a folder of pages, under ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        process: Callable[[DataFrame], DataFrame] = process_documents,
        columns: list[str] | None = None,
        buckets: int = BUCKETS,
    ):
        """``columns`` of the results to keep (all by default).  The number of buckets is the store's from its first run on."""
        self.spark, self.root, self.process, self.columns, self.buckets = spark, root.rstrip("/"), process, columns, buckets

        if self._exists("settings"):
            self.buckets = spark.read.parquet(f"{self.root}/settings").first()["buckets"]

    # --- reading ----------------------------------------------------------------

    def _system(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return place, place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _exists(self, table: str) -> bool:
        """Whether a table has been written to its end."""
        place, system = self._system(f"{table}/_SUCCESS")
        return system.exists(place)

    def _last_run(self) -> int | None:
        place, system = self._system("snapshots")
        if not system.exists(place):
            return None
        runs = (int(s.getPath().getName().split("=")[1]) for s in system.listStatus(place))
        return max((r for r in runs if self._exists(f"snapshots/run={r}")), default=None)

    def snapshot(self) -> DataFrame | None:
        """The listing of the last complete run."""
        last = self._last_run()
        return None if last is None else self.spark.read.parquet(f"{self.root}/snapshots/run={last}")

    def _table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        table = self.spark.read.parquet(f"{self.root}/{name}")
        return table if buckets is None else table.filter(F.col("bucket").isin(buckets))

    def results(self) -> DataFrame:
        return self._table("results").filter("path IS NOT NULL").drop("bucket")

    def resolved(self) -> DataFrame:
        """``STATE`` of every identifier."""
        return self._table("mappings").filter("checkov_id IS NOT NULL").select(*STATE)

    def mappings(self) -> DataFrame:
        return self.resolved().select("checkov_id", "severity")

    # --- writing ----------------------------------------------------------------

    def _write(self, rows: DataFrame, name: str, touched: list[int], spread: str, whole: bool) -> None:
        """Replace the touched buckets of a table (or the whole table) by ``rows`` and a marker each."""
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != "bucket"]
        numbers = self.spark.createDataFrame([(b,) for b in touched], "bucket int")
        kept = stage(rows.unionByName(numbers.select("bucket", *nothing)), name)
        salt = F.pmod(F.xxhash64(spread), F.lit(SALTS))
        dealt = kept.repartition(F.col("bucket"), salt).sortWithinPartitions("bucket")
        mode = "static" if whole else "dynamic"
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy("bucket").parquet(f"{self.root}/{name}")

    @staticmethod
    def _numbers(rows: DataFrame) -> list[int]:
        return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most the buckets

    def _by(self, rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("bucket", _bucket(F.col(key), self.buckets))

    def update(self, listing: DataFrame, read: Callable[[DataFrame], DataFrame]) -> Run:
        """Bring the store up to date with ``listing``.

        ``read`` gets the changed files (file, path) and returns their documents; files that
        can no longer be read then have no documents and so no results.
        """
        listed = stage(listing.select(*LISTED), "listing")
        last = self._last_run()
        number = 0 if last is None else last + 1
        if last is None:
            settings = self.spark.createDataFrame([(self.buckets,)], "buckets int")
            settings.write.mode("overwrite").parquet(f"{self.root}/settings")
        changed = changes(listed, self.snapshot())
        pending = f"pending/run={number}"
        if last is not None and self._exists(f"{pending}/files"):
            dead = self.spark.read.parquet(f"{self.root}/{pending}/files").select("file", "path")
            dead = dead.join(changed.select("file"), "file", "left_anti").join(
                listed.select("file", F.lit(True).alias("there")), "file", "left"
            )
            again = F.when(F.col("there"), "edited").otherwise("removed").alias("change")
            changed = changed.unionByName(dead.select("file", "path", again))
        changed = stage(changed, "changes")
        counts = {r["change"]: r["count"] for r in changed.groupBy("change").count().collect()}
        identifiers = 0
        if counts or last is None:
            documents = read(changed.filter("change <> 'removed'").select("file", "path"))
            fresh = self.process(documents)
            fresh = stage(fresh.select(*self.columns) if self.columns else fresh, "fresh")
            if last is None:
                identifiers = self._build(fresh)
            else:
                identifiers = self._apply(changed, fresh, pending)
        listed.write.mode("overwrite").parquet(f"{self.root}/snapshots/run={number}")
        return Run(number, listed.count(), *(counts.get(k, 0) for k in ("new", "edited", "removed")), identifiers)

    def _build(self, fresh: DataFrame) -> int:
        found = self._by(result_mappings(fresh), "checkov_id")
        table = stage(self._by(db.resolved(found), "checkov_id"), "mappings-now")
        results = self._by(fresh, "path")
        self._write(found, "found", self._numbers(found), "path", whole=True)
        self._write(table, "mappings", self._numbers(table), "checkov_id", whole=True)
        self._write(results, "results", self._numbers(results), "path", whole=True)
        return table.count()

    def _apply(self, changed: DataFrame, fresh: DataFrame, pending: str) -> int:
        gone = stage(self._by(changed.select("path").distinct(), "path"), "changed-paths")
        path_buckets = self._numbers(gone)
        old = self._table("results", path_buckets).filter("path IS NOT NULL")
        old_found = result_mappings(old.join(gone.select("path"), "path", "left_semi"))
        fresh_found = result_mappings(fresh)
        # Identifiers that lose or gain a row, also by a run that died.
        touched = old_found.select("checkov_id").union(fresh_found.select("checkov_id"))
        if self._exists(f"{pending}/identifiers"):
            touched = touched.union(self.spark.read.parquet(f"{self.root}/{pending}/identifiers"))
        touched = stage(self._by(touched.distinct(), "checkov_id"), "touched")
        changed.write.mode("overwrite").parquet(f"{self.root}/{pending}/files")
        touched.select("checkov_id").write.mode("overwrite").parquet(f"{self.root}/{pending}/identifiers")
        id_buckets = self._numbers(touched)
        if id_buckets:
            self._resolve_again(touched, gone, self._by(fresh_found, "checkov_id"), id_buckets)
        kept = old.join(gone.select("path"), "path", "left_anti")
        rows = kept.unionByName(self._by(fresh, "path").select(*kept.columns))
        self._write(rows, "results", path_buckets, "path", whole=False)
        return touched.count()

    def _resolve_again(self, touched: DataFrame, gone: DataFrame, added: DataFrame, buckets: list[int]) -> None:
        """Take out the rows of changed pages, put the fresh ones in, resolve the touched identifiers."""
        held = self._table("found", buckets).filter("path IS NOT NULL")
        kept = held.join(gone.select("path"), "path", "left_anti")
        found = stage(kept.unionByName(added.select(*kept.columns)), "found-now")
        again = db.resolved(found.join(touched.select("checkov_id"), "checkov_id", "left_semi"))
        before = self._table("mappings", buckets).filter("checkov_id IS NOT NULL")
        untouched = before.join(touched.select("checkov_id"), "checkov_id", "left_anti")
        table = stage(untouched.unionByName(self._by(again, "checkov_id").select(*untouched.columns)), "mappings-now")
        self._write(found, "found", buckets, "path", whole=False)
        self._write(table, "mappings", buckets, "checkov_id", whole=False)

    def update_folder(
        self,
        folder: str,
        extensions: list[str] | None = None,
        ignore: list[str] | None = None,
        max_mb: float = fixed.PIPELINE_MAX_MB,
    ) -> Run:
        """``update`` from the files of a folder, with the pipeline's selection rules."""
        chosen = extensions or fixed.PIPELINE_EXTENSIONS
        whole = files.manifest(self.spark, folder, extensions=chosen, max_mb=max_mb)
        listing = files.scan(files.listing(whole), chosen, ignore or fixed.PIPELINE_IGNORE, max_mb)
        return self.update(listing, lambda rows: files.read_documents(files.read_listed(self.spark, folder, rows, whole)))
