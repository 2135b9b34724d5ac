"""A keyed table of rendered rows that is replaced in one step and keeps no leftovers.

``parts/<run>`` holds the rows a run wrote, ``manifests/<run>`` one narrow row (keys, fingerprint, part) for every
live row, ``commits/<number>`` names the run whose manifest counts.  A run writes its part and manifest first and then
creates the next commit, which only one run can do; whoever reads before sees the old state as a whole.  A
run that broke leaves folders that no commit names; the next one removes them, with the parts and manifests that are
no longer in use.  There is one writer at a time; a second is refused at its commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a table beyond which a run writes all rows anew; reading opens all parts.
MOST_PARTS = 20


class _Folder:
    """The few folder operations needed, on the file system Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.files = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        path = self.path(name)
        return [s.getPath().getName() for s in self.files.listStatus(path)] if self.files.exists(path) else []

    def remove(self, name: str) -> None:
        self.files.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.files.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if the file is there."""
        stream = self.files.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


class Versions:
    """A table under ``root`` with rows known by ``keys`` and a ``fingerprint``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]) -> None:
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.folder = _Folder(spark, root)

    def _commit(self) -> tuple[int, str | None]:
        # A commit whose file is still empty is not yet one.
        for number in sorted((int(n) for n in self.folder.names("commits") if n.isdigit()), reverse=True):
            if run := self.folder.read(f"commits/{number}").strip():
                return number, run
        return 0, None

    def manifest(self) -> DataFrame | None:
        """(*keys, fingerprint, part) of the live rows; None before the first commit."""
        run = self._commit()[1]
        return self.spark.read.parquet(f"{self.root}/manifests/{run}") if run else None

    def rows(self) -> DataFrame | None:
        """The live rows."""
        live = self.manifest()
        return None if live is None else self._rows(live)

    def _rows(self, live: DataFrame) -> DataFrame:
        # MOST_PARTS names at most; an empty table still has the part of its own run.
        parts = [r["part"] for r in live.select("part").distinct().collect()] or [self._commit()[1]]
        held = self.spark.read.parquet(*[f"{self.root}/parts/{p}" for p in parts])
        known = F.struct(*self.keys, "part").alias("__known")
        return held.select("*", known).join(live.select(known), "__known", "left_semi").drop("__known", "part")

    def publish(self, found: DataFrame) -> int:
        """Apply (*keys, fingerprint, state, …) as ``refresh.delta`` gives it; returns the number of the commit.

        Rows that are added or changed are written, rows that stay keep their place in an earlier part, others go.  Frames
        read from the table before are not to be used after it."""
        number, run = self._commit()
        written = found.filter(F.col("state").isin("added", "changed")).drop("state")
        name = uuid.uuid4().hex
        known = F.struct(*self.keys).alias("__known")
        kept = None
        if run:
            live = self.spark.read.parquet(f"{self.root}/manifests/{run}")
            same = found.filter(F.col("state") == "same").select(known)
            kept = live.select("*", known).join(same, "__known", "left_semi").drop("__known")
            if kept.select("part").distinct().count() >= MOST_PARTS:
                written = written.unionByName(self._rows(kept))
                kept = None
        written.withColumn("part", F.lit(name)).write.parquet(f"{self.root}/parts/{name}")
        now = self.spark.read.parquet(f"{self.root}/parts/{name}").select(*self.keys, "fingerprint", "part")
        (now if kept is None else now.unionByName(kept)).write.parquet(f"{self.root}/manifests/{name}")
        self.folder.create(f"commits/{number + 1}", name)
        self.clean()
        return number + 1

    def clean(self) -> None:
        """Remove what the last commit does not name."""
        number, run = self._commit()
        if run is None:
            return
        used = {run, *(r["part"] for r in self.manifest().select("part").distinct().collect())}
        for part in self.folder.names("parts"):
            if part not in used:
                self.folder.remove(f"parts/{part}")
        for other in self.folder.names("manifests"):
            if other != run:
                self.folder.remove(f"manifests/{other}")
        for old in self.folder.names("commits"):
            if old.isdigit() and int(old) < number:
                self.folder.remove(f"commits/{old}")
