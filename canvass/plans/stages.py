"""The stored stages of a pull and the manifest that says which of them are whole.

A stage is written once, as a parquet folder under the run's root, and counts
as built only when its manifest entry is there.  The entry is published after
the folder is complete, and withdrawn before the folder is written anew, so a
pull that is killed at any moment leaves whole stages and at most one folder
that nobody believes.  The next pull over the same root takes the whole
stages as they are and builds the rest.

An entry names what it was built from: the parameters that decide the result
and a digest of the input files (path, length, time of change).  Entries of
other parameters or inputs are not believed either.

The number of rows of a stage, and any other count asked for, are observed
while it is written and kept in its entry: nobody reads a stage to count it.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from canvass.config import Config
from canvass.session import shuffles_removed
from canvass.sources import files

MANIFEST = "_manifest"
#: Parameters of a pull that change how it runs, not what comes out.
_RUNTIME_ONLY = {"broadcast_max_bytes", "hot_key_rows", "materialize"}


def input_digest(spark: SparkSession, tables: Mapping[str, DataFrame]) -> str:
    """A digest of the files that hold ``tables``: paths, lengths and times of change.

    The folders are listed and summed by one Spark job that reads no content,
    so tables of very many files are no burden to the driver.  Tables without
    files (a remote database) are named, but a change in them cannot be seen.
    """
    folders, unseen = set(), []
    for name in sorted(tables):
        found = tables[name].inputFiles()
        folders |= {f.rsplit("/", 1)[0] for f in found}
        unseen += [] if found else [name]
    seen = {}
    if folders:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(sorted(folders))
        one = F.xxhash64("path", "length", "modificationTime")
        seen = listed.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(one).alias("a"),
                          F.sum(F.pmod(one, F.lit(2**31))).alias("b")).first().asDict()
    return hashlib.sha256(json.dumps([seen, unseen], sort_keys=True).encode()).hexdigest()


def run_key(config: Config, inputs: str) -> str:
    """What a stage depends on, as one key."""
    given = {k: str(v) for k, v in dataclasses.asdict(config).items() if k not in _RUNTIME_ONLY}
    return hashlib.sha256(json.dumps([given, inputs], sort_keys=True).encode()).hexdigest()


class StageStore:
    """Stages under ``root``, as long as they belong to the run ``key``."""

    def __init__(self, spark: SparkSession, root: str, key: str, about: dict | None = None):
        self.spark, self.root, self.key, self.about = spark, root.rstrip("/"), key, about or {}
        #: Stages written by this store, in order (not the ones it found).
        self.built: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _entry_path(self, name: str) -> str:
        return f"{self.root}/{MANIFEST}/{name}.json"

    def entry(self, name: str) -> dict | None:
        """The manifest entry of a whole stage of this run; None if it has to be built."""
        text = files.read_text(self.spark, self._entry_path(name))
        found = json.loads(text) if text else None
        if not found or found["run"] != self.key or not files.exists(self.spark, f"{self.path(name)}/_SUCCESS"):
            return None
        return found

    def read(self, name: str) -> DataFrame:
        found = self.entry(name)
        if found is None:
            raise LookupError(f"stage {name} is not in {self.root}")
        return self.spark.read.schema(StructType.fromJson(found["schema"])).parquet(self.path(name))

    def publish(self, name: str, df: DataFrame, counts: dict[str, Column] | None = None) -> DataFrame:
        """Write a stage, observe its counts (``rows`` and those given), enter it; returns the stored copy."""
        start = time.perf_counter()
        files.delete(self.spark, self._entry_path(name))
        seen = Observation(f"{name}-{uuid.uuid4().hex[:12]}")
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (counts or {}).items()])
        with shuffles_removed(self.spark):
            watched.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        entry = {"stage": name, "run": self.key, "about": self.about, "schema": df.schema.jsonValue(),
                 "counts": seen.get, "seconds": round(time.perf_counter() - start, 3)}
        files.write_text(self.spark, self._entry_path(name), json.dumps(entry, indent=1))
        self.built.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def counts(self, name: str) -> dict[str, int]:
        """What was observed while the stage was written."""
        found = self.entry(name)
        if found is None:
            raise LookupError(f"stage {name} is not in {self.root}")
        return found["counts"]

    def release(self) -> None:
        """Delete the run: stages and manifest."""
        files.delete(self.spark, self.root)
