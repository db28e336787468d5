"""Keyed changes kept as a levelled log: the sink for batches that replace records by key.

A batch becomes one *run*, a Parquet folder partitioned by a bucket of the key.  Runs stand on levels: a batch enters
level 0, and when a level holds ``fan`` runs, they are merged into one run of the next level, newest record per key.
After n batches at most ``fan - 1`` runs stand on each of about log(n) levels, so a read opens a bounded number of files,
and every record is written again once a level only.

Which runs are live is said by a *manifest*, a small file for each version of the log that is written last.  A run that
no manifest names does not exist for readers: a job that dies before its manifest leaves the log as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators.collapse import collapse, keep_first

BATCH, BUCKET, RUN = "_batch", "_bucket", "_run"
TAG, LOADED = "_pipeline_load_tag", "_loaded_at"
LAST, FIRST = "last", "first"
KEPT_VERSIONS = 20


class Conflict(RuntimeError):
    """Another writer has written the same version of the manifest."""


@dataclass
class Manifest:
    """State of a log: its shape, the last batch applied, and the live runs as (level, folder name)."""

    key: list[str]
    buckets: int
    fan: int
    keep: str
    schema: str | None = None
    last_batch: int | None = None
    runs: list[tuple[int, str]] = field(default_factory=list)


class ChangeLog:
    """A keyed table below ``path``.

    ``keep`` says which batch wins a key, the last or the first.  ``buckets`` follow the table's size, as each is a file
    of a run; they and ``fan`` are fixed by the first batch.  One writer at a time: a second one gets a ``Conflict``.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 8, fan: int = 8, keep: str = LAST
    ):
        if keep not in (LAST, FIRST) or fan < 2 or buckets < 1:
            raise ValueError("keep is first or last, fan at least 2, buckets at least 1")
        self.spark, self.path = spark, path
        self._start = Manifest(list(key), buckets, fan, keep)

    # --- manifest ---------------------------------------------------------

    def _file(self, name: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self) -> list[int]:
        """Versions of the manifest, oldest first."""
        files, folder = self._file("manifest")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _state(self, version: int) -> Manifest | None:
        files, target = self._file(f"manifest/{version:012d}")
        stream = files.open(target)
        try:
            return Manifest(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        except (ValueError, TypeError):
            return None
        finally:
            stream.close()

    def manifest(self) -> tuple[int, Manifest]:
        """Latest whole manifest and its version; a file cut short by a crash does not count."""
        for version in reversed(self.versions()):
            state = self._state(version)
            if state is None:
                continue
            if state.key != self._start.key or state.keep != self._start.keep:
                raise ValueError(f"the log at {self.path} keeps the {state.keep} record per {state.key}")
            return version, state
        return 0, self._start

    def _commit(self, state: Manifest) -> None:
        """Write the next version; it becomes the log's state when the file is complete."""
        version = max(self.versions(), default=0) + 1
        files, target = self._file(f"manifest/{version:012d}")
        try:
            out = files.create(target, False)
        except Exception as e:
            if files.exists(target):
                raise Conflict(f"version {version} of {self.path} was written meanwhile") from e
            raise
        out.write(bytearray(json.dumps(asdict(state)).encode()))
        out.close()

    # --- writing ----------------------------------------------------------

    def append(self, df: DataFrame, batch: int, order: Sequence[str], tag: str | None = None) -> bool:
        """Apply one batch: of its records with one key the one with the highest ``order`` counts.

        Batches come with rising numbers.  A batch that is not above the last applied one is a retry of work that is
        already in the log and changes nothing; False is returned.  The order must not be empty, so that a retry of a
        batch that was not applied picks the same records.  A null key is a key.  Columns of the first batch are the
        log's; later batches may lack some but bring no others.
        """
        if not order:
            raise ValueError("an order is needed to choose between records of one key")
        _, state = self.manifest()
        if state.last_batch is not None and batch <= state.last_batch:
            return False
        loaded = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        newest = collapse(df, state.key, order, count_as=None).withColumns(
            {BATCH: F.lit(batch).cast("long"), TAG: F.lit(tag).cast("string"), LOADED: F.lit(loaded)}
        )
        if state.schema is None:
            state.schema = newest.schema.json()
        runs = [*map(tuple, state.runs), (0, self._write(self._aligned(newest, state), state))]
        merged = self._merge_full_levels(runs, state)
        self._commit(Manifest(state.key, state.buckets, state.fan, state.keep, state.schema, batch, merged))
        return True

    def _merge_full_levels(self, runs: list[tuple[int, str]], state: Manifest) -> list[tuple[int, str]]:
        level = 0
        while len(full := [name for at, name in runs if at == level]) >= state.fan:
            merged = self._write(self._newest(self._rows(full, state), state), state)
            runs = [(at, name) for at, name in runs if at != level] + [(level + 1, merged)]
            level += 1
        return runs

    def _aligned(self, df: DataFrame, state: Manifest) -> DataFrame:
        fields = T.StructType.fromJson(json.loads(state.schema)).fields
        unknown = set(df.columns) - {f.name for f in fields}
        if unknown:
            raise ValueError(f"columns that the log has not: {sorted(unknown)}")
        known = set(df.columns)
        return df.select(
            *[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
        )

    def _bucket(self, state: Manifest):
        return F.pmod(F.xxhash64(*state.key), F.lit(state.buckets)).cast("int")

    def _write(self, df: DataFrame, state: Manifest) -> str:
        name = uuid.uuid4().hex
        # Adaptive execution makes one task of small buckets and several of a large one, so a task is no larger with the run.
        placed = df.withColumn(BUCKET, self._bucket(state)).hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self.path}/runs/{RUN}={name}")
        return name

    # --- reading ----------------------------------------------------------

    def _rows(self, names: Sequence[str], state: Manifest) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state.schema)).add(RUN, T.StringType()).add(BUCKET, T.IntegerType())
        root = f"{self.path}/runs"
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/{RUN}={n}" for n in names]).drop(RUN)

    def _newest(self, rows: DataFrame, state: Manifest) -> DataFrame:
        """One record per key; the bucket, which the key determines, goes with the key."""
        key = [*state.key, BUCKET]
        best = keep_first(rows, key, [BATCH]) if state.keep == FIRST else collapse(rows, key, [BATCH], count_as=None)
        return best.drop(BUCKET)

    def read(self) -> DataFrame:
        """Current record of every key, with the load tag and time of its batch."""
        _, state = self.manifest()
        if not state.runs:
            raise ValueError(f"the log at {self.path} holds no batch")
        return self._newest(self._rows([n for _, n in state.runs], state), state).drop(BATCH)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Current records of some keys: only the buckets that hold them are read.  Null keys find nothing."""
        _, state = self.manifest()
        keys = keys.select(*state.key).distinct()
        # At most as many values as there are buckets.
        buckets = [r[0] for r in keys.select(self._bucket(state)).distinct().collect()]
        rows = self._rows([n for _, n in state.runs], state).where(F.col(BUCKET).isin(buckets))
        return self._newest(rows.join(keys, state.key, "left_semi"), state).drop(BATCH)

    def vacuum(self, keep_versions: int = KEPT_VERSIONS) -> list[str]:
        """Delete manifests but the last ``keep_versions`` and runs that none of those names; returns the run names.

        Not while a batch is being applied: its run is in no manifest yet.
        """
        version, _ = self.manifest()
        kept = [v for v in self.versions() if v <= version][-max(keep_versions, 1) :]
        live = {name for v in kept if (state := self._state(v)) for _, name in state.runs}
        for v in self.versions():
            if v < kept[0]:
                files, target = self._file(f"manifest/{v:012d}")
                files.delete(target, False)
        files, folder = self._file("runs")
        gone = sorted({s.getPath().getName().removeprefix(f"{RUN}=") for s in files.listStatus(folder)} - live)
        for name in gone:
            files, target = self._file(f"runs/{RUN}={name}")
            files.delete(target, True)
        return gone
