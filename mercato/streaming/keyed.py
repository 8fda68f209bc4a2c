"""A keyed table on plain Parquet for streams: batches are added as deltas, readers merge, compaction folds bucket by bucket.

Rows lie in buckets by a hash of their key. A batch is one folder with a sub-folder per bucket; a manifest names the
folders that count and is replaced by a rename, so a batch is there as a whole or not at all. A batch that is replayed
takes its own place. Compaction rewrites the buckets it chooses and nothing else, and folders are deleted only when no
manifest that a reader may still hold names them. One writer at a time, as a streaming query is.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.shaping import latest_by
from mercato.operators.skew import fits

BUCKET, BATCH = "_bucket", "_batch"
KEPT_MANIFESTS = 2  # a reader that began under the manifest before the last still finds its folders

Merge = Callable[[DataFrame], DataFrame]


@dataclass
class Manifest:
    """What a table consists of. ``bases`` maps a bucket to (folder, last batch in it), ``deltas`` a batch to (folder, its buckets)."""

    version: int
    keys: list[str]
    buckets: int
    schema: str
    bases: dict[int, tuple[str, int]] = field(default_factory=dict)
    deltas: dict[int, tuple[str, list[int]]] = field(default_factory=dict)

    def live(self, buckets: set[int] | None = None) -> tuple[list[str], list[str]]:
        """Folders of bases and of deltas, of all buckets or of some; a delta counts in buckets that do not hold it yet."""
        wanted = lambda b: buckets is None or b in buckets
        bases = [f"{f}/{BUCKET}={b}" for b, (f, _) in self.bases.items() if wanted(b)]
        deltas = [
            f"{f}/{BUCKET}={b}"
            for batch, (f, held) in sorted(self.deltas.items())
            for b in held
            if wanted(b) and batch > self.bases.get(b, ("", -1))[1]
        ]
        return bases, deltas

    def folders(self) -> set[str]:
        bases, deltas = self.live()
        return {path.rsplit("/", 1)[0] for path in bases + deltas}


class _Files:
    """The few file operations of a table, through the file system its path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write beside and rename: the file is there in full or not at all, and never replaces another."""
        beside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(beside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(self.path(beside), self.path(name)):
            self.fs.delete(self.path(beside), False)
            raise RuntimeError(f"{self.root}/{name} is there already: another writer has been at work")


def _bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class KeyedTable:
    """The table at ``path``. ``merge`` brings the rows of a key, which carry ``_batch``, to one; default: the newest batch,
    so that the one delta of a bucket without a base is read as it is.

    ``buckets`` is settled by the first write (default: the session's shuffle partitions); choose it so that one bucket is
    what one task can merge. Keys may be null. Batch ids only rise, but for replays: one that compaction has already
    folded is not applied again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], *, buckets: int | None = None, merge: Merge | None = None):
        self.spark, self.root, self.keys = spark, path.rstrip("/"), keys
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.merge, self.newest = merge or (lambda rows: latest_by(rows, keys, [BATCH])), merge is None
        self.files = _Files(spark, path)

    # -- manifests

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names("manifest") if n.endswith(".json"))

    def manifest(self) -> Manifest | None:
        versions = self._versions()
        return self._load(versions[-1]) if versions else None

    def _load(self, version: int) -> Manifest:
        d = json.loads(self.files.read(f"manifest/{version}.json"))
        bases = {int(b): tuple(x) for b, x in d.pop("bases").items()}
        deltas = {int(b): tuple(x) for b, x in d.pop("deltas").items()}
        return Manifest(**d, bases=bases, deltas=deltas)

    def _commit(self, m: Manifest) -> None:
        m.version += 1
        m.deltas = {b: d for b, d in m.deltas.items() if any(b > m.bases.get(x, ("", -1))[1] for x in d[1])}
        self.files.write_new(f"manifest/{m.version}.json", json.dumps(m.__dict__))
        self._clean()

    def _clean(self) -> None:
        """Delete folders that none of the last manifests names: folded, replaced, or left by a writer that failed."""
        versions = self._versions()
        named = set().union(*(self._load(v).folders() for v in versions[-KEPT_MANIFESTS:]))
        for v in versions[:-KEPT_MANIFESTS]:
            self.files.delete(f"manifest/{v}.json")
        for name in self.files.names("data"):
            if name not in named:
                self.files.delete(f"data/{name}")

    def _put(self, rows: DataFrame, kind: str) -> tuple[str, list[int]]:
        folder = f"{kind}-{uuid.uuid4().hex}"
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        held = [int(n.split("=")[1]) for n in self.files.names(f"data/{folder}") if n.startswith(f"{BUCKET}=")]
        return folder, sorted(held)

    # -- use

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch, or put it in the place of the same batch before. At most one row per key, or what ``merge`` takes."""
        m = self.manifest() or Manifest(-1, self.keys, self.buckets, "")
        if m.keys != self.keys:
            raise ValueError(f"{self.root} is keyed by {m.keys}, not by {self.keys}")
        rows = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        m.schema = rows.schema.json()
        m.deltas[batch_id] = self._put(rows.withColumn(BUCKET, _bucket_of(self.keys, m.buckets)), f"delta-{batch_id}")
        self._commit(m)

    def read(self, **key: object) -> DataFrame:
        """The table, one row per key; with values for all keys, that key's row from its one bucket."""
        m = self.manifest()
        if m is None:
            raise FileNotFoundError(f"no table at {self.root}")
        if not key:
            return self._merged(m, None).drop(BATCH)
        if set(key) != set(self.keys):
            raise ValueError(f"give all of {self.keys}")
        kinds = {f.name: f.dataType for f in self._schema(m).fields}
        values = {k: F.lit(key[k]).cast(kinds[k]) for k in self.keys}
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(*values.values()), F.lit(m.buckets)).cast("int")).first()[0]
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(v) for k, v in values.items()])
        return self._merged(m, {bucket}, same).drop(BATCH)

    def compact(self, most: int | None = None) -> list[int]:
        """Fold the deltas of the ``most`` buckets that have the most of them (default: of all); returns these buckets."""
        m = self.manifest()
        if m is None:
            return []
        waiting: dict[int, int] = {}
        for path in m.live()[1]:
            b = int(path.rsplit("=", 1)[1])
            waiting[b] = waiting.get(b, 0) + 1
        chosen = sorted(waiting, key=lambda b: (-waiting[b], b))[:most]
        if not chosen:
            return []
        through = max(m.deltas)
        rows = self._merged(m, set(chosen)).withColumn(BUCKET, _bucket_of(self.keys, m.buckets))
        folder, held = self._put(rows, "base")
        for b in chosen:
            m.bases.pop(b, None)
        m.bases.update({b: (folder, through) for b in held})
        self._commit(m)
        return chosen

    def _schema(self, m: Manifest) -> T.StructType:
        return T.StructType.fromJson(json.loads(m.schema))

    def _scan(self, m: Manifest, paths: list[str]) -> DataFrame:
        # folders are read by name, so that the bucket in the path does not become a column
        reader = self.spark.read.schema(self._schema(m)).option("recursiveFileLookup", True)
        return reader.parquet(*[f"{self.root}/data/{p}" for p in paths]) if paths else self.spark.createDataFrame([], self._schema(m))

    def _merged(self, m: Manifest, buckets: set[int] | None, only: Column | None = None) -> DataFrame:
        bases, deltas = m.live(buckets)
        held = Counter(path.rsplit("=", 1)[1] for path in bases + deltas)
        alone = {path for path in deltas if self.newest and held[path.rsplit("=", 1)[1]] == 1}
        if not alone:
            return self._folded(m, bases, deltas, only)
        rows = self._scan(m, sorted(alone))
        rows = rows if only is None else rows.filter(only)
        others = [path for path in deltas if path not in alone]
        return rows.unionByName(self._folded(m, bases, others, only)) if bases or others else rows

    def _folded(self, m: Manifest, bases: list[str], deltas: list[str], only: Column | None) -> DataFrame:
        base, delta = self._scan(m, bases), self._scan(m, deltas)
        if only is not None:
            base, delta = base.filter(only), delta.filter(only)
        if not deltas:
            return base
        if not bases:
            return self.merge(delta).select(base.columns)
        # a base holds a key once: only rows that a delta touches are merged, the others are neither grouped nor moved
        changed = delta.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(self.keys)]).distinct()
        changed = F.broadcast(changed) if fits(delta.select(*self.keys)) else changed
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(self.keys)])
        untouched = base.join(changed, same, "left_anti")
        merged = self.merge(base.join(changed, same, "left_semi").unionByName(delta))
        return untouched.unionByName(merged.select(base.columns))
