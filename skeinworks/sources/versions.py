"""Keyed Parquet tables in versions: a merge writes new files, then one rename makes them the table.

Below a table's path, `data/<token>/_bucket=<n>` holds what one merge wrote and `versions/<number>` is a small
JSON file that says which folder each bucket is read from. Readers take the greatest number, so they see the
whole of one version whatever a running or broken merge has left behind. Of two merges that start from one
version the second finds its number taken, reads the new version and merges again. This needs a file system
whose rename is atomic and refuses an existing target (HDFS does; a plain object store needs a committer).

A key lies in the bucket of its hash. The number of buckets is a power of two that follows the table's size,
`bucket_bytes` each and FIRST_BUCKETS at least, so that a bucket fits a task; only buckets that hold keys of the batch are written anew.
Null is a key like any other. Columns may be added by a batch (older rows hold null there), their types stay.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .writers import latest

BUCKET_BYTES, FIRST_BUCKETS = 256 << 20, 16
BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    number: int = 0
    buckets: int = FIRST_BUCKETS
    schema: str | None = None
    #: bucket -> folder below data/; a bucket without rows is absent
    folders: dict[str, str] = field(default_factory=dict)
    #: folder -> mean bytes of the buckets in it
    bucket_bytes: dict[str, int] = field(default_factory=dict)
    #: writer -> the last of its numbered batches that is in the table
    batches: dict[str, int] = field(default_factory=dict)

    def size(self) -> int:
        return sum(self.bucket_bytes[f] for f in self.folders.values())


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _names(spark: SparkSession, folder: str) -> list[str]:
    p = _path(spark, folder)
    fs = p.getFileSystem(_conf(spark))
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _bytes(spark: SparkSession, folder: str) -> int:
    p = _path(spark, folder)
    return p.getFileSystem(_conf(spark)).getContentSummary(p).getLength()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all below it, if it is there."""
    p = _path(spark, folder)
    p.getFileSystem(_conf(spark)).delete(p, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the whole versions of a table, in order."""
    return sorted(int(n) for n in _names(spark, f"{path}/versions") if n.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of the table, the last one by default; number 0 for a table that is not there yet."""
    if number is None:
        number = max(versions(spark, path), default=0)
    if number == 0:
        return Version()
    text = spark.read.text(f"{path}/versions/{number}", wholetext=True).first()[0]
    return Version(**json.loads(text))


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the last one by default."""
    v = version(spark, path, number)
    if v.number == 0:
        raise FileNotFoundError(f"no version of a table below {path}")
    return _rows(spark, path, v, list(v.folders))


def _rows(spark: SparkSession, path: str, v: Version, buckets: list[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(v.schema))
    paths = [f"{path}/data/{v.folders[b]}/{BUCKET}={b}" for b in buckets if b in v.folders]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge(
    new: DataFrame, path: str, key: str, order: list[Column], *, batch: tuple[str, int] | None = None, bucket_bytes: int = BUCKET_BYTES
) -> int:
    """Lay rows over the table: of the rows of a key the one that is greatest in `order` stays, a new one on ties.

    `batch` is (writer, number): a number not above the writer's last one changes nothing, so a batch may be
    handed in again. Returns the number of the version that holds the batch.
    """
    staged = latest(new, key, order)

    def combined(old: DataFrame, fresh: DataFrame) -> DataFrame:
        old, fresh = old.withColumn("_new", F.lit(0)), fresh.withColumn("_new", F.lit(1))
        both = old.unionByName(fresh, allowMissingColumns=True)
        both = both.repartition(BUCKET)  # one shuffle: the grouping below starts with the bucket
        other = [c for c in both.columns if c not in (BUCKET, key, "_new")]
        last = both.groupBy(BUCKET, key).agg(F.max_by(F.struct(*other), F.struct(*order, "_new")).alias("_r"))
        return last.select(BUCKET, key, *[F.col(f"_r.{c}").alias(c) for c in other])

    return _changed(staged, None, path, key, combined, batch, bucket_bytes)


def replace(
    new: DataFrame, keys: DataFrame, path: str, key: str, *, batch: tuple[str, int] | None = None, bucket_bytes: int = BUCKET_BYTES
) -> int:
    """Put `new` in the place of all rows the table has of `keys`, any number per key.

    Keys without new rows are removed; rows of `new` outside `keys` replace theirs too.
    """
    def combined(old: DataFrame, fresh: DataFrame, gone: DataFrame) -> DataFrame:
        same = (F.col(f"o.{BUCKET}") == F.col(f"g.{BUCKET}")) & F.col(f"o.{key}").eqNullSafe(F.col(f"g.{key}"))
        left = old.alias("o").join(gone.select(BUCKET, key).alias("g"), same, "left_anti")
        return left.unionByName(fresh, allowMissingColumns=True).repartition(BUCKET)

    return _changed(new, keys.select(key), path, key, combined, batch, bucket_bytes)


def _changed(staged: DataFrame, keys: DataFrame | None, path: str, key: str, combined: Callable, batch, bucket_bytes: int) -> int:
    """Write the batch once, then merge it into the last version until that is still the last one."""
    spark = staged.sparkSession
    base = version(spark, path)
    if batch and batch[1] <= base.batches.get(batch[0], -1):
        return base.number
    token = uuid.uuid4().hex
    incoming = f"{path}/incoming/{token}"
    staged.write.parquet(f"{incoming}/rows")
    parts = [spark.read.schema(staged.schema).parquet(f"{incoming}/rows")]
    if keys is not None:  # those of the batch are read from what was written, so its rows are made once
        keys = keys.unionByName(parts[0].select(key)).distinct()
        keys.write.parquet(f"{incoming}/keys")
        parts.append(spark.read.schema(keys.schema).parquet(f"{incoming}/keys"))
    try:
        attempt = 0
        while True:
            done = _version_from(spark, base, parts, path, key, combined, batch, bucket_bytes, f"{token}-{attempt}")
            if done is None:
                return base.number
            if _published(spark, path, done, token):
                return done.number
            base, attempt = version(spark, path), attempt + 1
            if batch and batch[1] <= base.batches.get(batch[0], -1):
                return base.number
    finally:
        remove(spark, incoming)


def _version_from(spark, base: Version, parts, path, key, combined, batch, bucket_bytes, token) -> Version | None:
    buckets = base.buckets
    size = base.size() + _bytes(spark, f"{path}/incoming/{token.split('-')[0]}/rows")
    while size > buckets * bucket_bytes:
        buckets *= 2

    def placed(d: DataFrame) -> DataFrame:
        return d.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    parts = [placed(p) for p in parts]
    touched = sorted(r[0] for r in parts[-1].select(BUCKET).distinct().collect())  # numbers, one a bucket
    if not touched and base.number:
        return None
    # a bucket of twice as many was part of the bucket with its number modulo the old count
    whole = buckets != base.buckets
    read_from = list(base.folders) if whole else [str(b) for b in touched]
    if base.number:
        old = placed(_rows(spark, path, base, read_from))
    else:
        old = parts[0].limit(0)
    kinds = {f.name: f.dataType for f in old.schema}
    for f in parts[0].schema:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise TypeError(f"column {f.name} is {kinds[f.name].simpleString()} in the table, not {f.dataType.simpleString()}")
    out = combined(old, *parts)
    out.write.partitionBy(BUCKET).parquet(f"{path}/data/{token}")
    made = [n.partition("=")[2] for n in _names(spark, f"{path}/data/{token}") if n.startswith(f"{BUCKET}=")]
    gone = set(base.folders) if whole else {str(b) for b in touched}
    folders = {b: f for b, f in base.folders.items() if b not in gone} | {b: token for b in made}
    means = {f: n for f, n in base.bucket_bytes.items() if f in folders.values()}
    if made:
        means[token] = _bytes(spark, f"{path}/data/{token}") // len(made)
    return Version(
        base.number + 1,
        buckets,
        StructType([f for f in out.schema if f.name != BUCKET]).json(),
        folders,
        means,
        base.batches | ({batch[0]: batch[1]} if batch else {}),
    )


def _published(spark: SparkSession, path: str, v: Version, token: str) -> bool:
    """Name the version; False if another merge has taken the number."""
    target, draft = _path(spark, f"{path}/versions/{v.number}"), _path(spark, f"{path}/incoming/{token}/version")
    fs = draft.getFileSystem(_conf(spark))
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(asdict(v)).encode()))
    stream.close()
    fs.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.makeQualified(target).toUri(), _conf(spark))
    refuse_existing = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), refuse_existing)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def expire(spark: SparkSession, path: str, *, keep: int = 10) -> list[int]:
    """Forget all but the last `keep` versions and delete the folders that only those read. Returns the forgotten."""
    numbers = versions(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    used = {f for n in kept for f in version(spark, path, n).folders.values()}
    unused = {f for n in old for f in version(spark, path, n).folders.values()} - used
    for n in old:  # first the names, so that no reader starts on a version whose files go
        remove(spark, f"{path}/versions/{n}")
    for f in unused:
        remove(spark, f"{path}/data/{f}")
    return old
