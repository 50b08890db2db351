"""Sinks, publishing and resumable stages.

* ``publish_table`` writes a new version directory (Spark's commit protocol
  leaves ``_SUCCESS`` only after every task committed), claims the next running
  number by an exclusive create, then creates one empty file whose name
  carries number and version.  The highest number is current.  Creating a file
  is one atomic step on any store and nothing is replaced, so a reader sees the
  old table or the new one at every moment, and a crash leaves the old one
  current.  Of two runs that build on one version, one gets the number.
* A version may take some of its buckets from earlier versions: its ``_parts``
  file names the version of each bucket.
* Versions that no kept publication needs are dropped once they are not young,
  also those whose run died before they were published.
* ``load_or_build`` makes a stage idempotent: an existing complete output
  with the expected schema is reused unless ``fresh=True``.
* ``write_documents`` lands raw documents as JSON lines, gzipped, in files of
  at most ``FILE_DOCUMENTS`` documents (a gzipped file is read by one task).
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTERS, CLAIMS, PARTS = "_published", "_claims", "_parts"
KEEP_VERSIONS, KEEP_SECONDS = 3, 24 * 3600
#: A claim this old without a publication is a dead run's.
CLAIM_SECONDS = 3600
#: Most documents in a landed file, some ten MB gzipped.
FILE_DOCUMENTS = 100_000


class PublishConflict(Exception):
    """Another run has published, or is about to publish, in between."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def version_name(key: str = "") -> str:
    """A fresh version name; a ``key`` is its end."""
    return f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}" + (f"-{key}" if key else "")


def write_version(df: DataFrame, root: str, version: str | None = None) -> str:
    """Write ``df`` as a new, not yet current, version under ``root``."""
    version = version or version_name()
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/v={version}")
    return version


def publish_table(df: DataFrame, root: str, version: str | None = None) -> str:
    """Write ``df`` as ``root/v=<version>`` and make it current."""
    root = root.rstrip("/")
    version = write_version(df, root, version)
    point_to(df.sparkSession, root, version)
    return f"{root}/v={version}"


def _pointers(spark: SparkSession, root: str) -> list[tuple[int, str, float]]:
    """(number, version, age in seconds) of every publication, oldest first."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/{POINTERS}")
    if not fs.exists(folder):
        return []
    found = []
    for st in fs.listStatus(folder):
        number, _, version = st.getPath().getName().partition("--")
        if version and number.isdigit():
            found.append((int(number), version, time.time() - st.getModificationTime() / 1000))
    return sorted(found)


def _claimed(spark: SparkSession, root: str, number: int) -> bool:
    """Take ``number``; False when another run has it."""
    fs, claim = _fs(spark, f"{root}/{CLAIMS}/{number:012d}")
    try:
        fs.create(claim, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(claim):
            return False
        raise


def _claim_age(spark: SparkSession, root: str, number: int) -> float:
    fs, claim = _fs(spark, f"{root}/{CLAIMS}/{number:012d}")
    return time.time() - fs.getFileStatus(claim).getModificationTime() / 1000


ANY = object()


def point_to(spark: SparkSession, root: str, version: str, base=ANY, companions=()) -> None:
    """Make ``version`` current and drop versions no longer needed.

    With ``base`` (a version or None) this happens only while that version is
    current, else ``PublishConflict`` is raised; without it the next free
    number is taken.  ``companions`` are further roots whose versions live and
    go with this one's."""
    root = root.rstrip("/")
    while True:
        known = _pointers(spark, root)
        if base is not ANY and (known[-1][1] if known else None) != base:
            raise PublishConflict(f"{root}: the version built upon is no longer current")
        number = known[-1][0] + 1 if known else 1
        while not _claimed(spark, root, number):
            taken = any(n == number for n, _, _ in _pointers(spark, root))
            if base is not ANY and (taken or _claim_age(spark, root, number) < CLAIM_SECONDS):
                raise PublishConflict(f"{root}: another run publishes at the same time")
            number += 1
        break
    fs, pointer = _fs(spark, f"{root}/{POINTERS}/{number:012d}--{version}")
    fs.create(pointer, False).close()
    drop_versions(spark, root, companions=companions)


def write_parts(spark: SparkSession, root: str, version: str, parts: dict[int, str]) -> None:
    """Name the version that holds each bucket of ``version``."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/v={version}/{PARTS}")
    out = fs.create(path, True)
    out.write(bytearray("".join(f"{b}\t{v}\n" for b, v in sorted(parts.items())).encode()))
    out.close()


def read_parts(spark: SparkSession, root: str, version: str) -> dict[int, str] | None:
    """bucket -> version of a version's buckets; None where it has no parts."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/v={version}/{PARTS}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {int(b): v for b, v in (line.split("\t") for line in text.splitlines())}


def _held(spark: SparkSession, root: str, versions) -> set[str]:
    held = set(versions)
    for v in versions:
        held |= set((read_parts(spark, root, v) or {}).values())
    return held


def drop_versions(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS,
                  seconds: float = KEEP_SECONDS, companions=()) -> int:
    """Delete publications beyond the last ``keep`` that are older than
    ``seconds`` (a reader that started before may still use them), pointer
    first, and version folders as old that no remaining publication needs;
    returns how many publications went."""
    root = root.rstrip("/")
    known = _pointers(spark, root)
    gone = [(n, v) for n, v, age in known[:-keep] if age >= seconds]
    for number, version in gone:
        fs, pointer = _fs(spark, f"{root}/{POINTERS}/{number:012d}--{version}")
        fs.delete(pointer, False)
    left = {v for n, v, _ in known if (n, v) not in gone}
    for place in (root, *companions):
        fs, folder = _fs(spark, place)
        if not fs.exists(folder):
            continue
        held = None
        for st in fs.listStatus(folder):
            name = st.getPath().getName()
            if name.startswith("v=") and name[2:] not in left and time.time() - st.getModificationTime() / 1000 >= seconds:
                held = _held(spark, place, left) if held is None else held
                if name[2:] not in held:
                    fs.delete(st.getPath(), True)
    return len(gone)


def drop_version(spark: SparkSession, root: str, version: str) -> None:
    """Delete a version that was written but never made current."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/v={version}")
    fs.delete(folder, True)


def current_version(spark: SparkSession, root: str) -> str | None:
    known = _pointers(spark, root)
    return known[-1][1] if known else None


def bucket_paths(root: str, parts: dict[int, str]) -> list[str]:
    return [f"{root.rstrip('/')}/v={v}/bucket={b}" for b, v in sorted(parts.items())]


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    parts = read_parts(spark, root, version)
    if parts:
        return spark.read.parquet(*bucket_paths(root, parts))
    return spark.read.parquet(f"{root.rstrip('/')}/v={version}")


def read_published(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return read_version(spark, root, version)


def load_or_build(spark: SparkSession, path: str, build, fresh: bool = False,
                  schema=None) -> DataFrame:
    """Reuse a complete output at ``path`` (``_SUCCESS`` present and, if
    given, the same schema) unless ``fresh``; otherwise build, write and
    read it back."""
    if not fresh and is_complete(spark, path):
        existing = spark.read.parquet(path)
        if schema is None or [(f.name, f.dataType) for f in existing.schema.fields] == \
                [(f.name, f.dataType) for f in schema.fields]:
            return existing
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def packed(df: DataFrame):
    """A writer of tables that hold whole documents; zstd takes less room than
    the session's usual codec."""
    return df.write.option("compression", "zstd")


def landed(df: DataFrame, mode: str = "overwrite"):
    """A writer of landed files: gzipped, bounded by their number of documents
    so that a reader has a task for each of many files."""
    return df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Raw documents as gzipped JSON lines."""
    landed(df, mode).json(path)
    return path


def checkpoint(df: DataFrame, label: str = "", enabled: bool = True, log=None) -> DataFrame:
    """Reliable checkpoint in the shared folder; a failure only warns."""
    if not enabled:
        return df
    from marquee.plans.storage import ensure_checkpoint_dir
    try:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    except Exception as e:  # noqa: BLE001 - a failed checkpoint must not stop the job
        if log is not None:
            log.warning("checkpoint %s failed: %s; continuing without", label, e)
        return df
