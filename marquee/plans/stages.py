"""Materialised stages in the shared folder.

The clean table is a stage: built once from its inputs, written as Parquet
under the session's shared folder (``spark.checkpoint.dir``), and read by
every report, as a production run does.  The location is keyed by

* the inputs' signature (path, size and modification time of every input
  file),
* a hash of the code that defines the stage,

so a changed input or changed cleaning rules always rebuild it, and a stage is
only reused when published.  A written table also survives lost executors,
unlike cached blocks.
"""

from __future__ import annotations

import hashlib
import pkgutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import publish
from marquee.plans.storage import shared_dir

_STAGE_CODE = ("config.py", "schema.py", "functions/columns.py", "operators/clean.py", "operators/ingest.py",
               "operators/membership.py", "operators/quality.py", "plans/clean.py", "plans/incremental.py", "plans/jobs.py",
               "sources/fixtures.py", "sources/readers.py")
STAR_INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def code_hash() -> str:
    h = hashlib.sha256()
    for rel in _STAGE_CODE:
        h.update(rel.encode())
        h.update(pkgutil.get_data("marquee", rel) or b"")
    return h.hexdigest()[:16]


def input_files(spark: SparkSession, paths) -> DataFrame:
    """path, modificationTime and length of every file under ``paths``, nested
    ones included; no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
            .select("path", "modificationTime", "length"))


def input_signature(spark: SparkSession, paths) -> str:
    """A digest of path, size and modification time of every file under
    ``paths``.  One small job: Spark lists the files and adds up their hashes."""
    files = input_files(spark, paths).select(F.xxhash64("path", "modificationTime", "length").alias("h"), "length")
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.bit_xor("h").alias("x"),
                  F.sum(F.pmod("h", F.lit(1 << 40))).alias("s")).first()
    return hashlib.sha256(f"{sorted(paths)}|{r['n']}|{r['size']}|{r['x']}|{r['s']}".encode()).hexdigest()[:16]


def materialized(spark: SparkSession, name: str, inputs, build, fresh: bool = False) -> DataFrame:
    """``build()`` published once under the shared folder and read back.

    Each build is a version of its own and becomes current in one step, so
    concurrent runs never see a partial stage and a rebuild never takes the
    files from under a reader."""
    root = f"{shared_dir(spark)}/marquee/stages/{name}-{input_signature(spark, inputs)}-{code_hash()}"
    if fresh or publish.current_version(spark, root) is None:
        publish.publish_table(build(), root)
    return publish.read_published(spark, root)


def clean_stage(spark: SparkSession, sf_dir: str, fresh: bool = False) -> DataFrame:
    """The clean title table for the star-schema tables in ``sf_dir``."""
    from marquee.plans.clean import clean_titles
    from marquee.sources.fixtures import raw_titles

    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in STAR_INPUTS]
    return materialized(spark, "clean", inputs, lambda: clean_titles(raw_titles(spark, sf_dir)),
                        fresh=fresh)
