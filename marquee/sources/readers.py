"""Readers.  Schemas are always declared: inference costs a full pass and
breaks on legal input (all-null structs, all-empty arrays)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schema import ARRIVAL_COLUMN, CORRUPT_COLUMN, DOCUMENT_SCHEMA, with_corrupt_column


# Declared schemas of the star-schema test tables: a declared schema skips
# the footer-reading job Spark otherwise runs to infer one on every read.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = STAR_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def stored_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a star-schema table's files; none is opened."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


read_clean = read_table


def read_documents(spark: SparkSession, path, schema=DOCUMENT_SCHEMA,
                   multi_line: bool = False, keep_corrupt: bool = True,
                   arrival: bool = False) -> DataFrame:
    """Title documents under a declared schema, numbers as their text.

    JSON lines (the default) split across tasks, gzipped ones by file;
    ``multi_line=True`` reads the single-array form, one task per file.  In PERMISSIVE mode a
    malformed line leaves its text in ``_corrupt_record`` so it can be
    quarantined instead of failing the job.  ``arrival=True`` adds the order
    of arrival: file modification time, path, place of the split in the file
    and place of the row in the split, which do not depend on how the files
    are dealt to tasks.
    """
    reader = (spark.read.option("mode", "PERMISSIVE").option("multiLine", multi_line)
              .option("recursiveFileLookup", "true"))
    if keep_corrupt:
        reader = (reader.schema(with_corrupt_column(schema))
                  .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    else:
        reader = reader.schema(schema)
    docs = reader.json(path)
    if arrival:
        m = "_metadata."
        docs = docs.withColumn(ARRIVAL_COLUMN, F.struct(
            F.col(m + "file_modification_time").alias("at"), F.col(m + "file_path").alias("file"),
            F.col(m + "file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")))
    return docs


#: A compressed file of no bytes is a header and a trailer.
COMPRESSED_EMPTY = 64


def _has_bytes(spark: SparkSession, fs, status) -> bool:
    """Whether a file holds anything, a compressed one once it is read."""
    if not 0 < status.getLen() <= COMPRESSED_EMPTY:
        return status.getLen() > 0
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(status.getPath())
    if codec is None:
        return True
    stream = codec.createInputStream(fs.open(status.getPath()))
    try:
        return stream.read() >= 0
    except Py4JJavaError:  # a broken file was landed all the same; reading it says what is wrong
        return True
    finally:
        stream.close()


def landed_documents_or_none(spark: SparkSession, path: str, **kw):
    """Landed documents when ``path`` holds at least one non-empty file,
    else None (the caller then has to land data first)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        statuses = fs.globStatus(p)
    except Exception:  # noqa: BLE001 - unreadable location: nothing landed
        return None
    if not statuses:
        return None
    for st in statuses:
        files = fs.listFiles(st.getPath(), True)
        while files.hasNext():
            f = files.next()
            name = f.getPath().getName()
            if not name.startswith(("_", ".")) and _has_bytes(spark, fs, f):
                return read_documents(spark, path, **kw)
    return None
