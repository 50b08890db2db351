"""Exact deduplication by content sort.

Normalised texts (A-Z lower-cased, null as empty) are range-partitioned by
sampled splitters, sorted inside each partition by Spark's external sort, so
equal texts become neighbours, and neighbours are compared in full.

* The splitters are taken on (first 32 characters, 64-bit hash, identifier):
  the sample that reaches the driver holds no whole texts, and a text shared
  by any share of the rows is cut at identifiers into several partitions.
* Inside a partition rows come sorted by (those characters, hash, whole
  text, identifier), best identifier first, so a run's first row is its
  keeper.  A task holds one batch of rows and the identifiers of one run.
* Only the runs at a partition's two ends can go on in another partition.
  Their partial results (at most two hash values a partition, hence a proven
  bound for the broadcast) are merged by the text's SHA-256.

Defined cases: null text = empty text, and all empty texts are one group;
repeated rows (same identifier and text) are one group of which one row is
kept; a null identifier is kept only when its group has no other; an empty
table gives an empty result; further columns are carried untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marquee.llm.common import ascii_lower, documents, stage, text_or_empty

PREFIX_CHARS = 32


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Neighbour comparison over one sorted partition.

    Rows of one hash value are held until the next value begins (nearly
    always one run); the group is open when it touches an end of the
    partition.
    """
    out: dict[str, list] = {n: [] for n in schema.names}
    held = 0
    group: list[dict] = []          # runs of the current hash value
    seen_hash, first_group = None, True
    has_row = "row" in schema.names

    def close(open_: bool) -> int:
        size = 0
        for run in group:
            sha = hashlib.sha256(run["norm"].encode("utf-8", "surrogatepass")).hexdigest()
            n = len(run["ids"])
            out["id"] += run["ids"]
            out["sha"] += [sha] * n
            out["keep"] += [run["ids"][0]] * n
            out["n"] += [n] * n
            out["first"] += [True] + [False] * (n - 1)
            out["open"] += [open_] * n
            if has_row:
                out["row"] += [run["row"]] + [None] * (n - 1)
                size += len(run["norm"])
        return size

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict({k: list(v) for k, v in out.items()}, schema=schema)
        for v in out.values():
            v.clear()
        return batch

    for batch in batches:
        hashes = batch.column("h").to_pylist()
        norms = batch.column("norm").to_pylist()
        ids = batch.column("id").to_pylist()
        rows = batch.column("row") if has_row else None
        for i, (h, norm, doc) in enumerate(zip(hashes, norms, ids)):
            if h != seen_hash or not group:
                if group:
                    held += close(first_group)
                    first_group = False
                    group = []
                seen_hash = h
            if group and group[-1]["norm"] == norm:
                group[-1]["ids"].append(doc)
            else:
                group.append({"norm": norm, "ids": [doc],
                              "row": rows[i].as_py() if has_row else None})
        if len(out["id"]) >= 5000 or held > 16_000_000:
            held = 0
            yield flush()
    if group:
        close(True)
    if out["id"]:
        yield flush()


def _resolved(docs: DataFrame, id_col: str, text_col: str, keep: str, with_rows: bool) -> DataFrame:
    """Columns id, sha, keep, n, kept and, with rows, the keeper's ``row``."""
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    norm = ascii_lower(text_or_empty("text"))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                      *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []))
    src = src.select("id", norm.alias("norm"), *(["row"] if with_rows else []))
    by_id = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    head, h = F.substring("norm", 1, PREFIX_CHARS), F.xxhash64("norm")
    ordered = (src.repartitionByRange(head, h, by_id)
               .withColumn("head", head).withColumn("h", h)
               .sortWithinPartitions("head", "h", "norm", by_id).drop("head"))
    fields = [T.StructField("id", T.LongType()), T.StructField("sha", T.StringType()),
              T.StructField("keep", T.LongType()), T.StructField("n", T.LongType()),
              T.StructField("first", T.BooleanType()), T.StructField("open", T.BooleanType())]
    if with_rows:
        fields.append(T.StructField("row", src.schema["row"].dataType))
    spark_schema = T.StructType(fields)
    arrow = to_arrow_schema(spark_schema)
    runs = stage(ordered.mapInArrow(lambda it: _runs(it, arrow), spark_schema), "runs")
    best = F.min("keep") if keep == "min" else F.max("keep")
    ends = (runs.filter("open AND first").groupBy("sha")
            .agg(best.alias("all_keep"), F.sum("n").alias("all_n")))
    rest = ["row"] if with_rows else []
    closed = runs.filter("NOT open").select("id", "sha", "keep", "n", F.col("first").alias("kept"), *rest)
    # at most two hash values a partition are open: a bounded broadcast
    opened = (runs.filter("open").join(F.broadcast(ends), "sha")
              .select("id", "sha", F.col("all_keep").alias("keep"), F.col("all_n").alias("n"),
                      (F.col("first") & F.col("keep").eqNullSafe(F.col("all_keep"))).alias("kept"), *rest))
    return closed.unionByName(opened)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _resolved(docs, id_col, text_col, keep, False).select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
        "kept", F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, all columns as they came."""
    kept = _resolved(docs, id_col, text_col, keep, True).filter("kept")
    return kept.select("row.*")


def op9_exact_dedup(spark, sf_dir):

    return exact_groups(documents(spark, sf_dir), keep="max")


OP9_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t"""
