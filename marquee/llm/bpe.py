"""Byte-level BPE encoding and decoding.

Documents up to ``CHUNK`` characters are encoded where they are read.  Longer
ones are cut into chunks that overlap by ``OVERLAP`` characters and are
pre-tokenised in parallel.  A pre-token depends only on the text from its
start on, so once two neighbouring chunks have a boundary in common in their
overlap, the later chunk is in step with the whole text; there the document
is cut, at the first common boundary that follows no white space (there the
pattern's look-ahead does not reach over the cut).  The pieces between cuts are
encoded in parallel and joined in order.  A document in which some overlap has
no such boundary (a run of one kind of character longer than the overlap) is
one piece.  Decoding concatenates the bytes of the ids.

Defined cases: null text = empty text = no ids; repeated rows are documents
of their own; a null identifier stays null; an empty table gives an empty
result.  Ids travel as little-endian 32-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, text_or_empty

CHUNK = 32_768
OVERLAP = 2_048

_CODECS: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Codec:
    """Encoding and decoding by one file of ranks."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = regex.compile(pattern)
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        digits = np.zeros((size, len(str(size)) + 1), dtype=np.uint8)
        for i in range(size):
            s = f"{i},".encode()
            digits[i, :len(s)] = np.frombuffer(s, dtype=np.uint8)
        self.digits = digits

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.bpe.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)

    def boundaries(self, text: str) -> list[int]:
        """Pre-token starts that follow a character other than white space."""
        return [p for p in (m.start() for m in self.pieces.finditer(text)) if p and not text[p - 1].isspace()]

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        shift = np.repeat(self.start[ids] - (ends - n), n)
        return self.flat[np.arange(ends[-1]) + shift].tobytes()

    def ids_text(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        d = self.digits[ids].ravel()
        return d[d != 0].tobytes()[:-1]


def codec(path: str) -> Codec:
    """One codec a worker process."""
    if path not in _CODECS:
        import public_tokenizers

        _CODECS[path] = Codec(path, public_tokenizers.PATTERN)
    return _CODECS[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of batches with columns doc_id and text."""
    c = codec(path)
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            yield doc, c.encode(text.as_py())


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
DIGEST_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(rows: Iterator[tuple[int | None, np.ndarray]], path: str) -> Iterator[pa.RecordBatch]:
    """Digest columns of encoded documents; the ids are decoded again."""
    c, out = codec(path), []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_DIGEST)],
                                          schema=_DIGEST)
    for doc, ids in rows:
        out.append((doc, len(ids), hashlib.sha256(c.ids_text(ids)).hexdigest(),
                    hashlib.sha256(c.decode(ids)).hexdigest()))
        if len(out) >= 5000:
            yield flush()
            out.clear()
    if out:
        yield flush()


def id_rows(rows: Iterator[tuple[int | None, np.ndarray]], path: str) -> Iterator[pa.RecordBatch]:
    docs, ids, size = [], [], 0
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    for doc, got in rows:
        docs.append(doc)
        ids.append(got.astype("<u4").tobytes())
        size += len(ids[-1])
        if size > 8_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.binary())], schema=schema)
            docs, ids, size = [], [], 0
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.binary())], schema=schema)


IDS_DDL = "doc_id long, ids binary"


def _chunks(batches, step: int, overlap: int):
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
            text = text.as_py()
            starts = range(0, max(1, len(text) - overlap), step)
            for k, s in enumerate(starts):
                yield pa.RecordBatch.from_pydict({"key": [key], "k": [k], "s": [s], "text": [text[s:s + step + overlap]]},
                                                 schema=pa.schema([("key", pa.string()), ("k", pa.int32()),
                                                                   ("s", pa.int64()), ("text", pa.string())]))


def _overlap_boundaries(batches, path: str, step: int, overlap: int):
    """The pre-token starts of a chunk in its first and its last overlap."""
    c = codec(path)
    for batch in batches:
        head, tail = [], []
        for s, text in zip(batch.column("s").to_pylist(), batch.column("text")):
            at = c.boundaries(text.as_py())
            head.append([s + p for p in at if p < overlap])
            tail.append([s + p for p in at if p >= step])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("k"), pa.array(head, pa.list_(pa.int64())),
             pa.array(tail, pa.list_(pa.int64()))], names=["key", "k", "head", "tail"])


def _pieces(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("copies", pa.int64()), ("at", pa.int64()),
                        ("text", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"]
            cuts = [0, *row["cuts"], len(text)]
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_pylist([{"doc_id": row["doc_id"], "key": row["key"], "copies": row["copies"],
                                                   "at": a, "text": text[a:b]}], schema=schema)


def _encode_pieces(batches, path: str):
    c = codec(path)
    for batch in batches:
        ids = [c.encode(t.as_py()).astype("<u4").tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), batch.column("copies"),
                                          batch.column("at"), pa.array(ids, pa.binary())],
                                         names=["doc_id", "key", "copies", "at", "ids"])


def _joined(batches):
    """(doc_id, ids) of documents whose pieces were gathered in order."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(b"".join(p["ids"] for p in row["parts"]), dtype="<u4")
            for _ in range(row["copies"]):
                yield row["doc_id"], ids


def encode_into(docs: DataFrame, finish, ddl: str, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encode all documents and turn each task's (doc_id, ids) rows into
    output batches by ``finish(rows, path)``, in the process that encodes."""
    path = path or default_vocabulary()
    step = chunk - overlap
    if step <= overlap:
        raise ValueError("chunk must be longer than twice the overlap")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    short = d.filter(F.length("text") <= chunk).mapInArrow(lambda it: finish(encoded(it, path), path), ddl)
    # long documents: equal rows are encoded once
    long_ = (d.filter(F.length("text") > chunk).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
             .groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    chunks = (long_.select("key", "text").mapInArrow(lambda it: _chunks(it, step, overlap),
                                                     "key string, k int, s long, text string")
              .repartition("key", "k"))
    marks = chunks.mapInArrow(lambda it: _overlap_boundaries(it, path, step, overlap),
                              "key string, k int, head array<long>, tail array<long>").dropDuplicates(["key", "k"])
    before = F.lag("tail").over(Window.partitionBy("key").orderBy("k"))
    cuts = (marks.withColumn("before", before).filter("k > 0")
            .select("key", "k", F.array_min(F.array_intersect("head", "before")).alias("cut"))
            .groupBy("key").agg(F.sort_array(F.collect_list("cut")).alias("cuts"), F.count(F.lit(1)).alias("n")))
    # a gap in step anywhere: the document stays whole
    cuts = cuts.select("key", F.when(F.size("cuts") == F.col("n"), F.array_distinct("cuts"))
                       .otherwise(F.array().cast("array<long>")).alias("cuts"))
    pieces = (long_.join(cuts, "key", "left")
              .withColumn("cuts", F.coalesce("cuts", F.array().cast("array<long>")))
              .mapInArrow(_pieces, "doc_id long, key string, copies long, at long, text string")
              .repartition("doc_id", "key", "at"))
    done = (pieces.mapInArrow(lambda it: _encode_pieces(it, path), "doc_id long, key string, copies long, at long, ids binary")
            .groupBy("doc_id", "key", "copies").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts")))
    long_out = done.select("doc_id", "copies", "parts").mapInArrow(lambda it: finish(_joined(it), path), ddl)
    return short.unionByName(long_out)


def encode(docs: DataFrame, **options) -> DataFrame:
    """doc_id and ids (little-endian 32-bit integers)."""
    return encode_into(docs, id_rows, IDS_DDL, **options)


def decode(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded bytes of rows (doc_id, ids)."""
    path = path or default_vocabulary()

    def run(batches):
        c = codec(path)
        for b in batches:
            data = [c.decode(np.frombuffer(x.as_py(), dtype="<u4")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "bytes"])
    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def token_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_into(docs, digests, DIGEST_DDL, **options)


def op5_bpe(spark, sf_dir):
    return token_digests(documents(spark, sf_dir))
