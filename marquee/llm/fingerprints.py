"""Order-independent document fingerprints (native).

A document is the multiset of its paragraphs (lines, cut again at sentence
ends so that an edit inside a long paragraph stays local).  Each paragraph is
hashed to a wide vector of 60 entries of 0 to 3 and the vectors are summed,
every coordinate modulo 2^31.  Sums commute, so equal multisets have equal
fingerprints in any order, and a paragraph is inserted or deleted by adding
or subtracting its vector.  A coordinate wraps only beyond 715 million
paragraphs in one document (1.4 GB of the shortest ones), so the centred
vectors keep inner products: the cosine of two fingerprints estimates the
share of common paragraphs, also where one line makes up a whole log.  Two
different paragraphs have equal vectors by a chance of 2^-120.

Stored form: ``array<bigint>``, the number of paragraphs and then 30 words of
two 31-bit lanes.  Lane-wise addition and subtraction keep carries and
borrows inside a lane by treating each lane's top bit apart.

Defined cases: null text = empty text = the empty multiset (all zeros);
repeated paragraphs count as often as they stand; repeated rows are documents
of their own; rows of one identifier are in the order of a hash of their text;
a null identifier comes first in the order of identifiers; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, text_or_empty

WORDS, LANES, LANE_BITS = 30, 2, 31
MODULUS = 1 << LANE_BITS
#: The largest entry of a paragraph's vector.
ENTRY = 3
_ENTRIES = sum(ENTRY << (LANE_BITS * i) for i in range(LANES))
_TOP = sum(1 << (LANE_BITS * i + LANE_BITS - 1) for i in range(LANES))
_LOW = sum(((1 << (LANE_BITS - 1)) - 1) << (LANE_BITS * i) for i in range(LANES))
PARAGRAPH_END = r"\n+|(?<=[.!?])[\x20\x09-\x0D]+"
#: Ranges of identifiers for each shuffle partition when documents are put in order.
RANGES = 4


def _long(v: int) -> Column:
    return F.lit(v).cast("long")


def lane_add(a: Column, b: Column) -> Column:
    """Lane-wise sum modulo 2^31 of two words."""
    return (a.bitwiseAND(_long(_LOW)) + b.bitwiseAND(_long(_LOW))).bitwiseXOR(
        a.bitwiseXOR(b).bitwiseAND(_long(_TOP)))


def lane_sub(a: Column, b: Column) -> Column:
    """Lane-wise difference modulo 2^31 of two words."""
    same_top = F.bitwise_not(a.bitwiseXOR(b)).bitwiseAND(_long(_TOP))
    return (a.bitwiseOR(_long(_TOP)) - b.bitwiseAND(_long(_LOW))).bitwiseXOR(same_top)


def merge(fp: Column, other: Column) -> Column:
    """The fingerprint of both documents' paragraphs together."""
    return F.zip_with(F.transform(fp, lambda v, i: F.struct(v.alias("v"), i.alias("i"))), other,
                      lambda x, o: F.when(x["i"] == 0, x["v"] + o).otherwise(lane_add(x["v"], o)))


def remove(fp: Column, other: Column) -> Column:
    """The fingerprint without the other's paragraphs (deletion)."""
    return F.zip_with(F.transform(fp, lambda v, i: F.struct(v.alias("v"), i.alias("i"))), other,
                      lambda x, o: F.when(x["i"] == 0, x["v"] - o).otherwise(lane_sub(x["v"], o)))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    hashes = F.transform(parts, lambda p: F.xxhash64(p))
    zero = F.array_repeat(_long(0), WORDS + 1)

    def add(acc: Column, h: Column) -> Column:
        # a paragraph's lanes hold 0 to 3, so its words have no top bits
        return F.transform(acc, lambda v, i: F.when(i == 0, v + 1).otherwise(
            (v.bitwiseAND(_long(_LOW)) + F.xxhash64(h, i).bitwiseAND(_long(_ENTRIES)))
            .bitwiseXOR(v.bitwiseAND(_long(_TOP)))))

    return F.aggregate(hashes, zero, add)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.array_join(F.transform(fp, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def vector(fp: Column) -> Column:
    """The centred coordinates (twice their value less the entries' mean), as doubles."""
    n = F.element_at(fp, 1)
    lanes = F.flatten(F.transform(F.slice(fp, 2, WORDS), lambda w: F.array(*[
        F.shiftright(w, LANE_BITS * i).bitwiseAND(_long(MODULUS - 1)) for i in range(LANES)])))
    wide = F.transform(lanes, lambda c: F.pmod(c * 2 - n * ENTRY, _long(2 * MODULUS)))
    return F.transform(wide, lambda c: F.when(c >= MODULUS, c - 2 * MODULUS).otherwise(c).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, aa: Column, b: Column, bb: Column) -> Column:
    """Cosine of two centred vectors with squared lengths aa and bb, in 0 to 1;
    two empty documents are alike (1), an empty and another are not (0)."""
    cos = _dot(a, b) / F.sqrt(aa * bb)
    return (F.when((aa == 0) & (bb == 0), 1.0).when((aa == 0) | (bb == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cos))))


def _ranges(df: DataFrame, id_col: str, text_col: str) -> Column:
    """The number of a row's range in the order (identifier, text hash).

    Identifiers are cut at approximate quantiles; where one identifier spans
    several cuts, its rows are cut again by the hash.  The cuts follow the
    rows, whatever the identifiers' values, and there are at most ``RANGES``
    for each shuffle partition."""
    parts = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(id_col, shares, 20 * parts).alias("cuts"),
                 F.count(id_col).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    nulls = 1 + parts * (got["rows"] - got["n"]) // max(1, got["rows"])
    c = F.col(id_col)
    cuts = F.array(*[F.lit(i).cast("long") for i in got["cuts"] or []]).cast("array<long>")
    below, upto = F.size(F.filter(cuts, lambda x: x < c)), F.size(F.filter(cuts, lambda x: x <= c))
    # ascending with the identifier, and a number of its own for each that is a cut
    place = F.when(c.isNull(), 0).otherwise(1 + below + upto)
    n = F.when(c.isNull(), nulls).otherwise(F.greatest(F.lit(1), upto - below))
    # the hash's upper 32 bits as a share of all hashes, in the hash's order
    share = (F.shiftright(F.xxhash64(text_col), 32) + (1 << 31)).cast("long")
    inner = F.floor(share * n / float(1 << 32)).cast("long")
    return place.cast("long") * (parts + 2) + inner


def with_next(df: DataFrame, id_col: str, carry: list[str], prefix: str = "next_") -> DataFrame:
    """Each row with the ``carry`` columns of the next row by identifier, then
    by the hash of the first of them, then by itself (after the last: the first).

    Rows are dealt to ranges of that order; inside a range a window finds the
    next row, and a range's last row takes the first row of the next range.
    Only one row a range meets in one task.
    """
    text = carry[0]
    dealt = df.withColumn("bucket", _ranges(df, id_col, text)).withColumn("_hash", F.xxhash64(text))
    order = [F.col(id_col).asc_nulls_first(), F.col("_hash"), F.col(text)]
    row = F.struct(*carry)
    inner = dealt.repartition("bucket").withColumn(
        "after", F.lead(row).over(Window.partitionBy("bucket").orderBy(*order)))
    # null identifiers have ranges of their own
    firsts = dealt.groupBy("bucket").agg(
        F.min_by(row, F.struct(F.coalesce(F.col(id_col), F.lit(0)), "_hash", text)).alias("wrap"))
    line = Window.orderBy("bucket")
    chain = dealt.select("bucket").distinct().select("bucket", F.coalesce(
        F.lag("bucket").over(line), F.max("bucket").over(Window.partitionBy())).alias("before"))
    firsts = firsts.join(chain, "bucket").select(F.col("before").alias("bucket"), "wrap")
    out = inner.join(firsts, "bucket")
    return out.select(*df.columns, *[F.coalesce("after", "wrap")[c].alias(prefix + c) for c in carry])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against itself with its last half replaced by the start
    of the next document: doc_id, n_chars, edited (text), fp, edited_fp,
    near_edited, near_next."""
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    d = d.select("doc_id", "text", fingerprint(F.col("text")).alias("fp"))
    d = with_next(d, "doc_id", ["text", "fp"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp",
                 F.concat(F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 2) as int))"),
                          F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    d = d.withColumn("edited_fp", fingerprint(F.col("edited")))
    d = d.select("*", vector(F.col("fp")).alias("v"), vector(F.col("edited_fp")).alias("ve"),
                 vector(F.col("next_fp")).alias("vn"))
    d = d.select("*", *[_dot(F.col(c), F.col(c)).alias(c + "2") for c in ("v", "ve", "vn")])
    c = F.col
    return d.select("doc_id", "n_chars", "edited", "fp", "edited_fp",
                    likeness(c("v"), c("v2"), c("ve"), c("ve2")).alias("near_edited"),
                    likeness(c("v"), c("v2"), c("vn"), c("vn2")).alias("near_next"))


def op8_fingerprints(spark, sf_dir):
    return edited_fingerprints(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_hex(F.col("fp")).alias("fingerprint"),
        fingerprint_hex(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
