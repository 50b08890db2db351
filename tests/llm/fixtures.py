"""Small tables for the operators' defined cases."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def passage(seed: int, n: int) -> str:
    """n words, the same for the same seed."""
    return " ".join(f"w{(seed * 7919 + i * 104729 + i * i * seed) % 9973}" for i in range(n))


def rows():
    """Nulls in every column, empty, blank and very long texts, ties,
    repeated rows, copies that differ in case, near copies and shared passages."""
    near = passage(3, 300).split()
    near[150] = "changed"
    out = [
        (1, passage(1, 120), "en", "a", 700), (2, passage(1, 120).upper(), "en", "a", 700),
        (3, passage(1, 120), "en", "b", 700), (4, None, None, None, None), (5, "", "en", "a", 0),
        (6, " \t\n", "de", "c", 3), (7, passage(3, 300), "en", "a", 1), (8, " ".join(near), "en", "b", 1),
        (9, passage(5, 20_000), "fr", "a", 1), (10, "two words", "en", "d", 9), (11, "one", "en", None, 3),
        (12, "Released under the MIT License. Ärger & café naïve.\nGNU General Public License", "en", "a", 1),
        (13, passage(8, 60) + " " + passage(9, 80), "en", "b", 1),
        (14, passage(10, 30) + " " + passage(9, 80) + " " + passage(11, 40), "en", "c", 1),
        (None, passage(12, 70), "en", "a", 1), (15, "you are an idiot and a moron. you will be trash", "en", "a", 1),
        (16, "x" * 70_000, "en", "b", 70_000), (17, "a  b\t\tc   'll don't 123 　 !!", "en", "b", 1),
    ]
    return out + [out[0], out[6]]   # repeated rows


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df):
    """Further columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["id", "norm", "h", "head", "row", "keep", "key", "size", "cls", "hb", "skey", "rank", "shard", "bucket",
             "fp", "text_crc32", "kept", "score", "copies", "label", "tree", "m", "runs", "size_", "start"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])
