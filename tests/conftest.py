import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = (SparkSession.builder.master("local[*]")
         .appName("marquee-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "4g")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         # tests only: a fresh shared folder of our own
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def small_clean(spark):
    from marquee.plans.clean import clean_titles
    from marquee.sources.fixtures import raw_titles
    return clean_titles(raw_titles(spark, SF_SMALL)).cache()


def docs_frame(spark, docs):
    """Hand-written JSON documents read under the document schema."""
    import json
    from marquee.schema import DOCUMENT_SCHEMA, with_corrupt_column
    lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    rdd = spark.sparkContext.parallelize(lines, 1)
    return (spark.read.schema(with_corrupt_column(DOCUMENT_SCHEMA))
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(rdd))
