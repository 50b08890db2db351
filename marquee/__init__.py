"""marquee: title-catalogue analytics on Spark DataFrames.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so plans stay inside Catalyst and whole-stage
codegen and run the same on ``local[*]`` and on a cluster.

Layout:

* ``sources``    - readers (declared-schema JSON, Parquet) and the
                   title-shaped fixture derived from the star-schema tables
* ``functions``  - column expressions (flattening, safe casts, null rules,
                   derived metrics)
* ``operators``  - cleaning steps, dedupe, quality gates, rankings,
                   searches, grouped reports, chart data, statistics, ingest
* ``plans``      - compositions: the clean pipeline, report bundle,
                   publishing, idempotent stages and the end-to-end job
* ``llm``        - operators for training data (an optional part that nothing
                   else imports)
"""

from marquee.config import Settings, DEFAULTS

__all__ = ["Settings", "DEFAULTS"]
