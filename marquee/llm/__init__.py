"""Training-data operators: deduplication, mixing, sharding, packing,
fingerprints, tokenisation, license scans and toxicity.

Nothing outside this subpackage imports it; ``queries()`` and
``oracle_sql()`` of :mod:`marquee.llm.registry` list its registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need
# only the third-party libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
