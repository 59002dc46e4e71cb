"""Training-data operators: packing, toxicity, deduplication, archives,
fingerprints, URL lists, embedding links, sharding, SentencePiece coding.

Nothing else in ``meterline`` imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task code travels with the task: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
