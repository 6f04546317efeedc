"""Training-data operators: near-dedup, decontamination, token counts, shards,
BPE, vector search, language-model scores, toxicity, language and PII.

Nothing else in the library imports this package. Functions that run in
Python workers are pickled by value, so an executor needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
