"""Document tables on Spark: ledger, text, chunks, embeddings, index, search."""

import sys

from pyspark import cloudpickle

# Tasks get the few Python helpers they need with the plan, so that executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
