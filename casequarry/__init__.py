"""Support-case analytics on Spark: ingest, quality, assembly, personal-data
removal, enrichment, vectors, hybrid search, evaluation, reconciliation and
stream monitoring as DataFrame and Column functions."""

import sys

from pyspark import cloudpickle

# Python helpers travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
