"""Training-data operators: ten operators over documents, vectors and pages,
and their registered queries (:mod:`recsift.llm.entry`).

Nothing else in the library imports this subpackage. Task functions are
pickled by value, so executors need Spark and numpy but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
