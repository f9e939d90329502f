"""Training-data operators: near-duplicates, packing, language, quality, archives.

Nothing else in the package imports this one. Operators take and return
DataFrames; ``wardflow.llm.queries`` registers one query per operator over its
whole table.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with the task, so that the
# executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
