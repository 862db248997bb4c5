"""Operators for preparing language-model training corpora.

Nothing outside this folder imports it; the rest of the library works without it.
Every operator takes and returns DataFrames, runs over whole texts and all rows,
and states in its docstring what it does with nulls, empty texts, ties, repeated
rows and empty tables.  Columns that an operator does not name are ignored or passed
through; its own helper columns take names that no column has.
"""

import sys

from pyspark import cloudpickle

# Work functions travel to the executors whole, so that they need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
