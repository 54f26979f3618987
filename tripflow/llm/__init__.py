"""Operators for training-data pipelines over a table of documents.

One module per operator, each with a general interface (table in, table out);
``queries`` holds the thin registered queries on top of them. Nothing outside
this folder imports it.

Worker code is pickled by value, so executors need no copy of this package on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
