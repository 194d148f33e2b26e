"""Operations of a training-data pipeline over documents and web pages.

Each module is one operator: it takes DataFrames and plain parameters and
returns DataFrames. ``queries`` registers them over the given tables. Nothing
outside this package imports it.

Functions that run inside tasks travel with the job, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
