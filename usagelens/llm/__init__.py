"""Operators of a training-data pipeline, each a function from DataFrame to DataFrame.

``queries`` registers one query per operator. Column names that begin with ``_ul_`` are reserved for
the operators' own working columns; any other extra column of an input is kept or ignored, never read.
"""

import sys

from pyspark import cloudpickle

# Python tasks get these functions with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
