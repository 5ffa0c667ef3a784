"""Operators for preparing training data for language models, on whole Spark tables.

Functions of this package that run inside tasks are sent to the workers whole, so that
executors need numpy, pyarrow and the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
