"""lumenfold: DataFrame operators for document collections and benchmark records on Spark.

Functions that run in Python on executors travel with their code, so executors need not have this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
