"""Batch and streaming jobs for payment-fraud data on Spark, and operators for training data in ``llm``."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their plan, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
