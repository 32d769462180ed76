"""Matching, propensity and segmentation analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from pairloom.spec import DatasetSpec, Range, ResponseCodes, load_spec

__all__ = ["DatasetSpec", "Range", "ResponseCodes", "load_spec"]

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
