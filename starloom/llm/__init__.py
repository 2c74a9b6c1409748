"""Operators of a training-data pipeline: filtering, deduplication, decontamination, mixing and scoring of texts."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers as they are, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
