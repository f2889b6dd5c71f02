"""Lexiforge: a Spark-native engine that structures large dictionaries and text corpora."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: functions of this package travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
