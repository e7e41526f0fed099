"""Spark-native analytics for segmented microscopy objects."""

import sys

from pyspark import cloudpickle

from roispark.session import build_session, materialize

# The few Python helpers used inside tasks travel with the plan, so executors
# need nothing installed beyond PySpark, pandas and numpy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "materialize"]
