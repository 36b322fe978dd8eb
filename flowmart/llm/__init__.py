"""Operators of a training-data pipeline. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with their tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
