"""Property-graph and vector analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few Arrow functions travel to the executors by value, so no executor needs
# this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from knotwork.model import PropertyGraph  # noqa: E402

__all__ = ["PropertyGraph"]
