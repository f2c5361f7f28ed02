"""gridspark: environmental grid, point and observation processing, and training data, as Spark DataFrame operators."""
import sys

from pyspark import cloudpickle

# functions and modules of this package travel to Python workers by value, so workers need no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
