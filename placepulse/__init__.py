"""placepulse: review analytics and text classification as PySpark table operators.

Every operator is a function from DataFrames (or Columns) to a DataFrame (or Column). Jobs in
``placepulse.plans`` compose the operators; nothing runs outside Spark.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with their code, so executors need
# no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
