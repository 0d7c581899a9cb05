"""statcube: statistical data cubes on Spark DataFrames.

Every operator takes DataFrames (or Columns) and returns a lazy DataFrame (or
Column).  See README.md for the map of modules and the scale notes.
"""

import sys

from pyspark import cloudpickle

# Python helpers used in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
