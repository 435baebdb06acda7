"""sitrep: multilingual crisis-report datasets as Spark jobs.

Every public function takes and returns DataFrames or Columns. See README.md
for the map from operator to function.
"""

import sys

from pyspark import cloudpickle

# Python code that runs inside tasks travels with the job, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
