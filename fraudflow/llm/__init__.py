"""Training-data operators: classifiers, near-duplicate joins, packing, archives.

Nothing else in the library imports this subpackage.  The functions that run
in Python workers are shipped with the job (pickled by value), so executors
need the third-party libraries but not this package; only op1's broadcast
model names its class, so toxicity needs the package there (``--py-files``).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
