"""Tagged-channel time series on Spark: normalise, batch, pack, check, store and deliver."""

import sys

from pyspark import cloudpickle

# Worker-side helpers travel with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
