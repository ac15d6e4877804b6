"""A PySpark engine for DNA-barcode reference databases, with operators for training-data pipelines in `llm`."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: what Python functions they run is sent to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
