"""Training-data operators: quality rules, toxicity, decontamination, de-duplication,
personal data, packing, secrets and quality classification.

Nothing else in the library imports this package.  Its functions are pickled by
value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
