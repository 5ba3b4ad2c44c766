"""Training-data operators: deduplication, decontamination, quality, mixing, PII, licences, chat.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered queries and their oracle SQL; every other module holds one operator
with its general interface, or shared helpers (``blocks``, ``cuts``).
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code: executors need numpy, pandas and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
