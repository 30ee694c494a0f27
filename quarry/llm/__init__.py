"""Operators of a training-data pipeline (chat formatting, scoring, dedup, BPE, archives).

Nothing outside this folder imports it; its queries are in ``queries.py`` and
their SQL in ``oracles.py``.
"""

import sys

from pyspark import cloudpickle

# Executors needn't have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
