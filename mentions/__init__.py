"""mentions: PySpark operators over flattened text-annotation tables.

Entry points: :class:`mentions.sources.tables.TableSet` (read, filter,
facades), :mod:`mentions.operators` (the operator functions),
:mod:`mentions.streaming` (incremental ingest, windowed counts).
"""

import sys

__version__ = "0.1.0"

# The few Python functions the library sends to executors (the pandas UDF of
# a Python concept predicate, the batching packer) are pickled by value, so
# executors need not have this package installed.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

from mentions.errors import NoRelevantData  # noqa: E402,F401
from mentions.sources.tables import TableSet  # noqa: E402,F401
