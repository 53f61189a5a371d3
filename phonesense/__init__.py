"""phonesense: Spark-native analytics for mobile-phone sensing uploads.

Raw uploads ``(user_id, payload)`` -> parsed probe objects (``sensor_raw``)
-> typed event tables -> daily per-participant measures, each also available
as JSON rows.
"""

from phonesense.operators import *  # noqa: F401,F403
from phonesense.operators import __all__ as _ops
from phonesense.plans.bronze import read_bronze, write_bronze
from phonesense.session import get_session
from phonesense.sources.json_sink import to_json_rows, write_json_rows
from phonesense.sources.uploads import read_register, read_uploads

__all__ = ["get_session", "read_uploads", "read_register", "to_json_rows", "write_json_rows",
           "write_bronze", "read_bronze", *_ops]
