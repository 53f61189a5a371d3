"""Sources: upload/register readers and the driver-table fixtures."""

from phonesense.sources.fixtures import (
    fixture_register, fixture_uploads, register_from_customers, uploads_from_events,
)
from phonesense.sources.uploads import read_register, read_uploads, with_source_order

__all__ = ["fixture_register", "fixture_uploads", "register_from_customers",
           "uploads_from_events", "read_register", "read_uploads", "with_source_order"]
