"""Table and file sinks."""

from tenderlake.sinks.files import write_delimited
from tenderlake.sinks.warehouse import UpsertResult, Warehouse, upsert_frame

__all__ = ["Warehouse", "UpsertResult", "upsert_frame", "write_delimited"]
