"""File and table sources."""

from tenderlake.sources.delimited import csv_header_scan, read_delimited
from tenderlake.sources.hygiene import clean_loaded
from tenderlake.sources.json_docs import (award_rows, contract_rows, defective_values, json_fields, landed_contracts,
                                          read_contracts, read_json_lines, rejected_documents, rejected_lines,
                                          strip_escapes, typed_contracts, value_defects)

__all__ = ["read_contracts", "landed_contracts", "typed_contracts", "value_defects", "defective_values",
           "rejected_documents",
           "strip_escapes", "contract_rows", "award_rows", "read_json_lines", "rejected_lines", "json_fields",
           "read_delimited", "csv_header_scan", "clean_loaded"]
