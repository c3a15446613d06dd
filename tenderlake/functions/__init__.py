"""Column expressions (JVM-side, inside whole-stage codegen; no Python UDFs)."""

from tenderlake.functions.dates import lenient_date, year_month
from tenderlake.functions.identifiers import french_vat_number
from tenderlake.functions.text import blank_as_null, strip_control, truncate_utf8

__all__ = ["lenient_date", "year_month", "french_vat_number", "blank_as_null", "strip_control", "truncate_utf8"]
