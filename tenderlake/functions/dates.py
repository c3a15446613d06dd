"""Date parsing and calendar labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# A leading day: ten characters with any tail, or one-digit month / day ended by a blank, a T or the end.
LEADING_DAY = r"^(\d{4}-\d{2}-\d{2}|\d{4}-\d{1,2}-\d{1,2}(?=$|[T\s]))"


def lenient_date(text: Column) -> Column:
    """ISO-ish text to DATE: the leading year-month-day, 1- or 2-digit month
    and day, whatever time follows; anything unparsable (``2001-02-31``,
    junk) becomes NULL."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, LEADING_DAY, 1), F.lit("")), "yyyy-M-d")


def year_month(d: Column) -> Column:
    """``<year>-<MM>``; the year is not zero-padded (year 20 gives ``20-03``)."""
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0"))
