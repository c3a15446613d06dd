"""Company identifier expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# French intra-EU VAT key = (12 + 3 * (siren mod 97)) mod 97,
# written as 2 digits after the country prefix.
VAT_COUNTRY, VAT_KEY_BASE, VAT_KEY_FACTOR, VAT_MODULUS = "FR", 12, 3, 97


def french_vat_number(siren: Column) -> Column:
    """Intra-EU VAT number of a French company: ``FR`` + 2-digit key + siren.

    key = (12 + 3 * (siren mod 97)) mod 97, left-padded with zeros.  A siren
    that is not an integer gives NULL instead of failing the whole job.
    """
    n = siren.try_cast("int")
    key = (F.lit(VAT_KEY_BASE) + F.lit(VAT_KEY_FACTOR) * (n % VAT_MODULUS)) % VAT_MODULUS
    return F.concat(F.lit(VAT_COUNTRY), F.lpad(key.cast("string"), 2, "0"), siren)
