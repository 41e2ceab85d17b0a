"""Masking of personal data. NULL stays NULL.

Short values are not protected: a phone number of four characters or fewer and an
address of three or fewer appear whole beside the stars.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(email: Column) -> Column:
    """First character and domain: ``ada@mail.example`` -> ``a***@mail.example``."""
    domain = F.split_part(email, F.lit("@"), F.lit(2))
    return F.concat(F.left(email, F.lit(1)), F.lit("***@"), domain)


def mask_phone(phone: Column) -> Column:
    """Last four characters: ``(555) 000-0001`` -> ``(***) ***-0001``."""
    return F.concat(F.lit("(***) ***-"), F.right(phone, F.lit(4)))


def mask_address(address: Column) -> Column:
    """First three characters: ``12 Sample St`` -> ``12 ***``."""
    return F.concat(F.left(address, F.lit(3)), F.lit("***"))
