"""Speaker labels: the number that a label carries, however it is written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits, and the letters that typists and scanners put for 0 and 1 beside or instead of digits.
_NUMBER = r"((?:(?<![A-Za-z])[OolI]+)?[0-9][0-9OolI]*)"


def speaker_number(label: Column | str) -> Column:
    """The speaker number as int; null where the label is null, blank or carries none."""
    c = F.col(label) if isinstance(label, str) else label
    ascii_digits = F.translate(c, "０１２３４５６７８９", "0123456789")
    digits = F.translate(F.regexp_extract(ascii_digits, _NUMBER, 1), "OolI", "0011")
    return digits.try_cast("int")


def normal_label(label: Column | str) -> Column:
    """Bare digits become SPEAKER_nn; any other label stays as it is."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c.rlike(r"^\d+$"), F.format_string("SPEAKER_%02d", c.cast("bigint"))).otherwise(c)
