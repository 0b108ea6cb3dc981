"""Log sequence numbers: text ``X/Y`` (two hex words) <-> 64-bit number.

Text comparison of LSNs is wrong (``F/0`` > ``10/0`` as text); always
compare the numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lsn_to_long(lsn: Column) -> Column:
    """``'16/B374D848'`` -> 0x16 << 32 | 0xB374D848 (NULL on bad text)."""
    hi = F.conv(F.split_part(lsn, F.lit("/"), F.lit(1)), 16, 10).try_cast("bigint")
    lo = F.conv(F.split_part(lsn, F.lit("/"), F.lit(2)), 16, 10).try_cast("bigint")
    ok = lsn.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    return F.when(ok, F.shiftleft(hi, 32) + lo)


def long_to_lsn(n: Column) -> Column:
    """64-bit position -> canonical upper-case ``X/Y`` text."""
    return F.format_string("%X/%X", F.shiftright(n, 32),
                           n.bitwiseAND(F.lit(0xFFFFFFFF)))


def lsn_lag(ahead: Column, behind: Column) -> Column:
    """Bytes between two positions (``ahead - behind``)."""
    return lsn_to_long(ahead) - lsn_to_long(behind)
