"""Random ranks: a repeatable uniform order over rows, and cut-offs on it.

The sample of a stratum is its ``s`` rows of lowest rank. As ranks are uniform, a cut-off that lets
slightly more than ``s`` of ``n`` rows pass is known before the rows are read, so the scan can drop
nearly all rows with one comparison and nothing but a few candidates is ever sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from varstrata.functions.columns import col

KINDS = ("md5", "xxhash64")
HEX_DIGITS = 13  # 52 bits, so that a cut-off is exact in a double


def rank(ids: Sequence[str] | None, seed: int, kind: str = "xxhash64") -> Column:
    """Rank of a row.

    With id columns the rank is a hash of seed and ids: the same on every run, whatever the
    partitioning. ``xxhash64`` is many times cheaper than ``md5``, which can be recomputed in
    other SQL engines. Without ids it is ``rand(seed)``, independent of the row's content.

    Rows whose ids hash alike (repeated ids; for ``md5`` also ids that differ only in nulls and ``|``) share a rank: sizes
    stay exact, but such rows are not drawn independently of each other.
    """
    if not ids:
        return F.rand(seed)
    if kind == "md5":
        return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(i).cast("string") for i in ids]))
    if kind == "xxhash64":
        # the hash skips nulls: with their places, (null, 5) and (5, null) differ
        places = [F.when(col(i).isNull(), F.lit(p)) for p, i in enumerate(ids)] if len(ids) > 1 else []
        return F.xxhash64(F.lit(seed), *[col(i) for i in ids], *places)
    raise ValueError(f"kind must be one of {KINDS}")


def cut_fraction(s: Column, n: Column, slack: float = 30.0) -> Column:
    """Fraction of a stratum's rows that holds its ``s`` lowest ranks.

    From the Chernoff bound P(X <= s) <= exp(-(mu - s)^2 / (2 mu)) for the number X of rows below the
    cut-off: mu = s + L + sqrt(L^2 + 2 s L) makes a shortfall less likely than exp(-L).
    """
    s = s.cast("double")
    expected = s + F.lit(slack) + F.sqrt(F.lit(slack * slack) + F.lit(2.0 * slack) * s)
    return F.when(expected >= n, F.lit(1.0)).otherwise(expected / n.cast("double"))


def cut_off(fraction: Column, ids: Sequence[str] | None, kind: str = "xxhash64") -> Column:
    """The highest rank that passes, in the type :func:`rank` yields."""
    if not ids:
        return fraction
    if kind == "md5":
        digits = F.lower(F.hex(F.floor(fraction * F.lit(float(2 ** (4 * HEX_DIGITS)))).cast("bigint")))
        # "g" sorts after every hexadecimal digit
        return F.when(fraction >= 1.0, F.lit("g")).otherwise(F.lpad(digits, HEX_DIGITS, "0"))
    top = F.lit(2**63 - 1).cast("bigint")
    # scaled by 2^53 first, as 2^64 does not fit a bigint
    scaled = F.floor(fraction * F.lit(float(2**53))).cast("bigint")
    return F.when(fraction >= 1.0, top).otherwise((scaled - F.lit(2**52)) * F.lit(2**11))
