"""Sums of amounts that do not depend on the order of addition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals an amount is added in, the first that holds it as it is. Sums have ten digits more.
SCALES = ("decimal(28,18)", "decimal(28,6)", "decimal(28,28)")


def exact_parts(amount: Column | str) -> list[Column]:
    """What is summed for :func:`exact_sum`: the amount in the first decimal that holds it, or as it is.

    Exactly one of the columns has a value, unless the amount is NULL. Amounts below 1e10 with
    up to 18 decimals, below 1e22 with up to 6, and below 1 with up to 28 are held; NaN,
    infinities and what is larger or finer are left as doubles in the last column.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    out, open_ = [], F.lit(True)
    for scale in SCALES:
        cast = value.try_cast(scale)
        held = F.coalesce(cast == value, F.lit(False))
        out.append(F.when(open_ & held, cast))
        open_ = open_ & ~held
    return [*out, F.when(open_, value).cast("double")]


def exact_total(sums: Sequence[Column]) -> Column:
    """The sums of :func:`exact_parts` as one double; NULL if all are."""
    doubles = [s.cast("double") for s in sums]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in doubles[1:]), F.coalesce(doubles[0], F.lit(0.0)))
    return F.when(F.coalesce(*doubles).isNotNull(), total)


def exact_sum(amount: Column | str) -> Column:
    """The sum of ``amount`` as double, added in decimals.

    Floating sums differ with the layout of the rows; decimal ones do not, and are turned
    into double once at the end. No amount is rounded: see :func:`exact_parts`; only what
    no decimal holds is added as doubles. NULL if there is no amount.
    """
    return exact_total([F.sum(part) for part in exact_parts(amount)])
