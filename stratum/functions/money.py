"""Money measures: sums and means rounded to a fixed number of decimals.

Two modes:

* ``"double"`` - ``round(sum(x), k)`` / ``round(avg(x), k)`` on doubles, the
  data product's original behaviour (half-up on the decimal text of a double).
  A plain sum of doubles depends on the order in which tasks deliver them; here
  it doesn't. Each value is cut into limbs of 24 bits at fixed places (see
  ``LIMB_PLACES``), which are added as integers, without any rounding; the
  total is put together once a group. Values of at least a millionth keep all
  their bits; below, what lies under 2^-72 is cut off, per value. NaN, infinities
  and magnitudes from 2^72 on are added as doubles beside the limbs.
* ``"exact"`` - inputs are turned into integer units (cents), summed as
  decimals (exact, order independent, rows up to 10^28 units) and
  the mean is rounded half away from zero with integer division. Results do
  not depend on partitioning and match a NUMERIC warehouse column. NaN, an
  infinity or a value beyond 10^28 units is no amount: it counts as missing,
  in the sum and in the mean alike.

Both are plain aggregate expressions, so Catalyst keeps its partial/final
hash aggregation and a hot group is reduced map-side before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("exact", "double")


@dataclass(frozen=True)
class Measure:
    """One output column of a summary.

    kind: ``count`` (non-null count of ``column``; ``*`` counts rows),
    ``sum`` or ``avg``. ``in_scale`` is the number of decimals the input is
    known to carry (used by the exact mode), ``scale`` the output decimals;
    ``scale=None`` leaves a double result unrounded (exact mode keeps the
    input scale, which is already exact).
    """

    name: str
    kind: str
    column: str
    scale: int | None = 2
    in_scale: int = 2

    @property
    def out_scale(self) -> int:
        return self.in_scale if self.scale is None else self.scale


#: Bits of a limb, and the exponents of the limbs' lowest bits: from 2^72 down to 2^-72.
#: Sums of 2^39 rows fit a long.
LIMB_BITS, LIMB_PLACES = 24, (48, 24, 0, -24, -48, -72)


def _units(column: str, in_scale: int) -> Column:
    # the sum widens to decimal(38,0): ten billion rows at the bound still fit
    return F.round(F.col(column) * (10 ** in_scale)).try_cast("decimal(28,0)")


def _limb_names(m: Measure) -> list[str]:
    return [f"__{m.name}_l{k}" for k in range(len(LIMB_PLACES))]


def _double_sums(m: Measure) -> list[Column]:
    """Exact sums of a double column's limbs, and the sum of values outside their range."""
    x = F.col(m.column).cast("double")
    inside = F.abs(x) < 2.0 ** (LIMB_PLACES[0] + LIMB_BITS)  # NaN is greater than any number
    # scaling by powers of two and the remainder are exact; the cast cuts towards zero
    limbs = [F.when(inside, (x * 2.0 ** -e % 2.0 ** LIMB_BITS).cast("long")) for e in LIMB_PLACES]
    sums = [F.sum(v).alias(n) for v, n in zip(limbs, _limb_names(m))]
    return [*sums, F.sum(F.when(~inside, x)).alias(f"__{m.name}_x")]


def _double_total(m: Measure) -> Column:
    """The sum as a double: carries first, then two exact halves and the rest."""
    limbs, carry = [], F.lit(0)
    for name in reversed(_limb_names(m)):
        s = F.col(name) + carry
        limbs.append(s.bitwiseAND(F.lit((1 << LIMB_BITS) - 1)))
        carry = F.shiftright(s, LIMB_BITS)
    rest, f1, f0, i1, i0, _ = limbs
    whole = s.cast("double") * 2.0 ** LIMB_PLACES[0] + (i0 * (1 << LIMB_BITS) + i1).cast("double")
    part = (f0 * (1 << LIMB_BITS) + f1).cast("double") * 2.0 ** LIMB_PLACES[4] + rest.cast("double") * 2.0 ** LIMB_PLACES[5]
    outside = F.col(f"__{m.name}_x")
    return F.when(outside.isNull(), whole + part).otherwise(outside + F.coalesce(whole + part, F.lit(0.0)))


def partial_columns(m: Measure, mode: str) -> list[Column]:
    """Aggregate expressions for one measure (evaluated inside ``agg``); their values
    add up across batches (:func:`remerge_columns`)."""
    if mode not in MODES:
        raise ValueError(f"unknown money mode {mode!r}")
    if m.kind == "count":
        target = F.lit(1) if m.column == "*" else F.col(m.column)
        return [F.count(target).alias(m.name)]
    if mode == "double":
        sums, counted = _double_sums(m), F.col(m.column)
    else:
        counted = _units(m.column, m.in_scale)
        sums = [F.sum(counted).alias(f"__{m.name}_s")]
    return sums + ([F.count(counted).alias(f"__{m.name}_n")] if m.kind == "avg" else [])


def final_column(m: Measure, mode: str) -> Column:
    """Projection applied after ``agg`` that turns partial columns into the measure."""
    if m.kind == "count":
        return F.col(m.name)
    if mode == "double":
        value = _double_total(m)
        if m.kind == "avg":
            value = F.when(F.col(f"__{m.name}_n") > 0, value / F.col(f"__{m.name}_n"))
        return (value if m.scale is None else F.round(value, m.scale)).alias(m.name)
    s = F.col(f"__{m.name}_s")
    if m.out_scale < m.in_scale:
        raise ValueError("exact measures keep the input scale or more")
    if m.kind == "sum":
        return (s.cast("double") / float(10 ** m.in_scale)).alias(m.name)
    n = F.col(f"__{m.name}_n")
    return exact_mean(s, n, m.out_scale - m.in_scale, m.out_scale).alias(m.name)


def exact_mean(units_sum: Column, count: Column, shift: int, scale: int) -> Column:
    """``round_half_away(units_sum * 10^shift / count) / 10^scale`` as double.

    ``(2|s|*10^shift + n)`` less its remainder by ``2n`` divides without a rest, so
    no second rounding of an already-rounded decimal quotient can creep in.
    """
    numerator = F.abs(units_sum) * (2 * 10 ** shift) + count
    quotient = (numerator - numerator % (count * 2)) / (count * 2)
    signed = F.when(units_sum < 0, -quotient).otherwise(quotient)
    return F.when(count > 0, signed.cast("double") / float(10 ** scale))


# ---------------------------------------------------------------------------
# Mergeable partials: measures kept as sums and counts so partial results of
# different batches can be added later (incremental summaries).
# ---------------------------------------------------------------------------

def mergeable_names(m: Measure, mode: str) -> list[str]:
    if m.kind == "count":
        return [m.name]
    sums = [*_limb_names(m), f"__{m.name}_x"] if mode == "double" else [f"__{m.name}_s"]
    return sums + ([f"__{m.name}_n"] if m.kind == "avg" else [])


def remerge_columns(m: Measure, mode: str) -> list[Column]:
    """Aggregates that add partials of the same key together."""
    return [F.sum(F.col(c)).alias(c) for c in mergeable_names(m, mode)]
