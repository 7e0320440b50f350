"""Exactly rounded sums of doubles: a superaccumulator of integer limbs.

A double is an integer times a power of two, so it is a sum of signed digits of base 2**24 whose places
are fixed. Digits of the same place are added as longs, which no order of rows, tasks or retries can
change, and the total is rounded once, to the nearest double (ties to even). Accumulators are arrays of
longs: sums of sums (:func:`merge`, :func:`merge_over`) stay exact.

The digit at place k of x is ``rint(x / B**k) - B rint(x / B**(k+1))``: scaling by powers of two, ``rint``
and this difference are exact in double arithmetic, so it is a built-in expression in the generated code.
Expressions are written as SQL text: they name their input often, and text is parsed in one step. Inputs
are column names, or SQL text that is cheap to repeat.
Digits are at most 2**23 + 1, so a group may hold 2**39 rows; beyond that ANSI mode fails loudly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
BASE = 1 << BITS
#: Places of a digit, lowest and highest. Numbers from 2**-92 (2e-28) to 2**143 (1e43), and 0; beyond, an error.
AMOUNTS = (-6, 5)
#: Every finite double.
DOUBLES = (-45, 42)

Places = tuple[int, int]


def _double(x: float) -> str:
    return f"{x!r}D" if "e" not in repr(x) else f"{repr(x).upper().replace('E+', 'E')}D"


def _scaled(x: str, power: int) -> str:
    """x times 2**power, in factors that are doubles themselves."""
    while power > 1000:
        x, power = f"{x} * {_double(2.0**1000)}", power - 1000
    while power < -1000:
        x, power = f"{x} * {_double(2.0**-1000)}", power + 1000
    return f"{x} * {_double(2.0**power)}"


def _digit(x: str, place: int, places: Places) -> str:
    digit = f"rint({_scaled(x, -BITS * place)})"
    if place < places[1]:
        digit += f" - rint({_scaled(x, -BITS * (place + 1))}) * {_double(float(BASE))}"
    if places == DOUBLES and BITS * place + 96 <= 1023:
        # where x would be scaled beyond the largest double, it has no bits at this place
        digit = f"CASE WHEN abs({x}) < {_double(2.0 ** (BITS * place + 96))} THEN {digit} ELSE 0D END"
    return f"CAST({digit} AS BIGINT)"


def _accumulated(x: str, places: Places) -> str:
    low, high = places
    limbs = [f"sum({_digit(x, k, places)})" for k in range(low, high + 1)]
    if places != DOUBLES:
        inside = f"{_scaled(f'rint({_scaled(x, -BITS * low)})', BITS * low)} = {x} AND abs({x}) < {_double(2.0 ** (BITS * (high + 1) - 1))}"
        problem = f"CAST(raise_error(concat('not a number that sums of amounts hold: ', CAST({x} AS STRING))) AS BIGINT)"
        limbs[0] = f"sum(CASE WHEN {x} IS NULL OR ({inside}) THEN {_digit(x, low, places)} ELSE {problem} END)"
    return f"CASE WHEN count({x}) > 0 THEN array({', '.join(limbs)}) END"


def accumulate(x: str, places: Places = AMOUNTS) -> Column:
    """Aggregate: the accumulator of all x that are not null, null if there are none.

    A number outside ``places``, NaN or an infinity is an error, never a wrong sum.
    """
    return F.expr(_accumulated(x, places))


def merge(total: str, places: Places = AMOUNTS, over: str = "") -> Column:
    """Aggregate: the accumulator of accumulators, null ones count for nothing. ``over``: of a window, as SQL."""
    over = f" OVER ({over})" if over else ""
    limbs = ", ".join(f"sum({total}[{i}]){over}" for i in range(places[1] - places[0] + 1))
    return F.expr(f"CASE WHEN count({total}){over} > 0 THEN array({limbs}) END")


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` computed once, under ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _carried(limbs: str) -> str:
    """Digits from 0 to BASE - 1, lowest first, and the carry that is left: ``struct(carry, digits)``."""
    value = "(_gl_s.carry + _gl_v)"
    step = f"named_struct('carry', shiftright({value}, {BITS}), 'digits', concat(_gl_s.digits, array({value} & {BASE - 1}L)))"
    start = "named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>))"
    return f"aggregate({limbs}, {start}, (_gl_s, _gl_v) -> {step})"


def _rounded(total: str, places: Places) -> str:
    zeros = "array(0L, 0L, 0L)"  # room for the carry, and for reading below the lowest digit
    limbs = f"concat({zeros}, {total}, {zeros})"
    turned = f"{_carried(f'transform({limbs}, _gl_x -> -_gl_x)')}.digits"
    head = f"CAST(_gl_d[_gl_t] * {BASE}L + _gl_d[_gl_t - 1] AS DOUBLE) * {_double(2.0 ** (2 * BITS))}"
    more = "CAST(exists(slice(_gl_d, 1, _gl_t - 3), _gl_z -> _gl_z <> 0) AS BIGINT)"
    rest = f"CAST((_gl_d[_gl_t - 2] * {BASE}L + _gl_d[_gl_t - 3]) | {more} AS DOUBLE)"
    power = f"((_gl_t - 6 + ({places[0]})) * {BITS})"
    half = f"CAST(floor({power} / 2D) AS INT)"
    size = f"({head} + {rest}) * pow(2D, {half}) * pow(2D, {power} - {half})"
    top = "array_max(transform(_gl_d, (_gl_v, _gl_i) -> CASE WHEN _gl_v <> 0 THEN _gl_i ELSE 3 END))"
    magnitude = _let("_gl_t", top, size)
    digits = f"CASE WHEN _gl_c.carry < 0 THEN {turned} ELSE _gl_c.digits END"
    signed = f"CASE WHEN _gl_c.carry < 0 THEN -1D ELSE 1D END * {_let('_gl_d', digits, magnitude)}"
    return f"CASE WHEN {total} IS NOT NULL THEN {_let('_gl_c', _carried(limbs), signed)} END"


def rounded(total: str, places: Places = AMOUNTS) -> Column:
    """The double nearest to an accumulator, ties to even; infinite beyond the largest double.

    The leading digit and the next three, with a mark for anything below them, are added as two doubles:
    one addition, so one rounding.
    """
    return F.expr(_rounded(total, places))


def rounded_total(x: str, *factors: str, places: Places = AMOUNTS) -> Column:
    """Aggregate: the sum of x times its factors; each product is the double that ``*`` gives."""
    term = " * ".join([x, *(f"CAST({f} AS DOUBLE)" for f in factors)])
    return F.expr(_rounded(_accumulated(f"({term})", places), places))
