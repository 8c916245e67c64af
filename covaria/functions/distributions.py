"""Search distributions: each maps a trial id to a drawn value, as a column.

`draw(name, seed)` returns the column for one named parameter.  The draw is
a function of (seed, parameter name, trial_id).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F

from .hashing import unit_uniform

TRIAL = "trial_id"


def _rounded(value: Column, q: float) -> Column:
    # Half-even, like the array library's round.
    return F.bround(value / F.lit(float(q))) * F.lit(float(q))


@dataclass(frozen=True)
class Distribution:
    """`shape(u1, u2)` turns two independent uniforms into a value."""

    shape: Callable[[Column, Column], Column]
    # Bounds and scale are kept for local resampling around good trials.
    low: float | None = None
    high: float | None = None
    log: bool = False
    quantum: float | None = None
    integer: bool = False
    options: tuple[Any, ...] | None = None

    def draw(self, name: str, seed: str | int) -> Column:
        u1 = unit_uniform(f"{seed}:{name}", TRIAL)
        u2 = unit_uniform(f"{seed}:{name}:2", TRIAL)
        return self.shape(u1, u2)


def uniform(low: float, high: float) -> Distribution:
    return Distribution(lambda u, _: F.lit(float(low)) + F.lit(float(high - low)) * u, low, high)


def quniform(low: float, high: float, q: float) -> Distribution:
    base = uniform(low, high)
    return Distribution(lambda u, v: _rounded(base.shape(u, v), q), low, high, quantum=q)


def loguniform(low: float, high: float) -> Distribution:
    a, b = math.log(low), math.log(high)
    return Distribution(lambda u, _: F.exp(F.lit(a) + F.lit(b - a) * u), low, high, log=True)


def qloguniform(low: float, high: float, q: float) -> Distribution:
    base = loguniform(low, high)
    return Distribution(lambda u, v: _rounded(base.shape(u, v), q), low, high, log=True, quantum=q)


def choice(options: Sequence[Any]) -> Distribution:
    values = tuple(options)

    def pick(u: Column, _: Column) -> Column:
        index = F.floor(u * F.lit(len(values))).cast("int") + F.lit(1)
        return F.element_at(F.array(*[F.lit(v) for v in values]), index)

    return Distribution(pick, options=values)


def randint(low: int, high: int) -> Distribution:
    """Integers low .. high-1."""
    return Distribution(
        lambda u, _: (F.lit(low) + F.floor(u * F.lit(high - low))).cast("long"), low, high, integer=True
    )


def qrandint(low: int, high: int, q: int) -> Distribution:
    """Multiples of q; the upper bound can be drawn."""
    return Distribution(
        lambda u, _: _rounded(F.lit(low) + F.floor(u * F.lit(high - low + 1)), q).cast("long"),
        low, high, quantum=q, integer=True,
    )


def lograndint(low: int, high: int) -> Distribution:
    base = loguniform(low, high)
    return Distribution(lambda u, v: F.floor(base.shape(u, v)).cast("long"), low, high, log=True, integer=True)


def qlograndint(low: int, high: int, q: int) -> Distribution:
    base = loguniform(low, high)
    return Distribution(
        lambda u, v: _rounded(F.floor(base.shape(u, v)), q).cast("long"),
        low, high, log=True, quantum=q, integer=True,
    )


def randn(mean: float = 0.0, sd: float = 1.0) -> Distribution:
    def normal(u: Column, v: Column) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u))
        return F.lit(float(mean)) + F.lit(float(sd)) * radius * F.cos(F.lit(2.0 * math.pi) * v)

    return Distribution(normal)


def qrandn(mean: float, sd: float, q: float) -> Distribution:
    base = randn(mean, sd)
    return Distribution(lambda u, v: _rounded(base.shape(u, v), q), quantum=q)


def sample_from(build: Callable[[Column], Column]) -> Distribution:
    """User column expression of a uniform draw."""
    return Distribution(lambda u, _: build(u))


function = sample_from

DISTRIBUTIONS: dict[str, Callable[..., Distribution]] = {
    "uniform": uniform,
    "quniform": quniform,
    "loguniform": loguniform,
    "qloguniform": qloguniform,
    "choice": choice,
    "randint": randint,
    "qrandint": qrandint,
    "lograndint": lograndint,
    "qlograndint": qlograndint,
    "randn": randn,
    "qrandn": qrandn,
    "sample_from": sample_from,
    "function": function,
}
