"""Normal distribution as column expressions: quantile and upper tail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wichura's rational approximations of the normal quantile
# (algorithm AS 241, about 16 digits): numerator and denominator, lowest power
# first, for the middle, the tail and the far tail.
MIDDLE = ([3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
           45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
          [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
           21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610])
TAIL = ([1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640],
        [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
         0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9])
FAR = ([6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
        0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
       [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
        0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])
# Hart's rational approximation of the normal tail, highest power first.
TAIL_OVER = [0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376]
TAIL_UNDER = [0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]


def polynomial(coefficients: Sequence[float], x: Column) -> Column:
    """Value at ``x``, coefficients from the lowest power up. A fold over the
    coefficients: written out, nested ones outgrow the generated code."""
    terms = F.array(*[F.lit(float(c)) for c in reversed(coefficients)])
    return F.aggregate(terms, F.lit(0.0), lambda total, c: total * x + c)


def _ratio(parts: tuple[list[float], list[float]], x: Column) -> Column:
    return polynomial(parts[0], x) / polynomial(parts[1], x)


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p, for 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(r <= 5, _ratio(TAIL, r - 1.6)).otherwise(_ratio(FAR, r - 5))
    return F.when(F.abs(q) <= 0.425, q * _ratio(MIDDLE, 0.180625 - q * q)).otherwise(F.signum(q) * outer)


def normal_upper_tail(z: Column) -> Column:
    """P(Z > z)."""
    x = F.abs(z)
    near = polynomial(TAIL_OVER[::-1], x) / polynomial(TAIL_UNDER[::-1], x)
    far = 1 / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    tail = F.exp(-x * x / 2) * F.when(x < 7.07106781186547, near).otherwise(far)
    return F.when(z >= 0, tail).otherwise(1 - tail)
