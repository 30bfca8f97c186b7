"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 1e-6  # stands in for a zero actual in percentage errors

# Coefficients of algorithm AS 241 (Wichura 1988), lowest power first.
_CENTRE_TOP = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
    1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
    3.3430575583588128105e4, 2.5090809287301226727e3,
)
_CENTRE_BOTTOM = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
    5.2264952788528545610e3,
)
_NEAR_TOP = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
    3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
    2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
_NEAR_BOTTOM = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
    1.05075007164441684324e-9,
)
_FAR_TOP = (
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
    2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
    2.71155556874348757815e-5, 2.01033439929228813265e-7,
)
_FAR_BOTTOM = (
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
    2.04426310338993978564e-15,
)


def try_long(c: str) -> Column:
    """Whole number or null: ``1.0`` is 1; a fraction such as 12.7 and text that is no number are null."""
    return F.expr(
        f"case when try_cast(`{c}` as double) % 1 = 0 then "
        f"coalesce(try_cast(`{c}` as bigint), try_cast(try_cast(`{c}` as double) as bigint)) end"
    )


def try_double(c: str) -> Column:
    """Double or null; text that is no number never raises."""
    return F.expr(f"try_cast(`{c}` as double)")


def non_zero(y: Column) -> Column:
    """Actual value with an exact zero replaced by a small number; null stays null."""
    return F.when(y == 0, F.lit(SMALL)).otherwise(y)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    result = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        result = result * x + F.lit(c)
    return result


def with_inverse_normal(df: DataFrame, p: Column, name: str) -> DataFrame:
    """Add the standard normal quantile of ``p`` (0 < p < 1), to double precision.

    The steps are columns of their own, so that each is computed once per row.
    """
    steps = df.withColumn("_p", p)
    q = F.col("_p") - 0.5
    steps = steps.withColumns(
        {
            "_q": q,
            "_c": F.lit(0.180625) - q * q,
            "_r": F.sqrt(-F.log(F.least(F.col("_p"), 1 - F.col("_p")))),
        }
    )
    c, near, far = F.col("_c"), F.col("_r") - 1.6, F.col("_r") - 5.0
    central = F.col("_q") * _polynomial(c, _CENTRE_TOP) / _polynomial(c, _CENTRE_BOTTOM)
    tail = F.when(
        F.col("_r") <= 5, _polynomial(near, _NEAR_TOP) / _polynomial(near, _NEAR_BOTTOM)
    ).otherwise(_polynomial(far, _FAR_TOP) / _polynomial(far, _FAR_BOTTOM))
    value = F.when(F.abs("_q") <= 0.425, central).otherwise(F.signum("_q") * tail)
    return steps.withColumn(name, value).drop("_p", "_q", "_c", "_r")
