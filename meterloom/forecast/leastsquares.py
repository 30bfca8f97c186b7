"""Least squares from summed cross products.

Tasks sum the products of their rows; only matrices of the size of the feature
list travel, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of (1, x) with (1, x, y), as a matrix."""
    left = np.column_stack([np.ones(len(x)), x])
    return left.T @ np.column_stack([left, y])


def solve(sums: np.ndarray, ridge: np.ndarray | float = 0.0) -> np.ndarray:
    """Coefficients (intercept first, one column per target) from summed products.

    Columns are centred and scaled first; a column without spread gets zero.
    ``ridge`` is a penalty per column on the original scale.
    """
    p = sums.shape[0]
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    centred = sums[1:, 1:] - n * np.outer(mean[: p - 1], mean)
    gram, cross = centred[:, : p - 1], centred[:, p - 1 :]
    spread = np.sqrt(np.clip(np.diag(gram), 0.0, None))
    used = spread > 1e-9 * np.sqrt(np.abs(np.diag(sums[1:, 1:p])) + 1e-300)
    scale = np.where(used, spread, 1.0)
    gram = gram / np.outer(scale, scale) + np.diag(np.broadcast_to(ridge, p - 1) / scale**2)
    gram[~used, :] = 0.0
    gram[:, ~used] = 0.0
    slope = np.linalg.lstsq(gram, cross / scale[:, None] * used[:, None], rcond=1e-12)[0]
    slope = slope / scale[:, None]
    intercept = mean[p - 1 :] - mean[: p - 1] @ slope
    return np.vstack([intercept, slope])


def solve_sparse(sums: np.ndarray, ridge: np.ndarray, lasso: np.ndarray, sweeps: int = 20_000) -> np.ndarray:
    """Coefficients (intercept first) of half the squares, half a ridge and a penalty on absolute values.

    ``lasso`` and ``ridge`` are penalties per column; columns with a lasso should have no ridge.
    The other columns are solved for in closed form; what is left goes round column by column
    until the columns in use keep their signs, whose equations are then solved at once.  Ends
    when all conditions of the optimum hold to rounding; otherwise an error.
    """
    p = sums.shape[0]
    gram, cross = sums[:, :p] + np.diag([0.0, *ridge]), sums[:, p]
    sparse = np.flatnonzero([0.0, *lasso])
    free = np.setdiff1d(np.arange(p), sparse)
    inverse = np.linalg.pinv(gram[np.ix_(free, free)], rcond=1e-13, hermitian=True)
    onto = inverse @ gram[np.ix_(free, sparse)]
    own = gram[np.ix_(sparse, sparse)] - gram[np.ix_(sparse, free)] @ onto
    left = cross[sparse] - onto.T @ cross[free]
    held, size = np.asarray(lasso, float)[sparse - 1], np.diag(own).copy()
    used = size > 1e-12 * np.maximum(np.diag(gram)[sparse], 1e-300)
    near = 1e-9 * max(1.0, float(np.abs(cross).max()))
    w = np.zeros(len(sparse))
    pull = left.copy()  # left - own @ w
    for sweep in range(sweeps):
        for j in np.flatnonzero(used):
            at = pull[j] + size[j] * w[j]
            new = np.sign(at) * max(abs(at) - held[j], 0.0) / size[j]
            if new != w[j]:
                pull -= own[:, j] * (new - w[j])
                w[j] = new
        if sweep % 20 and sweep < sweeps - 1:
            continue
        on = np.flatnonzero(w)
        exact = np.zeros(len(w))
        if len(on):
            exact[on] = np.linalg.lstsq(own[np.ix_(on, on)], left[on] - held[on] * np.sign(w[on]), rcond=1e-13)[0]
        slope = left - own @ exact
        off = np.setdiff1d(np.flatnonzero(used), on)
        if (np.sign(exact) == np.sign(w)).all() and (np.abs(slope[off]) <= held[off] + near).all():
            out = np.zeros(p)
            out[sparse] = exact
            out[free] = inverse @ (cross[free] - gram[np.ix_(free, sparse)] @ exact)
            return out
    raise ValueError("the sparse fit did not end")


def summed_products(df: DataFrame, x: str, y: str, n_x: int, n_y: int) -> np.ndarray:
    """Cross products of two array columns over all rows.

    One partial matrix per task, added up by Spark; the result has
    ``(n_x + 1) * (n_x + 1 + n_y)`` numbers.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_x + 1, n_x + 1 + n_y))
        for batch in batches:
            if len(batch):
                total += products(np.vstack(batch["x"].to_numpy()), np.vstack(batch["y"].to_numpy()))
        flat = total.ravel()
        yield pd.DataFrame({"place": np.arange(flat.size), "value": flat})

    pieces = df.select(F.col(x).alias("x"), F.col(y).alias("y")).mapInPandas(
        partial, "place int, value double"
    )
    sums = pieces.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros((n_x + 1) * (n_x + 1 + n_y))
    flat[sums["place"]] = sums["value"]
    return flat.reshape(n_x + 1, n_x + 1 + n_y)


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Mean of each column, 0 for a column without values."""
    row = df.select(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: float(row[c]) if row[c] is not None else 0.0 for c in cols}
