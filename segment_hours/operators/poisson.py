"""Poisson regressions of many labels at once, by reweighted least squares."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# Condition number beyond which the predictors do not decide the coefficients.
WORST_CONDITION = 1e12
# Expected counts are held within e to this power.
_WIDEST = 300.0

FITTED, SINGULAR, DIVERGED, EMPTY = "fitted", "singular", "diverged", "no events"


@dataclass(frozen=True)
class PoissonFit:
    """``status`` is "fitted", or why there are no coefficients."""

    label: str
    status: str
    intercept: float | None = None
    coefficients: tuple[float, ...] | None = None
    rounds: int = 0

    def predict(self, features):
        """Expected count of one row of predictors."""
        return math.exp(self.intercept + sum(b * x for b, x in zip(self.coefficients, features, strict=True)))


def _moments(labels, columns, betas):
    """(label, place, value) of a task: XᵀWX, XᵀWz and the deviance of every label, as one row of numbers."""

    def run(batches):
        d = len(columns) + 1
        square = {label: np.zeros((d, d)) for label in betas}
        right = {label: np.zeros(d) for label in betas}
        deviance = dict.fromkeys(betas, 0.0)
        for batch in batches:
            n = batch.num_rows
            x = np.ones((n, d))
            for i, c in enumerate(columns, 1):
                x[:, i] = batch.column(c).to_numpy(zero_copy_only=False)
            for label, beta in betas.items():
                y = batch.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
                known = np.isfinite(y)
                own, y = (x, y) if known.all() else (x[known], y[known])
                eta = np.log(np.maximum(y, 0.1)) if beta is None else np.clip(own @ beta, -_WIDEST, _WIDEST)
                mu = np.exp(eta)
                weighted = own * mu[:, None]
                square[label] += own.T @ weighted
                right[label] += weighted.T @ (eta + (y - mu) / mu)
                deviance[label] += 2 * (np.where(y > 0, y * (np.log(np.maximum(y, 1e-300)) - eta), 0.0) - (y - mu)).sum()
        rows = [np.concatenate((square[label].ravel(), right[label], [deviance[label]])) for label in betas]
        names = np.repeat(list(betas), d * d + d + 1)
        places = np.tile(np.arange(d * d + d + 1), len(betas))
        values = np.concatenate(rows) if rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array(names.tolist(), pa.string()), pa.array(places, pa.int32()), pa.array(values)], ["label", "place", "value"])

    return run


def _solve(square, right):
    """Coefficients, or None where several would do. Columns are brought to one scale first."""
    scale = np.sqrt(np.maximum(np.diag(square), 1e-300))
    even = square / np.outer(scale, scale)
    if not np.isfinite(even).all() or np.linalg.cond(even) > WORST_CONDITION:
        return None
    return np.linalg.solve(even, right / scale) / scale


def fit_poisson(matrix, labels, columns, max_iter=25, tolerance=1e-8):
    """One :class:`PoissonFit` a label: log-linear counts of the predictor ``columns``.

    Every round is one aggregate over the rows for all labels that have not converged, so the number of jobs does not
    depend on the number of labels. Only sums of the size of a model come back: (predictors + 1) squared for each label.
    Labels without events, with predictors that do not decide the coefficients, or that run off, are returned
    with that status. Rows whose label is null do not count for it; predictors must be finite.
    """
    d = len(columns) + 1
    betas = dict.fromkeys(labels)
    last, fits = {}, {}
    if labels:
        events = matrix.agg(*[F.sum(c).alias(c) for c in labels]).first()
        for label in labels:
            if not events[label]:
                fits[label] = PoissonFit(label, EMPTY)
    for number in range(max_iter + 1):
        waiting = {label: betas[label] for label in labels if label not in fits}
        if not waiting:
            break
        sums = matrix.mapInArrow(_moments(labels, columns, waiting), "label string, place int, value double")
        rows = sums.groupBy("label", "place").agg(F.sum("value").alias("value")).collect()
        found = {label: np.zeros(d * d + d + 1) for label in waiting}
        for r in rows:
            found[r["label"]][r["place"]] = r["value"]
        for label, values in found.items():
            deviance = values[-1]
            settled = label in last and abs(deviance - last[label]) <= tolerance * (abs(deviance) + 0.1)
            if betas[label] is not None and (settled or number == max_iter):
                fits[label] = PoissonFit(label, FITTED, float(betas[label][0]), tuple(map(float, betas[label][1:])), number)
                continue
            if betas[label] is not None:
                last[label] = deviance
            beta = _solve(values[: d * d].reshape(d, d), values[d * d : -1])
            if beta is None:
                fits[label] = PoissonFit(label, SINGULAR if number < 2 or np.isfinite(values).all() else DIVERGED, rounds=number)
            elif not np.isfinite(beta).all() or np.abs(beta).max() > 1e6:
                fits[label] = PoissonFit(label, DIVERGED, rounds=number)
            else:
                betas[label] = beta
    return [fits[label] for label in labels]


def fit_table(spark, fits, names):
    """Fits as rows: label, term, coefficient, status. A label without coefficients is one row with no term."""
    rows = []
    for fit in sorted(fits, key=lambda f: f.label):
        if fit.status != FITTED:
            rows.append((fit.label, None, None, fit.status))
            continue
        terms = [("const", fit.intercept), *zip(names, fit.coefficients, strict=True)]
        rows += [(fit.label, term, float(beta), FITTED) for term, beta in terms]
    return spark.createDataFrame(rows, "label string, term string, coefficient double, status string")
