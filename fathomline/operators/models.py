"""Forecasters. Historical inertia is exact; linear families are fitted by normal equations, whose sums are one aggregate
of bounded size (input length squared) whatever the number of samples; the solve is a small system on the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.grid import KEY, in_order


def historical_inertia(samples: DataFrame, targets: int, reverse: bool = False) -> DataFrame:
    """prediction: the last ``targets`` inputs, perhaps in reverse. Inputs must be at least as long."""
    n = F.size("inputs")
    tail = F.slice(F.col("inputs"), n - targets + 1, F.lit(targets))
    return samples.withColumn("prediction", F.reverse(tail) if reverse else tail)


def scored_rows(samples: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(series_id, sample_id, h, y_true, y_pred) and the columns named by ``carry``."""
    return samples.select(KEY, "sample_id", *carry, F.posexplode(F.arrays_zip("targets", "prediction")).alias("h", "x")).select(KEY, "sample_id", *carry, "h", F.col("x.targets").alias("y_true"), F.col("x.prediction").alias("y_pred"))


def _moments(batches, length: int, horizon: int, prepare):
    gram, cross = np.zeros((length + 1, length + 1)), np.zeros((length + 1, horizon))
    for pdf in batches:
        if len(pdf):
            x, y = prepare(np.stack(pdf["inputs"]).astype(float), np.stack(pdf["targets"]).astype(float))
            x = np.column_stack([x, np.ones(len(x))])
            gram, cross = gram + x.T @ x, cross + x.T @ y
    yield pd.DataFrame({"cell": np.arange(gram.size + cross.size), "v": np.concatenate([gram.ravel(), cross.ravel()])})


def _nothing(x, y):
    return x, y


def _less_last(x, y):
    return x - x[:, -1:], y - x[:, -1:]


def fit_linear(samples: DataFrame, length: int, horizon: int, subtract_last: bool = False, ridge: float = 1e-6) -> np.ndarray:
    """Weights (length + 1, horizon), the last row the bias. The partial sums of each task are added by Spark."""
    prepare = _less_last if subtract_last else _nothing
    sums = samples.select("inputs", "targets").mapInPandas(lambda b: _moments(b, length, horizon, prepare), "cell long, v double")
    flat = np.array([r["v"] for r in sums.groupBy("cell").agg(F.sum("v").alias("v")).orderBy("cell").collect()])
    if not len(flat):
        return np.zeros((length + 1, horizon))
    k = (length + 1) ** 2
    gram, cross = flat[:k].reshape(length + 1, -1), flat[k:].reshape(length + 1, -1)
    return np.linalg.solve(gram + ridge * np.trace(gram) / (length + 1) * np.eye(length + 1), cross)


def _dot(inputs: Column, weights: np.ndarray, shift: Column | None = None) -> Column:
    """inputs times weights as array expressions in generated code; the weights are literals of bounded size."""
    rows = F.array(*(F.array(*(F.lit(float(x)) for x in weights[:-1, h])) for h in range(weights.shape[1])))
    bias = F.array(*(F.lit(float(b)) for b in weights[-1]))
    x = inputs if shift is None else F.transform(inputs, lambda v: v - shift)
    out = F.zip_with(rows, bias, lambda w, b: F.aggregate(F.zip_with(x, w, lambda p, q: p * q), b, lambda s, v: s + v))
    return out if shift is None else F.transform(out, lambda v: v + shift)


def linear(samples: DataFrame, weights: np.ndarray) -> DataFrame:
    """One linear map of the inputs, the shortcut of light sampling networks."""
    return samples.withColumn("prediction", _dot(F.col("inputs"), weights))


def nlinear(samples: DataFrame, weights: np.ndarray) -> DataFrame:
    """Subtract the last input, map, add it back."""
    return samples.withColumn("prediction", _dot(F.col("inputs"), weights, F.element_at("inputs", -1)))


def _parts(samples: DataFrame, k: int) -> DataFrame:
    """_trend and _season of each window: a moving average with repeated ends, and the rest."""
    n, left, right = F.size("inputs"), (k - 1) // 2, k // 2
    padded = F.concat(F.array_repeat(F.element_at("inputs", 1), left), F.col("inputs"), F.array_repeat(F.element_at("inputs", -1), right))
    low = F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(F.slice(padded, i, F.lit(k)), F.lit(0.0), lambda s, v: s + v) / k)
    return samples.withColumn("_trend", low).withColumn("_season", F.zip_with("inputs", "_trend", lambda a, b: a - b))


def fit_parts(samples: DataFrame, length: int, horizon: int, k: int = 25, ridge: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """The two maps of ``dlinear``, fitted together by least squares; each has half of the bias."""
    both = _parts(samples, k).select(F.concat("_trend", "_season").alias("inputs"), "targets")
    w = fit_linear(both, 2 * length, horizon, ridge=ridge)
    return np.vstack([w[:length], w[-1:] / 2]), np.vstack([w[length : 2 * length], w[-1:] / 2])


def dlinear(samples: DataFrame, trend: np.ndarray, season: np.ndarray, k: int = 25) -> DataFrame:
    """Moving-average decomposition of the window, one linear map for each part."""
    out = _parts(samples, k)
    return out.withColumn("prediction", F.zip_with(_dot(F.col("_trend"), trend), _dot(F.col("_season"), season), lambda a, b: a + b)).drop("_trend", "_season")


def sparse_linear(samples: DataFrame, weights: np.ndarray, period: int, horizon: int) -> DataFrame:
    """Cross-period map shared by all phases of a period, after removing the window's mean."""
    mean = F.aggregate("inputs", F.lit(0.0), lambda s, v: s + v) / F.size("inputs")
    m, out_rows = weights.shape[0] - 1, weights.shape[1]
    cell = lambda h: sum((F.element_at("inputs", i * period + h % period + 1) * float(weights[i, h // period]) for i in range(m)), F.lit(float(weights[-1, h // period])))
    total = float(1)
    shift = lambda h: mean * (total - float(weights[:-1, h // period].sum()))
    return samples.withColumn("prediction", F.array(*(cell(h) + shift(h) for h in range(min(horizon, out_rows * period)))))


def seed_decoder(samples: DataFrame, label_len: int, horizon: int, k: int = 25) -> DataFrame:
    """Decomposed decoder input: the trend's tail then the window mean, the season's tail then zeros."""
    n, left, right = F.size("inputs"), (k - 1) // 2, k // 2
    mean = F.aggregate("inputs", F.lit(0.0), lambda s, v: s + v) / n
    padded = F.concat(F.array_repeat(F.element_at("inputs", 1), left), F.col("inputs"), F.array_repeat(F.element_at("inputs", -1), right))
    low = F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(F.slice(padded, i, F.lit(k)), F.lit(0.0), lambda s, v: s + v) / k)
    out = samples.withColumn("_trend", low)
    tail = lambda c: F.slice(c, n - label_len + 1, F.lit(label_len))
    season = F.zip_with("inputs", "_trend", lambda a, b: a - b)
    return out.withColumns({"trend_seed": F.concat(tail(F.col("_trend")), F.array_repeat(mean, horizon)), "season_seed": F.concat(tail(season), F.array_repeat(F.lit(0.0), horizon))}).drop("_trend")


def _outer(batches, width: int):
    """Sums of products of each window's steps, by series: of width + 1 steps, so bounded whatever the series' length."""
    sums: dict[str, np.ndarray] = {}
    for pdf in batches:
        for key, part in pdf.groupby(KEY):
            x = np.stack(part["inputs"]).astype(float)
            sums[key] = sums.get(key, 0.0) + x.T @ x
    for key, m in sums.items():
        yield pd.DataFrame({KEY: key, "cell": np.arange(m.size), "v": m.ravel()})


def _rolled(pdf: pd.DataFrame, width: int, horizon: int) -> pd.DataFrame:
    m = pdf.sort_values("cell")["v"].to_numpy(float).reshape(width + 1, width + 1)
    operator = np.eye(width, k=1)  # a delay vector moves on by one step; its last entry is the fitted one
    operator[-1] = np.linalg.lstsq(m[:-1, :-1], m[:-1, -1], rcond=1e-12)[0]
    state, out = np.array(pdf["state"].iloc[0], float), []
    for _ in range(horizon):
        state = operator @ state
        out.append(state[-1])
    return pd.DataFrame({KEY: pdf[KEY].iloc[0], "h": np.arange(horizon), "value": out})


def dynamic_modes(df: DataFrame, width: int, horizon: int) -> DataFrame:
    """(series_id, h, value): the one-step operator of each series' delay vectors of ``width`` steps, by least squares over
    the whole series, applied again and again to its last delay vector. All but the operator's last row is a shift."""
    both = F.collect_list("value").over(in_order().rowsBetween(0, width))
    samples = df.select(KEY, both.alias("inputs")).where(F.size("inputs") == width + 1)
    sums = samples.mapInPandas(lambda b: _outer(b, width), f"{KEY} string, cell long, v double").groupBy(KEY, "cell").agg(F.sum("v").alias("v"))
    last = df.groupBy(KEY).agg(F.max("t").alias("_end"))
    state = df.join(last, KEY).where(F.col("t") > F.col("_end") - width).groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("t", "value"))).alias("xs"))
    state = state.select(KEY, F.transform("xs", lambda x: x["value"]).alias("state"))
    return sums.join(state, KEY).groupBy(KEY).applyInPandas(lambda pdf: _rolled(pdf, width, horizon), f"{KEY} string, h long, value double")


def legendre_system(order: int, step: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """A and B of the translated Legendre measure, made discrete by the bilinear rule."""
    i, j = np.arange(order)[:, None], np.arange(order)[None, :]
    a = np.where(i < j, -1.0, (-1.0) ** (i - j + 1)) * (2 * i + 1)
    b = (-1.0) ** np.arange(order) * (2 * np.arange(order) + 1)
    left = np.linalg.inv(np.eye(order) - step / 2 * a)
    return left @ (np.eye(order) + step / 2 * a), left @ b * step


def legendre_state(df: DataFrame, order: int, block: int = 64) -> DataFrame:
    """(series_id, k, value): c after c = A c + B x over each whole series, from zero.

    The recurrence is linear: a block of steps adds a weighted sum of its values, weights being powers of A times B, and
    blocks follow each other by A to the power of a block. Blocks are one aggregate; only their sums are put in order.
    """
    a, b = legendre_system(order)
    powers = [b]
    for _ in range(block - 1):
        powers.append(a @ powers[-1])
    jump = np.linalg.matrix_power(a, block)
    weights = F.array(*(F.array(*(F.lit(float(x)) for x in row)) for row in powers))
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    back = df.select(KEY, "value", (n - 1 - F.col("t")).alias("_back"))  # steps from the end, so that full blocks come last
    w = F.element_at(weights, (F.pmod("_back", F.lit(block)) + 1).cast("int"))
    sums = back.groupBy(KEY, F.floor(F.col("_back") / block).alias("_block")).agg(F.array(*(F.sum(F.col("value") * w[k]) for k in range(order))).alias("s"))
    ordered = sums.groupBy(KEY).agg(F.reverse(F.array_sort(F.collect_list(F.struct("_block", "s")))).alias("xs"))

    def step(c, x):
        return F.array(*(sum((c[j] * float(jump[i, j]) for j in range(order)), F.lit(0.0)) + x["s"][i] for i in range(order)))

    return ordered.select(KEY, F.posexplode(F.aggregate("xs", F.array(*(F.lit(0.0) for _ in range(order))), step)).alias("k", "value"))


def fit_cross_period(samples: DataFrame, period: int, inputs: int, horizon: int) -> np.ndarray:
    """Weights of ``sparse_linear``: one map from the steps of a phase to its coming ones, shared by all phases, by least
    squares over the phases of all samples, each window less its mean."""
    mean = F.aggregate("inputs", F.lit(0.0), lambda s, v: s + v) / F.size("inputs")
    phase = lambda c, n: F.transform(F.sequence(F.lit(0), F.lit(n // period - 1)), lambda i: F.element_at(c, i * period + F.col("_p") + 1) - F.col("_m"))
    phases = samples.select("inputs", "targets", mean.alias("_m"), F.explode(F.sequence(F.lit(0), F.lit(period - 1))).alias("_p"))
    return fit_linear(phases.select(phase("inputs", inputs).alias("inputs"), phase("targets", horizon).alias("targets")), inputs // period, horizon // period)


def _spectra(pdf: pd.DataFrame, cut: int):
    """Instance-normed inputs, their low bins, and the mean and deviation that undo the norm."""
    x = np.stack(pdf["inputs"]).astype(float)
    mean, std = x.mean(1, keepdims=True), np.sqrt(x.var(1, keepdims=True) + 1e-5)
    return np.fft.rfft((x - mean) / std)[:, :cut], mean, std


def _bin_moments(batches, cut: int, out: int, ratio: float):
    gram, cross = np.zeros((cut + 1, cut + 1), complex), np.zeros((cut + 1, out), complex)
    for pdf in batches:
        if len(pdf):
            low, mean, std = _spectra(pdf, cut)
            whole = (np.column_stack([np.stack(pdf["inputs"]), np.stack(pdf["targets"])]).astype(float) - mean) / std
            low = np.column_stack([low, np.ones(len(low))])
            gram, cross = gram + low.conj().T @ low, cross + low.conj().T @ (np.fft.rfft(whole)[:, :out] / ratio)
    flat = np.concatenate([gram.ravel(), cross.ravel()])
    yield pd.DataFrame({"cell": np.arange(len(flat)), "re": flat.real, "im": flat.imag})


def fit_frequencies(samples: DataFrame, length: int, horizon: int, cut: int, ridge: float = 1e-6) -> np.ndarray:
    """A complex map from the ``cut`` low bins of the inputs to the bins of inputs and targets together, the last row the
    bias: least squares whose sums are one aggregate of bounded size."""
    ratio = (length + horizon) / length
    out = int(cut * ratio)
    sums = samples.select("inputs", "targets").mapInPandas(lambda b: _bin_moments(b, cut, out, ratio), "cell long, re double, im double")
    rows = sums.groupBy("cell").agg(F.sum("re").alias("re"), F.sum("im").alias("im")).orderBy("cell").collect()
    flat = np.array([complex(r["re"], r["im"]) for r in rows])
    if not len(flat):
        return np.zeros((cut + 1, out), complex)
    gram, cross = flat[: (cut + 1) ** 2].reshape(cut + 1, -1), flat[(cut + 1) ** 2 :].reshape(cut + 1, -1)
    return np.linalg.solve(gram + ridge * np.trace(gram).real / (cut + 1) * np.eye(cut + 1), cross)


def frequency_forecast(samples: DataFrame, weights: np.ndarray, horizon: int) -> DataFrame:
    """prediction: low bins through the map, padded with zeros, back to steps, norm undone; the last ``horizon`` of them."""
    cut = weights.shape[0] - 1

    def predict(batches):
        for pdf in batches:
            if len(pdf):
                length = len(pdf["inputs"].iloc[0])
                low, mean, std = _spectra(pdf, cut)
                spectrum = np.zeros((len(pdf), (length + horizon) // 2 + 1), complex)
                spectrum[:, : weights.shape[1]] = np.column_stack([low, np.ones(len(low))]) @ weights
                whole = np.fft.irfft(spectrum, length + horizon) * ((length + horizon) / length)
                pdf = pdf.assign(prediction=list((whole * std + mean)[:, -horizon:]))
            else:
                pdf = pdf.assign(prediction=[])
            yield pdf

    schema = ", ".join(f"{c} {k}" for c, k in samples.dtypes)
    return samples.mapInPandas(predict, f"{schema}, prediction array<double>")


def boosted_importance(df: DataFrame, features: list[str], target: str, k: int, trees: int = 10, depth: int = 4, seed: int = 7) -> list[tuple[str, float]]:
    """Importances of gradient-boosted trees, largest first. Another learner than the deterministic ranking; not for parity."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip").transform(df.where(F.col(target).isNotNull()))
    model = GBTRegressor(featuresCol="_x", labelCol=target, maxIter=trees, maxDepth=depth, seed=seed).fit(rows)
    return sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:k]
