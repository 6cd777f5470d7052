"""Data set settings and experiment identity."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

#: Fixed values: (split ratio, null value, per channel, rescale, metrics, steps a day) of the public data sets.
NAN = float("nan")
SETTINGS = {
    "ETTh1": ((0.6, 0.2, 0.2), NAN, True, False, ("MAE", "MSE"), 24), "ETTh2": ((0.6, 0.2, 0.2), NAN, True, False, ("MAE", "MSE"), 24),
    "ETTm1": ((0.6, 0.2, 0.2), NAN, True, False, ("MAE", "MSE"), 96), "ETTm2": ((0.6, 0.2, 0.2), NAN, True, False, ("MAE", "MSE"), 96),
    "Electricity": ((0.7, 0.1, 0.2), NAN, True, False, ("MAE", "MSE"), 24), "Traffic": ((0.7, 0.1, 0.2), NAN, True, False, ("MAE", "MSE"), 24),
    "Weather": ((0.7, 0.1, 0.2), NAN, True, False, ("MAE", "MSE"), 144), "ExchangeRate": ((0.7, 0.1, 0.2), NAN, True, False, ("MAE", "MSE"), 1),
    "Illness": ((0.7, 0.1, 0.2), NAN, True, False, ("MAE", "MSE"), 1 / 7), "BeijingAirQuality": ((0.6, 0.2, 0.2), NAN, True, False, ("MAE", "MSE"), 24),
    "METR-LA": ((0.7, 0.1, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288), "PEMS-BAY": ((0.7, 0.1, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288),
    "PEMS03": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288), "PEMS04": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288),
    "PEMS07": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288), "PEMS08": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288),
    "JiNan": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 288), "CA": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 96),
    "GBA": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 96), "GLA": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 96),
    "SD": ((0.6, 0.2, 0.2), 0.0, False, True, ("MAE", "RMSE", "MAPE"), 96), "GlobalTemp": ((0.7, 0.1, 0.2), NAN, False, True, ("MAE", "MSE"), 24),
    "GlobalWind": ((0.7, 0.1, 0.2), NAN, False, True, ("MAE", "MSE"), 24), "Pulse": ((0.7, 0.1, 0.2), NAN, False, True, ("MAE", "RMSE", "MAPE"), None), "Gaussian": ((0.7, 0.1, 0.2), NAN, False, True, (), None),
}

#: Keys that do not change what an experiment computes.
INDEPENDENT = ("gpus", "num_workers", "save_dir", "log_every")


@dataclass(frozen=True)
class Experiment:
    """A forecasting experiment; its identity ignores keys that do not change its result."""

    dataset: str
    model: str
    input_len: int = 336
    output_len: int = 336
    batch_size: int = 64
    metrics: tuple[str, ...] = ("MAE", "MSE", "RMSE", "MAPE", "WAPE")
    options: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Experiment:
        x = json.loads(text)
        return Experiment(**{**x, "metrics": tuple(x["metrics"])})

    def identity(self) -> str:
        x = asdict(self)
        x["options"] = {k: v for k, v in x["options"].items() if k not in INDEPENDENT}
        return hashlib.md5(json.dumps(x, sort_keys=True).encode()).hexdigest()
