"""ALS model persistence."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel


def model_path(base: str, max_iter: int, reg: float, rmse: float) -> str:
    """The reference's naming with the score embedded: ``<base>/i_<iter>_l0_<lambda>_<rmse>``."""
    return f"{base.rstrip('/')}/i_{max_iter}_l0_{reg!r}_{rmse!r}"


def save_model(model: ALSModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
