"""Fitted models on the shared file system."""

from __future__ import annotations

from vacancia.operators.models import Scorer


def save_model(model: Scorer, path: str) -> None:
    model.save(path)


def load_model(path: str) -> Scorer:
    return Scorer.load(path)
