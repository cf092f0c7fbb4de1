"""Dataset registry (S13): logical dataset name -> table location, upsert
keys and text fields, checked against the data before a job starts."""
from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    keys: tuple = ("id",)
    text_fields: tuple = ("name",)
    fallback_cols: tuple = field(default_factory=tuple)


class Registry:
    def __init__(self, datasets=()):
        self._d = {d.name: d for d in datasets}

    def register(self, ds: Dataset) -> None:
        self._d[ds.name] = ds

    def resolve(self, name: str) -> Dataset:
        """The dataset of ``name``; an unknown name raises KeyError."""
        if name not in self._d:
            raise KeyError(f"unknown dataset '{name}'; known: {sorted(self._d)}")
        return self._d[name]

    def check(self, name: str, df: DataFrame) -> list[str]:
        """Key fields missing from ``df`` (a warning, as upserts would then match
        on fewer fields); returns them."""
        ds = self.resolve(name)
        missing = [k for k in ds.keys if k not in df.columns]
        if missing:
            warnings.warn(f"dataset '{name}': key fields missing from the data: {missing}")
        return missing
