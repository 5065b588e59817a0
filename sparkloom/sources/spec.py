"""Column and table specifications with a tolerant JSON round trip."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

KINDS = ("identifier", "numerical_continuous", "numerical_discrete", "categorical_nominal", "categorical_ordinal")
SCALINGS = ("standard", "minmax", "none")
ENCODINGS = ("label", "onehot", "ordinal")
NUMERICAL = ("numerical_continuous", "numerical_discrete")
CATEGORICAL = ("categorical_nominal", "categorical_ordinal")


@dataclass
class ColumnSpec:
    name: str
    kind: str
    scaling: str | None = None
    encoding: str | None = None
    ordinal: list[str] | None = None
    is_quasi_identifier: bool = False

    @staticmethod
    def read(raw: dict) -> "ColumnSpec":
        """Unknown names fall back: kind to nominal, scaling to standard, encoding to label."""
        def known(value, names, default):
            return value if value is None or value in names else default
        kind = raw.get("kind")
        return ColumnSpec(
            name=raw["name"], kind=kind if kind in KINDS else "categorical_nominal",
            scaling=known(raw.get("scaling"), SCALINGS, "standard"),
            encoding=known(raw.get("encoding"), ENCODINGS, "label"),
            ordinal=raw.get("ordinal"), is_quasi_identifier=bool(raw.get("is_quasi_identifier", False)))


@dataclass
class TableSpec:
    columns: dict[str, ColumnSpec] = field(default_factory=dict)
    seed: int = 42
    reuse: bool = True

    def kinds(self) -> dict[str, str]:
        return {n: c.kind for n, c in self.columns.items()}

    def quasi_identifiers(self) -> list[str]:
        return [n for n, c in self.columns.items() if c.is_quasi_identifier]

    def to_dict(self) -> dict:
        return {"columns": {n: asdict(c) for n, c in self.columns.items()}, "seed": self.seed, "reuse": self.reuse}

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), ensure_ascii=False, sort_keys=True)

    @staticmethod
    def from_dict(raw: dict) -> "TableSpec":
        columns = {n: ColumnSpec.read({"name": n, **c}) for n, c in raw.get("columns", {}).items()}
        return TableSpec(columns, int(raw.get("seed", 42)), bool(raw.get("reuse", True)))

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON document on the file system Spark uses."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TableSpec":
        return TableSpec.from_dict(json.loads(spark.read.text(path, wholetext=True).first()["value"]))

    def table(self, spark: SparkSession) -> DataFrame:
        """The specification as rows, one per column."""
        rows = [(c.name, c.kind, c.scaling, c.encoding, c.ordinal, c.is_quasi_identifier) for c in self.columns.values()]
        return spark.createDataFrame(
            rows, "name string, kind string, scaling string, encoding string, ordinal array<string>, "
                  "is_quasi_identifier boolean")
