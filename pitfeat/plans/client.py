"""A client facade with the call shapes reference users already write.

It resolves table names (registered here, or catalog tables), keeps named
feature specs, packages a fitted model with the lookups it was trained on and
scores new frames with it. Every method returns lazy DataFrames built by the
operators of this package; nothing here holds data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.rolling import aggregate_features
from ..specs import AggregateSpec, Feature, FeatureSpec, TableSpec
from . import ml
from .training import FeatureTable, apply_spec, training_set


@dataclass
class TrainingSet:
    """A compiled training set: the frame plus what produced it."""

    df: DataFrame
    features: tuple[Feature, ...]
    label: str | None
    exclude: tuple[str, ...]

    def load_df(self) -> DataFrame:
        return self.df


@dataclass
class PackagedModel:
    """A fitted pipeline with its input columns and the lookups that feed them."""

    model: PipelineModel
    inputs: list[str]
    spec: FeatureSpec
    label: str | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted pipeline and, as JSON, its inputs, lookups and label below ``path``."""
        self.model.write().overwrite().save(f"{path}/model")
        package = json.dumps({"inputs": self.inputs, "spec": self.spec.to_json(), "label": self.label})
        spark.createDataFrame([(package,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/package")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PackagedModel":
        package = json.loads(spark.read.text(f"{path}/package", wholetext=True).where("value <> ''").first()[0])
        return cls(PipelineModel.load(f"{path}/model"), package["inputs"], FeatureSpec.from_json(package["spec"]), package["label"])


@dataclass
class FeatureClient:
    spark: SparkSession
    tables: dict[str, FeatureTable] = field(default_factory=dict)
    specs: dict[str, FeatureSpec] = field(default_factory=dict)

    # -- tables --------------------------------------------------------------
    def register_table(self, name: str, df: DataFrame | str, spec: TableSpec,
                       valid_to: str | None = None) -> FeatureTable:
        """Declare a feature table: its keys (and time key) and, for SCD-2, its
        end column. ``df`` is a DataFrame or the name of a catalog table."""
        if isinstance(df, str):
            df = self.spark.table(df)
        spec.validate(df.columns)
        self.tables[name] = FeatureTable(df, spec, valid_to)
        return self.tables[name]

    def read_table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name].df
        return self.spark.table(name)

    def _resolved(self, features: Sequence[Feature]) -> Mapping[str, FeatureTable]:
        missing = {f.table for f in features if hasattr(f, "table") and f.table not in self.tables}
        if missing:
            raise KeyError(f"tables not registered (register_table): {sorted(missing)}")
        return self.tables

    # -- aggregates ----------------------------------------------------------
    def aggregate_features(self, features: AggregateSpec, source: str | DataFrame | None = None,
                           spine: DataFrame | None = None, on: dict | None = None,
                           max_cells: int | None = None, prune_facts: bool = False) -> DataFrame:
        """Windowed aggregates of ``source`` (default: the spec's ``source``
        table): on the daily grid between the spec's start and end (the
        reference's default), or at the rows of ``spine`` when one is given
        (cheaper: no grid; ``prune_facts`` for a narrow spine such as one day
        of requests)."""
        source = source if source is not None else features.source
        if source is None:
            raise ValueError("no source table: pass source= or set AggregateSpec(source=...)")
        facts = self.read_table(source) if isinstance(source, str) else source
        if spine is None:
            return aggregate_features(facts, features, mode="grid", max_cells=max_cells)
        return aggregate_features(facts, features, spine=spine, on=on, prune_facts=prune_facts)

    # -- training sets -------------------------------------------------------
    def create_training_set(self, df: DataFrame, feature_lookups: Sequence[Feature], label: str | None,
                            exclude_columns: Sequence[str] = (), **kw) -> TrainingSet:
        out = training_set(df, feature_lookups, self._resolved(feature_lookups), label=label,
                           exclude=exclude_columns, **kw)
        return TrainingSet(out, tuple(feature_lookups), label, tuple(exclude_columns))

    def create_feature_spec(self, name: str, features: Sequence[Feature]) -> FeatureSpec:
        self._resolved(features)
        self.specs[name] = FeatureSpec(name, features)
        return self.specs[name]

    def apply_spec(self, name: str | FeatureSpec, df: DataFrame) -> DataFrame:
        spec = self.specs[name] if isinstance(name, str) else name
        return apply_spec(spec, df, self._resolved(spec.features))

    # -- models --------------------------------------------------------------
    def fit_model(self, ts: TrainingSet, max_depth: int = 5) -> PackagedModel:
        """Depth-5 gini tree on the whole training set, packaged with its lookups."""
        model, inputs = ml.fit_tree(ts.df, ts.label, max_depth=max_depth)
        return PackagedModel(model, inputs, FeatureSpec("training_set", ts.features), ts.label)

    def score_batch(self, model: PackagedModel, df: DataFrame) -> DataFrame:
        """Look up the model's features for ``df`` (keeping supplied ones), then predict."""
        return ml.score_batch(df, model.spec, self._resolved(model.spec.features), model.model, model.inputs)
