"""The five ways to prepare features and train that are to be compared.

=================  =========================  ==============  =======================
variant            numeric stage              assembler       missing for the trainer
=================  =========================  ==============  =======================
drop_missing       raw values                 skip            rows are gone
scaled_drop        standard score             skip            rows are gone
scaled_keep        standard score             keep            NaN
imputed            standard score, 0 if gone  keep            0
sparse             standard score             sparse          absent entries
=================  =========================  ==============  =======================
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame

from gapwise.operators.assemble import SparseVectorAssembler, assembler
from gapwise.operators.boost import BoostedTreeClassifier
from gapwise.operators.category import CategoryIndexer, label_indexer, label_text
from gapwise.operators.scale import StandardScore
from gapwise.sources import CENSUS_CATEGORICAL, CENSUS_LABEL, CENSUS_NUMERIC

VARIANTS = ("drop_missing", "scaled_drop", "scaled_keep", "imputed", "sparse")

# The training settings all variants share.
TRAINING_OPTIONS = {
    "eta": 0.3,
    "max_depth": 3,
    "objective": "multi:softprob",
    "num_class": 2,
    "num_round": 100,
    "num_workers": 3,
    "seed": 123,
}
TRIM_FACTOR = 500.0


@dataclass(frozen=True)
class Roles:
    """Which columns are categories, numbers and the label."""

    categorical: list[str]
    numeric: list[str]
    label: str
    label_out: str = field(default="label")


CENSUS_ROLES = Roles(CENSUS_CATEGORICAL, CENSUS_NUMERIC, CENSUS_LABEL)


def default_trainer(variant: str, options: dict | None = None) -> BoostedTreeClassifier:
    """The trainer of a variant: ``missing=0`` for imputed data, consent to NaN otherwise."""
    consent = {"missing": 0.0} if variant == "imputed" else {"allow_non_zero_for_missing": True}
    return BoostedTreeClassifier.from_options({**TRAINING_OPTIONS, **consent, **(options or {})})


def build(
    variant: str,
    training: DataFrame,
    roles: Roles,
    labelled: DataFrame | None = None,
    trainer: Estimator | None = None,
    text_out: str = "predicted_income",
    prepared_on: DataFrame | None = None,
    trim_factor: float | None = TRIM_FACTOR,
) -> Pipeline:
    """Stages of one variant, ready to fit on ``training``.

    The label dictionary is fitted here, on ``labelled`` (default: ``training``), because
    the stage that turns predictions back into text needs its labels. With ``prepared_on``
    category indices and column statistics are fitted here as well, on that frame: all data,
    say, while the trees see the training side alone. Otherwise they are learned when the
    pipeline is fitted. ``trim_factor=None`` takes deviations over all values, as columns with
    a mean of zero or less need.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    indexed = [f"{c}_index" for c in roles.categorical]
    scaled = [f"{c}_norm" for c in roles.numeric]
    labels = label_indexer(labelled if labelled is not None else training, roles.label, roles.label_out)

    def prepared(stage):
        return stage if prepared_on is None else stage.fit(prepared_on)

    stages = [prepared(CategoryIndexer(inputCols=roles.categorical, outputCols=indexed, handleInvalid="keep")), labels]
    if variant != "drop_missing":
        score = StandardScore(inputCols=roles.numeric, outputCols=scaled, handleInvalid="keep")
        if variant == "imputed":
            score.setReplacementValue(0.0)
        elif trim_factor is not None:
            score._set(trimFactor=float(trim_factor))
        stages.append(prepared(score))
    inputs = indexed + (roles.numeric if variant == "drop_missing" else scaled)
    if variant == "sparse":
        stages.append(SparseVectorAssembler(inputCols=inputs, outputCol="features", form="struct"))
    else:
        stages.append(assembler(inputs, "features", "skip" if variant in ("drop_missing", "scaled_drop") else "keep"))
    stages.append(trainer if trainer is not None else default_trainer(variant))
    stages.append(label_text(labels.labels, "prediction", text_out))
    return Pipeline(stages=stages)


def fit(variant: str, training: DataFrame, roles: Roles, **kwargs) -> PipelineModel:
    """Build and fit one variant."""
    return build(variant, training, roles, **kwargs).fit(training)


def apply_stages(df: DataFrame, stages: list) -> DataFrame:
    """Apply fitted stages one after another, outside a pipeline."""
    for stage in stages:
        df = stage.transform(df)
    return df


def rows_dropped(before: DataFrame, after: DataFrame) -> int:
    """How many rows the stages between two frames took out."""
    return before.count() - after.count()
