"""The six-step feature-selection funnel, its report and its stored result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabloom.functions.columns import is_numeric, quoted
from tabloom.functions.lineage import materialize
from tabloom.operators import select as steps
from tabloom.operators.importance import permutation_importance, tree_importance
from tabloom.operators.information import class_totals, information_value
from tabloom.sources.csv import write_csv_table
from tabloom.sources.fits import save_fit
from tabloom.functions.wide import small_table

STEPS = ("missing", "variance", "correlation", "iv", "importance", "permutation")


@dataclass(frozen=True)
class SelectorSettings:
    target: str = "target"
    exclude: tuple[str, ...] = ()
    missing_threshold: float = 0.95
    variance_threshold: float = 0.01
    correlation_threshold: float = 0.95
    iv_threshold: float = 0.02
    iv_bins: int = 10
    iv_max_categories: int = 50
    importance_percentile: float = 0.25
    importance_trees: int = 200
    permutation_threshold: float = 0.0005
    permutation_repeats: int = 5
    permutation_sample: int = 50_000
    seed: int = 42
    # The tree steps may be left out, as they are when nothing numeric is left.
    run_importance: bool = True
    run_permutation: bool = True


@dataclass
class Selection:
    """The outcome of :func:`fit_selector`."""

    settings: SelectorSettings
    candidates: list[str]
    selected: list[str]
    dropped: dict[str, list[str]]
    iv: list[tuple] = field(default_factory=list)
    importance: list[tuple] = field(default_factory=list)
    permutation: list[tuple] = field(default_factory=list)

    def transform(self, df: DataFrame, *, include_target: bool = True) -> DataFrame:
        """Excluded columns, selected features and the target; absent names are passed over.

        Each excluded column is put in front in sorted order, so they come out reversed.
        """
        names = list(self.selected)
        if include_target and self.settings.target in df.columns:
            names.append(self.settings.target)
        for c in sorted(self.settings.exclude):
            if c in df.columns and c not in names:
                names.insert(0, c)
        return df.select(*[quoted(c) for c in names if c in df.columns])

    def iv_scores(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, self.iv, "column string, iv double, label string, kind string")

    def importance_scores(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, self.importance, "column string, importance double")

    def permutation_scores(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, self.permutation, "column string, importance_mean double, importance_std double"
        )

    def report(self, spark: SparkSession) -> DataFrame:
        """Status, step and scores per candidate; selected last among equals, NULL step last."""
        rows = [(c, "dropped", step) for step, names in self.dropped.items() for c in names]
        rows += [(c, "selected", None) for c in self.selected]
        status = small_table(spark, rows, "column string, status string, step string")
        return (
            status.join(self.iv_scores(spark).select("column", "iv"), "column", "left")
            .join(self.importance_scores(spark), "column", "left")
            .join(self.permutation_scores(spark).select("column", "importance_mean"), "column", "left")
            .orderBy("status", F.col("step").asc_nulls_last(), "column")
        )

    def waterfall(self, spark: SparkSession) -> DataFrame:
        """(step_no, step, dropped, remaining), starting with all candidates."""
        remaining = len(self.candidates)
        rows = [(0, "candidates", 0, remaining)]
        for number, step in enumerate(STEPS, 1):
            remaining -= len(self.dropped[step])
            rows.append((number, step, len(self.dropped[step]), remaining))
        return small_table(spark, rows, "step_no int, step string, dropped int, remaining int")

    def save(self, spark: SparkSession, folder: str) -> None:
        """Selected list, dropped summary, report and the score tables that have rows."""
        folder = folder.rstrip("/")
        save_fit(spark, self.selected, f"{folder}/selected_features.json")
        save_fit(
            spark,
            {
                "summary": {step: len(names) for step, names in self.dropped.items()},
                "total_dropped": sum(map(len, self.dropped.values())),
                "total_selected": len(self.selected),
                "detail": self.dropped,
            },
            f"{folder}/dropped_features.json",
        )
        write_csv_table(self.report(spark), f"{folder}/feature_selection_report.csv", single_file=True)
        tables = {
            "iv_scores": (self.iv, self.iv_scores),
            "tree_importance": (self.importance, self.importance_scores),
            "permutation_importance": (self.permutation, self.permutation_scores),
        }
        for name, (rows, table) in tables.items():
            if rows:
                write_csv_table(table(spark), f"{folder}/{name}.csv", single_file=True)


def _booleans_as_numbers(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: quoted(c).cast("tinyint") for c in flags}) if flags else df


def fit_selector(
    train: DataFrame, settings: SelectorSettings | None = None, *, reuse: bool = True, **changes
) -> Selection:
    """Run the steps in order; each sees the survivors of the one before.

    Candidates are the train columns without the excluded ones and the target.
    With ``reuse`` the candidate columns are written once to the shared folder, since
    every step reads them again; pass False when ``train`` already is a stored table.
    """
    s = settings or SelectorSettings()
    if changes:
        s = SelectorSettings(**{**s.__dict__, **changes})
    candidates = [c for c in train.columns if c not in {*s.exclude, s.target}]
    kept = [quoted(c) for c in candidates]
    if s.target in train.columns:
        kept.append(quoted(s.target))
    train = _booleans_as_numbers(train.select(*kept))
    if reuse:
        train = materialize(train, "selection-train")

    left = list(candidates)
    dropped: dict[str, list[str]] = {step: [] for step in STEPS}

    def remove(step: str, names: Sequence[str]) -> None:
        dropped[step] = [c for c in left if c in set(names)]
        left[:] = [c for c in left if c not in set(names)]

    health = steps.column_health(train, left).collect()
    remove("missing", steps.drop_by_missing(health, s.missing_threshold))
    numeric = [c for c in left if is_numeric(train, c)]
    remove("variance", steps.drop_by_variance(health, numeric, s.variance_threshold))
    remove(
        "correlation",
        steps.select_by_correlation(train, left, target=s.target, threshold=s.correlation_threshold),
    )
    selection = Selection(s, candidates, left, dropped)

    totals = class_totals(train, s.target)
    if min(totals) > 0 and left:
        scores = information_value(
            train,
            left,
            target=s.target,
            bins=s.iv_bins,
            max_categories=s.iv_max_categories,
            totals=totals,
        ).collect()
        selection.iv = [tuple(r) for r in scores]
        remove("iv", steps.drop_by_iv(scores, s.iv_threshold))

    numeric = [c for c in left if is_numeric(train, c)]
    if s.run_importance and numeric:
        scores = tree_importance(
            train, numeric, target=s.target, trees=s.importance_trees, seed=s.seed
        ).collect()
        selection.importance = [tuple(r) for r in scores]
        remove("importance", steps.drop_by_importance(scores, s.importance_percentile))

    numeric = [c for c in left if is_numeric(train, c)]
    if s.run_permutation and numeric:
        scores = permutation_importance(
            train,
            numeric,
            target=s.target,
            sample_size=s.permutation_sample,
            repeats=s.permutation_repeats,
            seed=s.seed,
        ).collect()
        selection.permutation = [tuple(r) for r in scores]
        remove("permutation", steps.drop_by_permutation(scores, s.permutation_threshold))
    return selection
