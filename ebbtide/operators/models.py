"""Training, scoring and calibration with Spark ML on prepared snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.metrics import average_precision, clipped
from ebbtide.operators.prepare import (
    align_categories,
    balanced_weights,
    category_value,
    impute,
    incomplete_columns,
    indicator_name,
    level_map,
    medians,
    numeric_value,
    population_std,
    prepare_categories,
    prepare_numeric,
    shuffle_key,
    stratified_split,
)
from ebbtide.operators.lookup import attach
from ebbtide.operators.rank import hexadecimal, ranked
from ebbtide.operators.swaps import coded, swapped_precision
from ebbtide.operators.trees import BoostedTrees, fit_trees
from ebbtide.session import durable
from ebbtide.sources.io import path_exists
from ebbtide.spec import (
    CATEGORICAL_FEATURES,
    ID,
    LABEL,
    NUMERIC_FEATURES,
    RARE_LEVEL_ROWS,
    SCORE_EPSILON,
)

PARAMETERS = "column string, fill double, flagged boolean, scale double"
FEATURES = "features"
#: Folder of stored trees.
TREES = "trees"


@dataclass
class ChurnModel:
    """A fitted classifier with what it learned about its inputs.

    ``parameters`` holds the fill value, missing flag and divisor per numeric
    column; ``levels`` maps category levels to modelling levels.
    """

    parameters: DataFrame
    levels: DataFrame
    pipeline: PipelineModel

    def inputs(self, df: DataFrame) -> DataFrame:
        """Model-ready columns, each under its name plus ``_in``; the originals are kept."""
        rows = self.parameters.collect()
        numeric = [r.column for r in rows]
        categories = sorted({r.feature for r in self.levels.select("feature").distinct().collect()})
        ready = prepare_numeric(df.select("*", *[F.col(c).alias(f"_raw_{c}") for c in numeric + categories]), numeric)
        ready = prepare_categories(ready, categories)
        ready = impute(
            ready, {r.column: r.fill for r in rows}, [r.column for r in rows if r.flagged]
        )
        scaled = {}
        for r in rows:
            scaled[f"{r.column}_in"] = F.col(r.column) / F.lit(r.scale)
        for c in categories:
            mapping = self.levels.where(F.col("feature") == c).select(
                F.col("level").alias(c), F.col("model_level").alias(f"{c}_in")
            )
            ready = attach(ready, mapping, [c])
        ready = ready.withColumns(scaled)
        return ready.withColumns({c: F.col(f"_raw_{c}") for c in numeric + categories}).drop(
            *[f"_raw_{c}" for c in numeric + categories]
        )

    def score(self, df: DataFrame, column: str = "risk_score") -> DataFrame:
        """Add the score of the positive class."""
        scored = self.pipeline.transform(self.inputs(df))
        return scored.select(
            *df.columns, vector_to_array(F.col("probability"))[1].alias(column)
        )

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.parameters.write.mode("overwrite").parquet(f"{path}/parameters")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ChurnModel | TreeModel:
        """A stored model of either kind."""
        if path_exists(spark, f"{path}/{TREES}"):
            return TreeModel.of_rows(spark.read.parquet(f"{path}/{TREES}"))
        return ChurnModel(
            spark.read.parquet(f"{path}/parameters"),
            spark.read.parquet(f"{path}/levels"),
            PipelineModel.load(f"{path}/pipeline"),
        )


def _flag_inputs(flagged: Sequence[str]) -> list[str]:
    return [indicator_name(c) for c in flagged]


def fit_linear(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
    label: str = LABEL,
    alpha: float = 1e-4,
    max_iter: int = 40,
    tol: float = 1e-3,
    min_rows: int = RARE_LEVEL_ROWS,
) -> ChurnModel:
    """Class-balanced logistic regression with L2 penalty.

    Missing values become exact medians with an indicator, numbers are divided by
    their standard deviation, rare category levels share one slot and levels not
    seen in training get none.
    """
    spark = train.sparkSession
    ready = durable(
        prepare_categories(prepare_numeric(train, numeric), categories).select(label, *numeric, *categories)
    )
    fill = medians(ready, numeric)
    flagged = incomplete_columns(ready, numeric)
    filled = impute(ready, fill, flagged)
    std = population_std(filled, [*numeric, *_flag_inputs(flagged)])
    usable = [c for c in numeric if fill[c] is not None]
    parameters = spark.createDataFrame(
        [(c, float(fill[c]), c in flagged, float(std[c])) for c in usable], PARAMETERS
    )
    levels = durable(level_map(ready, categories, min_rows).select("feature", "level", "model_level"))
    flags = [c for c in _flag_inputs(flagged) if c.removesuffix("_missing") in usable]
    stages = [
        StringIndexer(
            inputCols=[f"{c}_in" for c in categories],
            outputCols=[f"{c}_index" for c in categories],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categories],
            outputCols=[f"{c}_slots" for c in categories],
            dropLast=True,
        ),
        VectorAssembler(
            inputCols=[f"{c}_in" for c in usable] + flags + [f"{c}_slots" for c in categories],
            outputCol=FEATURES,
        ),
        LogisticRegression(
            featuresCol=FEATURES,
            labelCol=label,
            weightCol="weight",
            regParam=alpha,
            elasticNetParam=0.0,
            standardization=False,
            maxIter=max_iter,
            tol=tol,
        ),
    ]
    unfitted = ChurnModel(parameters, levels, None)
    data = durable(balanced_weights(unfitted.inputs(ready), label))
    return ChurnModel(parameters, levels, Pipeline(stages=stages).fit(data))


@dataclass
class TreeModel:
    """Boosted trees over prepared inputs; same use as :class:`ChurnModel`."""

    numeric: list[str]
    categories: list[str]
    trees: BoostedTrees

    def score(self, df: DataFrame, column: str = "risk_score") -> DataFrame:
        """Add the score of the positive class."""
        ready = df.withColumns(_tree_inputs(self.numeric, self.categories))
        return self.trees.probability(ready, column).select(*df.columns, column)

    def coded(self, df: DataFrame, keep: Sequence[str], column: str) -> DataFrame:
        """The columns to keep, and the codes of the inputs as bytes."""
        ready = df.select(*keep, *[c.alias(n) for n, c in _tree_inputs(self.numeric, self.categories).items()])
        return coded(self.trees, ready, column).select(*keep, column)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.trees.rows(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/{TREES}")

    @staticmethod
    def of_rows(rows: DataFrame) -> TreeModel:
        trees = BoostedTrees.of_rows(rows)
        plain = [[f.removesuffix("_in") for f in kind] for kind in (trees.bins.cuts, trees.bins.levels)]
        return TreeModel(*plain, trees)


def _tree_inputs(numeric: Sequence[str], categories: Sequence[str]) -> dict[str, Column]:
    return {f"{c}_in": numeric_value(c) for c in numeric} | {f"{c}_in": category_value(c) for c in categories}


def fit_boosted(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
    label: str = LABEL,
    id_col: str = ID,
    schema: DataFrame | None = None,
    step: float = 0.08,
    max_iter: int = 150,
    max_leaves: int = 31,
    min_leaf: int = 50,
    l2: float = 1.0,
    validation_share: float = 0.10,
    max_bins: int = 255,
    patience: int = 15,
    seed: int = 42,
) -> TreeModel:
    """Class-balanced gradient-boosted trees with early stopping on a stratified tenth.

    Trees grow best first to ``max_leaves`` leaves with an L2 penalty. Missing numbers take a branch that is learnt at
    each split, categories are parted into sets of levels; levels outside ``schema``, if it is given, are missing.
    """
    rows = train.select(id_col, label, *numeric, *categories)
    if schema is not None:
        rows = align_categories(rows, schema, categories)
    marked = stratified_split(rows, validation_share, seed, label, id_col)
    ready = balanced_weights(marked, label).select(
        F.col(label).alias("label"), "weight", (F.col("split") == "test").alias("is_validation"),
        *[c.alias(name) for name, c in _tree_inputs(numeric, []).items()],
        *[(category_value(c) if schema is None else F.col(c)).alias(f"{c}_in") for c in categories],
    )
    trees = fit_trees(
        durable(ready), [f"{c}_in" for c in numeric], [f"{c}_in" for c in categories], step, max_iter, max_leaves, min_leaf, l2, max_bins, patience
    )
    return TreeModel(list(numeric), list(categories), trees)


def fit_isotonic(
    scored: DataFrame, label: str = LABEL, score: str = "risk_score"
) -> IsotonicRegressionModel:
    """Monotone map from score to observed rate; equal scores are merged before fitting."""
    points = scored.groupBy(F.col(score).alias("score")).agg(
        F.avg(label).alias("rate"), F.count("*").cast("double").alias("weight")
    )
    return IsotonicRegression(
        featuresCol="score", labelCol="rate", weightCol="weight", predictionCol="calibrated"
    ).fit(points)


def calibrate(
    model: IsotonicRegressionModel,
    scored: DataFrame,
    score: str = "risk_score",
    column: str = "calibrated_score",
    epsilon: float = SCORE_EPSILON,
) -> DataFrame:
    """Interpolated calibrated score, held inside ``[epsilon, 1 - epsilon]``."""
    out = model.transform(scored.withColumn("score", F.col(score).cast("double")))
    return out.withColumn(column, clipped(F.col("calibrated"), epsilon)).select(*scored.columns, column)


def permutation_importance(
    model: ChurnModel,
    sample: DataFrame,
    features: Sequence[str] = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES),
    repeats: int = 5,
    seed: int = 42,
    label: str = LABEL,
    id_col: str = ID,
) -> DataFrame:
    """Drop in average precision when one feature is shuffled, per feature.

    Every repeat pairs each row with a donor row through two seeded orders of the
    same ids. Trees score all swaps of a pair within its task and pass on counts of the scores that change; other models score
    a table of ``rows * features * repeats`` rows, so a caller that wants less passes a sample.
    """
    if isinstance(model, TreeModel):
        rows = durable(model.coded(sample, [id_col, label], "_codes"))
        pairs = _paired(rows, [label, "_codes"], F.col("_codes"), repeats, seed, id_col)
        plain, found = swapped_precision(model.trees, rows, pairs, [f"{f}_in" for f in features], repeats, label, id_col, "_codes", "_donor")
        named = [(f.removesuffix("_in"), r, ap) for f, r, ap in found]
        return _drops(sample.sparkSession.createDataFrame(named, "feature string, repeat int, average_precision double"), plain)
    paired = _paired(sample, [label, *features], F.struct(*features), repeats, seed, id_col)
    plain = average_precision(model.score(sample.select(label, *features)), label).first()[0]
    variants = paired.select("*", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))

    def swapped(f: str) -> Column:
        return F.when(F.col("feature") == f, F.col(f"_donor.{f}")).otherwise(F.col(f)).alias(f)

    shuffled = model.score(
        variants.select("feature", "repeat", label, *[swapped(f) for f in features])
    )
    return _drops(average_precision(shuffled, label, by=["feature", "repeat"]), plain)


def _paired(sample: DataFrame, own: Sequence[str], donor: Column, repeats: int, seed: int, id_col: str) -> DataFrame:
    """``own`` of each row and, per ``repeat``, the ``_donor`` of the row that takes its place in another order of the ids."""
    base = ranked(
        sample.select(id_col, *own).withColumn("_mix", shuffle_key(id_col, f"{seed}:base")),
        [hexadecimal(F.col("_mix")), F.col(id_col)],
        rank="_place",
    ).drop("_mix", "total")
    rounds = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    donors = ranked(
        sample.select(id_col, donor.alias("_donor"), rounds).withColumn(
            "_mix",
            F.md5(F.concat(F.lit(f"{seed}:"), F.col("repeat").cast("string"), F.lit(":"), F.col(id_col))),
        ),
        [hexadecimal(F.col("_mix")), F.col(id_col)],
        ["repeat"],
        rank="_place",
    ).select("repeat", "_place", "_donor")
    return base.join(donors, "_place")


def _drops(precision: DataFrame, plain: float | None) -> DataFrame:
    return (
        precision.withColumn("drop", F.lit(plain).cast("double") - F.col("average_precision")).groupBy("feature")
        .agg(
            F.avg("drop").alias("average_precision_drop_mean"),
            F.stddev_pop("drop").alias("average_precision_drop_std"),
        )
        .orderBy(F.col("average_precision_drop_mean").desc())
    )
