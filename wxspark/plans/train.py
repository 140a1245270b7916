"""Train and evaluate five forests: one extreme-weather classifier and four regressors.

The features are month, day and hour, at most 12 * 31 * 24 distinct combinations. So two things are
done once per combination and not once per row:

* training rows are summed up to weighted cells before any tree is grown, which takes one pass over
  the data with map-side partial sums; the trees then iterate over a table whose size does not
  depend on the number of observations;
* every possible prediction is computed once into a grid, so that scoring is a lookup in a
  broadcast table of 8,928 rows.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import (
    CLASSIFIER_TREES,
    FEATURES,
    REGRESSOR_TREES,
    SEED,
    TARGETS,
    TEST_FRACTION,
    TREE_DEPTH,
)
from wxspark.functions.calendar import calendar_parts
from wxspark.functions.draws import draw_bits, fixed, uniform
from wxspark.operators.metrics import accuracy, as_rows, mean_absolute_error, precision
from wxspark.operators.sampling import sample_exact, split_bucket, split_exact
from wxspark.session import scratch_base, scratch_path

# Resampling units of a feature combination, for trees on one shared table of cells. More of them follow a fit on rows more
# closely, and make the table as much larger; ``bootstrap_cells`` resamples the rows themselves.
REPLICATES = 32
REPLICATE_SALT = 103
#: The tree of number t draws its rows' weights with the salt BOOTSTRAP_SALT + t.
BOOTSTRAP_SALT = 200
#: Trees that are fitted at once.
FITS = 8
CELLS = 12 * 31 * 24
# Fixed, because a forest's bootstrap is seeded per partition: another count gives other trees.
FIT_PARTITIONS = 8

CLASS_PREDICTION = "predicted_extreme"


def predicted(target: str) -> str:
    return f"predicted_{target}"


@dataclass
class Trained:
    model: PipelineModel
    grid: DataFrame
    test: DataFrame

    def metrics(self) -> DataFrame:
        return evaluate(score(self.test, self.grid))


def calendar_features(df: DataFrame, at: str = "timestamp") -> DataFrame:
    return df.withColumns(calendar_parts(F.col(at)))


def training_rows(observations: DataFrame) -> DataFrame:
    """Id, features, the 0/1 label and the four targets."""
    return calendar_features(observations).select(
        "id", *FEATURES, F.col("is_extreme_weather").cast("int").alias("extreme"), *TARGETS
    )


def training_cells(rows: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """Training rows summed up per (features, replicate, label).

    A forest resamples its input rows. To keep that effective, every feature combination is kept as
    up to ``replicates`` separate weighted rows. Least squares and Gini splits need only weights and
    means, so summing up loses nothing else. Targets have two decimals and are summed as whole
    hundredths: exact, and so independent of the order of addition. A null target is an error.

    The replicate is hashed from the whole id, so how many a combination has depends on its number of rows
    alone. A task has at most 12 * 31 * 24 * ``replicates`` * 2 groups after its partial sums.
    """
    replicate = (draw_bits(F.col("id"), REPLICATE_SALT) % replicates).cast("int")
    keys = [*FEATURES, "replicate", "extreme"]
    return (
        rows.withColumn("replicate", replicate)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("weight"),
            *[F.sum(_hundredths(t)).alias(f"{t}_hundredths") for t in TARGETS],
        )
    )


def _hundredths(target: str) -> Column:
    missing = F.raise_error(F.lit(f"{target} is null")).cast("long")
    return F.coalesce(F.rint(F.col(target) * 100).cast("long"), missing)


def feature_matrix(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def estimators() -> list:
    """Feature subsets: one of three per split for the classifier, all for the regressors."""
    shared = {"maxDepth": TREE_DEPTH, "seed": SEED, "weightCol": "weight"}
    classifier = RandomForestClassifier(
        numTrees=CLASSIFIER_TREES,
        featureSubsetStrategy="1",
        labelCol="extreme",
        predictionCol=CLASS_PREDICTION,
        **shared,
    )
    regressors = [
        RandomForestRegressor(
            numTrees=REGRESSOR_TREES,
            featureSubsetStrategy="all",
            labelCol=target,
            predictionCol=predicted(target),
            **shared,
        )
        for target in TARGETS
    ]
    return [classifier, *regressors]


def fit_forests(cells: DataFrame) -> PipelineModel:
    """Fit the five forests on the same cells, as five concurrent Spark jobs.

    The cells are laid out in a fixed number of sorted partitions and checkpointed: the trees come
    out equal on any cluster, and an executor lost while growing them costs no second pass over the
    observations.
    """
    spark = cells.sparkSession
    scratch_base(spark)
    keys = [*FEATURES, "replicate", "extreme"]
    points = (
        cells.repartition(FIT_PARTITIONS, *keys)
        .sortWithinPartitions(*keys)
        .select(
            *FEATURES,
            F.col("extreme").cast("double").alias("extreme"),
            F.col("weight").cast("double").alias("weight"),
            *[(F.col(f"{t}_hundredths") / F.col("weight") / 100).alias(t) for t in TARGETS],
        )
        .checkpoint()
    )
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    assembled = assembler.transform(points)
    forests = estimators()
    with ThreadPoolExecutor(len(forests)) as pool:
        fitted = list(pool.map(lambda forest: forest.fit(assembled), forests))
    return PipelineModel([assembler, *fitted])


# Chances that a row is drawn at most 0, 1, ... times by a tree, if it is drawn once on average.
AT_MOST = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]


def bootstrap_weight(key: Column, tree: Column) -> Column:
    """How often the row of this key is drawn by a tree: Poisson of mean 1, by the key and the tree alone."""
    u = uniform(key, tree + BOOTSTRAP_SALT)
    return sum((u >= p).cast("int") for p in AT_MOST)


def bootstrap_cells(rows: DataFrame, trees: int) -> DataFrame:
    """Training rows summed up per (tree, features, label), each as often as the tree draws it.

    One pass over the rows makes the samples of all trees, by partial sums in each task: at most
    12 * 31 * 24 * 2 * ``trees`` groups, whatever the number of rows. The sums are exact.
    """
    drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    drawn = drawn.withColumn("times", bootstrap_weight(F.col("id"), F.col("tree"))).where("times > 0")
    return drawn.groupBy("tree", *FEATURES, "extreme").agg(
        F.sum("times").alias("weight"),
        *[F.sum(F.col("times") * _hundredths(t)).alias(f"{t}_hundredths") for t in TARGETS],
    )


def fit_bootstrapped(cells: DataFrame, only: tuple[str, ...] = ("extreme", *TARGETS)) -> PipelineModel:
    """Fit each tree of the five forests on its own sample, and average them.

    A resampled row weighs what it weighs in a fit on rows, so trees differ as much as there, also where a
    feature combination has thousands of rows. Class trees are grown on the label as a number: the splits that reduce
    its variance most are those that reduce impurity most, and a leaf's mean is its share of the class.
    """
    spark = cells.sparkSession
    path = scratch_path(spark, "bootstrap")
    cells.repartition("tree").sortWithinPartitions(*FEATURES, "extreme").write.partitionBy("tree").parquet(path)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = {label: CLASSIFIER_TREES if label == "extreme" else REGRESSOR_TREES for label in only}
    points = {
        t: assembler.transform(
            spark.read.parquet(f"{path}/tree={t}").select(
                *FEATURES,
                F.col("extreme").cast("double").alias("extreme"),
                F.col("weight").cast("double").alias("weight"),
                *[(F.col(f"{x}_hundredths") / F.col("weight") / 100).alias(x) for x in TARGETS],
            )
        ).coalesce(1)
        for t in range(max(trees.values()))
    }

    def fit(label: str, t: int):
        tree = RandomForestRegressor(
            numTrees=1, bootstrap=False, maxDepth=TREE_DEPTH, seed=SEED + t, weightCol="weight", labelCol=label,
            featureSubsetStrategy="1" if label == "extreme" else "all", predictionCol=_of_tree(label, t),
        )
        return tree.fit(points[t])

    wanted = [(label, t) for label, n in trees.items() for t in range(n)]
    with ThreadPoolExecutor(FITS) as pool:
        fitted = list(pool.map(lambda w: fit(*w), wanted))
    return PipelineModel([assembler, *fitted, SQLTransformer(statement=f"SELECT {_averages(trees)} FROM __THIS__")])


def _of_tree(label: str, t: int) -> str:
    return f"{label}_tree_{t}"


def _averages(trees: dict[str, int]) -> str:
    means = {label: "(" + " + ".join(_of_tree(label, t) for t in range(n)) + f") / {n}" for label, n in trees.items()}
    named = [f"CAST({m} > 0.5 AS DOUBLE) AS {CLASS_PREDICTION}" if x == "extreme" else f"{m} AS {predicted(x)}" for x, m in means.items()]
    return ", ".join(["*", *named])


def prediction_grid(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The five predictions for every (month, day, hour): 8,928 rows whatever the data."""
    scratch_base(spark)
    cells = spark.range(0, CELLS, 1, 8).select(
        F.col("id").alias("cell"),
        F.expr("cast(id div 744 + 1 as int)").alias("month"),
        F.expr("cast(id div 24 % 31 + 1 as int)").alias("day"),
        F.expr("cast(id % 24 as int)").alias("hour"),
    )
    return model.transform(cells).select("cell", CLASS_PREDICTION, *map(predicted, TARGETS)).checkpoint()


def score(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Add the predictions for the rows' features; null features give null predictions. No shuffle.

    The three features are joined as one dense long, which Spark keeps as an array and not a hash map.
    """
    cell = (F.col("month") - 1) * 744 + (F.col("day") - 1) * 24 + F.col("hour")
    return df.withColumn("cell", cell.cast("long")).join(F.broadcast(grid), "cell", "left").drop("cell")


def evaluate(scored: DataFrame) -> DataFrame:
    """Hold-out scores of all five models as (model, metric, value), in one pass."""
    label, prediction = F.col("extreme"), F.col(CLASS_PREDICTION)
    scores: dict[str, Column] = {
        "extreme__accuracy": accuracy(label, prediction),
        "extreme__precision": precision(label, prediction),
    }
    for target in TARGETS:
        scores[f"{target}__mae"] = mean_absolute_error(F.col(target), F.col(predicted(target)))
    wide = scored.agg(*[value.alias(name) for name, value in scores.items()])
    return as_rows(wide, list(scores))


def train(
    observations: DataFrame,
    cap: int | None = None,
    exact_split: bool = False,
    fraction: float = TEST_FRACTION,
    replicates: int = REPLICATES,
    bootstrap: str = "replicates",
) -> Trained:
    """Observations to fitted forests. All five share one split.

    By default all rows are used and the split is by hashed bucket (narrow). ``cap`` draws a sample of
    that size first, and ``exact_split`` makes the test side exactly ceil(fraction * n) rows.
    ``replicates`` is how many units the forests resample of each feature combination. With ``bootstrap`` "rows" every
    tree resamples the rows themselves instead; that takes 110 small fits in place of five.
    """
    if bootstrap not in ("replicates", "rows"):
        raise ValueError(f"no bootstrap of {bootstrap}")
    rows = training_rows(observations)
    if cap is not None:
        scratch_base(observations.sparkSession)
        rows = sample_exact(rows, cap).checkpoint()  # every later pass would search for its cut again
    flagged = split_exact(rows, fraction=fraction) if exact_split else split_bucket(rows, fraction=fraction)
    training = flagged.where(~F.col("is_test"))
    if bootstrap == "rows":
        model = fit_bootstrapped(bootstrap_cells(training, max(CLASSIFIER_TREES, REGRESSOR_TREES)))
    else:
        model = fit_forests(training_cells(training, replicates))
    return Trained(model, prediction_grid(observations.sparkSession, model), flagged.where("is_test").drop("is_test"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_predictions(grid: DataFrame):
    """Predictor for the verify job: adds the ``ai_*`` columns from the grid, rounded to two decimals."""

    def predict(requests: DataFrame) -> DataFrame:
        scored = score(requests, grid)
        return scored.withColumns(
            {
                **{f"ai_{t}": fixed(F.col(predicted(t))) for t in TARGETS},
                "ai_is_extreme_weather": F.col(CLASS_PREDICTION) == 1.0,
            }
        ).drop(CLASS_PREDICTION, *map(predicted, TARGETS))

    return predict
