"""One-hot features, binary classifiers and batch scoring."""

from __future__ import annotations

from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml import network
from millrace.operators.metrics import auc
from millrace.operators.rows import exact_split, flag
from millrace.operators.running import width_chunk

PARTS = [("train", 0.8), ("val", 0.2)]


@contextmanager
def reused(df: DataFrame):
    """Keep a frame that several passes read; lost blocks are computed again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def yes_no(df: DataFrame, *columns: str, yes: str = "Yes") -> DataFrame:
    """Text answers to 0/1; used for training and for scoring alike."""
    return df.withColumns({c: flag(F.col(c) == yes) for c in columns})


def one_hot_long(df: DataFrame, key: str, categorical: list[str], numeric: list[str]) -> DataFrame:
    """One row per (row, feature): ``col=value`` with 1.0 for text, the number itself for numbers."""
    text = [
        F.struct(F.concat(F.lit(c + "="), F.col(c)).alias("feature"), F.lit(1.0).alias("value")) for c in categorical
    ]
    numbers = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric]
    return df.select(key, F.inline(F.array(*text, *numbers))).filter("feature is not null")


def encoder(categorical: list[str], numeric: list[str], out: str = "features") -> list:
    """Stages from text and number columns to one vector.

    Values are indexed in text order.  A value not seen in training goes to the
    extra slot, which the encoder drops: all its features are zero.
    """
    stages, inputs = [], []
    if categorical:
        index, onehot = [f"{c}__i" for c in categorical], [f"{c}__v" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=index, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True))
        inputs += onehot
    return [*stages, VectorAssembler(inputCols=[*inputs, *numeric], outputCol=out, handleInvalid="keep")]


def feature_names(model: PipelineModel, categorical: list[str], numeric: list[str]) -> list[str]:
    labels = model.stages[0].labelsArray if categorical else []
    return [f"{c}={v}" for c, values in zip(categorical, labels) for v in values] + list(numeric)


def train(df: DataFrame, categorical: list[str], numeric: list[str], label: str, c: float = 10.0,
          iterations: int = 1000, keep: bool = True) -> PipelineModel:
    """Logistic regression with L2 strength 1/C over the sum of losses.

    Spark minimizes the mean loss, hence 1 / (C * rows); the bias stays free.
    ``keep`` is for frames that the caller does not keep already.
    """
    rows = df.select(*categorical, *numeric, label)
    with reused(rows) if keep else nullcontext(rows) as rows:
        n = rows.count()
        model = LogisticRegression(
            featuresCol="features", labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0,
            standardization=False, maxIter=iterations,
        )
        return Pipeline(stages=[*encoder(categorical, numeric), model]).fit(rows)


def loss_slopes(model: PipelineModel, df: DataFrame, categorical: list[str], numeric: list[str], label: str, c: float) -> DataFrame:
    """Per feature and for the bias: rows where it is not zero, and the slope of the penalized mean loss.

    At the optimum every slope is zero.
    """
    fitted = model.stages[-1]
    names = [*feature_names(model, categorical, numeric), "bias"]
    weights = [*map(float, fitted.coefficients), 0.0]  # the bias is not penalized
    terms = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    wrong = F.get(vector_to_array("probability"), F.lit(1)) - F.col(label)
    rows = model.transform(df).select(wrong.alias("_wrong"), F.posexplode(terms).alias("_i", "_x"))
    slopes = rows.groupBy("_i").agg(F.sum(F.col("_wrong") * F.col("_x")).alias("_s"), F.count_if(F.col("_x") != 0).alias("n_rows"), F.count("*").alias("_n"))
    name, weight = F.get(F.array(*map(F.lit, names)), F.col("_i")), F.get(F.array(*map(F.lit, weights)), F.col("_i"))
    return slopes.select(name.alias("feature"), "n_rows", ((F.col("_s") + weight / F.lit(c)) / F.col("_n")).alias("slope"))


def score(model: PipelineModel, df: DataFrame, keep: list[str], threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """Probability of class 1 and the flag ``>= threshold`` (``>`` if strict)."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    cut = (lambda p: p > threshold) if strict else (lambda p: p >= threshold)
    out = model.transform(df).withColumn("probability_1", probability)
    return out.select(*keep, F.col("probability_1").alias("probability"), cut(F.col("probability_1")).alias("flag"))


def score_json(model: PipelineModel, records: DataFrame, data: str, schema: str, keep: list[str], answers: tuple = ()) -> DataFrame:
    """Score JSON records after the same preparation as in training."""
    rows = records.select(F.from_json(data, schema).alias("_r")).select("_r.*")
    return score(model, yes_no(rows, *answers), keep)


def fit_and_judge(df: DataFrame, key: str, categorical: list[str], numeric: list[str], label: str, seed: int = 2, c: float = 10.0):
    """Fit on 80 % of the rows; the model and the ROC AUC on the rest."""
    train_df, val_df = split_80_20(df, key, seed)
    model = train(train_df, categorical, numeric, label, c)
    scored = score(model, val_df, [label])
    return model, auc(scored, "probability", label, width_chunk(F.col("probability"), 0.001))


def accuracy(scored: DataFrame, label: str) -> DataFrame:
    return scored.agg(F.avg((F.col("flag") == (F.col(label) == 1)).cast("int")).alias("accuracy"))


def eliminate(train_df: DataFrame, val_df: DataFrame, categorical: list[str], numeric: list[str], label: str, c: float = 10.0) -> DataFrame:
    """Validation accuracy of a refit without each feature."""
    spark, out = train_df.sparkSession, []
    with reused(train_df) as fit_on, reused(val_df) as judge_on:
        for name in [*categorical, *numeric]:
            cats, nums = [x for x in categorical if x != name], [x for x in numeric if x != name]
            scored = score(train(fit_on, cats, nums, label, c, keep=False), judge_on, [label], strict=True)
            out.append((name, accuracy(scored, label).first()[0]))
    return spark.createDataFrame(out, "feature string, accuracy double")


def split_80_20(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    parts = exact_split(df, key, seed, PARTS)
    return parts.filter("split = 'train'"), parts.filter("split = 'val'")


def _vectors(df: DataFrame, vector: str, label: str) -> DataFrame:
    return df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"))


def train_network(df: DataFrame, vector: str, label: str, hidden: int = 64, step: float | None = None, iterations: int = 10,
                  seed: int = 42, validation: DataFrame | None = None, **options):
    """Binary classifier with one hidden layer on array columns; returns a model and the history.

    With ``step`` (a learning rate) it is trained by ``network.train``, which see;
    ``options`` are its ``momentum`` and ``batches``.  Without it MLlib's
    optimizer (L-BFGS) chooses its own steps; the history then has epoch and loss.
    """
    if step is not None:
        return network.train(df, vector, label, hidden, step, epochs=iterations, seed=seed, validation=validation, **options)
    size = df.select(F.size(vector)).first()[0]
    with reused(_vectors(df, vector, label)) as rows:
        model = MultilayerPerceptronClassifier(layers=[size, hidden, 2], maxIter=iterations, seed=seed, solver="l-bfgs").fit(rows)
    losses = [float(v) for v in model.summary().objectiveHistory]
    return model, df.sparkSession.createDataFrame(list(enumerate(losses, 1)), "epoch int, loss double")


def compare_steps(df: DataFrame, validation: DataFrame, vector: str, label: str, steps: list[float], **options) -> DataFrame:
    """Training histories for several step sizes (learning rates), under each other."""
    out = None
    for step in steps:
        _, history = train_network(df, vector, label, step=step, validation=validation, **options)
        part = history.select(F.lit(float(step)).alias("step"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def predict_network(model, df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    if isinstance(model, network.Network):
        return network.predict(model, df, vector, keep)
    rows = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(rows).select(*keep, probability.alias("probability"))


def compare(train_df: DataFrame, val_df: DataFrame, categorical: list[str], numeric: list[str], label: str, values: list[float]) -> DataFrame:
    """Validation accuracy for each value of C."""
    out = []
    with reused(train_df) as fit_on, reused(val_df) as judge_on:
        for c in values:
            scored = score(train(fit_on, categorical, numeric, label, c, keep=False), judge_on, [label])
            out.append((float(c), accuracy(scored, label).first()[0]))
    return train_df.sparkSession.createDataFrame(out, "c double, accuracy double")
