"""Driver ranking, boosted trees and segmentation with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

#: Below this area under the ROC curve a driver ranking should not be trusted.
AUC_FLOOR = 0.65


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], interactions: Sequence[tuple[str, str]] = ()) -> list:
    """Stages that make `features`: numbers, products of pairs of numbers, one-hot categories (unseen values kept)."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in categorical]
    hot = [OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], dropLast=True)] if categorical else []
    parts = [*numeric, *(f"{a}_x_{b}" for a, b in interactions), *(f"{c}_hot" for c in categorical)]
    return [*index, *hot, VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep")]


def with_products(df: DataFrame, interactions: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in interactions}) if interactions else df


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label, with a `weight` under which both classes weigh the same."""
    df = df.filter(F.col(label).isNotNull())
    n = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(n.values())
    weight = F.coalesce(*[F.when(F.col(label) == k, F.lit(total / (len(n) * c))) for k, c in n.items()], F.lit(1.0)) if n else F.lit(1.0)
    return df.withColumn("weight", weight)


def fit_drivers(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), interactions: Sequence[tuple[str, str]] = (), l2: float = 0.1) -> tuple[PipelineModel, DataFrame]:
    """A class-balanced ridge logistic model and the held-out fifth of rows (by hash) with its predictions."""
    rows = with_products(balanced(df, label), interactions).withColumn("label", F.col(label).cast("double"))
    held = F.pmod(F.xxhash64(*[c for c in (*numeric, *categorical)], label), F.lit(5)) == 0
    train, test = rows.filter(~held), rows.filter(held)
    model = Pipeline(stages=[*feature_stages(numeric, categorical, interactions), LogisticRegression(weightCol="weight", regParam=l2, elasticNetParam=0.0, maxIter=50)]).fit(train)
    return model, model.transform(test)


def explain(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, attribution): mean absolute pull of each source feature on the log odds."""
    fitted = model.stages[-1]
    rows = PipelineModel(model.stages[:-1]).transform(df).select(vector_to_array("features").alias("x"))
    coef = fitted.coefficients.toArray().tolist()
    attrs = PipelineModel(model.stages[:-1]).transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    source = {i: n.split("_hot_")[0] for i, n in names.items()}
    means = rows.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(coef))]).first()
    pull = rows.agg(*[F.avg(F.abs(F.lit(c) * (F.col("x")[i] - F.lit(means[f"m{i}"])))).alias(f"a{i}") for i, c in enumerate(coef)]).first()
    total: dict[str, float] = {}
    for i in range(len(coef)):
        total[source[i]] = total.get(source[i], 0.0) + (pull[f"a{i}"] or 0.0)
    return df.sparkSession.createDataFrame(sorted(total.items(), key=lambda r: (-r[1], r[0])), "feature string, attribution double")


#: The persona's own features of the driver model, and the response that its label comes from.
PERSONA_FEATURES = (
    "creative", "gender_clean", "age_band_banner", "archetype_race", "income_low_usd", "is_parent", "nps_band",
    "archetype_psychometric_vector_name", "archetype_adoption_category_name", "archetype_location_type",
)
LABEL_META = "POSTINT"


def driver_features(boxed: DataFrame, persona: DataFrame, flags: DataFrame, by: Sequence[str] = ("archetype_id",), features: Sequence[str] = PERSONA_FEATURES, meta: str = LABEL_META, skip: Sequence[str] = ("cut_postint_tb",)) -> DataFrame:
    """The driver feature mart: one row per persona with an answer to `meta`: label, persona features, behaviour cuts.

    The label is whether any primary answer to `meta` is in the top box, null where none has a code
    (such rows are for the caller to leave out and count). `skip` names cuts that are the label
    itself. Labels and flags are summed by persona before they are joined; a persona without flags
    keeps its row.
    """
    label = boxed.filter((F.col("meta") == meta) & F.col("is_primary_run")).groupBy(*by).agg(F.bool_or("is_tb").alias("postint_tb"))
    own = persona.select(*by, *features)
    cuts = flags.drop(*skip)
    return label.join(own, list(by)).join(cuts, list(by), "left")


def evaluate(predicted: DataFrame) -> dict[str, float]:
    """roc_auc, precision, recall, f1, accuracy, log_loss, and whether the AUC reaches the floor."""
    many = lambda m: MulticlassClassificationEvaluator(metricName=m).evaluate(predicted)
    out = {"roc_auc": BinaryClassificationEvaluator().evaluate(predicted)}
    out |= {n: many(m) for n, m in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1"), ("accuracy", "accuracy"), ("log_loss", "logLoss"))}
    return out | {"trusted": float(out["roc_auc"] >= AUC_FLOOR)}


def fit_boosted(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees and (feature, importance)."""
    rows = balanced(df, label).withColumn("label", F.col(label).cast("double"))
    model = Pipeline(stages=[*feature_stages(numeric, categorical), GBTClassifier(weightCol="weight", maxIter=10, maxDepth=3, seed=7)]).fit(rows)
    found = model.stages[-1].featureImportances.toArray().tolist()
    attrs = model.transform(rows.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    total: dict[str, float] = {}
    for kind in attrs.values():
        for a in kind:
            n = a["name"].split("_hot_")[0]
            total[n] = total.get(n, 0.0) + found[a["idx"]]
    return model, df.sparkSession.createDataFrame(sorted(total.items(), key=lambda r: (-r[1], r[0])), "feature string, importance double")


def davies_bouldin(assigned: DataFrame, centers: list, cluster: str = "prediction", features: str = "scaled") -> float:
    """Mean over clusters of the worst (spread + spread) / distance; lower is better."""
    x = vector_to_array(features)
    table = assigned.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "_c int, center array<double>")
    dist = F.sqrt(F.aggregate(F.zip_with(x, "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    spread = {r["_c"]: r["s"] for r in assigned.join(F.broadcast(table), F.col(cluster) == F.col("_c")).groupBy("_c").agg(F.avg(dist).alias("s")).collect()}
    gap = lambda i, j: float(sum((a - b) ** 2 for a, b in zip(centers[i], centers[j], strict=True)) ** 0.5)
    worst = [max((spread[i] + spread[j]) / (gap(i, j) or 1e-12) for j in spread if j != i) for i in spread if len(spread) > 1]
    return sum(worst) / len(worst) if worst else float("inf")


def fit_segments(df: DataFrame, features: str, ks: Sequence[int] = range(3, 9), seed: int = 7) -> tuple[DataFrame, list[tuple[int, float]]]:
    """df with `segment` from the k-means, of those tried, with the least Davies-Bouldin index; the index of each k.

    features: a vector or array of numbers. Features are standardised first.
    """
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("_v", array_to_vector(features) if df.schema[features].dataType.typeName() == "array" else F.col(features))
    rows = StandardScaler(inputCol="_v", outputCol="scaled", withMean=True, withStd=True).fit(rows).transform(rows).persist()
    tried = []
    for k in ks:
        model = KMeans(featuresCol="scaled", k=k, seed=seed, initMode="k-means||").fit(rows)
        tried.append((davies_bouldin(model.transform(rows), model.clusterCenters()), k, model))
    best = min(tried, key=lambda t: t[:2])
    out = best[2].transform(rows).withColumnRenamed("prediction", "segment").drop("_v", "scaled")
    return out, [(k, v) for v, k, _ in tried]


def crosstab(df: DataFrame, authored: str, found: str) -> DataFrame:
    """Rows per authored and found segment."""
    return df.groupBy(authored, found).agg(F.count("*").alias("n"))
