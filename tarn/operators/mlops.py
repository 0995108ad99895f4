"""Feature matrices, scoring, explanations and metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.exprs import softmax

CLASSES = ("H", "D", "A")


def align_features(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and the features in order, as floats; infinite and NaN become null, missing ones null."""
    def one(f: str) -> Column:
        if f not in df.columns:
            return F.lit(None).cast("float").alias(f)
        c = F.col(f).cast("double")
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).cast("float").alias(f)

    return df.select(*keep, *[one(f) for f in features])


def decide(home: str = "p_home", draw: str = "p_draw", away: str = "p_away", draw_threshold: float = 0.32) -> Column:
    """D from the draw threshold on, else the likelier side."""
    return F.when(F.col(draw) >= draw_threshold, "D").when(F.col(home) >= F.col(away), "H").otherwise("A")


def with_decision(df: DataFrame, actual: str | None = None, draw_threshold: float = 0.32) -> DataFrame:
    out = df.withColumn("predicted_result", decide(draw_threshold=draw_threshold))
    p = F.when(F.col("predicted_result") == "H", F.col("p_home")).when(F.col("predicted_result") == "D", F.col("p_draw")).otherwise(F.col("p_away"))
    out = out.withColumn("confidence", p)
    return out.withColumn("is_correct", F.when(F.col(actual).isNotNull(), (F.col("predicted_result") == F.col(actual)).cast("int"))) if actual else out


def rule_scores(df: DataFrame, home_logit: Column, away_logit: Column, draw_logit: Column | None = None, low: float = 0.08, high: float = 0.82) -> DataFrame:
    """Probabilities from logits: softmax, clipped to [low, high], renormalised."""
    ps = softmax(home_logit, F.lit(0.0) if draw_logit is None else draw_logit, away_logit)
    clipped = [F.least(F.lit(high), F.greatest(F.lit(low), p)) for p in ps]
    total = clipped[0] + clipped[1] + clipped[2]
    return df.withColumns({n: c / total for n, c in zip(("p_home", "p_draw", "p_away"), clipped, strict=True)})


def feature_report(df: DataFrame, features: list[str], split: str = "split", train: str = "train") -> DataFrame:
    """(feature, missing_train, missing_other, missing_gap, n_distinct_train), one pass."""
    on = F.col(split) == train
    cells = []
    for f in features:
        miss = F.col(f).isNull().cast("double")
        a, b = F.avg(F.when(on, miss)), F.avg(F.when(~on, miss))
        cells.append(F.struct(F.lit(f).alias("feature"), a.alias("missing_train"), b.alias("missing_other"), (b - a).alias("missing_gap"), F.count_distinct(F.when(on, F.col(f))).alias("n_distinct_train")))
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def select_features(df: DataFrame, features: list[str], most_missing: float = 0.15, least_distinct: int = 2, **options) -> list[str]:
    """The features whose missing rate and distinct count on the training split are good enough."""
    r = feature_report(df, features, **options).filter((F.col("missing_train") <= most_missing) & (F.col("n_distinct_train") >= least_distinct)).collect()
    good = {x["feature"] for x in r}
    return [f for f in features if f in good]


def class_weight(label: str, weights: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for k, v in weights.items():
        out = F.when(F.col(label) == k, float(v)).otherwise(out)
    return out


def train_multiclass(df: DataFrame, features: list[str], label: str, kind: str = "logistic", weights: dict[str, float] | None = None, seed: int = 7) -> PipelineModel:
    """Imputation, assembly and a multinomial regression or a forest, with class weights."""
    common = {"featuresCol": "features", "labelCol": "_y", "weightCol": "_w"}
    last = LogisticRegression(**common, family="multinomial", maxIter=50, regParam=0.01) if kind == "logistic" else RandomForestClassifier(**common, numTrees=40, maxDepth=6, seed=seed)
    stages = [StringIndexer(inputCol=label, outputCol="_y", handleInvalid="keep", stringOrderType="alphabetAsc"), Imputer(inputCols=features, outputCols=[f"_i_{f}" for f in features]), VectorAssembler(inputCols=[f"_i_{f}" for f in features], outputCol="features", handleInvalid="keep"), last]
    return Pipeline(stages=stages).fit(df.filter(F.col(label).isNotNull()).withColumn("_w", class_weight(label, weights or {})))


def score(model: PipelineModel, df: DataFrame, keep: list[str], label: str) -> DataFrame:
    """``keep`` and a probability column per class."""
    names = model.stages[0].labels
    src = df if label in df.columns else df.withColumn(label, F.lit(None).cast("string"))
    p = vector_to_array("probability")
    return model.transform(src).select(*keep, *[p[i].alias(f"p_{n}") for i, n in enumerate(names)])


def contributions(model: PipelineModel, df: DataFrame, features: list[str], keep: list[str], label: str, cls: str) -> DataFrame:
    """(keep, feature_name, feature_value, impact, impact_direction): coefficient times centred value."""
    k = model.stages[0].labels.index(cls)
    coef = model.stages[-1].coefficientMatrix.toArray()
    means = {f: v for f, v in zip(features, df.agg(*[F.avg(f) for f in features]).first(), strict=True)}
    cells = [F.struct(F.lit(f).alias("feature_name"), F.col(f).cast("double").alias("feature_value"), ((F.coalesce(F.col(f).cast("double"), F.lit(float(means[f] or 0.0))) - float(means[f] or 0.0)) * float(coef[k][i])).alias("impact")) for i, f in enumerate(features)]
    long = df.select(*keep, F.inline(F.array(*cells)))
    return long.withColumn("impact_direction", F.when(F.col("impact") > 0, "up").when(F.col("impact") < 0, "down").otherwise("none"))


def top_contributors(long: DataFrame, keys: list[str], name: str, impact: str, k_pos: int = 3, k_neg: int = 1) -> DataFrame:
    """``keys`` with the names of the largest positive and negative impacts, in order."""
    items = F.collect_list(F.struct(F.col(impact).alias("v"), F.col(name).alias("n")))
    g = long.groupBy(*keys).agg(F.array_sort(items).alias("_a"))
    pos = F.slice(F.reverse(F.filter("_a", lambda x: x["v"] > 0)), 1, k_pos)
    neg = F.slice(F.filter("_a", lambda x: x["v"] < 0), 1, k_neg)
    return g.select(*keys, F.transform(pos, lambda x: x["n"]).alias("drivers"), F.transform(neg, lambda x: x["n"]).alias("risks"))


def importance_rank(df: DataFrame, name: str, value: str) -> DataFrame:
    """(name, value, rank, share_pct) of a table of features."""
    one = df.agg(F.sum(F.abs(value)).alias("_t"))
    w = Window.orderBy(F.abs(value).desc(), name)
    return df.crossJoin(F.broadcast(one)).select(name, value, F.row_number().over(w).alias("rank"), (100 * F.abs(value) / F.col("_t")).alias("share_pct"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(class, support, predicted_n, tp, precision, recall, f1) from a confusion table."""
    c = confusion(df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()), actual, predicted)
    rows = c.groupBy(F.col("actual").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    cols = c.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("predicted_n"))
    j = rows.join(cols, "class", "outer").fillna(0, ["support", "tp", "predicted_n"])
    p, r = F.col("tp") / F.nullif(F.col("predicted_n"), F.lit(0)), F.col("tp") / F.nullif(F.col("support"), F.lit(0))
    j = j.withColumns({"precision": F.coalesce(p, F.lit(0.0)), "recall": F.coalesce(r, F.lit(0.0))})
    return j.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))


def overall_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, accuracy, balanced accuracy, macro and weighted F1, Matthews correlation."""
    m = class_metrics(df, actual, predicted)
    s, t, k = F.col("support"), F.col("predicted_n"), F.col("tp")
    one = m.agg(F.sum(s).alias("n"), F.sum(k).alias("c"), F.avg(F.when(s > 0, F.col("recall"))).alias("balanced_accuracy"), F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * s) / F.sum(s)).alias("weighted_f1"), F.sum(s * t).cast("double").alias("st"), F.sum(s * s).cast("double").alias("ss"), F.sum(t * t).cast("double").alias("tt"))
    n2 = F.col("n").cast("double") * F.col("n")
    mcc = (F.col("c") * F.col("n") - F.col("st")) / F.nullif(F.sqrt((n2 - F.col("ss")) * (n2 - F.col("tt"))), F.lit(0.0))
    return one.select("n", (F.col("c") / F.col("n")).alias("accuracy"), "balanced_accuracy", "macro_f1", "weighted_f1", F.coalesce(mcc, F.lit(0.0)).alias("mcc"))


def log_loss(df: DataFrame, actual: str, probs: dict[str, str], eps: float = 1e-15) -> DataFrame:
    p = F.lit(None).cast("double")
    for cls, c in probs.items():
        p = F.when(F.col(actual) == cls, F.col(c)).otherwise(p)
    return df.filter(F.col(actual).isNotNull()).agg(F.avg(-F.ln(F.least(F.lit(1 - eps), F.greatest(F.lit(eps), p)))).alias("log_loss"))


def f_beta(precision: Column, recall: Column, beta: float = 2.0) -> Column:
    b = beta * beta
    return (1 + b) * precision * recall / F.nullif(b * precision + recall, F.lit(0.0))
