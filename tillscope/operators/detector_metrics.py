"""How good is a detector: counts, curves, threshold sweeps and money.

Everything that needs an order works on the distinct scores with their counts, so one pass
replaces a pass per threshold and the size of the curve frames is the number of distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import correlation, safe_div
from tillscope.operators import ranking

def binary(df: DataFrame, *columns: str) -> DataFrame:
    """Bring labels to 1 = positive, 0 = negative; a column that uses -1/1 has -1 for positive."""
    row = df.agg(*[F.max((F.col(c) == -1).cast("int")).alias(c) for c in columns]).first()
    return df.withColumns({c: (F.when(F.col(c) == -1, 1).otherwise(0) if row[c] else F.col(c)).cast("long") for c in columns})


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", groups: Sequence[str] = ()) -> DataFrame:
    """Counts, rates and the usual ratios from one aggregate; a zero divisor gives 0."""
    a, p = F.col(y) == 1, F.col(pred) == 1
    counts = df.groupBy(*groups).agg(
        F.count_if(a & p).alias("true_positives"),
        F.count_if(~a & p).alias("false_positives"),
        F.count_if(a & ~p).alias("false_negatives"),
        F.count_if(~a & ~p).alias("true_negatives"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    n = tp + fp + fn + tn
    return counts.withColumns(
        {
            "precision": safe_div(tp, tp + fp, 0.0),
            "recall": safe_div(tp, tp + fn, 0.0),
            "f1": safe_div(2 * tp, 2 * tp + fp + fn, 0.0),
            "accuracy": safe_div(tp + tn, n),
            "specificity": safe_div(tn, tn + fp, 0.0),
            "false_positive_rate": safe_div(fp, tn + fp, 0.0),
            "false_negative_rate": safe_div(fn, fn + tp, 0.0),
            "fraud_rate_actual": safe_div(tp + fn, n),
            "fraud_rate_predicted": safe_div(tp + fp, n),
            "total_samples": n,
            "total_frauds": tp + fn,
        }
    )


def orient(df: DataFrame, y: str = "y", score: str = "score", groups: Sequence[str] = ()) -> DataFrame:
    """Turn the score so that it does not correlate negatively with the label (per model)."""
    x = F.col(score).cast("double")
    turn = F.coalesce(correlation(F.col(score), F.col(y)) < 0, F.lit(False)).alias("_turn")
    if not groups:
        return df.withColumn(score, -x if df.agg(turn).first()[0] else x)
    signs = df.groupBy(*groups).agg(turn).withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    return df.join(signs, same, "left").withColumn(score, F.when(F.col("_turn"), -x).otherwise(x)).select(*df.columns)


def score_table(df: DataFrame, y: str = "y", score: str = "score", groups: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: rows at or above it (``flagged``), positives among them (``tp``), totals."""
    d = ranking.distribution(df, score, groups, weights={"pos": F.col(y)})
    return d.select(
        *groups,
        F.col(score).alias("threshold"),
        "n",
        "pos",
        "before",
        "total",
        (F.col("total") - F.col("before")).alias("flagged"),
        (F.col("pos_total") - F.col("pos_before")).alias("tp"),
        F.col("pos_total").alias("positives"),
        (F.col("total") - F.col("pos_total")).alias("negatives"),
    )


def area_metrics(df: DataFrame, y: str = "y", score: str = "score", groups: Sequence[str] = ()) -> DataFrame:
    """Area under ROC (rank sum, ties averaged) and average precision; null with one class only."""
    t = score_table(orient(df, y, score, groups), y, score, groups)
    both = (F.max("positives") > 0) & (F.max("negatives") > 0)
    p, n = F.max("positives").cast("double"), F.max("negatives").cast("double")
    ranks = F.sum(F.col("pos") * (F.col("before") + (F.col("n") + 1) / 2.0))
    steps = F.sum(safe_div(F.col("pos"), F.col("positives")) * safe_div(F.col("tp"), F.col("flagged")))
    out = t.groupBy(*groups).agg(
        F.when(both, F.try_divide(ranks - p * (p + 1) / 2, p * n)).alias("auc_roc"),
        F.when(both, steps).alias("avg_precision"),
    )
    return out


def roc_points(df: DataFrame, y: str = "y", score: str = "score", drop_collinear: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) for falling thresholds; points inside a straight piece are left out."""
    t = score_table(orient(df, y, score), y, score).withColumn("neg", F.col("n") - F.col("pos"))
    if drop_collinear:
        seen = ranking.in_order(t, "threshold", "threshold", previous={"_pos": "pos", "_neg": "neg"}, position="_p", size="_k")
        ends = (F.col("_p") == 1) | (F.col("_p") == F.col("_k"))
        t = seen.where(ends | (F.col("pos") != F.col("_pos")) | (F.col("neg") != F.col("_neg")))
    fp = F.col("flagged") - F.col("tp")
    points = t.select("threshold", safe_div(fp, F.col("negatives")).alias("fpr"), safe_div(F.col("tp"), F.col("positives")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return points.unionByName(start)


def precision_recall_points(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, and the closing point (1, 0)."""
    t = score_table(orient(df, y, score), y, score)
    points = t.select("threshold", safe_div(F.col("tp"), F.col("flagged")).alias("precision"), safe_div(F.col("tp"), F.col("positives")).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], points.schema)
    return points.unionByName(end)


def evaluate(df: DataFrame, y: str = "y", pred: str = "pred", score: str | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """All metrics, one row (per model)."""
    df = binary(df, y, pred)
    out = confusion(df, y, pred, groups)
    if score is None:
        return out
    areas = area_metrics(df, y, score, groups)
    if groups:
        return out.join(areas, list(groups), "left")
    return out.withColumn("_one", F.lit(1)).join(areas.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")


def compare_models(df: DataFrame, model: str = "model", y: str = "y", pred: str = "pred", score: str | None = "score") -> DataFrame:
    """One row per model, best F1 first."""
    out = evaluate(df, y, pred, score, [model])
    keep = [model, "precision", "recall", "f1", *(["auc_roc"] if score else []), "false_positive_rate"]
    return out.select(*keep).orderBy(F.desc("f1"), model)


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support of both classes, with macro and weighted means."""
    c = confusion(binary(df, y, pred), y, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("true_positives", "false_positives", "false_negatives", "true_negatives"))

    def one(name: str, hit: Column, wrong: Column, missed: Column) -> dict[str, Column]:
        return {
            "class": F.lit(name),
            "precision": safe_div(hit, hit + wrong, 0.0),
            "recall": safe_div(hit, hit + missed, 0.0),
            "f1": safe_div(2 * hit, 2 * hit + wrong + missed, 0.0),
            "support": hit + missed,
        }

    normal, fraud = one("Normal", tn, fn, fp), one("Fraud", tp, fp, fn)
    size = normal["support"] + fraud["support"]
    measures = ("precision", "recall", "f1")
    macro = {"class": F.lit("macro avg"), **{m: (normal[m] + fraud[m]) / 2 for m in measures}, "support": size}
    weighted = {
        "class": F.lit("weighted avg"),
        **{m: safe_div(normal[m] * normal["support"] + fraud[m] * fraud["support"], size, 0.0) for m in measures},
        "support": size,
    }
    rows = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in (normal, fraud, macro, weighted)]
    return c.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def sweep_counts(df: DataFrame, y: str, score: str, steps: int = 100, direction: str = "higher", amount: str | None = None) -> DataFrame:
    """Confusion counts at equally spaced thresholds from one pass over the rows.

    ``higher`` flags score > threshold, ``lower`` flags score < threshold. The rows are reduced to
    at most ``steps + 1`` buckets; the running sums are over that small frame.
    """
    low, high = df.agg(F.min(F.col(score).cast("double")), F.max(F.col(score).cast("double"))).first()
    if low is None:
        raise ValueError("no scores")
    thresholds = [float(v) for v in np.linspace(low, high, steps)]
    higher = direction == "higher"
    rows = df.where(F.col(score).isNotNull())
    tagged = ranking.count_below(rows, score, thresholds, "_b", strict=higher)
    money = F.col(amount).cast("double") if amount else F.lit(0.0)
    pos = (F.col(y) == 1).cast("long")
    buckets = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.sum(pos).alias("p"), F.sum(money * pos).alias("m"))
    # flagged at threshold i: buckets above i (higher) or up to i (lower)
    grid = df.sparkSession.createDataFrame([(i, t) for i, t in enumerate(thresholds)], "step long, threshold double")
    key = F.col("step") + 1 if higher else F.col("step")
    joined = grid.withColumn("_b", key).join(F.broadcast(buckets), "_b", "left")
    order = Window.orderBy(F.desc("step") if higher else F.asc("step")).rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0))
    totals = buckets.agg(F.sum("n").alias("rows"), F.sum("p").alias("positives"), F.sum("m").alias("total_money")).withColumn("_one", F.lit(1))
    out = joined.select("step", "threshold", zero("n").alias("flagged"), zero("p").alias("tp"), zero("m").alias("caught"), F.lit(1).alias("_one"))
    return out.join(F.broadcast(totals), "_one").drop("_one")


def threshold_metrics(df: DataFrame, y: str = "y", score: str = "score", steps: int = 100, direction: str = "higher") -> DataFrame:
    tp, flagged, positives = F.col("tp"), F.col("flagged"), F.col("positives")
    return sweep_counts(df, y, score, steps, direction).select(
        "step",
        "threshold",
        safe_div(tp, flagged, 0.0).alias("precision"),
        safe_div(tp, positives, 0.0).alias("recall"),
        safe_div(2 * tp, flagged + positives, 0.0).alias("f1"),
        safe_div(flagged, F.col("rows")).alias("flagged_rate"),
    )


def best_threshold(df: DataFrame, metric: str = "f1", y: str = "y", score: str = "score", steps: int = 100, direction: str = "lower") -> DataFrame:
    """The first of the equally spaced thresholds with the best metric."""
    if metric not in ("f1", "precision", "recall"):
        raise ValueError(f"unknown metric: {metric}")
    return threshold_metrics(df, y, score, steps, direction).orderBy(F.desc(metric), "step").limit(1)


def _money(caught: Column, missed: Column, total: Column, investigated: Column, cost: float, ratio: float) -> dict[str, Column]:
    spent = investigated * F.lit(float(cost))
    prevented = caught * F.lit(float(ratio))
    return {
        "caught_fraud_amount": caught,
        "missed_fraud_amount": missed,
        "total_fraud_amount": total,
        "fraud_detection_rate": caught / (total + 1e-10),
        "investigation_costs": spent,
        "fraud_loss": missed * F.lit(float(ratio)),
        "prevented_loss": prevented,
        "net_savings": prevented - spent,
        "roi": (prevented - spent) / (spent + 1e-10),
    }


def business_metrics(df: DataFrame, y: str = "y", pred: str = "pred", amount: str = "amount", investigation_cost: float = 10.0, fraud_cost_ratio: float = 1.0) -> DataFrame:
    df = binary(df, y, pred)
    a, p, x = F.col(y) == 1, F.col(pred) == 1, F.col(amount).cast("double")
    zero = F.lit(0.0)
    sums = df.agg(
        F.coalesce(F.sum(F.when(a & p, x)), zero).alias("c"),
        F.coalesce(F.sum(F.when(a & ~p, x)), zero).alias("m"),
        F.coalesce(F.sum(F.when(a, x)), zero).alias("t"),
        F.count_if(p).cast("double").alias("k"),
    )
    return sums.select(*[v.alias(k) for k, v in _money(F.col("c"), F.col("m"), F.col("t"), F.col("k"), investigation_cost, fraud_cost_ratio).items()])


def best_business_threshold(df: DataFrame, y: str = "y", score: str = "score", amount: str = "amount", investigation_cost: float = 10.0, fraud_cost_ratio: float = 1.0, steps: int = 100) -> DataFrame:
    """The first threshold with the highest net savings, and its money figures."""
    s = sweep_counts(binary(df, y), y, score, steps, "higher", amount)
    caught, total = F.col("caught").cast("double"), F.col("total_money").cast("double")
    money = _money(caught, total - caught, total, F.col("flagged").cast("double"), investigation_cost, fraud_cost_ratio)
    return s.select("step", "threshold", *[v.alias(k) for k, v in money.items()]).orderBy(F.desc("net_savings"), "step").limit(1)
