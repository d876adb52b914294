"""Exact metrics and curves over a scored table ``id, label, prob, prediction``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import CLASS_LABELS
from ..functions.numeric import half_up, ratio
from ..plans.ordering import ROW_LIMIT, running_totals

_CELLS = (("TN", 0, 0), ("FP", 0, 1), ("FN", 1, 0), ("TP", 1, 1))


def _counts() -> list[Column]:
    return [
        F.count_if((F.col("label") == actual) & (F.col("prediction") == predicted)).alias(name.lower())
        for name, actual, predicted in _CELLS
    ]


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Four rows, always present: ``cell, actual, predicted, n``."""
    rows = [
        F.struct(
            F.lit(name).alias("cell"),
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.col(name.lower()).alias("n"),
        )
        for name, actual, predicted in _CELLS
    ]
    return scored.agg(*_counts()).select(F.inline(F.array(*rows)))


def confusion_square(scored: DataFrame) -> DataFrame:
    """The same counts as a 2x2 table."""
    rows = [
        F.struct(F.lit("Actual " + CLASS_LABELS[1]).alias("row"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit("Actual " + CLASS_LABELS[0]).alias("row"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    ]
    return scored.agg(*_counts()).select(F.inline(F.array(*rows)))


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """precision, recall, F1 with 0/0 = 0."""
    return _zero(ratio(tp, tp + fp)), _zero(ratio(tp, tp + fn)), _zero(ratio(2 * tp, 2 * tp + fp + fn))


def binary_metrics(scored: DataFrame, digits: int = 6) -> DataFrame:
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return scored.agg(*_counts()).select(
        half_up(precision, digits).alias("precision"),
        half_up(recall, digits).alias("recall"),
        half_up(f1, digits).alias("f1"),
    )


def score_table(
    scored: DataFrame, by: list[str] | None = None, limit: int = ROW_LIMIT, range_col: str | None = None
) -> DataFrame:
    """One row per distinct score: ``[by,] prob, p, f, hit_p, hit_f, cum_p, cum_f``.

    ``p`` and ``f`` count the positive and negative rows, ``hit_`` those predicted positive, ``cum_``
    runs from the highest score.

    Rows are counted per score before anything is ordered, so tied scores cost one row. Rows whose score
    is null or NaN have no place in an order and are left out, here and in everything built on this table.
    """
    by = by or []
    known = scored.where(F.col("prob").isNotNull() & ~F.isnan("prob"))
    per_score = known.groupBy(*by, "prob").agg(
        F.count_if(F.col("label") == 1).alias("p"),
        F.count_if(F.col("label") == 0).alias("f"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("hit_p"),
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 1)).alias("hit_f"),
    )
    return running_totals(per_score, "prob", ["p", "f"], by=by, descending=True, limit=limit, range_col=range_col)


def _areas() -> list[Column]:
    """ROC area and average precision, from ``score_table`` rows."""
    p, f, cp, cf = (F.col(c).cast("double") for c in ("p", "f", "cum_p", "cum_f"))
    total_p, total_f = F.sum(p), F.sum(f)
    wins = F.sum(f * (cp - p / 2))
    steps = F.sum(p * F.try_divide(cp, cp + cf))
    return [
        F.try_divide(wins, total_p * total_f).alias("roc_auc"),
        F.try_divide(steps, total_p).alias("average_precision"),
    ]


def roc_auc(scored: DataFrame, digits: int = 6, limit: int = ROW_LIMIT, table: DataFrame | None = None) -> DataFrame:
    """Exact area; null when a class is missing. ``table`` is a score table made before, here and below."""
    table = score_table(scored, limit=limit) if table is None else table
    return table.agg(*_areas()).select(half_up(F.col("roc_auc"), digits).alias("roc_auc"))


def average_precision(
    scored: DataFrame, digits: int = 6, limit: int = ROW_LIMIT, table: DataFrame | None = None
) -> DataFrame:
    """Sum of recall steps times precision."""
    table = score_table(scored, limit=limit) if table is None else table
    return table.agg(*_areas()).select(
        half_up(F.col("average_precision"), digits).alias("average_precision")
    )


def _totals(table: DataFrame) -> tuple[Column, Column]:
    """All positives and negatives, from ``score_table`` rows."""
    both = table.agg(F.struct(F.sum("p").alias("p"), F.sum("f").alias("f"))).scalar()
    return both["p"], both["f"]


def _thinned(table: DataFrame, x: Column, y: Column, max_points: int | None, steps: bool) -> DataFrame:
    """At most ``max_points`` rows of a curve over ``prob``, with an error of at most 1 / cells in x and in y.

    A curve whose x and y both grow (``steps``) passes through at most 2 * cells - 1 squares of a grid with ``cells`` on a
    side, and the first and last point of each are kept. Other curves keep, of each of ``cells`` strips in x, the first
    and last point and those with the least and greatest y. Rows are combined before the shuffle.
    """
    if max_points is None:
        return table
    if max_points < 4:
        raise ValueError("a curve needs room for four points")
    cells = max_points // 4
    at = lambda v: F.least(F.floor(F.coalesce(v, F.lit(0.0)) * cells), F.lit(cells - 1))
    row = F.struct(*table.columns)
    ends = [F.min_by(row, "prob"), F.max_by(row, "prob")]
    if not steps:
        ends += [F.min_by(row, F.struct(y, "prob")), F.max_by(row, F.struct(y, "prob"))]
    placed = table.withColumns({"_x": at(x), "_y": at(y) if steps else F.lit(0)})
    kept = placed.groupBy("_x", "_y").agg(F.array_distinct(F.array(*ends)).alias("_kept"))
    return kept.select(F.inline("_kept"))


def roc_curve(
    scored: DataFrame,
    digits: int = 9,
    drop_collinear: bool = False,
    limit: int = ROW_LIMIT,
    table: DataFrame | None = None,
    max_points: int | None = None,
) -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score, highest first, after the origin (threshold null).

    With ``max_points`` there are at most as many besides the origin, and every point left out is within
    1 / (max_points // 4) of a point that stays, in either direction.
    """
    table = score_table(scored, limit=limit, range_col="_range") if table is None else table
    all_p, all_f = _totals(table)
    if drop_collinear:
        # A point inside a straight run goes: the step after it equals the step into it. The step after
        # the last point of a key range is the first of the next range (one row for each range).
        order = Window.partitionBy("_range").orderBy(F.desc("prob"))
        ranges = Window.orderBy(F.desc("_range"))
        heads = table.groupBy("_range").agg(F.max_by(F.struct("p", "f"), "prob").alias("_head"))
        heads = heads.select(
            "_range", F.lead("_head").over(ranges).alias("_after"), (F.row_number().over(ranges) == 1).alias("_top")
        )
        table = table.join(F.broadcast(heads), "_range").withColumns(
            {
                "_first": F.col("_top") & F.lag("p").over(order).isNull(),
                "_p": F.coalesce(F.lead("p").over(order), F.col("_after.p")),
                "_f": F.coalesce(F.lead("f").over(order), F.col("_after.f")),
            }
        ).where(F.col("_first") | F.col("_p").isNull() | (F.col("_p") != F.col("p")) | (F.col("_f") != F.col("f")))
    fpr, tpr = ratio(F.col("cum_f"), all_f), ratio(F.col("cum_p"), all_p)
    points = _thinned(table, fpr, tpr, max_points, steps=True).select(
        F.col("prob").alias("threshold"),
        half_up(ratio(F.col("cum_f"), all_f), digits).alias("fpr"),
        half_up(ratio(F.col("cum_p"), all_p), digits).alias("tpr"),
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points).orderBy(F.desc_nulls_first("threshold"))


def pr_curve(
    scored: DataFrame,
    digits: int = 9,
    limit: int = ROW_LIMIT,
    table: DataFrame | None = None,
    max_points: int | None = None,
) -> DataFrame:
    """``threshold, precision, recall`` per distinct score, lowest first, before the end point (1, 0).

    With ``max_points`` there are at most as many besides the end point: every point left out has a recall within
    1 / (max_points // 4) of points that stay, and a precision between theirs.
    """
    table = score_table(scored, limit=limit) if table is None else table
    all_p, _ = _totals(table)
    precision = ratio(F.col("cum_p"), F.col("cum_p") + F.col("cum_f"))
    points = _thinned(table, ratio(F.col("cum_p"), all_p), precision, max_points, steps=False).select(
        F.col("prob").alias("threshold"),
        half_up(ratio(F.col("cum_p"), F.col("cum_p") + F.col("cum_f")), digits).alias("precision"),
        half_up(ratio(F.col("cum_p"), all_p), digits).alias("recall"),
    )
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end).orderBy(F.asc_nulls_last("threshold"))


def no_skill_baseline(scored: DataFrame, digits: int = 6) -> DataFrame:
    return scored.agg(half_up(F.avg("label"), digits).alias("no_skill_precision"))


def classification_report(scored: DataFrame, names: tuple[str, str] = (CLASS_LABELS[1], CLASS_LABELS[0]), digits: int = 6) -> DataFrame:
    """Per class, accuracy, macro and weighted averages; accuracy has only the F1 column filled."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    neg, pos = _prf(tn, fn, fp), _prf(tp, fp, fn)
    macro = [(a + b) / 2 for a, b in zip(neg, pos)]
    weighted = [_zero(ratio(a * n0 + b * n1, total)) for a, b in zip(neg, pos)]
    accuracy = ratio(tp + tn, total)
    missing = F.lit(None).cast("double")

    def line(name: str, values, support: Column):
        cells = [half_up(v, digits).alias(c) for v, c in zip(values, ("precision", "recall", "f1"))]
        return F.struct(F.lit(name).alias("class_name"), *cells, support.alias("support"))

    rows = [
        line(names[0], neg, n0),
        line(names[1], pos, n1),
        line("accuracy", [missing, missing, accuracy], total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    ]
    return scored.agg(*_counts()).select(F.inline(F.array(*rows)))


def model_metrics(scored: DataFrame, digits: int | None = None, limit: int = ROW_LIMIT) -> DataFrame:
    """``name, position, roc_auc, recall, precision, f1`` per model of a long scored table."""
    by = ["model", "position"]
    table = score_table(scored, by, limit).groupBy(*by).agg(
        *_areas(),
        F.sum("hit_p").alias("tp"),
        F.sum("hit_f").alias("fp"),
        F.sum(F.col("p") - F.col("hit_p")).alias("fn"),
    )
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    metrics = {"roc_auc": F.col("roc_auc"), "recall": recall, "precision": precision, "f1": f1}
    return table.select(
        F.col("model").alias("name"),
        "position",
        *[(c if digits is None else half_up(c, digits)).alias(n) for n, c in metrics.items()],
    )


def model_comparison(scored: DataFrame, base: str | None = None, digits: int = 6) -> DataFrame:
    """Metric table, with the recall gain in percent over the model named ``base``."""
    metrics = model_metrics(scored)
    gain = F.lit(None).cast("double")
    if base is not None:
        base_recall = F.max(F.when(F.col("name") == base, F.col("recall"))).over(Window.partitionBy())
        gain = F.try_divide(F.col("recall") - base_recall, base_recall) * 100
    rounded = [half_up(F.col(c), digits).alias(c) for c in ("roc_auc", "recall", "precision", "f1")]
    table = metrics.select("name", "position", *rounded, half_up(gain, digits).alias("recall_gain_pct"))
    return table.orderBy("position")


def flag_best(metrics: DataFrame) -> DataFrame:
    """Add ``is_best``: the highest ROC area, the first listed on a tie."""
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("roc_auc"), "position"))
    return metrics.withColumn("is_best", place == 1)


def best_model(scored: DataFrame, digits: int = 6) -> DataFrame:
    best = model_metrics(scored).orderBy(F.desc("roc_auc"), "position").limit(1)
    return best.select("name", *[half_up(F.col(c), digits).alias(c) for c in ("roc_auc", "recall", "precision", "f1")])


def union_models(tables: dict[str, DataFrame]) -> DataFrame:
    """Scored tables of several models in long form, in the given order."""
    named = [
        t.select(F.lit(name).alias("model"), F.lit(i).alias("position"), "id", "label", "prob", "prediction")
        for i, (name, t) in enumerate(tables.items(), start=1)
    ]
    return reduce(DataFrame.unionByName, named)
