"""Evaluation measures. Each is one aggregate; undefined ratios are 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def binary_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall and F1 of 0/1 columns."""
    actual, predicted = F.col(y) == 1, F.col(p) == 1
    counts = _grouped(df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()), by).agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    return with_ratios(counts)


def with_ratios(counts: DataFrame) -> DataFrame:
    """Add the four ratios to a table that has tp, fp, fn and tn."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion(df: DataFrame, y: str, p: str, labels: Sequence = (0, 1)) -> DataFrame:
    """Dense ``(actual, predicted, n)`` over the given labels, from one aggregate."""
    cells = [(a, b) for a in labels for b in labels]
    row = df.agg(
        *[F.count_if((F.col(y) == a) & (F.col(p) == b)).alias(f"c{i}") for i, (a, b) in enumerate(cells)]
    )
    structs = [
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{i}").alias("n"))
        for i, (a, b) in enumerate(cells)
    ]
    return row.select(F.explode(F.array(*structs)).alias("cell")).select("cell.*")


def class_report(df: DataFrame, y: str, p: str, labels: Sequence = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows."""
    row = df.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(y) == F.col(p)).alias("hits"),
        *[F.count_if((F.col(y) == c) & (F.col(p) == c)).alias(f"tp{i}") for i, c in enumerate(labels)],
        *[F.count_if(F.col(y) == c).alias(f"act{i}") for i, c in enumerate(labels)],
        *[F.count_if(F.col(p) == c).alias(f"pred{i}") for i, c in enumerate(labels)],
    )
    k = range(len(labels))
    measures = {
        "precision": [_ratio(F.col(f"tp{i}"), F.col(f"pred{i}")) for i in k],
        "recall": [_ratio(F.col(f"tp{i}"), F.col(f"act{i}")) for i in k],
        "f1": [_ratio(2 * F.col(f"tp{i}"), F.col(f"pred{i}") + F.col(f"act{i}")) for i in k],
    }
    support = [F.col(f"act{i}") for i in k]

    def line(name: str, values: dict[str, Column], n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"), *[values[m].alias(m) for m in measures], n.cast("bigint").alias("support")
        )

    accuracy = _ratio(F.col("hits"), F.col("n"))
    lines = [line(str(c), {m: v[i] for m, v in measures.items()}, support[i]) for i, c in enumerate(labels)]
    lines.append(line("accuracy", dict.fromkeys(measures, accuracy), F.col("n")))
    lines.append(line("macro avg", {m: sum(v) / len(labels) for m, v in measures.items()}, F.col("n")))
    weighted = {m: _ratio(sum(x * s for x, s in zip(v, support)), F.col("n")) for m, v in measures.items()}
    lines.append(line("weighted avg", weighted, F.col("n")))
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def regression_error(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(y).cast("double") - F.col(p).cast("double")
    return _grouped(df, by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.count(error).alias("n")
    )


def compare_models(df: DataFrame, y: str, p: str, model: str = "model") -> DataFrame:
    """One row of the four scores per model, from predictions stacked in long form."""
    scores = binary_metrics(df, y, p, by=[model])
    return scores.select(
        F.col(model).alias("Model"),
        F.col("accuracy").alias("Accuracy"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("f1").alias("F1-Score"),
    )
