"""Class reports from label/prediction rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 per class and accuracy in one grouped pass; 0 where undefined."""
    truth, guess = F.col(label), F.col(prediction)
    sums = [F.count_if(truth == guess).alias("_hits"), F.count("*").alias("_n")]
    for c in CLASSES:
        sums += [
            F.count_if((truth == c) & (guess == c)).alias(f"_tp{c}"),
            F.count_if(guess == c).alias(f"_predicted{c}"),
            F.count_if(truth == c).alias(f"_actual{c}"),
        ]
    out = []
    for c in CLASSES:
        tp, predicted, actual = F.col(f"_tp{c}"), F.col(f"_predicted{c}"), F.col(f"_actual{c}")
        out += [
            _ratio(tp, predicted).alias(f"precision_{c}"),
            _ratio(tp, actual).alias(f"recall_{c}"),
            _ratio(tp * 2, predicted + actual).alias(f"f1_{c}"),
        ]
    return df.groupBy(*by).agg(*sums).select(*by, *out, _ratio(F.col("_hits"), F.col("_n")).alias("accuracy"))


def scoreboard(reports: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of split reports, 3 digits, halves to even."""
    scores = [c for c in reports.columns if c.startswith(("precision_", "recall_", "f1_")) or c == "accuracy"]
    return reports.groupBy(*by).agg(*[F.bround(F.avg(c), 3).alias(c) for c in scores])
