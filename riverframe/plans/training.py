"""From a feature table to scaled, split sequences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.operators.scaling import apply_scaler, fit_scaler
from riverframe.operators.select import require_columns
from riverframe.operators.settle import settle
from riverframe.operators.ordered import DAILY
from riverframe.operators.sequences import chrono_split, sequence_counts, sequences


@dataclass(frozen=True)
class TrainingSet:
    rows: DataFrame
    sequences: DataFrame
    scaler: DataFrame
    counts: DataFrame


def make_training_set(
    table: DataFrame,
    features: Sequence[str],
    target: str = "river_discharge_m3s",
    keys: Sequence[str] = ("location",),
    ts: str = "date",
    n: int = 14,
    ratios: Sequence[float] = (0.8, 0.2),
    mode: str = "per_key",
    history: tuple[str, str] | None = ("data_type", "historical"),
    rounding: str = "floor",
    fit_on_train: bool = False,
    settled: bool = False,
    chunk: int | None = DAILY,
    carry: Sequence[str] = (),
) -> TrainingSet:
    """Complete historical rows, scaled, cut into sequences per key and split by time.

    ``fit_on_train`` fits the scaler on the oldest share of each key only. Unless ``settled``
    (``table`` is stored already), the rows are written once: the scaler, the counts and the
    sequences all read them. ``chunk=None`` is for a table of more than a row per key and day. Columns to ``carry`` (such as
    the place of a location's category) are put on each sequence as they are.
    """
    require_columns(table, [*keys, ts, target, *features, *([history[0]] if history else [])])
    rows = table.filter(F.col(history[0]) == history[1]) if history else table
    needed = list(dict.fromkeys([*keys, ts, target, *features]))
    rows = rows.select(*dict.fromkeys([*needed, *carry])).dropna(subset=needed)
    rows = rows if settled else settle(rows, "training")
    fit_rows = rows
    if fit_on_train:
        fit_rows = chrono_split(rows, keys, ts, ratios, rounding=rounding, chunk=chunk).filter(F.col("split") == "train")
    scaler = fit_scaler(fit_rows, features)
    # The label keeps its own scale, also where the target is one of the features.
    scaled = apply_scaler(rows.withColumn("__label", F.col(target)), scaler, features)
    cut = sequences(scaled, keys, ts, features, n, "__label", carry, chunk=chunk).withColumnRenamed("__label", target)
    return TrainingSet(rows, chrono_split(cut, keys, ts, ratios, mode, rounding, chunk=chunk), scaler, sequence_counts(rows, keys, n))


def training_metadata(
    training: TrainingSet, features: Sequence[str], target: str, n: int, key: str = "location", counts_map: bool = False
) -> DataFrame:
    """One row of counts. ``counts_map`` adds the per-key sequence counts as a map, for a handful
    of keys; otherwise write ``training.counts`` beside it."""
    split = training.sequences.agg(
        F.count("*").alias("total_sequences"),
        F.count_if(F.col("split") == "train").alias("train_sequences"),
        F.count_if(F.col("split") == "test").alias("test_sequences"),
    )
    row = split.select(
        F.lit(n).alias("sequence_length"),
        F.lit(target).alias("target_column"),
        F.lit(len(features)).alias("feature_count"),
        training.counts.agg(F.sum("n_rows").alias("n")).scalar().alias("rows_used"),
        "total_sequences", "train_sequences", "test_sequences",
    )
    if not counts_map:
        return row
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "n_sequences"))))
    return row.withColumn("location_sequence_counts", training.counts.agg(entries.alias("m")).scalar())
