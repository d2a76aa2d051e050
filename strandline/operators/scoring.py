"""Opaque scoring functions at one boundary: a frame and input columns in, score columns out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Makes a scorer for one Python worker (loads the model there), which takes a list of values.
Factory = Callable[[], Callable[[list], list]]


def batch_scorer(factory: Factory, kind: str = "double", batch: int = 32):
    """Iterator UDF over one column: the model is made once for each task and gets ``batch`` values at a time."""

    @F.pandas_udf(kind)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for part in parts:
            values = part.tolist()
            out: list = []
            for at in range(0, len(values), batch):
                out += list(model(values[at : at + batch]))
            yield pd.Series(out, dtype=object if kind.startswith("array") else None)

    return score


def embedded(df: DataFrame, id_col: str, value: Column, factory: Factory, rows_per_task: int = 50_000, rows: int | None = None) -> DataFrame:
    """(id, embedding) of each row, range-partitioned by id into tasks of about ``rows_per_task`` rows."""
    from strandline.operators.relational import range_partitions

    spread = range_partitions(df.select(id_col, value.alias("__value")), id_col, rows, rows_per_task)
    return spread.select(id_col, batch_scorer(factory, "array<float>")("__value").alias("embedding"))


def _isolated(factory: Factory):
    """Struct of score and error for each value, so that a failure stays with its value."""

    @F.pandas_udf("score double, error string")
    def score(values: pd.Series) -> pd.DataFrame:
        try:
            model = factory()
        except Exception as error:
            return pd.DataFrame({"score": [float("nan")] * len(values), "error": [str(error)] * len(values)})
        rows = []
        for v in values:
            try:
                rows.append((float(model([v])[0]), None))
            except Exception as error:
                rows.append((float("nan"), str(error)))
        return pd.DataFrame(rows, columns=["score", "error"])

    return score


def score_axes(df: DataFrame, value: str, factories: Mapping[str, Factory]) -> DataFrame:
    """One column for each scorer and <name>_error; where a scorer fails its score is null and the rest go on."""
    out = df
    for name, factory in factories.items():
        made = _isolated(factory)
        out = out.withColumn(f"__{name}", made(value))
        out = out.withColumns({name: F.when(~F.isnan(f"__{name}.score"), F.col(f"__{name}.score")), f"{name}_error": F.col(f"__{name}.error")}).drop(f"__{name}")
    return out


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Frame by frame, with whatever the function closes over."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(run, schema)


def call_styles(rows: Sequence[Mapping], style: str) -> dict:
    """Payload of a call: records, plain inputs of the first column, or a split table."""
    rows = [dict(r) for r in rows]
    if style == "records":
        return {"dataframe_records": rows}
    columns = list(rows[0]) if rows else []
    if style == "inputs":
        return {"inputs": [r[columns[0]] for r in rows]}
    return {"dataframe_split": {"columns": columns, "data": [[r[c] for c in columns] for r in rows]}}


def first_column(prediction: object) -> list:
    """Predictions as a list: arrays by their first column, texts as one."""
    if isinstance(prediction, str):
        return [prediction]
    array = np.asarray(prediction)
    return array[:, 0].tolist() if array.ndim == 2 else array.tolist()


def burden(kmers: Column, score: Callable[[Column], Column], strong: float = 0.5) -> tuple[Column, Column]:
    """Strong k-mers over the sequence's k-mers, and the greatest score; 0 for none."""
    scores = F.transform(kmers, score)
    hits = F.size(F.filter(scores, lambda s: s >= strong))
    return F.when(F.size(kmers) > 0, hits / F.size(kmers)).otherwise(0.0), F.coalesce(F.array_max(scores), F.lit(0.0))


def screen(df: DataFrame, value: str, factories: Mapping[str, Factory], enabled: Sequence[str] | None = None) -> DataFrame:
    """Scores of the enabled predictors, with the names of those that failed in ``failed``."""
    chosen = {n: f for n, f in factories.items() if enabled is None or n in enabled}
    scored = score_axes(df, value, chosen)
    failed = F.filter(F.array(*[F.when(F.col(f"{n}_error").isNotNull(), n) for n in chosen]), lambda x: x.isNotNull())
    return scored.withColumn("failed", failed if chosen else F.array().cast("array<string>")).drop(*[f"{n}_error" for n in chosen])


def chained(df: DataFrame, value: str, steps: Sequence[tuple[str, Factory, str]]) -> DataFrame:
    """Each step's scorer reads the column of the step before: (name, factory, type) adds the column ``name``."""
    for name, factory, kind in steps:
        df = df.withColumn(name, batch_scorer(factory, kind)(value))
        value = name
    return df
