"""Calling a model from Spark: partitions sized to the work, failures kept per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def spread(companies: DataFrame, num_partitions: int) -> DataFrame:
    """Even partitions ahead of a slow per-row step, no more of them than there are rows.
    Round-robin: the work is per row, so equal names need not meet and cannot pile up."""
    probe = companies.limit(num_partitions).count()  # reads at most num_partitions rows
    return companies.repartition(max(1, min(num_partitions, probe)))


def score_batch(df: DataFrame, setup: Callable[[], Callable[[dict], dict]],
                schema: T.StructType, key: str = "company",
                error_chars: int = 500) -> DataFrame:
    """Run a per-row function over a table; a row that raises becomes a row of defaults with
    the message in `error`.

    `setup` is called once per partition and returns the function, so that clients and models
    are built where they are used. `schema` describes the function's output without the key.
    """
    fields = [f for f in schema.fields if f.name != key]
    zero = {"string": "", "boolean": False, "integer": 0, "long": 0, "double": 0.0}
    defaults = {f.name: zero.get(f.dataType.typeName()) for f in fields}
    names = [f.name for f in fields]
    full = T.StructType([T.StructField(key, df.schema[key].dataType, False), *fields,
                         T.StructField("error", T.StringType(), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = setup()
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                try:
                    got = call(record)
                    row = {n: got.get(n, defaults[n]) for n in names}
                    row["error"] = None
                except Exception as exc:  # any failure is this row's own
                    row = dict(defaults, error=str(exc)[:error_chars])
                rows.append({key: record[key], **row})
            yield pd.DataFrame(rows, columns=[key, *names, "error"])

    return df.mapInPandas(run, full)
