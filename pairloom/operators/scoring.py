"""How scores are attached to pairs.

A score comes from (a) a table that already holds it, (b) a Column expression, (c) a function over
pandas batches, or (d) a model.  All but the first never move rows between tasks.

A model is loaded once per Python worker, however many tasks and queries that worker serves, and only
where there is something to score.  It is called with batches of its own size, whose texts are of
similar length; equal inputs are scored once a batch of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.model import columns_except
from pairloom.operators.joins import lookup_join

ScoreTable = DataFrame
BatchScorer = Callable[..., pd.Series]


@dataclass(frozen=True)
class Model:
    """``load`` gives a function from a list of texts per input to a list of scores, one per text.

    ``name`` tells models apart: a worker that has loaded the name does not load it again.
    """

    name: str
    load: Callable[[], Callable[..., Sequence]]
    batch_size: int = 32


_loaded: dict[str, Callable[..., Sequence]] = {}  # of this Python worker


def _ready(model: Model) -> Callable[..., Sequence]:
    if model.name not in _loaded:
        _loaded[model.name] = model.load()
    return _loaded[model.name]


def batches_by_length(sizes: np.ndarray, batch_size: int) -> Iterator[np.ndarray]:
    """Places of rows in batches of similar sizes, the largest first: too large a batch shows at once."""
    order = np.argsort(-sizes, kind="stable")
    yield from (order[at:at + batch_size] for at in range(0, len(order), batch_size))


def _scored(model: Model, columns: Sequence[pa.Array], kind: pa.DataType) -> pa.Array:
    """Scores of the rows in which no input is null; the others get null."""
    rows = pa.table(list(columns), [str(i) for i in range(len(columns))])
    numbered = rows.append_column("row", pa.array(np.arange(len(rows)))).drop_null()
    if not len(numbered):
        return pa.nulls(len(rows), kind)
    keys = numbered.column_names[:-1]
    distinct = numbered.group_by(keys, use_threads=False).aggregate([("row", "min")])
    score = _ready(model)
    sizes = sum(pc.binary_length(distinct[k].cast(pa.string())).to_numpy().astype(np.int64) for k in keys)
    found: list = [None] * len(distinct)
    texts = [distinct[k].to_pylist() for k in keys]
    for batch in batches_by_length(sizes, model.batch_size):
        given = score(*[[t[i] for i in batch] for t in texts])
        if len(given) != len(batch):
            raise ValueError(f"model {model.name} gave {len(given)} scores for {len(batch)} texts")
        for i, value in zip(batch, given, strict=True):
            found[i] = value
    scores = distinct.select(keys).append_column("score", pa.array(found, kind))
    joined = numbered.join(scores.append_column("place", pa.array(np.arange(len(scores)))).drop_columns(["score"]), keys, use_threads=False)
    places = np.full(len(rows), -1)
    places[joined["row"].to_numpy()] = joined["place"].to_numpy()
    taken = pa.array(places, mask=places < 0)
    return scores["score"].combine_chunks().take(taken)


def model_column(models: Model | Mapping[str, Model], inputs: Sequence[Column | str], returns: str = "double",
                 family: Column | str | None = None) -> Column:
    """Scores of ``inputs``; with several models, that of the one named by ``family``, and null for rows that
    name none.  Each family has its own batch size, and is loaded where it is met."""
    by_family = {"": models} if isinstance(models, Model) else dict(models)
    kind = pa.list_(pa.float32()) if returns == "array<float>" else {"double": pa.float64(), "string": pa.string(), "bigint": pa.int64()}[returns]

    @F.arrow_udf(returns)
    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for named, *columns in batches:
            parts, places = [pa.array([], kind)], [np.empty(0, np.int64)]
            for name, model in by_family.items():
                own = np.flatnonzero(pc.fill_null(pc.equal(named, name), False).to_numpy(zero_copy_only=False))
                if len(own):
                    parts.append(_scored(model, [c.take(pa.array(own)) for c in columns], kind))
                    places.append(own)
            at = np.full(len(named), -1)
            known = np.concatenate(places)
            at[known] = np.arange(len(known))
            yield pa.concat_arrays(parts).take(pa.array(at, mask=at < 0))

    return score(F.lit("") if family is None else family, *inputs)


def attach_score(
    df: DataFrame,
    name: str,
    scorer: Column | ScoreTable | BatchScorer | Model | Mapping[str, Model],
    on: str = "pair_id",
    inputs: tuple[str, ...] = ("src", "tgt"),
    returns: str = "double",
    family: str = "encoder",
) -> DataFrame:
    """``df`` plus a column ``name``.

    A score table holds ``on`` and one score column, at most one row per key; rows it does
    not know get a null score.  A batch scorer is called with one pandas Series per input;
    the batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.  Of several models each
    scores the rows whose column ``family`` names it.
    """
    if isinstance(scorer, DataFrame):
        (column,) = columns_except(scorer, on)
        # Many pairs may share one key (a document, a text): no task gets them all.
        scores = scorer.select(F.col(on).alias("score_key"), F.col(column).alias(name))
        return lookup_join(df, scores, on, "score_key", "left")
    if isinstance(scorer, Column):
        return df.withColumn(name, scorer)
    if isinstance(scorer, Model):
        return df.withColumn(name, model_column(scorer, inputs, returns))
    if isinstance(scorer, Mapping):
        return df.withColumn(name, model_column(scorer, inputs, returns, family))
    return df.withColumn(name, F.pandas_udf(scorer, returns)(*inputs))
