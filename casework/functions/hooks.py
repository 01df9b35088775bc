"""User hooks: tokenisers, embedders, re-rankers, generators. They run as Arrow batches in the tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions.text import terms


#: Characters of the texts whose tokens a task holds at a time.
TOKENISED_CHARS = 1 << 20


def _of_known(values: pd.Series, fn: Callable[[list], Sequence]) -> list:
    """``fn`` of the non-null values as one list; null stays null."""
    known = values.notna()
    got = list(fn(values[known].tolist())) if known.any() else []
    if len(got) != int(known.sum()):
        raise ValueError(f"the hook gave {len(got)} results for {int(known.sum())} inputs")
    out = [None] * len(values)
    for i, v in zip(known.to_numpy().nonzero()[0], got):
        out[i] = v
    return out


def _slices(texts: pd.Series, chars: int) -> Iterator[pd.Series]:
    """Consecutive parts of at most so many characters, or of one longer text."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        size = 0 if t is None else len(t)
        if i > first and held + size > chars:
            yield texts.iloc[first:i]
            first, held = i, 0
        held += size
    yield texts.iloc[first:]


def register_tokeniser(fn: Callable, batched: bool = False) -> Callable[[Column], Column]:
    """Text → tokens, for chunking and keyword search instead of whitespace tokens.

    ``fn`` takes one text, or with ``batched`` some texts of an Arrow batch and gives a list of token lists.
    A task holds the tokens of about ``TOKENISED_CHARS`` characters, or of one longer text, at a time.
    """
    many = fn if batched else lambda texts: [fn(t) for t in texts]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def tokenise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for part in _slices(texts, TOKENISED_CHARS):
                yield pd.Series([None if t is None else list(t) for t in _of_known(part, many)], index=part.index, dtype=object)

    return tokenise


def register_reranker(fn: Callable, batched: bool = False) -> Callable[[Column, Column], Column]:
    """Question and text → score between 0 and 4; null where either is null.

    ``fn`` takes a question and a text, or with ``batched`` a list of such pairs and gives a list of scores.
    """
    many = fn if batched else lambda pairs: [fn(q, t) for q, t in pairs]

    @F.pandas_udf("double")
    def score(questions: pd.Series, texts: pd.Series) -> pd.Series:
        pairs = pd.Series([None if q is None or t is None else (q, t) for q, t in zip(questions, texts)], dtype=object)
        return pd.Series([None if s is None else min(4.0, max(0.0, float(s))) for s in _of_known(pairs, many)], dtype="float64")

    return score


def _attempts(call: Callable, tries: int, wait: float):
    """Result or error text of a call tried a bounded number of times."""
    for attempt in range(tries):
        try:
            return call(), None
        except Exception as failure:  # kept as a row, the job goes on
            error = str(failure) or type(failure).__name__
            if attempt + 1 < tries:
                time.sleep(min(10.0, wait * 2**attempt))
    return None, error


def _apply(df: DataFrame, text: str, out: T.DataType, name: str, fn, batch: int, tries: int, wait: float) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField(name, out), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values: list = []
            errors: list = []
            for start in range(0, len(frame), batch):
                texts = frame[text].iloc[start : start + batch].tolist()
                result, error = _attempts(lambda: list(fn(texts)), tries, wait)
                if error is None and len(result) != len(texts):
                    result, error = None, f"{len(texts)} texts gave {len(result)} results"
                values += list(result) if error is None else [None] * len(texts)
                errors += [error] * len(texts)
            yield frame.assign(**{name: pd.Series(values, index=frame.index, dtype=object), "error": errors})

    return df.mapInPandas(run, schema)


def hashed_vectors(df: DataFrame, text: str = "content", dim: int = 256) -> DataFrame:
    """Default embedding, in the JVM: hashed term counts scaled to unit length."""
    hashed = HashingTF(inputCol="__terms", outputCol="__tf", numFeatures=dim).transform(
        df.withColumn("__terms", terms(F.coalesce(F.col(text), F.lit(""))))
    )
    unit = Normalizer(inputCol="__tf", outputCol="__unit", p=2.0).transform(hashed)
    return unit.withColumns(
        {"content_vector": vector_to_array("__unit", "float32"), "error": F.lit(None).cast("string")}
    ).drop("__terms", "__tf", "__unit")


def embed(
    df: DataFrame,
    text: str = "content",
    fn: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
    batch: int = 100,
    tries: int = 3,
    wait: float = 2.0,
) -> DataFrame:
    """Add ``content_vector`` and ``error``.

    ``fn`` gets batches of at most ``batch`` texts in input order and is tried up to ``tries``
    times; a batch that keeps failing stays as rows with a null vector and its error.
    Without ``fn`` the hashed term vector is used.
    """
    if fn is None:
        return hashed_vectors(df, text)
    return _apply(df, text, T.ArrayType(T.FloatType()), "content_vector", fn, batch, tries, wait)


def generate(
    df: DataFrame,
    fn: Callable[[list[str]], Sequence[str]],
    prompt: str = "prompt",
    batch: int = 20,
    tries: int = 3,
    wait: float = 2.0,
) -> DataFrame:
    """Add ``answer`` and ``error`` from a supplied model function, with the same retry rule."""
    return _apply(df, prompt, T.StringType(), "answer", fn, batch, tries, wait)


#: Name kept for symmetry with the other hooks: ``register_embedder(fn)(df)``.
def register_embedder(fn, **options) -> Callable[[DataFrame], DataFrame]:
    return lambda df, text="content": embed(df, text, fn, **options)


def register_generator(fn, **options) -> Callable[[DataFrame], DataFrame]:
    return lambda df, prompt="prompt": generate(df, fn, prompt, **options)
