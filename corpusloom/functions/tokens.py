"""Token counters for chunking: words as built-in expression, or a byte-pair vocabulary in an Arrow UDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

_loaded: dict = {}


def _counter(path: str | None, text: str | None):
    """A vocabulary, once for a worker process."""
    if (path, text) not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path, text] = Tokenizer.from_file(path) if text is None else Tokenizer.from_str(text)
    return _loaded[path, text]


def vocabulary_counter(path: str | None = None, text: str | None = None) -> Callable[[Column], Column]:
    """Counts the ids of a text, without special ones, by a vocabulary: a file that every node can read, or
    the ``text`` of one, which is sent along."""
    if (path is None) == (text is None):
        raise ValueError("either a path or a text")

    @F.pandas_udf(LongType())
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            got = _counter(path, text).encode_batch_fast(texts.fillna("").tolist(), add_special_tokens=False)
            yield pd.Series([len(g.ids) for g in got], dtype="int64")

    return lambda c: count(c)
