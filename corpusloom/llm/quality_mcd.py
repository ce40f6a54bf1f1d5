"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Each text gives a vector of transformed statistics.  For every (lang, source) the minimum covariance
determinant estimate is found by concentration steps: distances from the present centre, the share
``CORE`` of nearest rows (a mergeable quantile, so a group of any size is never in one task), their
moments (plain sums), and again until the determinants of all groups have settled; of two deterministic
starts the one with the smaller determinant stays.  The covariance is scaled to the chi-square median,
re-estimated on the rows inside, and a text is rejected when its squared Mahalanobis distance passes the
``CUTOFF`` quantile.

Every group is judged by itself, however small: its estimate is regularised by that of its language over
all sources, which counts as ``PRIOR_ROWS`` more rows in the covariance and ``PRIOR_CENTRE`` in the
centre, so it fades as a group grows.  Only rows that pass the base rules take part in the estimates.  A
variance under ``LEAST_SPREAD`` is raised to it, so that a statistic that is nearly constant in a group
does not reject its first exception; others stay as they are.

Null languages and sources form groups of their own; null and empty texts have no words and fail the
base.  Repeated rows are judged one by one; rows at the same distance are taken or left together.  An
empty table gives an empty one.  A very long text is one row of a batch and costs its own size.  Columns
other than ``doc_id, lang, source, text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.common import forget, written

CORE = 0.75
MOST_STEPS = 8
SETTLED = 1e-3  # change of a log determinant
CUTOFF = 0.999
PRIOR_ROWS, PRIOR_CENTRE = 30, 5
LEAST_SPREAD = (0.0036, 0.04, 0.01, 0.01, 0.0025, 0.0025)
SYMBOLS = b"#*$%&|<>"  # fixed by the contract
P = len(LEAST_SPREAD)
FEATURES = [f"x{i}" for i in range(P)]

_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_digit = np.zeros(256, bool)
_digit[48:58] = True
_upper = np.zeros(256, bool)
_upper[65:91] = True


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter([index.setdefault(w, len(index)) for w in words], np.int64, n)
    size = len(index)
    pairs = ids[:-1] * size + ids[1:]
    _, pair = np.unique(pairs, return_inverse=True)
    _, where, count = np.unique(pair[:-1].astype(np.int64) * size + ids[2:], return_inverse=True, return_counts=True)
    many = count[where] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= many
    return int(hit.sum())


def statistics(text: bytes | None) -> tuple:
    """Base counts of one UTF-8 text and its vector of transformed statistics."""
    text = text or b""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    starts = (raw & 0xC0) != 0x80
    chars = int((starts & ~_space[raw]).sum())
    symbols = int(_symbol[raw].sum())
    seen: set[bytes] = set()
    dup = lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    n, repeated = len(words), repeat_words(words)
    some = max(n, 1)
    vector = (
        math.log(max(chars, 1) / some),
        math.log1p(100 * symbols / some),
        math.sqrt(dup / max(lines, 1)),
        math.sqrt(repeated / some),
        math.sqrt(float(_digit[raw].sum()) / max(chars, 1)),
        math.sqrt(float(_upper[raw].sum()) / max(chars, 1)),
    )
    return (n, chars, symbols, dup, repeated, *vector)


_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_STATS = _BASE + ", " + ", ".join(f"{x} double" for x in FEATURES)


def text_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns with the base counts and the statistic vector of every whole text."""
    inner = docs.select(*keep, F.col(text_col).cast("binary").alias("__text"))
    schema = StructType([*inner.schema.fields[:-1], *StructType.fromDDL(_STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        for batch in batches:
            rows = [statistics(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            made = [pa.array([r[i] for r in rows], pa.int64() if i < 5 else pa.float64()) for i in range(5 + P)]
            yield pa.RecordBatch.from_arrays(kept + made, names=names)

    return inner.mapInArrow(run, schema)


def chi2_quantile(q: float, p: int) -> float:
    """Wilson and Hilferty's approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(q)
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _moments() -> list:
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(FEATURES)]
    return [F.count("*").alias("n"), *sums, *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}_{j}") for i, j in _PAIRS]]


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_PARAMS = "lang string, source string, start int, logdet double, scale double, " + ", ".join([f"m{i} double" for i in range(P)] + [f"v{i}_{j} double" for i, j in _PAIRS] + [f"c{i}_{j} double" for i, j in _PAIRS])


def _square(r, letter: str) -> np.ndarray:
    out = np.empty((P, P))
    for i, j in _PAIRS:
        out[i, j] = out[j, i] = getattr(r, f"{letter}{i}_{j}")
    return out


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre, inverse covariance, covariance and log determinant from the moments of each group and,
    where it has one, the prior (``pm.., pc..``) of its language."""
    names = [c.split()[0] for c in _PARAMS.split(", ")]
    for rows in batches:
        out = []
        for r in rows.itertuples(index=False):
            mean = np.array([getattr(r, f"s{i}") for i in range(P)]) / r.n
            cov = _square(r, "q") / r.n - np.outer(mean, mean)
            if hasattr(r, "pm0") and not math.isnan(r.pm0):
                mean = (r.n * mean + PRIOR_CENTRE * np.array([getattr(r, f"pm{i}") for i in range(P)])) / (r.n + PRIOR_CENTRE)
                cov = (r.n * cov + PRIOR_ROWS * _square(r, "pc")) / (r.n + PRIOR_ROWS)
            cov[np.diag_indices(P)] = np.maximum(cov.diagonal(), LEAST_SPREAD)
            inv = np.linalg.inv(cov)
            out.append((r.lang, r.source, r.start, float(np.linalg.slogdet(cov)[1]), 1.0, *mean, *(inv[i, j] for i, j in _PAIRS), *(cov[i, j] for i, j in _PAIRS)))
        yield pd.DataFrame(out, columns=names)


def _joined(rows: DataFrame, params: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the parameters of their group, null-safe, and their squared distance ``d2``."""
    p = params.withColumnsRenamed({"lang": "__l", "source": "__s"})
    d = [F.col(FEATURES[i]) - F.col(f"m{i}") for i in range(P)]
    d2 = sum((d[i] * d[j] * F.col(f"v{i}_{j}") * (1 if i == j else 2) for i in range(P) for j in range(i, P)), F.lit(0.0))
    return rows.join(p, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), how).withColumn("d2", d2 / F.col("scale"))


def _same(lang: str, source: str, start: str | None = None):
    same = F.col("lang").eqNullSafe(F.col(lang)) & F.col("source").eqNullSafe(F.col(source))
    return same & (F.col("start") == F.col(start)) if start else same


def mcd(stats: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Parameters of each (lang, source) from a table with ``lang, source, x0..``; ``prior`` has those of
    the languages."""
    key, group = ["lang", "source"], ["lang", "source", "start"]
    rows = stats.select(*key, *FEATURES)
    spread = rows.groupBy(*key).agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"k{i}") for i, x in enumerate(FEATURES)])
    robust = [F.col(f"k{i}")[1].alias(f"m{i}") for i in range(P)]
    unset = [F.lit(0.0).alias(f"c{i}_{j}") for i, j in _PAIRS]
    diag = lambda width: [F.lit(0.0).alias(f"v{i}_{j}") if i != j else (1.0 / F.greatest(width(i), F.lit(LEAST_SPREAD[i]))).alias(f"v{i}_{j}") for i, j in _PAIRS]
    begun = lambda k, width: spread.select(*key, F.lit(k).alias("start"), F.lit(0.0).alias("logdet"), F.lit(1.0).alias("scale"), *robust, *diag(width), *unset)
    first = begun(0, lambda i: F.pow((F.col(f"k{i}")[2] - F.col(f"k{i}")[0]) / 1.35, 2))
    second = begun(1, lambda i: F.lit(0.0))
    known = None
    if prior is not None:
        known = prior.select(F.col("lang").alias("pl"), *[F.col(f"m{i}").alias(f"pm{i}") for i in range(P)], *[F.col(f"c{i}_{j}").alias(f"pc{i}_{j}") for i, j in _PAIRS])

    def fitted(chosen: DataFrame) -> DataFrame:
        moments = chosen.groupBy(*group).agg(*_moments())
        if known is not None:
            moments = moments.join(known, F.col("lang").eqNullSafe(F.col("pl")), "left").drop("pl")
        return moments.mapInPandas(_fit, _PARAMS)

    params = written(first.unionByName(second), "quality-params")
    for _ in range(MOST_STEPS):
        near = _joined(rows, params)
        cut = near.groupBy(*group).agg(F.percentile_approx("d2", CORE, 1000).alias("cut")).withColumnsRenamed({"lang": "cl", "source": "cs", "start": "ct"})
        core = near.drop("__l", "__s").join(cut, _same("cl", "cs", "ct")).filter("d2 <= cut")
        before, params = params, written(fitted(core), "quality-params")
        old = before.select(F.col("lang").alias("ol"), F.col("source").alias("os"), F.col("start").alias("ot"), F.col("logdet").alias("was"))
        moved = params.join(old, _same("ol", "os", "ot")).agg(F.max(F.abs(F.col("logdet") - F.col("was")))).first()[0]
        forget(before)
        if moved is None or moved < SETTLED:
            break
    least = params.groupBy(*key).agg(F.min_by(F.struct(*params.columns[2:]), F.struct("logdet", "start")).alias("p")).select(*key, "p.*")
    for last in (False, True):
        middle = _joined(rows, least).groupBy(*key).agg((F.percentile_approx("d2", 0.5, 1000) / chi2_quantile(0.5, P)).alias("c")).withColumnsRenamed({"lang": "cl", "source": "cs"})
        scaled = least.join(middle, _same("cl", "cs"))
        least = written(scaled.select(*key, "start", "logdet", F.greatest(F.col("c"), F.lit(1.0) if last else F.lit(1e-3)).alias("scale"), *params.columns[5:]), "quality-params")
        if not last:
            least = fitted(_joined(rows, least).filter(F.col("d2") <= chi2_quantile(0.975, P)))
    return least


def quality(docs: DataFrame) -> DataFrame:
    """Every document with base counts, ``base_failed``, ``distance`` (null without verdict) and ``kept``."""
    cols = ["doc_id", "lang", "source"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = written(text_statistics(docs, cols).withColumn("base_failed", failed), "quality-stats")
    good = stats.filter("not base_failed").select("lang", "source", *FEATURES)
    by_lang = mcd(good.withColumn("source", F.lit("*")))
    judged = _joined(stats, mcd(good, by_lang), "left")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= chi2_quantile(CUTOFF, P))).alias("kept"), F.sqrt("d2").alias("distance"))
