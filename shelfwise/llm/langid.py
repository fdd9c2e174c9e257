"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character 1- to 3-grams of the lower-cased text. Document frequencies are
counted over every training row. The weights are fitted by follow-the-regularised-leader with an
elastic net (L1 keeps them sparse) on a bounded sample of labelled rows, and a temperature fitted
on rows of that sample which the weights have not seen calibrates the probabilities. One task fits them,
so the sample never comes to the driver; only the weights do.

Null text, or one without a letter: ``und`` with score 0. Without labelled rows nothing is learned
and every row gets ``und``. Repeated rows get equal predictions; the language with the smaller
name wins a tie. Columns named like the result's are replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.textops import crc_fold, slices, unit_hash

UNKNOWN = "und"


@dataclass(frozen=True)
class LangIdParams:
    """``sample_rows`` bounds the rows the weights are fitted on, over all languages."""

    n_features: int = 1 << 15
    max_n: int = 3
    sample_rows: int = 6000
    calibration_share: float = 0.2
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.001


@dataclass
class LangIdModel:
    params: LangIdParams
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0


def ngram_counts(texts: list[str], params: LangIdParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of every n-gram that occurs, by row and feature."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    joined = "".join(lowered).encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(joined, np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - (params.n_features.bit_length() - 1))
    keys, h = [], np.zeros(len(chars), np.uint64)
    for n in range(1, params.max_n + 1):
        if len(chars) < n:
            break
        h = h[: len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1 :] + np.uint64(n)
        one_row = row[: len(h)] == row[n - 1 :]
        feature = ((h * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)
        keys.append((row[: len(h)] * params.n_features + feature)[one_row])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cells = np.bincount(np.concatenate(keys), minlength=1)
    filled = np.flatnonzero(cells)
    return filled // params.n_features, filled % params.n_features, cells[filled]


def tf_idf(row, feature, count, idf, n_rows) -> np.ndarray:
    """Weights of length one per row."""
    value = (1.0 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(row, value * value, n_rows))
    return value / np.maximum(norm, 1e-12)[row]


def _groups(texts: list[str], params: LangIdParams) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose dense count table stays small."""
    size = max(1, (1 << 20) // params.n_features)
    for begin in range(0, len(texts), size):
        yield begin, min(begin + size, len(texts))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def predict_texts(texts: list[str], model: LangIdModel) -> tuple[list[str], np.ndarray]:
    langs, scores = [], np.zeros(len(texts))
    for begin, end in _groups(texts, model.params):
        row, feature, count = ngram_counts(texts[begin:end], model.params)
        value = tf_idf(row, feature, count, model.idf, end - begin)
        logits = np.stack(
            [np.bincount(row, value * w[feature], end - begin) for w in model.weights], axis=1
        )
        p = _softmax((logits + model.bias) / model.temperature)
        langs += [model.langs[k] for k in p.argmax(axis=1)]
        scores[begin:end] = p.max(axis=1)
    return langs, scores


def _document_frequencies(train: DataFrame, params: LangIdParams) -> tuple[int, np.ndarray]:
    """Rows, and rows with each feature, over all of ``train``; every task adds up its own."""

    def count(batches):
        seen, rows = np.zeros(params.n_features, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                rows += len(texts)
                for begin, end in _groups(texts, params):
                    _, feature, _ = ngram_counts(texts[begin:end], params)
                    seen += np.bincount(feature, minlength=params.n_features)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], rows))],
            names=["feature", "n"],
        )

    summed = (
        train.select("text")
        .mapInArrow(count, "feature long, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most n_features + 1 rows
    )
    frequency = np.zeros(params.n_features + 1, np.int64)
    frequency[summed["feature"].to_numpy()] = summed["n"].to_numpy()
    return int(frequency[-1]), frequency[:-1]


def _sample(train: DataFrame, params: LangIdParams) -> DataFrame:
    """N-gram counts of about ``sample_rows`` rows, as many of each language as there are.

    Rows are picked by a hash of their id and text, so the sample is the same on every run.
    """
    counts = train.groupBy("lang").count()
    n_langs = max(1, counts.count())
    share = max(1, params.sample_rows // n_langs)
    if n_langs > params.sample_rows:
        raise ValueError(f"{n_langs} languages, but only {params.sample_rows} sample rows")
    rates = {r["lang"]: min(1.0, share / r["count"]) for r in counts.collect()}
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    picked = train.filter(unit_hash("doc_id", "text") < rate[F.col("lang")])

    def features(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                found = [ngram_counts([t], params)[1:] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"),
                        part.column("pick"),
                        pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                        pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
                    ],
                    names=["lang", "pick", "feature", "n"],
                )

    pick = F.xxhash64(F.lit("order"), "doc_id", "text").alias("pick")
    schema = "lang string, pick long, feature binary, n binary"
    return picked.select("lang", "text", pick).mapInArrow(features, schema)


def _ftrl(x: list, y: np.ndarray, n_langs: int, params: LangIdParams):
    """Per-coordinate FTRL-proximal over the rows in order; the last column is the bias."""
    width = params.n_features + 1
    z = np.zeros((n_langs, width))
    n = np.zeros((n_langs, width))

    def weights(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - params.l1, 0.0)
        return -shrunk / ((params.beta + np.sqrt(ni)) / params.alpha + params.l2)

    for _ in range(params.epochs):
        for (feature, value), label in zip(x, y, strict=True):
            at = np.append(feature, width - 1)
            v = np.append(value, 1.0)
            zi, ni = z[:, at], n[:, at]
            w = weights(zi, ni)
            error = _softmax(w @ v)
            error[label] -= 1.0
            g = error[:, None] * v
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / params.alpha
            z[:, at] = zi + g - sigma * w
            n[:, at] = ni + g * g
    full = weights(z, n)
    return full[:, :-1], full[:, -1]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(y):
        return 1.0

    def loss(log_t):
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, params: LangIdParams | None = None) -> LangIdModel | None:
    """Fit on rows with a text and a ``lang``; None if there are none."""
    params = params or LangIdParams()
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    n_rows, frequency = _document_frequencies(usable, params)
    if not n_rows:
        return None
    idf = np.log((1.0 + n_rows) / (1.0 + frequency)) + 1.0

    def fit(batches):
        found = [b.to_pandas() for b in batches if b.num_rows]
        if found:
            yield _fitted(pd.concat(found, ignore_index=True), idf, params)

    # As many rows as there are languages.
    rows = _sample(usable, params).repartition(1).mapInArrow(fit, FITTED).collect()
    if not rows:
        return None
    weights = np.stack([np.frombuffer(r["weights"], np.float64) for r in rows])
    bias = np.array([r["bias"] for r in rows])
    return LangIdModel(params, [r["lang"] for r in rows], idf, weights, bias, rows[0]["temperature"])


FITTED = "lang string, weights binary, bias double, temperature double"


def _fitted(sample: pd.DataFrame, idf: np.ndarray, params: LangIdParams) -> pa.RecordBatch:
    """A row for each language, in their order, of what is learned from the sample."""
    sample = sample.sort_values(["pick", "lang"], kind="stable")
    langs = sorted(sample["lang"].unique())
    y = sample["lang"].map({lang: k for k, lang in enumerate(langs)}).to_numpy()
    x = []
    for feature, count in zip(sample["feature"], sample["n"], strict=True):
        feature, count = np.frombuffer(feature, np.int32), np.frombuffer(count, np.int32)
        x.append((feature, tf_idf(np.zeros(len(feature), np.int64), feature, count, idf, 1)))
    cut = len(x) - int(len(x) * params.calibration_share)
    weights, bias = _ftrl(x[:cut], y[:cut], len(langs), params)
    logits = np.array([weights[:, f] @ v + bias for f, v in x[cut:]]).reshape(-1, len(langs))
    temperature = _temperature(logits, y[cut:])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array([w.tobytes() for w in weights], pa.binary()),
            pa.array(bias, pa.float64()),
            pa.array([temperature] * len(langs), pa.float64()),
        ],
        names=["lang", "weights", "bias", "temperature"],
    )


def predict(docs: DataFrame, model: LangIdModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        langs, scores = predict_texts(texts.tolist(), model)
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = scored(F.when(has_letter, F.col(text)).otherwise(F.lit("")))
    own = "_found"
    while own in docs.columns:
        own += "_"
    return docs.withColumn(own, found).select(
        *[c for c in docs.columns if c not in ("lang_pred", "score")],
        F.when(has_letter, F.col(own)["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(has_letter, F.col(own)["score"]).otherwise(0.0).alias("score"),
    )


def learned_rows(docs: DataFrame) -> Column:
    """Rows of the fixed training folds."""
    return crc_fold(docs["doc_id"], 4) != 2


def confident(predicted: DataFrame, at_least: float = 0.5) -> DataFrame:
    """Rows with a known language of at least that probability."""
    return predicted.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= at_least))
