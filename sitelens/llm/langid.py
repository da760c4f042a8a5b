"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties and calibrated by temperature.

Features are the 1- to 3-grams of the lower-cased text, hashed into
``BUCKETS`` buckets: term frequency (share of the text's n-grams) times
inverse document frequency. Document frequencies come from all training
documents. The classifier itself is fitted on a bounded sample of them:
about ``SAMPLE`` documents, spread evenly over all labels but at least
``PER_LABEL`` for each (or all it has), and chosen by a hash of the id; all buckets of
a sample document count (at most ``BUCKETS``, six bytes each on the driver). A fifth of the sample
is kept from the fit and sets the temperature. Every prediction reads the
whole text, and only the text.

Defined cases: a null text or one without a letter gives ``und`` with score
0; rows with null labels don't train; without any labelled row everything is
``und``; equal scores go to the label that sorts first; an empty table gives
an empty result. ``predict`` keeps all input columns except those named like
its own two.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
ORDERS = 3
SAMPLE = 4000
PER_LABEL = 40
#: More labels than there are languages: the column holds something else.
MOST_LABELS = 10_000
MIN_SCORE = 0.5
UNDETERMINED = "und"
_SCALE = 20.0  # keeps feature values near 1, so the penalties below fit
_SLAB = 1 << 18
_TAKEN = 100 * _SLAB  # weights looked up at a time
_FACTORS = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917)]
_SALTS = [np.uint32(x) for x in (374761393, 668265263, 1640531527)]


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # BUCKETS x labels: weight times idf, float32
    bias: np.ndarray
    temperature: float


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the text's character n-grams, slab by slab."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(points), _SLAB):
        own = points[start:start + _SLAB + ORDERS - 1]
        n = min(_SLAB, len(points) - start)
        out, h = [], np.zeros(len(own), np.uint32)
        for order in range(ORDERS):
            m = min(n, len(own) - order)
            if m <= 0:
                break
            h = h[:len(own) - order] * np.uint32(31) + own[order:] * _FACTORS[order]
            x = (h[:m] ^ (h[:m] >> np.uint32(15))) * _SALTS[order]
            out.append((x >> np.uint32(16)).astype(np.int32))
        yield np.concatenate(out)


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, a few hundred at a time."""
    for start in range(0, len(column), 256):
        yield from column.slice(start, 256).to_pylist()


def term_counts(text: str) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    for g in grams(text):
        counts += np.bincount(g, minlength=BUCKETS)
    return counts


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """For each bucket the number of documents that have it, and the number of
    documents. Tasks add up their own; at most BUCKETS + 1 sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in _texts(b.column(0)):
                rows += 1
                for_text = [np.unique(g) for g in grams(t or "")]
                if for_text:
                    found[for_text[0] if len(for_text) == 1 else np.unique(np.concatenate(for_text))] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, BUCKETS).astype(np.int32)),
                                          pa.array(np.append(found[at], rows))], ["bucket", "n"])

    sums = docs.select(text_col).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out[:BUCKETS], int(out[BUCKETS])


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, idf: np.ndarray,
                    sample: int) -> tuple[list[str], list[tuple[int, np.ndarray, np.ndarray]]]:
    """Labels, and (label, buckets, values) of about ``sample`` documents in the order of their hash."""
    per_label = {r[0]: r[1] for r in docs.groupBy(lang_col).count().limit(MOST_LABELS + 1).collect()}
    if len(per_label) > MOST_LABELS:
        raise ValueError(f"column {lang_col} has more than {MOST_LABELS} different labels; these can't be languages")
    labels = sorted(per_label)
    if not labels:
        return [], []
    share = max(PER_LABEL, sample // len(labels))
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(7)), F.lit(1 << 30))
    rates = docs.sparkSession.createDataFrame([(label, min(1.0, share / n) * (1 << 30)) for label, n in per_label.items()],
                                              "_label string, _rate double")
    weights = idf.astype(np.float32)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where, values = [], []
            for t in _texts(b.column(2)):
                counts = term_counts(t or "")
                at = np.flatnonzero(counts)
                x = (counts[at] / max(1, counts.sum()) * weights[at] * _SCALE).astype(np.float32)
                where.append(at.astype(np.uint16).tobytes())
                values.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(where, pa.binary()), pa.array(values, pa.binary())],
                                             ["draw", "lang", "buckets", "vals"])

    rows = (docs.withColumn("_draw", draw).join(F.broadcast(rates), F.col(lang_col) == F.col("_label")).filter(F.col("_draw") < F.col("_rate"))
            .select(F.col("_draw").cast("long"), F.col(lang_col), F.col(text_col))
            .mapInArrow(vectors, "draw long, lang string, buckets binary, vals binary").collect())
    number = {label: i for i, label in enumerate(labels)}
    rows.sort(key=lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3])))
    return labels, [(number[r[1]], np.frombuffer(r[2], np.uint16).astype(np.int64), np.frombuffer(r[3], np.float32)) for r in rows]


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, epochs: int = 3, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x labels, sparse through l1) and biases after ``epochs`` passes."""
    z, n = np.zeros((BUCKETS, n_labels)), np.zeros((BUCKETS, n_labels))
    zb, nb = np.zeros(n_labels), np.zeros(n_labels)

    def weights(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for label, at, x in rows:
            w, b = weights(z[at], n[at], l1, l2), weights(zb, nb, 0.0, 0.0)
            p = _softmax(x @ w + b)
            p[label] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            zb += p - (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha * b
            nb += p * p
    return weights(z, n, l1, l2), weights(zb, nb, 0.0, 0.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / math.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, ratio = math.log(0.2), math.log(10.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Model:
    """A model of the labelled documents."""
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(F.col(id_col), F.col(text_col), F.col(lang_col).cast("string"))
    df, n = document_frequencies(labelled, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    labels, rows = training_sample(labelled, id_col, text_col, lang_col, idf, sample)
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    kept, apart = [r for i, r in enumerate(rows) if i % 5], rows[::5]
    fitted = {r[0] for r in kept}
    kept += [r for r in apart if r[0] not in fitted]  # no label goes without a document in the fit
    w, b = ftrl(kept, len(labels))
    logits = np.array([x @ w[at] + b for _, at, x in apart]).reshape(-1, len(labels))
    temperature = fitted_temperature(logits, np.array([r[0] for r in apart], np.int64))
    return Model(labels, (w * idf[:, None] * _SCALE).astype(np.float32), b, temperature)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred and lang_score."""
    import regex

    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats a label
    kept = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])
    names_in = kept.columns
    at = names_in.index(text_col)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letter = shared.value, regex.compile(r"\p{L}")
        for b in batches:
            names, scores = [], []
            for t in _texts(b.column(at)):
                name, score = UNDETERMINED, 0.0
                if t and m.labels and letter.search(t):
                    total, n = np.zeros(len(m.labels)), 0
                    step = max(1, _TAKEN // len(m.labels))
                    for g in grams(t):
                        for start in range(0, len(g), step):
                            total += m.table.take(g[start:start + step], axis=0).sum(axis=0, dtype=np.float64)
                        n += len(g)
                    p = _softmax((total / n + m.bias) / m.temperature)
                    best = int(p.argmax())
                    name, score = m.labels[best], float(p[best])
                names.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*names_in, "lang_pred", "lang_score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return kept.mapInArrow(label, schema)


def accepted(predicted: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language could be told: not ``und``, and a score of ``min_score`` at least."""
    return predicted.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") >= min_score))
