"""Language identification by a byte convolutional network, trained in numpy on a bounded sample of labelled rows.

Bytes are embedded, filtered by convolutions of several widths, max-pooled over a window and classified by a softmax.
A text is cut into windows of fixed length, all of them, and its windows' probabilities are averaged by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import small_table, text_of

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 12  # of every width
EMBEDDED = 8
PAD = 256  # stands after the end of a text; a filter that touches it gives nothing
SAMPLE_DOCS = 1600  # labelled documents that training may read, shared evenly by the languages
SAMPLE_WINDOWS = 4  # windows taken from each of them, spread over its whole text
EPOCHS = 8
BATCH = 64
RATE = 0.01
FOLDS = 5  # documents of fold 0 are held out
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    embed: np.ndarray  # 256 x EMBEDDED
    filters: list[np.ndarray]  # per width: width x EMBEDDED x FILTERS
    bias: np.ndarray  # all filters
    weight: np.ndarray  # all filters x labels
    offset: np.ndarray  # labels

    def tables(self) -> list[np.ndarray]:
        """Per width: width x 257 x FILTERS, what a byte at each place of a filter adds; the network without products."""
        out = []
        for f in self.filters:
            t = np.full((len(f), PAD + 1, f.shape[2]), -1e4, dtype=np.float32)
            t[:, :PAD] = self.embed @ f
            out.append(t)
        return out


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last one padded."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.full(n * WINDOW, PAD, dtype=np.int16)
    out[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(n, WINDOW)


def _pooled(tables: list[np.ndarray], bias: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of every filter in every window (not below 0), and where it is."""
    tops, places = [], []
    for w, t in enumerate(tables):
        width, places_of = len(t), WINDOW - len(t) + 1
        acc = np.take(t[0], x[:, :places_of], axis=0)
        for j in range(1, width):
            acc += np.take(t[j], x[:, j : j + places_of], axis=0)
        at = acc.argmax(axis=1)
        tops.append(np.take_along_axis(acc, at[:, None, :], axis=1)[:, 0, :] + bias[w * FILTERS : (w + 1) * FILTERS])
        places.append(at)
    return np.maximum(np.concatenate(tops, axis=1), 0), np.concatenate(places, axis=1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], *, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adam on the cross-entropy; the gradient passes the pooling only where a filter was largest."""
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    shapes = [(PAD, EMBEDDED), *[(w, EMBEDDED, FILTERS) for w in WIDTHS], (total,), (total, len(labels)), (len(labels),)]
    scales = [0.3, *[0.5 / np.sqrt(w) for w in WIDTHS], 0.0, 0.3, 0.0]
    params = [(rng.standard_normal(s) * c).astype(np.float32) for s, c in zip(shapes, scales, strict=True)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), BATCH):
            pick = order[start : start + BATCH]
            xb, n = x[pick], len(pick)
            model = Model(labels, params[0], params[1:-3], *params[-3:])
            pooled, at = _pooled(model.tables(), model.bias, xb)
            error = _softmax(pooled @ model.weight + model.offset)
            error[np.arange(n), y[pick]] -= 1
            error /= n
            back = (error @ model.weight.T) * (pooled > 0)
            grads = [np.zeros_like(p) for p in params]
            grads[-1], grads[-2], grads[-3] = error.sum(axis=0), pooled.T @ error, back.sum(axis=0)
            for w, width in enumerate(WIDTHS):
                cols = slice(w * FILTERS, (w + 1) * FILTERS)
                g, place = back[:, cols], at[:, cols]
                for j in range(width):
                    byte = np.minimum(np.take_along_axis(xb, place + j, axis=1), PAD - 1)
                    grads[1 + w][j] = np.einsum("nf,nfe->ef", g, params[0][byte])
                    np.add.at(grads[0], byte.ravel(), (g[:, :, None] * params[1 + w][j].T[None]).reshape(-1, EMBEDDED))
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(labels, params[0], params[1:-3], *params[-3:])


def predict(model: Model, texts: list[bytes]) -> tuple[list[int], list[float]]:
    """Label number and mean probability of every text, over all its windows."""
    tables, picks, scores = model.tables(), [], []
    sums = np.zeros((len(texts), len(model.labels)))

    def flush(held: list[np.ndarray], owners: list[int]) -> None:
        x = np.concatenate(held)
        pooled, _ = _pooled(tables, model.bias, x)
        p = _softmax(pooled @ model.weight + model.offset) * (x != PAD).sum(axis=1, keepdims=True)
        np.add.at(sums, np.repeat(owners, [len(h) for h in held]), p)

    held, owners, n = [], [], 0
    for i, data in enumerate(texts):
        all_windows = windows_of(data)
        for a in range(0, len(all_windows), 256):
            held.append(all_windows[a : a + 256])
            owners.append(i)
            n += len(held[-1])
            if n >= 256:
                flush(held, owners)
                held, owners, n = [], [], 0
    if held:
        flush(held, owners)
    for i, data in enumerate(texts):
        best = int(sums[i].argmax())
        picks.append(best)
        scores.append(float(min(1.0, sums[i][best] / max(1, len(data)))))
    return picks, scores


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _has_letters() -> Column:
    return text_of().rlike(r"\p{L}")


def fit(docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Train on at most ``sample_docs`` labelled rows outside the held-out fold, in hash order; None without any.

    Equal rows are one, and rows that share an id are rows of their own: the bound holds however often either repeats.
    """
    usable = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & _has_letters())
    usable = usable.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", text_of()).alias("of"), text_of().alias("text"))
    labels = sorted(r[0] for r in usable.select("lang").distinct().collect())
    if not labels:
        return None
    each = max(1, sample_docs // len(labels))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("of"), "of")
    chosen = usable.select("lang", "of").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= each)
    taken = small_table(docs.sparkSession, [(r["lang"], r["of"]) for r in chosen.collect()], "lang string, of long")
    rows = usable.join(taken, ["lang", "of"], "left_semi")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, data = [], [], []
            for row, text in enumerate(batch.column("text")):
                whole = windows_of(text.as_py().encode())
                for i in sorted({int(j) for j in np.linspace(0, len(whole) - 1, SAMPLE_WINDOWS)}):
                    at.append(row)
                    places.append(i)
                    data.append(whole[i].tobytes())
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("lang", "of")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(places, pa.int64()), pa.array(data, pa.binary())], names=["lang", "of", "place", "data"])

    windows = rows.mapInArrow(sample, "lang string, of long, place long, data binary").distinct()
    got = sorted((r["lang"], bytes(r["data"])) for r in windows.collect())
    x = np.stack([np.frombuffer(d, dtype=np.int16) for _, d in got])
    y = np.array([labels.index(lang) for lang, _ in got])
    return train(x, y, labels)


def _predicting(model: Model | None, carried: str):
    """Arrow task: ``carried`` as it is, lang_pred and score; the text is a column or a field of the carried row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            kept = batch.column(carried)
            texts = batch.column("text") if "text" in batch.schema.names else kept.field("text")
            langs, scores = [UNKNOWN] * n, [0.0] * n
            rows = [i for i, ok in enumerate(batch.column("letters").to_pylist()) if ok] if model else []
            if rows:
                found = predict(model, [str(texts[i].as_py()).encode() for i in rows])
                for i, pick, score in zip(rows, *found, strict=True):
                    langs[i], scores[i] = model.labels[pick], score
            yield pa.RecordBatch.from_arrays([kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[carried, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row, read from its text alone.

    ``und`` with score 0 where the text is null, empty or has no letter, and everywhere when nothing could be learned.
    Repeated rows are each predicted, alike; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", text_of().alias("text"), _has_letters().alias("letters"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _predicting(sent.value, "doc_id")(it), f"doc_id {kind}, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that can be in a language: null texts and texts without any letter are rejected.

    The text alone decides; the network names a language for every other row, rejects none, and its language replaces
    ``lang``. Where nothing could be learned the same rows stay, as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    rows = docs.where(_has_letters()).select(F.struct(*docs.columns).alias("row"), F.lit(True).alias("letters"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    named = F.coalesce(F.nullif("lang_pred", F.lit(UNKNOWN)), F.col("row.lang").cast("string")).cast(docs.schema["lang"].dataType)
    found = rows.mapInArrow(lambda it: _predicting(sent.value, "row")(it), schema)
    return found.select(*[named.alias(c) if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns])
