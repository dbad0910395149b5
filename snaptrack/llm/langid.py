"""Language identification by a byte convolutional network, trained here in numpy.

A text's UTF-8 bytes (ASCII letters in lower case) are cut into windows of `WINDOW` bytes that
overlap by the widest filter less one, so every stretch a filter can see lies in one window. Bytes
are embedded, filters of several widths slide over them, each keeps its largest value in the window,
and a dense layer with softmax gives the languages' probabilities. A text's score is the geometric
mean over all its windows, weighted by their bytes.

The network learns from excerpts of at most about `DOCS` labelled documents of each language; that
bound is the only sample, predictions read whole texts. Which documents are taken depends on a hash
of their id, and training is seeded, so fitting the same rows again gives the same network.

Defined results: a null text, a text without a letter, and any text if nothing could be learned get
`und` with score 0; rows with a null language are not learned from; repeated rows are predicted
alike; ties go to the first language by code point; a null id counts as the empty text where rows
are held out; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col, fresh

UNKNOWN = "und"
#: Labelled documents of a language that are learned from, about; excerpts of each, characters of an excerpt.
DOCS, EXCERPTS, EXCERPT = 400, 4, 256
#: Labelled documents of all languages together, about: of very many languages fewer documents each are learned from.
SAMPLE = 200_000
#: So many languages' shares, one small row each, are sent to every task; of more they are joined by a shuffle.
SENT = 10_000
WINDOW, EMBED, WIDTHS, FILTERS = 128, 8, (2, 3, 4), 16
EPOCHS, BATCH, RATE, SEED = 6, 128, 0.01, 7
#: Windows convolved at a time.
CHUNK = 128
TAIL = max(WIDTHS) - 1


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (257, EMBED); byte b is row b + 1, row 0 is padding
    kernel: np.ndarray  # (widest * EMBED, filters); narrow filters end in zeros
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def fields(self, windows: np.ndarray) -> np.ndarray:
        """What filters see: (windows, places, widest * EMBED)."""
        x = self.embedding[windows]
        n, length, e = x.shape
        s = x.strides
        view = np.lib.stride_tricks.as_strided(x, (n, length - TAIL, (TAIL + 1) * e), (s[0], s[1], s[2]))
        return np.ascontiguousarray(view)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for low in range(0, len(windows), CHUNK):
            seen = self.fields(windows[low : low + CHUNK])
            n, places, wide = seen.shape
            pooled = (seen.reshape(-1, wide) @ self.kernel).reshape(n, places, -1).max(1) + self.bias
            found.append(_log_softmax(np.maximum(pooled, 0) @ self.dense + self.dense_bias))
        return np.concatenate(found)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's windows (byte values plus one, 0 after the end) and the bytes each stands for."""
    step = WINDOW - TAIL
    n = max(1, -(-(len(data) - TAIL) // step))
    padded = np.zeros(n * step + TAIL, np.uint16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    padded[: len(data)] += 1
    s = padded.strides[0]
    rows = np.lib.stride_tricks.as_strided(padded, (n, WINDOW), (step * s, s)).copy()
    weights = np.full(n, step, np.float64)
    weights[-1] = max(1, len(data) - (n - 1) * step)
    return rows, weights


def fold(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def train(rows: list[tuple[str, str]]) -> Network | None:
    """A network from (language, excerpt) rows, or None without rows."""
    rows = sorted({r for r in rows if r[1]})
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    rnd = np.random.default_rng(SEED)
    wide, n_filters = max(WIDTHS) * EMBED, len(WIDTHS) * FILTERS
    mask = np.concatenate(
        [np.repeat((np.arange(wide) < w * EMBED).astype(np.float32)[:, None], FILTERS, 1) for w in WIDTHS], 1
    )
    net = Network(
        languages,
        rnd.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        (rnd.normal(0, 1, (wide, n_filters)) * mask / np.sqrt(mask.sum(0))).astype(np.float32),
        np.zeros(n_filters, np.float32),
        (rnd.normal(0, 1, (n_filters, len(languages))) / np.sqrt(n_filters)).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    place = {x: k for k, x in enumerate(languages)}
    y = np.array([place[r[0]] for r in rows])
    data = [fold(r[1]) for r in rows]
    names = ["embedding", "kernel", "bias", "dense", "dense_bias"]
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rnd.permutation(len(rows))
        for low in range(0, len(rows), BATCH):
            own = order[low : low + BATCH]
            windows = np.zeros((len(own), WINDOW), np.uint16)
            for k, i in enumerate(own):
                # Texts of any length come: learn from short stretches too.
                size = min(len(data[i]), int(rnd.integers(24, WINDOW + 1)))
                at = int(rnd.integers(0, len(data[i]) - size + 1))
                windows[k, :size] = np.frombuffer(data[i], np.uint8)[at : at + size]
                windows[k, :size] += 1
            seen = net.fields(windows)
            n, places, _ = seen.shape
            conv = (seen.reshape(-1, wide) @ net.kernel).reshape(n, places, -1)
            best = conv.argmax(1)
            pooled = np.take_along_axis(conv, best[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            p = np.exp(_log_softmax(hidden @ net.dense + net.dense_bias))
            p[np.arange(n), y[own]] -= 1
            p /= n
            back = (p @ net.dense.T) * (pooled > 0)
            at_best = seen[np.arange(n)[:, None], best]  # (n, filters, wide)
            to_embedding = np.zeros_like(net.embedding)
            spread = back[:, :, None] * net.kernel.T[None]
            for j in range(TAIL + 1):
                bytes_there = windows[np.arange(n)[:, None], best + j]
                np.add.at(to_embedding, bytes_there, spread[:, :, j * EMBED : (j + 1) * EMBED])
            to_embedding[0] = 0
            grads = {
                "embedding": to_embedding,
                "kernel": np.einsum("nf,nfw->wf", back, at_best) * mask,
                "bias": back.sum(0),
                "dense": hidden.T @ p,
                "dense_bias": p.sum(0),
            }
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network learned from a bounded sample of the rows of `docs` with a language."""
    own = docs.select(col(id_col).alias("i"), col(text_col).alias("t"), col(lang_col).cast("string").alias("l"))
    own = own.filter(F.col("l").isNotNull())
    counts = own.groupBy("l").count()
    languages = counts.count()
    if not languages:
        return None
    # So many of 2^20 hash values let in about `each` documents of a language.
    each = min(float(DOCS), SAMPLE / languages)
    share = counts.select(F.col("l").alias("of"), (F.least(F.lit(1.0), F.lit(each) / F.col("count")) * (1 << 20)).cast("long").alias("share"))
    taken = own.join(F.broadcast(share) if languages <= SENT else share, F.col("l") == F.col("of")).filter(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < F.col("share"))
    n = F.length("t")
    excerpts = F.array(*(F.substring("t", F.floor(n * k / EXCERPTS).cast("int") + 1, F.lit(EXCERPT)) for k in range(EXCERPTS)))
    return train([(r["l"], r["e"]) for r in taken.select("l", F.explode(excerpts).alias("e")).collect()])


def predictions(net: Network | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    import regex

    letter = regex.compile(r"\p{L}")
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    own = [i for i, t in enumerate(texts) if net is not None and t and letter.search(t)]
    if not own:
        return names, scores
    rows, weights = zip(*(windows_of(fold(texts[i])) for i in own), strict=True)
    logs = net.log_probabilities(np.concatenate(rows)).astype(np.float64)
    weight = np.concatenate(weights)
    firsts = np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]])
    mean = np.add.reduceat(logs * weight[:, None], firsts, axis=0) / np.add.reduceat(weight, firsts)[:, None]
    p = np.exp(_log_softmax(mean))
    best = p.argmax(1)
    for i, b in zip(own, best, strict=True):
        names[i] = net.languages[b]
    scores[own] = p[np.arange(len(own)), best]
    return names, scores


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", into: str = "language") -> DataFrame:
    """`docs` with a struct `into` (renamed if taken) of lang_pred and score, from whole texts."""

    @F.arrow_udf("lang_pred string, score double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = predictions(net, texts.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    batch_rows(docs.sparkSession)
    # A filter on the result must not be pushed down as a second call.
    return docs.withColumn(fresh(docs, into), of.asNondeterministic()(col(text_col)))


def held_out(id_col: Column) -> Column:
    """Every fourth document by its id: nothing is learned from these."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 4 == 2


def op3(docs: DataFrame) -> DataFrame:
    kept = held_out(F.col("doc_id"))
    net = fit(docs.filter(~kept))
    found = predict(docs.select("doc_id", "text"), net)
    return found.select("doc_id", kept.alias("held_out"), "language.lang_pred", "language.score")
