"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text, window by window.

A text is cut at white space into windows of about `window` bytes, and each window is compressed twice: with the
ordinary dictionary, and with the toxic one.  The toxic dictionary is trained on what toxic documents say and ordinary
ones don't, and extends the ordinary one, so that ordinary windows compress alike with both and a toxic window is
shorter with the second.  A logistic regression over the windows' savings is calibrated so that 0.5 is the threshold.

Fitting is bounded: at most `fit_toxic` and `fit_ordinary` labelled rows, the first by hash of doc_id, go to the
driver, whatever the corpus.  Dictionaries come from one half of them and the calibration from the other.

Defined results: a null or empty text has no windows and scores as such; a null label is no label; every row of the
input gives one row, repeated ids too; without labels of both kinds every score is 0; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.common import as_documents, runs, texts

EDGES = b".,;:!?*$%&#\"'()"


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def windows(text: bytes, window: int) -> list[bytes]:
    """The text's words, lower-cased in A-Z, in windows of at least `window` bytes, the last one shorter."""
    out, held, size = [], [], 0
    for word in text.lower().split():
        held.append(word)
        size += len(word) + 1
        if size >= window:
            out.append(b" ".join(held))
            held, size = [], 0
    if held:
        out.append(b" ".join(held))
    return out


def trained(samples: list[bytes], size: int, **options: int) -> bytes:
    """The content of a dictionary; what there is, joined, where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def grams(word: bytes, width: int = 5) -> list[bytes]:
    """The strings of `width` bytes in a word with a space before it."""
    spaced = b" " + word.strip(EDGES)
    return [spaced[i : i + width] for i in range(len(spaced) - width + 1)]


def gram_counts(corpus: list[bytes]) -> Counter:
    """In how many texts each string occurs."""
    known: dict[bytes, list[bytes]] = {}
    return Counter(g for t in corpus for g in {g for w in set(t.lower().split()) for g in known.get(w) or known.setdefault(w, grams(w))})


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    window: int

    def start(self) -> Model:
        """Prepares the compressors, which can't be pickled."""
        self.compressors = [self._compressor(self.ordinary), self._compressor(self.toxic + self.ordinary)]
        return self

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=2 * self.window, dict_size=len(content), min_match=4, strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_dict_id=False
        )
        if len(content) < 8:  # zstandard takes no shorter one
            return zstandard.ZstdCompressor(compression_params=how)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(compression_params=how, dict_data=held)

    def features(self, text: bytes) -> list[float]:
        without, with_toxic = (c.compress for c in self.compressors)
        saved = sorted((len(without(w)) - len(with_toxic(w)) for w in windows(text, self.window)), reverse=True)
        n = max(len(saved), 1)
        mean = sum(x for x in saved if x > 0) / n
        return [1.0, mean, np.sqrt(mean), sum(saved[:3]) / 3, saved[0] if saved else 0.0, sum(x >= 3 for x in saved) / n, 1 / n]

    def score(self, text: bytes) -> float:
        if not self.weights.any():
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.weights @ self.features(text), -50, 50))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[int, bytes, int]], window: int = 128, ordinary_size: int = 32768, toxic_size: int = 1024, seen_in: int = 4, lift: float = 12.0) -> Model:
    """The model of labelled rows (doc_id, text, toxic).

    The toxic dictionary is trained on the words of toxic texts that hold a telling string: one that `seen_in` toxic
    texts have, and `lift` times the share of ordinary ones.
    """
    rows = list({text: (doc_id, text, toxic) for doc_id, text, toxic in rows}.values())
    first = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 < 3]
    toxic, ordinary = ([t for _, t, label in first if label == kind] for kind in (1, 0))
    empty = Model(b"", b"", np.zeros(7), window)
    if not toxic or not ordinary:
        return empty
    kinds = [gram_counts(ts) for ts in (toxic, ordinary)]
    rates = {g: (n / len(toxic)) / ((kinds[1][g] + 0.5) / len(ordinary)) for g, n in kinds[0].items() if n >= seen_in}
    telling = {g for g, rate in rates.items() if rate >= lift}
    samples = [b" ".join(kept) for t in toxic if (kept := [w for w in dict.fromkeys(t.lower().split()) if not telling.isdisjoint(grams(w))])]
    plain = [w for t in ordinary for w in windows(t, window)]
    model = Model(trained(plain[:: max(1, len(plain) // 30_000)], ordinary_size), trained(samples, toxic_size, k=16, d=6), np.zeros(7), window).start()
    second = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 >= 3]
    labels = np.array([r[2] for r in second], float)
    if 0 < labels.sum() < len(labels):
        model.weights = logistic(np.array([model.features(t) for _, t, _ in second]), labels)
    return Model(model.ordinary, model.toxic, model.weights, window)


def labelled(docs: DataFrame, labels: DataFrame, fit_toxic: int = 2500, fit_ordinary: int = 7000) -> list[tuple[int, bytes, int]]:
    """The bounded sample that `fit` takes, without held-out rows."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    ids = [marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for kind, n in ((1, fit_toxic), (0, fit_ordinary))]
    picked = ids[0].unionByName(ids[1])
    rows = as_documents(docs).join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(fit_toxic + fit_ordinary)
    return [(r["doc_id"], (r["text"] or "").encode(), r["toxic"]) for r in rows.collect()]


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = (), **bounds: int) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic) and predicted (1 if score >= 0.5); then, under their own
    names, the columns of docs in `keep`, row by row."""
    model = fit(labelled(docs, labels, **bounds))
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    rows = docs.select(*own, *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)])
    passed = [f for f in rows.schema.fields if f.name.startswith("kept_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = model.start()
        for batch in runs(batches, 8 << 20):
            scores = pa.array([ready.score(t) for t in texts(batch.column("text"))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores, *batch.columns[2:]], ["doc_id", "score", *batch.schema.names[2:]])

    scored = rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), *passed]))
    held = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    kept = [F.col(f.name).alias(c) for f, c in zip(passed, keep, strict=True)]
    return scored.select(*([] if "doc_id" in keep else ["doc_id"]), held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *kept)
