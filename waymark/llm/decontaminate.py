"""Benchmark decontamination by latent semantic retrieval.

1. Words are looked up once: each document's 32-bit word ids go to the checkpoint folder, and all passes read those.
   Inverse document frequencies of hashed words, over all documents and items.
2. A randomised singular value decomposition of the TF-IDF passages of all documents, distributed: tasks add up their
   parts of A'(A Omega), and the parts are added one block of terms at a time; the driver orthogonalises the sum (terms
   x dimensions, whatever the corpus).  There are as many parts as two a core, so that they don't grow with the corpus.
   Singular values are scaled out, so that what all passages share weighs no more than the rest.
3. Every window of every document, at the lengths that the items have and with half-length steps, is projected and
   compared with all items by cosine.  The items go to every task; more than `most_items` of them are dealt by hash
   into parts of about nine tenths of that, and all windows are searched for one part after another.
4. Candidates are verified: longest common subsequence of words in the window and its surroundings, as a share of the
   item; below `verbatim`, a paraphrase must reach `paraphrase` and hold the item's answer in order.  The answer is the
   last sentence: all of it up to `SHORT` words, else a share of `verbatim`.  A last sentence of more than half the
   item's words, such as the only one, is no answer apart; then half of its rarer half has to be there.

Defined results: null and empty texts match nothing; items of fewer than `least_words` words are not searched for; a
pair of document and item gives one row, its best place; items equal in item_id and text are one, others that share an
item_id (or have none) are items of their own; rows with a null doc_id are searched and reported as such;
empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import as_documents, checkpointed, runs, stored

BITS, BLOCKS = 16, 64
TERMS = 1 << BITS
SPLIT = bytes.maketrans(bytes(x for x in range(33, 127) if not chr(x).isalnum()), b" " * sum(not chr(x).isalnum() for x in range(33, 127)))
SENTENCE = regex.compile(r"(?<=[.!?])\s+")
SHORT = 5
FOUND = "doc_id long, item_id long, similarity double, lcs_share double, answer_found boolean, start long, n_words long"


class Ids(dict):
    """32-bit ids of words, kept as they are asked for; the low bits are the terms of the decomposition."""

    def __init__(self, most: int = 700_000) -> None:
        self.most = most

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh32_intdigest(word)
        return found

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        words = text.lower().encode().translate(SPLIT).split()
        return np.array([self[w] for w in words], np.uint32)


@dataclass
class Item:
    item_id: int
    ids: list[int]
    answer: list[int]
    needed: int = 0

    def __post_init__(self) -> None:
        self.at, self.answer_at = places(self.ids), places(self.answer)

    def settle(self, frequency: np.ndarray, verbatim: float) -> None:
        """What has to be found of the answer, by how many texts hold each term."""
        share = 1.0 if len(self.answer) <= SHORT else verbatim
        if 2 * len(self.answer) > len(self.ids):
            rarest = np.argsort(frequency[np.array(self.answer, np.uint32) & np.uint32(TERMS - 1)], kind="stable")
            self.answer = [self.answer[i] for i in sorted(rarest[: -(-len(self.answer) // 2)])]
            self.answer_at, share = places(self.answer), 0.5
        self.needed = int(np.ceil(share * len(self.answer) - 1e-9))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id and text of the benchmark's different items."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()


def read_items(benchmark: DataFrame, least_words: int) -> list[Item]:
    ids, out = Ids(), []
    for r in sorted(benchmark.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"])):
        words = ids.of(r["text"]).tolist()
        if len(words) >= least_words:
            answer = next((a for s in reversed(SENTENCE.split(r["text"])) if (a := ids.of(s).tolist())), words)
            out.append(Item(r["item_id"], words, answer))
    return out


def looked_up(docs: DataFrame) -> DataFrame:
    """doc_id and ids, the 32-bit ids of the text's words (none if it is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Ids()
        for batch in runs(batches, 8 << 20):
            ids = [known.of(text or "").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def terms_of(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.uint32) & np.uint32(TERMS - 1)


def document_frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, and how many texts there are; TERMS + 1 rows reach the driver at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                counts[terms_of(ids)] += 1  # a repeated index counts once
                n += 1
        terms = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, terms]), pa.array(np.r_[n, counts[terms]])], ["term", "n"])

    rows = words.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        counts[r["term"]] = r["n"]
    return counts[:TERMS], int(counts[TERMS])


def omega(dimensions: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((TERMS, dimensions)).astype(np.float32)


def passages(texts: list[bytes], idf: np.ndarray, size: int, least: int = 12) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passages of texts given as ids: their terms, some thousand rows at a time, and what each weighs, a row's squares adding up to 1.

    A term counts once in a passage.  Passages of few terms, such as one word again and again, would take the basis over.
    """
    room = [-(-len(t) // 4 // size) * size for t in texts]
    flat = np.full(sum(room), TERMS, np.uint32)
    at = 0
    for t, n in zip(texts, room, strict=True):
        flat[at : at + len(t) // 4] = terms_of(t)
        at += n
    rows = np.sort(flat.reshape(-1, size), axis=1)
    counted = rows < TERMS
    counted[:, 1:] &= rows[:, 1:] != rows[:, :-1]
    some = counted.sum(axis=1) >= least
    rows, counted = rows[some] & np.uint32(TERMS - 1), counted[some]
    for at in range(0, len(rows), 8192):
        terms = rows[at : at + 8192]
        weights = idf[terms] * counted[at : at + 8192]
        yield terms, weights / np.maximum(np.sqrt((weights**2).sum(axis=1, keepdims=True)), 1e-9)


def fit_basis(words: DataFrame, idf: np.ndarray, dimensions: int, extra: int = 8, passage: int = 32) -> np.ndarray:
    """terms x dimensions: takes a TF-IDF passage to its left singular vector, the scale of singular values taken out.

    One pass adds up A'(A Omega), whose orthonormal basis is Q; another adds up (A Q)'(A Q), whose eigenvectors turn
    Q into the right singular vectors; the last `extra` of them are dropped.
    """
    size, wide = TERMS // BLOCKS, dimensions + extra
    words = words.select("ids").coalesce(2 * words.sparkSession.sparkContext.defaultParallelism)

    def part_of(batches: Iterator[pa.RecordBatch], first: np.ndarray, back: bool) -> np.ndarray:
        total = np.zeros((TERMS if back else wide, wide))
        for batch in runs(batches, 2 << 20, "ids"):
            for terms, weights in passages(batch.column("ids").to_pylist(), idf, passage):
                y = np.concatenate([np.matmul(weights[i : i + 256, None, :], first[terms[i : i + 256]])[:, 0] for i in range(0, len(terms), 256)])
                if back:
                    kept = np.flatnonzero(weights)
                    order = kept[np.argsort(terms.ravel()[kept].astype(np.uint16), kind="stable")]
                    for some in np.split(order, range(4096, len(order), 4096)):  # so few stay in the processor's cache
                        term = terms.ravel()[some]
                        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
                        total[term[starts]] += np.add.reduceat(y[some // passage] * weights.ravel()[some, None], starts, axis=0)
                else:
                    total += y.T @ y
        return total.astype(np.float32)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part_of(batches, omega(wide), True)
        blocks = [total[b * size : (b + 1) * size].tobytes() for b in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int64()), pa.array(blocks, pa.binary())], ["block", "part"])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([part_of(batches, basis, False).tobytes()], pa.binary())], ["block", "part"])

    def add(pdf):  # noqa: ANN001, ANN202
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["part"])
        return pdf.iloc[:1].assign(part=[total.astype(np.float32).tobytes()])

    summed = words.mapInArrow(sketch, "block long, part binary").groupBy("block").applyInPandas(add, "block long, part binary").collect()
    whole = 1e-6 * omega(wide).astype(np.float64)
    for r in summed:
        whole[r["block"] * size : (r["block"] + 1) * size] += np.frombuffer(r["part"], np.float32).reshape(size, wide)
    basis = np.linalg.qr(whole)[0].astype(np.float32)
    rows = words.mapInArrow(gram, "block long, part binary").groupBy("block").applyInPandas(add, "block long, part binary").collect()
    second = np.frombuffer(rows[0]["part"], np.float32).reshape(wide, wide).astype(np.float64) if rows else np.eye(wide)
    values, vectors = np.linalg.eigh(second)
    values, vectors = values[::-1][:dimensions], vectors[:, ::-1][:, :dimensions]
    vectors = np.where(values > 4 * np.median(values), 0, vectors)  # a passage's language; it tells no passages of one apart
    return (basis @ (vectors / np.sqrt(np.maximum(values, 1e-6 * max(values[0], 1e-9))))).astype(np.float32)


def places(a: list[int]) -> dict[int, int]:
    """Where each word of a is, as bits."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    return at


def lcs(at: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of b and the n words that `places` was given, by bits of one integer."""
    v = full = (1 << n) - 1
    for m in map(at.get, b):
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    dimensions: int = 56,
    cosine: float = 0.5,
    verbatim: float = 0.8,
    paraphrase: float = 0.6,
    least_words: int = 5,
    most_items: int = 20_000,
) -> DataFrame:
    """doc_id, item_id, similarity (cosine), lcs_share, answer_found, and the window's first word and length."""
    words = checkpointed(looked_up(as_documents(docs)))
    different = stored(items_of(benchmark))
    n_items = different.count()
    of_items = looked_up(benchmark.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    frequency, n = document_frequencies(words.unionByName(of_items))
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32)
    basis = fit_basis(words, idf, dimensions) * idf[:, None]
    parts = 1 if n_items <= most_items else -(-n_items * 10 // (most_items * 9))
    of_part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    found = None
    for part in range(parts):
        items = read_items(different.where(of_part == part), least_words)
        for item in items:
            item.settle(frequency, verbatim)
        leaks = search_items(words, items, basis, cosine, verbatim, paraphrase)
        if parts > 1:
            leaks = stored(leaks)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def search_items(words: DataFrame, items: list[Item], basis: np.ndarray, cosine: float, verbatim: float, paraphrase: float) -> DataFrame:
    """The leaks of these items, in the columns of FOUND."""
    dimensions, groups = basis.shape[1], []
    lengths = sorted({window_length(len(i.ids)) for i in items})
    for length in lengths:
        own = [i for i in items if window_length(len(i.ids)) == length]
        vectors = np.array([basis[np.array(i.ids, np.uint32) & np.uint32(TERMS - 1)].sum(axis=0) for i in own])
        groups.append((length, own, (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).T.astype(np.float32)))

    base, whole = (min(lengths) // 2, max(lengths) // 2) if lengths else (1, 1)
    padded = np.vstack([basis, np.zeros((1, dimensions), np.float32)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 320 << 10, "ids"):
            words = [np.frombuffer(ids, np.uint32) for ids in batch.column("ids").to_pylist()]
            doc_ids = batch.column("doc_id").to_pylist()
            room = np.array([-(-len(w) // whole) * whole for w in words])
            ends = np.cumsum(room)
            flat = np.full(int(ends[-1]), TERMS, np.uint32)  # each document starts at a multiple of the longest step
            for w, end, n in zip(words, ends.tolist(), room.tolist(), strict=True):
                flat[end - n : end - n + len(w)] = w & np.uint32(TERMS - 1)
            sums = np.concatenate([padded[some].reshape(-1, base, dimensions).sum(axis=1) for some in np.split(flat, range(1 << 16, len(flat), 1 << 16))]) if len(flat) else np.zeros((0, dimensions), np.float32)
            best: dict[tuple[int, int, int], tuple] = {}
            step = base
            for length, own, vectors in groups:
                while step < length // 2:
                    sums = sums.reshape(-1, 2, dimensions).sum(axis=1)
                    step *= 2
                windows = sums + np.vstack([sums[1:], np.zeros((1, dimensions), np.float32)]) if len(sums) else sums
                norms = np.sqrt(np.einsum("ij,ij->i", windows, windows))
                scores = windows @ vectors
                hits, which = np.nonzero(scores >= cosine * norms[:, None] + 1e-12)
                owners = np.searchsorted(ends, hits * step, side="right")
                for w, k, d in zip(hits.tolist(), which.tolist(), owners.tolist(), strict=True):
                    item, s = own[k], w * step - int(ends[d] - room[d])
                    known = best.get((d, length, k), (0,))[0]
                    if known == 1:
                        continue
                    near = words[d][max(0, s - length // 2) : s + 3 * length // 2].tolist()
                    if (share := lcs(item.at, len(item.ids), near) / len(item.ids)) >= paraphrase and share > known:
                        answered = lcs(item.answer_at, len(item.answer), near) >= item.needed
                        if share >= verbatim or answered:
                            best[d, length, k] = (share, float(scores[w, k] / norms[w]), answered, s, item.item_id)
            rows = [(doc_ids[d], i, sim, share, answered, s, len(words[d])) for (d, _, _), (share, sim, answered, s, i) in best.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

    return words.mapInArrow(search, FOUND)


def window_length(words: int) -> int:
    """The window for an item of so many words: of 8, 16, 32, 64 ..., the first that is 0.7 of it at least."""
    length = 8
    while length < 0.7 * words:
        length *= 2
    return length
