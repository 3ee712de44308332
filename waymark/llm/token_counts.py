"""Edit-aware token counts: a segment tree of pre-token counts per document, updated where an edit touches it.

`build_trees` splits each text into pre-tokens, counts each one's byte-pair tokens, groups `leaf` pre-tokens to a leaf
and keeps the leaves' places and a binary tree of sums over them.  `edited` applies edits to a document: it splits and
encodes anew from the last leaf that starts two characters before an edit (what decides a pre-token reaches that far
past its end), until a pre-token starts where an old leaf did; the leaves between take the new counts, and the sums
above them are updated.  Everything else is kept.  Results equal a count from scratch.

Edits replace the characters from `start` up to `end` (code points of the old text) by `text`.  They apply in order of
(start, end, text); where one starts before the last one ended, it starts there.  Places beyond the text mean its end,
a null text is empty, and null places drop the edit.

Defined results: a null or empty text has no tokens; edits of unknown documents do nothing; rows equal in doc_id each
get all of its edits, and edits of a null doc_id none; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import as_documents, runs

#: How the public byte-level vocabulary splits a text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTEXT = 2
TREE = "doc_id long, text string, starts array<int>, sums array<int>, n_pretokens long"
EDITED = f"{TREE}, n_tokens_before long, n_reencoded long"


class Counter:
    """Pre-tokens of texts, and how many tokens each one is."""

    def __init__(self, path: str, cached: int = 500_000) -> None:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.split = regex.compile(PATTERN)
        self.pairs = tiktoken.Encoding("counted", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.cached, self.cache = cached, {}

    def counts(self, pretokens: list[str]) -> list[int]:
        cache = self.cache
        try:
            return [cache[p] for p in pretokens]
        except KeyError:
            if len(cache) > self.cached:
                cache.clear()
            encode = self.pairs.encode_single_piece
            for p in pretokens:
                if p not in cache:
                    cache[p] = len(encode(p.encode()))
            return [cache[p] for p in pretokens]


class Tree:
    """Where leaves start, and sums: node 1 is the root, node i has the children 2i and 2i + 1, leaves come last."""

    def __init__(self, starts: list[int], sums: np.ndarray) -> None:
        self.starts, self.sums = starts, sums

    @classmethod
    def of(cls, starts: list[int], totals: np.ndarray | list[int]) -> Tree:
        width = 1
        while width < len(starts):
            width *= 2
        levels = [np.zeros(width, np.int64)]
        levels[0][: len(starts)] = totals
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return cls(starts, np.concatenate([[0], *levels[::-1]]))

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def set(self, leaf: int, total: int) -> None:
        node = len(self.sums) // 2 + leaf
        change = total - self.sums[node]
        while node and change:
            self.sums[node] += change
            node //= 2


def build(text: str, counter: Counter, leaf: int) -> tuple[Tree, int]:
    """The tree of a text, and the number of its pre-tokens."""
    pretokens = counter.split.findall(text)
    if not pretokens:
        return Tree.of([], []), 0
    counts = np.array(counter.counts(pretokens), np.int64)
    lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
    at = np.arange(0, len(pretokens), leaf)
    return Tree.of((np.cumsum(lengths) - lengths)[at].tolist(), np.add.reduceat(counts, at)), len(pretokens)


def edited(text: str, tree: Tree, edits: list[tuple[int, int, str]], counter: Counter, leaf: int) -> tuple[str, Tree, int]:
    """The new text, its tree, and how many pre-tokens were encoded for it."""
    plain, last = [], 0
    for start, end, new in sorted(edits):
        start = min(max(start, last), len(text))
        end = min(max(end, start), len(text))
        plain.append((start, end, new))
        last = end
    if not plain:
        return text, tree, 0
    parts, at, places, shift = [], 0, [], 0
    for start, end, new in plain:
        parts += [text[at:start], new]
        at = end
        places.append((start + shift, start + shift + len(new), shift + len(new) - (end - start)))  # from, to, and the shift after it
        shift = places[-1][2]
    changed = "".join([*parts, text[at:]])
    old = tree.starts
    starts: list[int] = []
    totals: list[int] = []
    leaves = len(tree.sums) // 2
    encoded, i, shift = 0, 0, 0  # i: the next old leaf; shift: what to add to an old place

    k = 0
    while k < len(plain):
        first = max(i, bisect_right(old, plain[k][0] - CONTEXT) - 1, 0)
        starts += [s + shift for s in old[i:first]]
        totals += tree.sums[leaves + i : leaves + first].tolist()
        at = old[first] + shift if old else 0
        spans: list[str] = []
        i, passed = len(old), k
        for m in counter.split.finditer(changed, at):
            here = m.start()
            while passed < len(plain) and places[passed][1] <= here:
                passed += 1
            if passed > k:
                back = here - places[passed - 1][2]
                j = bisect_right(old, back) - 1
                if back >= plain[passed - 1][1] and j >= 0 and old[j] == back and (passed == len(plain) or back + CONTEXT <= plain[passed][0]):
                    i, shift, k = j, places[passed - 1][2], passed
                    break
            spans.append(m[0])
        else:
            k = len(plain)
        encoded += len(spans)
        counts = counter.counts(spans)
        for low in range(0, len(spans), leaf):
            starts.append(at)
            totals.append(sum(counts[low : low + leaf]))
            at += sum(map(len, spans[low : low + leaf]))
    starts += [s + shift for s in old[i:]]
    totals += tree.sums[leaves + i : leaves + len(old)].tolist()
    if len(starts) == len(old):
        new_tree = Tree(starts, tree.sums.copy())
        for j, total in enumerate(totals):
            if total != new_tree.sums[leaves + j]:
                new_tree.set(j, total)
        return changed, new_tree, encoded
    return changed, Tree.of(starts, totals), encoded


def build_trees(docs: DataFrame, vocabulary: str, leaf: int = 32) -> DataFrame:
    """The columns of TREE for every document; the number of its tokens is sums[1]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in runs(batches, 2 << 20):
            trees = [build(text or "", counter, leaf) for text in batch.column("text").to_pylist()]
            yield tree_frame(batch, batch.column("text"), [t for t, _ in trees], [n for _, n in trees])

    return as_documents(docs).mapInArrow(run, TREE)


def tree_frame(batch: pa.RecordBatch, text: pa.Array, trees: list[Tree], sizes: list[int], *more: list[int]) -> pa.RecordBatch:
    columns = [batch.column("doc_id"), text, pa.array([t.starts for t in trees], pa.list_(pa.int32())), pa.array([t.sums for t in trees], pa.list_(pa.int32()))]
    names = [x.split()[0] for x in EDITED.split(", ")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), *(pa.array(x, pa.int64()) for x in more)], names[: 5 + len(more)])


def with_edits(frame: DataFrame, edits: DataFrame) -> DataFrame:
    """frame with the column `edits`, from one row per edit: doc_id, start, end, text."""
    row = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    valid = edits.where("start IS NOT NULL AND end IS NOT NULL")
    grouped = valid.groupBy(F.col("doc_id").cast("long").alias("of_id")).agg(F.collect_list(row).alias("edits"))
    return frame.join(grouped, frame["doc_id"] == grouped["of_id"], "left").drop("of_id")


def apply_edits(trees: DataFrame, vocabulary: str, leaf: int = 32) -> DataFrame:
    """Trees (the columns of TREE) with a column `edits` (array<struct<start, end, text>>) to the columns of EDITED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in runs(batches, 2 << 20):
            texts, out, sizes, before, encoded = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "starts", "sums", "n_pretokens", "edits"))
            for text, starts, sums, size, edits in zip(*columns, strict=True):
                tree = Tree(starts, np.array(sums, np.int64))
                before.append(tree.total)
                text, new, n = edited(text or "", tree, edit_list(edits), counter, leaf)
                texts.append(text)
                out.append(new)
                sizes.append(size)
                encoded.append(n)
            yield tree_frame(batch, pa.array(texts, pa.string()), out, sizes, before, encoded)

    return trees.select("doc_id", "text", "starts", "sums", "n_pretokens", "edits").mapInArrow(run, EDITED)


def edit_list(edits: list[dict] | None) -> list[tuple[int, int, str]]:
    return [(e["start"], e["end"], e["text"] or "") for e in edits or () if e["start"] is not None and e["end"] is not None]


def count_edited(docs: DataFrame, vocabulary: str, leaf: int = 32) -> DataFrame:
    """doc_id, n_tokens before and n_tokens_edited after the edits in column `edits`, n_pretokens and n_reencoded.

    Builds each tree and edits it in one pass, for corpora whose trees aren't kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in runs(batches, 2 << 20):
            rows = []
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                tree, n = build(text or "", counter, leaf)
                _, new, encoded = edited(text or "", tree, edit_list(edits), counter, leaf)
                rows.append((tree.total, new.total, n, encoded))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "edits")
    return plain.mapInArrow(run, "doc_id long, n_tokens long, n_tokens_edited long, n_pretokens long, n_reencoded long")
