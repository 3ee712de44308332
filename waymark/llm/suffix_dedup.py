"""Removal of repeated passages: every byte covered by a `width`-byte string that starts in an earlier document too.

The strings are never all sorted in one place.  Each has an anchor, its `seed` bytes with the smallest hash; equal
strings have equal anchors at equal offsets, so whatever repeats meets where its anchor goes.

1. Each task finds the anchors of its texts, with a hash of each anchor's context: the bytes that strings around it
   can hold.  Where a context occurs in several documents of a batch, only the first document's goes on; the others
   are repeats already.  Anchors go to buckets by hash, as compressed columns.
2. A bucket compares anchors by context: an equal one in an earlier document makes a whole context a repeat.  Anchors
   that occur with different contexts, which is where repeats begin or end, ask for their texts.
3. Some thousand anchors' contexts at a time make a run-length index (`runlength`): a Burrows-Wheeler transform held
   as runs, each with a sample at its head, the smallest document that it comes from.  Copies of a context make one
   run.  The contexts are streamed past the index by backward search, and a position whose matching statistic reaches
   `width` with a sample of an earlier document is the start of a repeat.
4. Repeats are merged per document and cut from its text.

An anchor with more than `hot` different contexts in one batch, such as a common phrase in ever new surroundings, does
not go to its bucket but for a mark; then all strings around it, from every batch, meet by their own 128-bit hashes
instead, in a minimum that is combined before the shuffle, and a join that Spark may split.

Memory of a task is its bucket's anchors, at most `hot` contexts of each from a batch; buckets are as many as the
session's shuffle partitions.  Hashes of anchors and contexts have 96 bits and the bucket's.

Defined results: text is UTF-8 bytes, null is empty; a document never repeats itself, nor another row of its doc_id; a
null doc_id comes before all others; rows equal in doc_id and text fare alike; every row gives one row; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import as_documents, compress, packed_runs, partitions, squeezed, stored, unpacked
from waymark.llm.runlength import RunLengthIndex

NO_ID = -(1 << 63)  # stands for a null doc_id
SEGMENT = 1 << 20  # bytes hashed at a time
BASE = 0x9E3779B97F4A7C15
TOP = np.uint64(21)  # bits of a place within a segment; SEGMENT and its overlap fit
ROW = np.dtype([("h", "<u4"), ("c1", "<u4"), ("c2", "<u4"), ("left", "u1"), ("right", "u1"), ("pos", "<u4"), ("doc", "<i8"), ("row", "<i8")])
MARK = 255  # in place of `left`: the anchor is hot
BATCH = 16_000  # contexts of an index
FOUND = "bucket int, blob binary, row long, low long, high long, w1 long, w2 long, doc long"
COMPARED = "row long, low long, high long, w1 long, w2 long, doc long, left int, right int, anchor long"


@lru_cache(maxsize=2)
def powers(base: int, n: int = 2 * SEGMENT) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def anchors(parts: list[tuple[int, bytes]], width: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of segments (start in the text, bytes): for each anchor its segment, place in the text, bytes of context on its
    left and right, hash, and context's hash."""
    joined = np.frombuffer(b"".join(b for _, b in parts), np.uint8)
    n, reach, span = len(joined), width - seed, width - seed + 1
    sizes = np.array([len(b) for _, b in parts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    forth, back = powers(BASE), powers(pow(BASE, -1, 1 << 64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * forth[:n], out=sums[1:])
    hashes = mixed((sums[seed:] - sums[:-seed]) * back[: n - seed + 1])
    least = (hashes >> TOP << TOP) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[: size - span], least[span - size :])
    inside = np.zeros(len(least) + 1, np.int64)
    long = sizes >= width
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - width + 1, -1)
    places = (least[np.cumsum(inside)[:-1] > 0] & np.uint64((1 << 21) - 1)).astype(np.int64)
    places = places[np.r_[True, places[1:] != places[:-1]]] if len(places) else places
    part = np.searchsorted(ends, places, side="right")
    low, high = np.maximum(places - reach, starts[part]), np.minimum(places + seed + reach, ends[part])
    contexts = mixed(((sums[high] - sums[low]) * back[low]) ^ ((places - low).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    first = np.array([s for s, _ in parts])[part]
    return part, places - starts[part] + first, places - low, high - places - seed, hashes[places], contexts


def pack_rows(rows: np.ndarray) -> bytes:
    """Rows as columns, byte by byte, compressed."""
    return compress(b"".join(np.ascontiguousarray(rows[n]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for n in ROW.names))


def unpack_rows(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    out, at = np.zeros(len(raw) // ROW.itemsize, ROW), 0
    for n in ROW.names:
        size = ROW[n].itemsize
        out[n] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, size * len(out), at).reshape(size, len(out)).T).view(ROW[n]).ravel()
        at += size * len(out)
    return out


def hashes_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of packed rows the hashes, and which are marks, without the other columns."""
    raw = zstandard.decompress(blob)
    n = len(raw) // ROW.itemsize
    h = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n).T).view(ROW["h"]).ravel()
    return h, np.frombuffer(raw, np.uint8, n, 12 * n) == MARK


def repeated(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a bucket whose anchor occurs twice or is marked, and the marked hashes; the others are never held
    unpacked together."""
    hashes, marks = (np.concatenate(x) for x in zip(*map(hashes_of, blobs), strict=True))
    marked, ordered = np.unique(hashes[marks]), np.sort(hashes[~marks])
    del hashes, marks
    wanted = np.union1d(ordered[1:][ordered[1:] == ordered[:-1]], marked)
    del ordered
    return np.concatenate([x[(x["left"] != MARK) & among(x["h"], wanted)] for x in map(unpack_rows, blobs)]), marked


def among(some: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of some are in wanted, sorted: searched for, as np.isin would sort all that is wanted again for each blob."""
    if not len(wanted):
        return np.zeros(len(some), bool)
    return wanted[np.minimum(np.searchsorted(wanted, some), len(wanted) - 1)] == some


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns change."""
    changed = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        changed |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[len(columns[0]) > 0, changed])


def merged(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of the intervals of each row."""
    if not len(row):
        return row, low, high
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    group = np.zeros(len(row), np.int64)
    group[starts_of(row)] = 1
    lift = np.cumsum(group) * (1 << 33)  # keeps rows apart in one running maximum
    reached = np.maximum.accumulate(high + lift)
    new = np.r_[True, low[1:] + lift[1:] > reached[:-1]]
    at = np.flatnonzero(new)
    return row[at], low[at], (reached - lift)[np.r_[at[1:] - 1, len(row) - 1]]


def frame(schema: str, n: int, **columns: object) -> pa.RecordBatch:
    """n rows of the columns given; the others of the schema are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def covers(schema: str, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    row, low, high = merged(row.astype(np.int64), low.astype(np.int64), high.astype(np.int64))
    return frame(schema, len(row), row=row, low=low, high=high)


def covers_of(schema: str, rows: np.ndarray, seed: int) -> pa.RecordBatch:
    """The whole contexts of anchors."""
    at = rows["pos"].astype(np.int64)
    return covers(schema, rows["row"], at - rows["left"], at + seed + rows["right"])


def windows_of(schema: str, found: list[tuple[int, int, int, bytes]], width: int) -> pa.RecordBatch:
    """The strings of contexts (row, doc, place, bytes) by their hashes."""
    out = [(row, low + i, doc, xxhash.xxh3_128_digest(context[i : i + width])) for row, doc, low, context in found for i in range(len(context) - width + 1)]
    keys = np.frombuffer(b"".join(x[3] for x in out), np.int64).reshape(-1, 2)
    return frame(schema, len(out), row=[x[0] for x in out], low=[x[1] for x in out], doc=[x[2] for x in out], w1=keys[:, 0], w2=keys[:, 1])


def index_repeats(contexts: list[bytes], docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) of every `width`-byte string in the contexts that a context of a smaller document holds."""
    if not contexts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    which, start, length, sample = RunLengthIndex.of(contexts, docs, width).matches(contexts)
    hit = (length == width) & (sample < docs[which])
    return which[hit], start[hit]


def remove_repeats(docs: DataFrame, width: int = 50, seed: int = 24, hot: int = 1000) -> DataFrame:
    """doc_id, text (binary: what is left), n_bytes, n_removed, spans (array of struct(low, high), the removed runs)."""
    if not 8 <= seed < width <= 250:
        raise ValueError("takes a seed of 8 bytes or more that is shorter than the width, and a width of 250 at most")
    buckets = partitions(docs.sparkSession)
    whole = as_documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text", F.monotonically_increasing_id().alias("row"))
    packed = stored(squeezed(whole).drop("text_key"))  # rows keep the numbers that they have there

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packed_runs(batches, 6 << 20):
            found: list[tuple[np.ndarray, np.ndarray]] = []
            parts: list[tuple[int, bytes]] = []
            owners: list[tuple[int, int]] = []
            held = 0

            def flush() -> None:
                part, pos, left, right, h, c = anchors(parts, width, seed)
                rows = np.zeros(len(part), ROW)
                owner = np.array(owners, np.int64).reshape(-1, 2)[part]
                rows["doc"], rows["row"], rows["pos"], rows["left"], rows["right"] = owner[:, 0], owner[:, 1], pos, left, right
                rows["h"], rows["c1"], rows["c2"] = h >> np.uint64(32), c >> np.uint64(32), c & np.uint64(0xFFFFFFFF)
                found.append((rows, h % np.uint64(buckets)))
                parts.clear()
                owners.clear()

            given = [x or b"" for x in unpacked(batch.column("packed"))]
            rows_of = batch.column("row").to_pylist()
            for doc, row, text in zip(batch.column("doc").to_pylist(), rows_of, given, strict=True):
                for start in range(0, max(1, len(text) - width + 1), SEGMENT - width):
                    piece = text[start : start + SEGMENT - 1]
                    if len(piece) < width:
                        continue
                    if held + len(piece) > SEGMENT and parts:
                        flush()
                        held = 0
                    parts.append((start, piece))
                    owners.append((doc, row))
                    held += len(piece)
            if parts:
                flush()
            if not found:
                continue
            rows, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((rows["pos"], rows["row"], rows["doc"], rows["c2"], rows["c1"], rows["h"], bucket))
            rows, bucket = rows[order], bucket[order]
            groups = starts_of(bucket, rows["h"], rows["c1"], rows["c2"])
            first = np.repeat(rows["doc"][groups], np.diff(np.r_[groups, len(rows)]))
            again = rows["doc"] > first
            yield covers_of(FOUND, rows[again], seed)
            by_anchor = starts_of(bucket, rows["h"])
            kinds = np.diff(np.r_[np.searchsorted(groups, by_anchor), len(groups)])
            crowded = np.repeat(kinds > hot, np.diff(np.r_[by_anchor, len(rows)]))
            if crowded.any():
                texts_of = dict(zip(rows_of, given, strict=True))
                for some in np.array_split(rows[crowded & ~again], max(1, int(crowded.sum()) // 2000)):
                    around = [(int(r["row"]), int(r["doc"]), int(r["pos"]) - int(r["left"]), int(r["pos"]) + seed + int(r["right"])) for r in some]
                    yield windows_of(FOUND, [(row, doc, low, texts_of[row][low:high]) for row, doc, low, high in around], width)
                marks = np.zeros(len(rows), bool)
                marks[by_anchor[kinds > hot]] = True
                rows["left"][marks] = MARK
                keep = marks | ~(crowded | again)
            else:
                keep = ~again
            rows, bucket = rows[keep], bucket[keep]
            order = np.lexsort((rows["pos"], rows["doc"], bucket))
            rows, bucket = rows[order], bucket[order]
            at = starts_of(bucket)
            blobs = [pack_rows(x) for x in np.split(rows, at[1:])] if len(rows) else []
            yield frame(FOUND, len(blobs), bucket=bucket[at].astype(np.int32), blob=blobs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}  # packed: most anchors of a bucket occur once, and are never unpacked together
        for batch in batches:
            blob = batch.column("blob")
            sent = batch.filter(blob.is_null())
            if sent.num_rows:
                yield frame(COMPARED, sent.num_rows, **{k: sent.column(k) for k in ("row", "low", "high", "w1", "w2", "doc")})
            for bucket, some in zip(batch.column("bucket").to_pylist(), blob.to_pylist(), strict=True):
                if some is not None:
                    held.setdefault(bucket, []).append(some)
        for bucket in list(held):
            rows, marked = repeated(held.pop(bucket))
            rows = rows[np.lexsort((rows["pos"], rows["row"], rows["doc"], rows["c2"], rows["c1"], rows["h"]))]
            if not len(rows):
                continue
            by_h, by_c = starts_of(rows["h"]), starts_of(rows["h"], rows["c1"], rows["c2"])
            size_h, size_c = np.diff(np.r_[by_h, len(rows)]), np.diff(np.r_[by_c, len(rows)])
            first = np.repeat(rows["doc"][by_c], size_c)
            yield covers_of(COMPARED, rows[rows["doc"] > first], seed)
            kinds = np.searchsorted(by_c, np.r_[by_h[1:], len(rows)]) - np.searchsorted(by_c, by_h)
            apart = np.minimum.reduceat(rows["doc"], by_h) != np.maximum.reduceat(rows["doc"], by_h)
            crowded = np.isin(rows["h"], marked)
            asks = (np.repeat((kinds > 1) & apart, size_h) | crowded) & (rows["doc"] == first)
            crowded, asks = crowded[asks], rows[asks]
            anchor = np.int64(bucket) << np.int64(32) | asks["h"].astype(np.int64)
            yield frame(
                COMPARED, len(asks), row=asks["row"], doc=asks["doc"], low=asks["pos"].astype(np.int64), left=asks["left"].astype(np.int32), right=asks["right"].astype(np.int32),
                anchor=np.where(crowded, -1, anchor),
            )

    contexts_schema = "anchor long, context binary, row long, low long, w1 long, w2 long, doc long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Requests with their text to contexts, those of hot anchors to hashed strings."""
        for batch in packed_runs(batches):
            plain, crowded = [], []
            for doc, row, text, asks in zip(batch.column("doc").to_pylist(), batch.column("row").to_pylist(), unpacked(batch.column("packed")), batch.column("asks").to_pylist(), strict=True):
                for a in asks:
                    low = a["low"] - a["left"]
                    (plain if a["anchor"] >= 0 else crowded).append((row, doc, low, text[low : a["low"] + seed + a["right"]], a["anchor"]))
            columns = list(zip(*plain, strict=True)) or [()] * 5
            yield frame(contexts_schema, len(plain), **dict(zip(("row", "doc", "low", "context", "anchor"), columns, strict=True)))
            if crowded:
                yield windows_of(contexts_schema, [x[:4] for x in crowded], width)

    spans_schema = "row long, low long, high long"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts sorted by anchor to the repeats that the run-length index of some thousand anchors' contexts finds."""
        held: list[pa.RecordBatch] = []

        def search(some: pa.Table) -> pa.RecordBatch:
            doc, row, low = (some.column(k).to_numpy() for k in ("doc", "row", "low"))
            which, start = index_repeats(some.column("context").to_pylist(), doc, width)
            return covers(spans_schema, row[which], low[which] + start, low[which] + start + width)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BATCH:
                joined = pa.Table.from_batches(held)
                anchor = joined.column("anchor").to_numpy()
                end = int(np.searchsorted(anchor, anchor[-1]))
                if end:
                    yield search(joined.slice(0, end))
                    held = joined.slice(end).to_batches()
        if held:
            yield search(pa.Table.from_batches(held))

    found = packed.mapInArrow(find, FOUND)
    dealt = found.repartition(buckets, F.coalesce("bucket", F.pmod(F.xxhash64("row", "low"), F.lit(buckets)).cast("int")))
    compared = stored(dealt.mapInArrow(compare, COMPARED))
    asks = compared.where("anchor IS NOT NULL").groupBy(F.col("row").alias("asking")).agg(F.collect_list(F.struct("low", "left", "right", "anchor")).alias("asks"))
    contexts = stored(packed.join(asks.hint("merge"), packed["row"] == asks["asking"]).mapInArrow(cut, contexts_schema))
    ordered = contexts.where("anchor IS NOT NULL").select("anchor", "context", "row", "low", "doc").repartition(buckets, "anchor").sortWithinPartitions("anchor")
    repeats = ordered.mapInArrow(index, spans_schema)
    strings = compared.where("w1 IS NOT NULL").select("w1", "w2", "row", "low", "doc").unionByName(contexts.where("w1 IS NOT NULL").select("w1", "w2", "row", "low", "doc"))
    least = stored(strings.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most"))
    crowded = strings.join(least.hint("merge"), ["w1", "w2"]).where("doc > least").select("row", "low", (F.col("low") + width).alias("high"))
    spans = compared.where("high IS NOT NULL").select("row", "low", "high").unionByName(repeats).unionByName(crowded)
    spans = spans.groupBy(F.col("row").alias("of_row")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packed_runs(batches):
            rows = []
            for doc, text, found in zip(batch.column("doc").to_pylist(), unpacked(batch.column("packed")), batch.column("spans").to_pylist(), strict=True):
                text, kept, at, joined = text or b"", [], 0, []
                for low, high in sorted((s["low"], s["high"]) for s in found or ()):
                    if joined and low <= joined[-1]["high"]:
                        joined[-1]["high"] = max(joined[-1]["high"], high)
                    else:
                        joined.append({"low": low, "high": high})
                for s in joined:
                    kept.append(text[at : s["low"]])
                    at = s["high"]
                left = b"".join([*kept, text[at:]])
                rows.append((None if doc == NO_ID else doc, left, len(text), len(text) - len(left), joined, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "text", "n_bytes", "n_removed", "spans", "sha256"])

    joined = packed.join(spans.hint("merge"), packed["row"] == spans["of_row"], "left").select("doc", "packed", "spans")
    return joined.mapInArrow(remove, "doc_id long, text binary, n_bytes long, n_removed long, spans array<struct<low long, high long>>, sha256 string")
