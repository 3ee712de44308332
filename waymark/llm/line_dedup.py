"""Line dedup by a deletion-neighbourhood join: drop a line if an earlier one is within one word of it.

A line is its words (split at ASCII white space), lower-cased in A-Z.  The edit bound is one word put in, left out or
exchanged; that holds every change inside a word.  A line is dropped if it equals an earlier line, or is within the
bound of one; earlier by doc_id (null first), then by text and place.  Lines of fewer than `min_words` words are
dropped only if they equal an earlier one: one word of so few is another line.

Only the first occurrence of each distinct line goes on.  Lines that can't have a partner are set aside without loss:
of two lines within one word of each other, the first or the last half of the words agree, so only lines that share
such a half with another one (a count that is combined before the shuffle) emit their deletion neighbourhood, and of
the half that they share, nothing.  That is, for each word, the hash of the line without it: with the word's place, to
meet lines that differ in that word, and without, to meet the lines that are just that text.  Each key keeps its
earliest line alone, a minimum that is combined before the shuffle, and what is joined back is a table that was
written, so that Spark may split a hot key: no group is gathered and no pairs are emitted, however many variants a
template has.  Keys have 128 bits; the earliest line that a line meets is then verified, word by word.

Defined results: a null text stays null; a line may hold any text, and lines are split at \\n alone; lines without
words stay; rows of one doc_id (null too) are told apart by 64 bits of their texts' hashes; rows equal in doc_id and
text fare alike, as none is the earlier: a line that no other row or place has before them stays in each; every row of
the input gives one row; an empty table gives no rows; columns other than doc_id and text are passed on, except
`n_lines` and `dropped`, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.common import packed_runs, partitions, runs, squeezed, stored, text_hash, texts, unpacked

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # of the two 64-bit halves of a key; odd
MASK = (1 << 64) - 1
NO_ID = -(1 << 63)  # stands for a null doc_id
PLACE = ["doc", "tag", "number"]  # of a line: doc_id, hash of the text, which line of it
PLACED, PLACE_KINDS = "doc long, tag long, number int", (pa.int64(), pa.int64(), pa.int32())


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def half_keys(words: list[bytes]) -> list[int]:
    """Of what a line shares, at its start (even) or at its end (odd), with every line within the bound."""
    n, digest = len(words), xxhash.xxh3_64_intdigest
    out = []
    for size in {n // 2, (n - 1) // 2} - {0}:
        out += [digest(b" ".join(words[:size]), size) & ~1, digest(b" ".join(words[-size:]), size) | 1]
    return [signed(x) for x in out]


def neighbourhood(words: list[bytes], sides: int) -> list[tuple[int, int, int]]:
    """(key, key, kind): kind 0, the line itself; 1, without a word; 2, without a word and with its place.

    sides: 1 if another line shares the start, 2 if one shares the end, 3 for both.  What differs from a line that
    shares a half is not in it, so that words of a half that all partners share are never left out.

    A key is a polynomial in the words' hashes, so that all variants of a line take time in its length.
    """
    n = len(words)
    hashes = [xxhash.xxh3_128_intdigest(w) for w in words]
    hashed = []
    for side, base in enumerate(BASES):
        h = [x >> 64 * side & MASK for x in hashes]
        before, after, power = [0], [0], [1]
        for x in h:
            before.append((before[-1] * base + x) & MASK)
        for x in reversed(h):
            after.append((after[-1] + x * power[-1]) & MASK)
            power.append(power[-1] * base & MASK)
        without = [(before[i] * power[n - 1 - i] + after[n - 1 - i]) & MASK for i in range(n)]
        hashed.append([before[n], *without])
    mix = lambda x, more: signed((x ^ (more + 1) * BASES[1] & MASK) * BASES[0] & MASK)
    whole, *shorter = zip(*hashed, strict=True)
    out = {(mix(whole[0], 2 * n), signed(whole[1]), 0)}
    some = range((n - 1) // 2 if sides == 1 else 0, n - (n - 1) // 2 if sides == 2 else n)
    for i in some:
        a, b = shorter[i]
        out.add((mix(a, 2 * (n - 1)), signed(b), 1))
        out.add((mix(a, (2 * n + 1) + (i << 32)), signed(b), 2))
    return list(out)


def within(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word is put in, left out or exchanged between a and b."""
    if abs(len(a) - len(b)) > 1:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[start + (len(a) >= len(b)) :] == b[start + (len(b) >= len(a)) :]


def dedup_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """docs with the lines dropped from text, n_lines (before), and dropped (array of the dropped lines' places)."""
    keep = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "dropped")]
    kept = [f"kept_{i}" for i in range(len(keep))]  # names that clash with none
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)])
    n = partitions(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents to their lines; those that equal an earlier one of the batch come without keys."""
        for batch in runs(batches, 8 << 20):
            first: dict[bytes, tuple] = {}
            again: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                doc, tag = NO_ID if doc_id is None else doc_id, text_hash(text)
                for number, line in enumerate(text.split(b"\n")):
                    if words := line.lower().split():
                        key, place = xxhash.xxh3_128_digest(b" ".join(words)), (doc, tag, number)
                        known = first.get(key)
                        if known is None:
                            first[key] = (*place, half_keys(words) if len(words) >= min_words else [])
                        elif place < known[:3]:
                            again.append(known[:3])
                            first[key] = (*place, known[3])
                        elif place > known[:3]:  # a repeated row's line is the very line known
                            again.append(place)
            keys = np.frombuffer(b"".join(first), np.int64).reshape(-1, 2)
            rows, m = list(first.values()), len(again)
            columns = [pa.concat_arrays([pa.array(keys[:, i]), pa.nulls(m, pa.int64())]) for i in (0, 1)]
            columns += [pa.array([r[i] for r in rows] + [r[i] for r in again], kind) for i, kind in enumerate(PLACE_KINDS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in rows] + [None] * m, pa.list_(pa.int64()))], ["k1", "k2", *PLACE, "halves"])

    lines = docs.select("doc_id", "text").mapInArrow(split, f"k1 long, k2 long, {PLACED}, halves array<long>")
    dealt = lines.repartition(n, F.coalesce("k1", F.xxhash64("doc", "number"))).sortWithinPartitions("k1", "k2", *PLACE)
    told = stored(dealt.mapInArrow(firsts, f"{PLACED}, halves array<long>"))

    halves = told.where("size(halves) > 0").select(F.explode("halves").alias("half"), *PLACE)
    shared = stored(halves.groupBy("half").count().where("count > 1").select("half"))
    side = F.col("half").bitwiseAND(1).cast("int") + 1
    asked = stored(halves.join(shared.hint("merge"), "half").groupBy("doc", "tag").agg(F.collect_list(F.struct("number", side.alias("side"))).alias("numbers")))
    picked = identified(docs.select("doc_id", "text")).join(asked.hint("merge"), ["doc", "tag"]).mapInArrow(pick, f"{PLACED}, sides int, line binary")
    candidates = stored(picked.dropDuplicates(PLACE))

    line = F.struct(*PLACE)
    emitted = stored(candidates.mapInArrow(emit, f"v1 long, v2 long, kind int, {PLACED}").select("v1", "v2", "kind", line.alias("line")))
    by_kind = [F.min(F.when(F.col("kind") == k, F.col("line"))).alias(f"least{k}") for k in (0, 1, 2)]
    least = stored(emitted.groupBy("v1", "v2").agg(*by_kind, F.count("*").alias("members")).where("members > 1"))
    #: A line meets those without one of its words, those with one word more, and those that differ in one word.
    partner = F.when(F.col("kind") == 0, F.col("least1")).when(F.col("kind") == 1, F.col("least0")).otherwise(F.col("least2"))
    met = emitted.join(least.hint("merge"), ["v1", "v2"]).select("line", partner.alias("partner")).where("partner < line").groupBy("line").agg(F.min("partner").alias("partner"))
    as_line = lambda name: candidates.select(line.alias(name), F.col("line").alias(f"{name}_text"))
    verified = stored(met).join(as_line("line"), "line").join(as_line("partner").hint("merge"), "partner").mapInArrow(verify, PLACED)

    gone = told.where("halves IS NULL").select(*PLACE).unionByName(verified)
    of_doc = stored(gone.groupBy("doc", "tag").agg(F.array_sort(F.collect_set(F.col("number").cast("long"))).alias("dropped")))
    joined = identified(docs).join(of_doc.hint("merge"), ["doc", "tag"], "left")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("dropped", T.ArrayType(T.LongType()))])
    rebuilt = joined.mapInArrow(lambda batches: rebuild(batches, names), schema)
    return rebuilt.select("doc_id", "text", *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "n_lines", "dropped")


def identified(docs: DataFrame) -> DataFrame:
    """docs with their text packed, and doc and tag, by which lines name them."""
    return squeezed(docs).withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).withColumnRenamed("text_key", "tag")


def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines sorted by key and place: the first of each key as it is, the others without halves; lines of repeated rows once."""
    last, line = (None, None), None
    for batch in batches:
        new, own = np.ones(batch.num_rows, bool), np.ones(batch.num_rows, bool)
        if batch.num_rows:
            keyed = batch.column("k1").is_valid().to_numpy(zero_copy_only=False)
            k1, k2 = (batch.column(k).fill_null(0).to_numpy() for k in ("k1", "k2"))
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            new[0] = (k1[0], k2[0]) != last
            new &= keyed
            place = [batch.column(k).to_numpy() for k in PLACE]
            moved = np.ones(batch.num_rows, bool)
            moved[1:] = np.any([p[1:] != p[:-1] for p in place], axis=0)
            moved[0] = tuple(p[0] for p in place) != line
            own = new | ~keyed | moved
            last, line = (k1[-1], k2[-1]) if keyed[-1] else (None, None), tuple(p[-1] for p in place)
        halves = pa.compute.if_else(pa.array(new), batch.column("halves"), pa.nulls(batch.num_rows, pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in PLACE), halves], [*PLACE, "halves"]).filter(pa.array(own))


def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the numbers of lines to those lines, their words joined by one space, and the halves they share."""
    for batch in packed_runs(batches):
        out = []
        for doc, tag, text, numbers in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), unpacked(batch.column("packed")), batch.column("numbers").to_pylist(), strict=True):
            lines, sides = (text or b"").split(b"\n"), {}
            for x in numbers:
                sides[x["number"]] = sides.get(x["number"], 0) | x["side"]
            out += [(doc, tag, number, some, b" ".join(lines[number].lower().split())) for number, some in sides.items()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [*PLACE_KINDS, pa.int32(), pa.binary()], strict=True)], [*PLACE, "sides", "line"])


def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to their deletion neighbourhoods."""
    for big in batches:
        for batch in (big.slice(at, 1000) for at in range(0, big.num_rows, 1000)):
            keys = [neighbourhood(line.split(b" "), sides) for line, sides in zip(batch.column("line").to_pylist(), batch.column("sides").to_pylist(), strict=True)]
            rows = np.array([k for ks in keys for k in ks], np.int64).reshape(-1, 3)
            at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            columns = [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32)), *(batch.column(k).take(at) for k in PLACE)]
            yield pa.RecordBatch.from_arrays(columns, ["v1", "v2", "kind", *PLACE])


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with a partner to the places of those that are within the bound of it."""
    for batch in batches:
        pairs = zip(batch.column("line_text").to_pylist(), batch.column("partner_text").to_pylist(), strict=True)
        good = batch.column("line").filter(pa.array([within(a.split(b" "), b.split(b" ")) for a, b in pairs], pa.bool_()))
        yield pa.RecordBatch.from_arrays(good.flatten(), PLACE)


def rebuild(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Joined rows to documents without their dropped lines."""
    for batch in packed_runs(batches):
        new, counts, gone = [], [], []
        for text, dropped in zip(unpacked(batch.column("packed")), batch.column("dropped").to_pylist(), strict=True):
            lines, out = (text or b"").split(b"\n"), set(dropped or ())
            counts.append(len(lines) if text is not None else 0)
            gone.append(dropped or [])
            new.append(text if not out else b"\n".join([x for i, x in enumerate(lines) if i not in out]))
        columns = {n: batch.column(n) for n in names if n != "text"} | {"text": pa.array(new, pa.binary()).cast(pa.string())}
        yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), pa.array(counts, pa.int64()), pa.array(gone, pa.list_(pa.int64()))], [*names, "n_lines", "dropped"])
