"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of their upper or of their lower 32.  The
anchors of a half are the words of a covering code: a perfect Hamming code of length 31, of covering radius 1, and the
32nd bit as it is.  A fingerprint has one home anchor in each half (the nearest one, within the covering radius) and
is replicated to every anchor within covering radius plus threshold, which is 2; the code being perfect, those are the
homes of what differs from it in at most one bit: 17 a half, 34 in all.  So of any two fingerprints that link, one
comes to the other's home.  There are 2 ** 27 anchors a half, so that anchors stay nearly empty for billions of
fingerprints; equal fingerprints are one from the start.  Anchors never emit all their pairs: small ones emit
their links, large ones a spanning forest of them.

`near_duplicates` links fingerprints of 64 bits that differ in 3 at most.  `similar_documents` is for a similarity of
texts: 3 of 64 bits are far stricter than a Jaccard similarity of 0.8, at which 39 of 256 differ on average, and no code
with that threshold has anchors enough.  It takes 256 bits a document, and `CODES` codes instead of two: each is all
words over 27 of the bits, chosen by a fixed seed, so that covering radius and threshold are 0 and a document has one
anchor a code.  Documents of one anchor whose first 64 bits are alike are compared by all 256, of which as many may
differ as do on average at that similarity, and one standard error more.

Defined results: a null or empty text has fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; rows with a null doc_id get a fingerprint, and the component of the rows that share it; every
row of the input gives one row; an empty table gives no rows; further columns are ignored.  `similar_documents` tells
texts apart by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import as_documents, checkpointed, partitions, runs, stored, texts
from waymark.llm.components import components

SEED, HALF, THRESHOLD = 42, 32, 3
CODES, WORD, LOOSE = 128, 27, 18  # codes over 256 bits, the bits of each, and how many of the first 64 a pair may differ in
SMALL = 32  # rows of an anchor up to which it emits its links as they are
PAIRS = 1 << 22  # comparisons at a time
OFTEN, MOST_OFTEN = 8, 100_000  # documents of a batch from which a shingle counts as frequent, and how many are known as such
MOST_NODES = 1_000_000  # rows up to which a table of their numbers goes to all tasks


def shingles(text: bytes, width: int) -> list[bytes]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < width:
        return [joined]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]]
    n = len(words) - width + 1
    return [joined[s:e] for s, e in zip(starts[:n].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: np.ndarray) -> np.ndarray:
    """Words of 64 bits, each bit set if it is in over half of the rows."""
    ones, wide = np.zeros(64 * hashes.shape[1], np.int64), hashes.shape[1]
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8 * wide), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    some, digest = shingles(text, width), xxhash.xxh64_intdigest
    return int(majority(np.fromiter([digest(x, SEED) for x in some], np.uint64, len(some)).reshape(-1, 1))[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 8 << 20):
            values = np.array([fingerprint(t, width) for t in texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return as_documents(docs).mapInArrow(run, "doc_id long, fp long")


def parity(x: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(x) & 1).astype(np.uint32)


#: Check i of the Hamming code covers the positions 1 to 31 (bits 0 to 30) whose number has bit i.
CHECKS = [np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> i & 1)) for i in range(5)]


def home(half: np.ndarray) -> np.ndarray:
    """The nearest anchor of 32-bit words."""
    wrong = sum(parity(half & c) << np.uint32(i) for i, c in enumerate(CHECKS))  # the position to flip; 0: none
    return np.where(wrong > 0, half ^ (np.uint32(1) << ((wrong - 1) & np.uint32(31))), half)


def anchors(half: np.ndarray) -> np.ndarray:
    """Every anchor within covering radius plus threshold of each word, as columns, the home first; repeats elsewhere."""
    flips = np.r_[np.uint32(0), np.uint32(1) << np.arange(HALF, dtype=np.uint32)]
    return home(half[:, None] ^ flips[None, :])


def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp, rep) to one row per anchor: anchor (with the half in bit 32), fp, rep, at_home."""
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            fp, rep = (part.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            for k in (0, 1):
                half = (fp.view(np.uint64) >> np.uint64(HALF * k)).astype(np.uint32)
                reached = anchors(half)
                own = reached[:, :1]
                order = np.sort(reached, axis=1)
                first = np.c_[np.ones((len(fp), 1), bool), order[:, 1:] != order[:, :-1]]
                row, column = np.nonzero(first)
                anchor = order[row, column]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int64) | np.int64(k << HALF)), pa.array(fp[row]), pa.array(rep[row]), pa.array(anchor == own[row, 0])], ["anchor", "fp", "rep", "at_home"]
                )


def forest(fp: np.ndarray, at_home: np.ndarray, most: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links between rows of one anchor that span what its links connect; either end of a link is at home."""
    left, out = np.arange(len(fp)), []
    while len(left):
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            step = max(1, PAIRS // len(left))
            some, frontier = frontier[:step], frontier[step:]
            near = (np.bitwise_count(fp[some][:, None] ^ fp[left][None, :]) <= most) & (at_home[some][:, None] | at_home[left][None, :])
            hit = near.any(axis=0)
            out += zip(some[near[:, hit].argmax(axis=0)].tolist(), left[hit].tolist(), strict=True)
            frontier, left = np.r_[frontier, left[hit]], left[~hit]
    return out


def link(batches: Iterator[pa.RecordBatch], most: int = THRESHOLD) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor to links (a, b) between reps whose fingerprints differ in `most` bits or fewer."""

    def links(anchor: np.ndarray, fp: np.ndarray, rep: np.ndarray, at_home: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[starts, len(anchor)])
        found = []
        small = np.repeat(sizes <= SMALL, sizes)
        for shift in range(1, min(SMALL, int(sizes.max(initial=1)))):
            i = np.flatnonzero((anchor[shift:] == anchor[:-shift]) & small[shift:] & (at_home[shift:] | at_home[:-shift]))
            i = i[np.bitwise_count(fp[i] ^ fp[i + shift]) <= most]
            found.append(np.stack([rep[i], rep[i + shift]]))
        for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            if pairs := forest(fp[s : s + n], at_home[s : s + n], most):
                found.append(rep[s + np.array(pairs).T])
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)]
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        new[1] = new[1].view(np.uint64)
        held = [np.concatenate(x) for x in zip(held, new, strict=True)]
        if len(held[0]):
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last anchor may go on
            if cut:
                yield links(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
    if len(held[0]):
        yield links(*held)


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp, and component_id: the smallest doc_id reachable over links, its own included."""
    marked = checkpointed(fingerprints(docs, width))
    reps = marked.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    spread = reps.where("rep is not null").mapInArrow(replicate, "anchor long, fp long, rep long, at_home boolean")
    met = spread.repartition(partitions(docs.sparkSession), "anchor").sortWithinPartitions("anchor", "rep")
    found = components(met.mapInArrow(link, "a long, b long"))
    of_fp = reps.join(found, reps["rep"] == found["node"], "left").select(F.col("fp").alias("own"), F.coalesce("root", "rep").alias("component_id"))
    return marked.join(of_fp, marked["fp"] == of_fp["own"], "left").select("doc_id", "fp", "component_id")


def bits_apart(similarity: float, bits: int) -> int:
    """How many of so many bits may differ between texts of this Jaccard similarity: their average and a standard error."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * share + np.sqrt(bits * share * (1 - share)))


def words_of(prints: np.ndarray, code: int) -> np.ndarray:
    """The anchor of each fingerprint (rows of four words) in a code."""
    chosen = np.random.default_rng(code).choice(256, WORD, replace=False)
    out = np.full(len(prints), code << WORD, np.int64)
    for i, bit in enumerate(chosen):
        out |= ((prints[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64) << np.int64(i)
    return out


def marks_of(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """256 bits of fingerprint, and the hashes of the distinct shingles, ascending."""
    some, digest = shingles(text, width), xxhash.xxh3_128_digest
    if not some:
        return np.zeros(4, np.uint64), np.zeros(0, np.uint64)
    columns = [np.frombuffer(b"".join([digest(x, seed) for x in some]), np.uint64).reshape(-1, 2) for seed in (0, 1)]
    return majority(np.concatenate(columns, axis=1)), np.unique(columns[0][:, 0])


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The set that marks_of has."""
    return np.unique(np.frombuffer(b"".join([xxhash.xxh3_128_digest(x, 0) for x in shingles(text, width)]), np.uint64)[::2])


def prefix(some: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The shingles of a set, rare ones first, of which two sets of this similarity share one at least.

    common: hashes, ascending, and counts of those known to be frequent; any order that all sets follow will do."""
    names, counts = common
    at = np.minimum(np.searchsorted(names, some), max(0, len(names) - 1))
    often = np.where(names[at] == some, counts[at], 0) if len(names) else np.zeros(len(some), np.int64)
    return some[np.lexsort((some, often))][: len(some) - int(np.ceil(similarity * len(some) - 1e-9)) + 1] if len(some) else some


def meeting(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, n, place, row, part) sorted by shingle and n to pairs (a, b, na, nb) of different parts that may have
    this similarity, once a shared shingle: by their numbers of shingles, and by what can be common before and after it."""

    def may(i: np.ndarray, j: np.ndarray, n: np.ndarray, place: np.ndarray, part: np.ndarray) -> np.ndarray:
        shared = np.minimum(place[i], place[j]) + np.minimum(n[i] - place[i], n[j] - place[j])
        return (part[i] != part[j]) & (n[i] >= similarity * n[j] - 1e-9) & (shared >= similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9)

    def pairs(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        shingle, n, place, row, part = held
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        sizes = np.diff(np.r_[starts, len(shingle)])
        mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
        small, out = np.repeat((sizes <= SMALL) & mixed, sizes), []
        for shift in range(1, min(SMALL, int(sizes.max()))):
            i = np.flatnonzero((shingle[shift:] == shingle[:-shift]) & small[shift:])
            i = i[may(i, i + shift, n, place, part)]
            out.append((i, i + shift))
        for s, size in zip(starts[(sizes > SMALL) & mixed].tolist(), sizes[(sizes > SMALL) & mixed].tolist(), strict=True):
            last = s + np.searchsorted(n[s : s + size], n[s : s + size] / similarity + 1e-6, side="right")  # sorted by n
            many = last - np.arange(s, s + size) - 1
            for some in np.split(np.arange(size), np.flatnonzero(np.diff(np.cumsum(many) // PAIRS)) + 1):
                i = np.repeat(s + some, many[some])
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
                good = may(i, j, n, place, part)
                yield edges(i[good], j[good], n, row)
        if out:
            yield edges(*(np.concatenate(x) for x in zip(*out, strict=True)), n, row)

    def edges(i: np.ndarray, j: np.ndarray, n: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        turned = row[i] > row[j]
        i, j = np.where(turned, j, i), np.where(turned, i, j)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (row[i], row[j], n[i], n[j])], ["a", "b", "na", "nb"])

    held: list[np.ndarray] = []
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
        if len(held[0]) and (cut := int(np.searchsorted(held[0], held[0][-1]))):  # the last shingle may go on
            yield from pairs([x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held and len(held[0]):
        yield from pairs(held)


def alike(pairs: DataFrame, texts_of: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of rows whose sets of shingles have this Jaccard similarity or more, counted exactly."""
    nodes = stored(pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct())
    nodes = F.broadcast(nodes) if nodes.count() <= MOST_NODES else nodes.hint("merge")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 8 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([shingle_set(t, width).tobytes() for t in texts(batch.column("text"))], pa.binary())], ["row", "held"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("a_held").to_pylist(), batch.column("b_held").to_pylist(), strict=True):
                common = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                good.append(common >= similarity * ((len(a) + len(b)) // 8 - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    held = stored(texts_of.join(nodes, "row", "left_semi").mapInArrow(sets, "row long, held binary").groupBy("row").agg(F.first("held").alias("held")))
    of = lambda side: held.select(F.col("row").alias(side), F.col("held").alias(f"{side}_held")).hint("merge")
    return stored(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "a_held", "b_held").mapInArrow(verify, "a long, b long"))


def similar_documents(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, and component_id: the smallest doc_id reachable over links between documents whose sets of shingles have
    this Jaccard similarity or more; its own included.

    Links come by the codes, then, between documents that those leave apart, by shared rare shingles, so that none is left
    out; every one is counted exactly.
    """
    names = [*(f"fp{k}" for k in range(4)), "set0", "set1"]
    allowed, prints_of = bits_apart(similarity, 256), [f"fp{k}" for k in range(4)]
    context = docs.sparkSession.sparkContext
    hashed = as_documents(docs).withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))  # tells texts apart, however often they are read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 8 << 20):
            found = [marks_of(t, width) for t in texts(batch.column("text"))]
            keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for _, s in found), np.int64).reshape(-1, 2)
            values = np.c_[np.array([p for p, _ in found], np.uint64).reshape(-1, 4).view(np.int64), keys]
            shingle, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s for _, s in found)]), return_counts=True)
            shingle, times = shingle[times >= OFTEN].view(np.int64), times[times >= OFTEN].astype(np.int64)
            n, m = len(found), len(shingle)
            columns = [pa.concat_arrays([c, pa.nulls(m, pa.int64())]) for c in (batch.column("doc_id"), batch.column("row"), *(pa.array(np.ascontiguousarray(values[:, k])) for k in range(6)))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c)]) for c in (shingle, times))], ["doc_id", "row", *names, "shingle", "times"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, prints = batch.column("row"), np.stack([batch.column(n).to_numpy() for n in prints_of], axis=1).view(np.uint64)
            home = pa.array(np.ones(len(prints), bool))
            for code in range(CODES):
                yield pa.RecordBatch.from_arrays([pa.array(words_of(prints, code)), batch.column("fp0"), rep, home], ["anchor", "fp", "rep", "at_home"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = sum(np.bitwise_count((batch.column(f"a_{n}").to_numpy() ^ batch.column(f"b_{n}").to_numpy()).view(np.uint64)).astype(np.int64) for n in prints_of)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= allowed))

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 8 << 20):
            sets = [shingle_set(t, width) for t in texts(batch.column("text"))]
            first = [prefix(s, common.value, similarity).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(first, pa.binary())], ["row", "n", "first"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [np.frombuffer(x, np.int64) for x in batch.column("first").to_pylist()]
            sizes = [len(x) for x in first]
            places = np.concatenate([np.zeros(0, np.int64), *(np.arange(k) for k in sizes)])
            repeated = [np.repeat(batch.column(k).to_numpy(), sizes) for k in ("n", "row", "part")]
            columns = [np.concatenate([np.zeros(0, np.int64), *first]), repeated[0], places, *repeated[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "n", "place", "row", "part"])

    parts = partitions(docs.sparkSession)
    found = stored(hashed.mapInArrow(run, ", ".join(f"{n} long" for n in ["doc_id", "row", *names, "shingle", "times"])))
    marked = found.where("row IS NOT NULL").select("doc_id", *names, "row")
    reps = stored(marked.groupBy(*names).agg(F.min("doc_id").alias("least"), F.min("row").alias("row")).where("least IS NOT NULL"))
    met = reps.mapInArrow(spread, "anchor long, fp long, rep long, at_home boolean").repartition(parts, "anchor").sortWithinPartitions("anchor", "rep")
    candidates = met.mapInArrow(lambda batches: link(batches, LOOSE), "a long, b long").distinct()
    of = lambda side: reps.select(F.col("row").alias(side), *[F.col(n).alias(f"{side}_{n}") for n in prints_of])
    close = stored(candidates.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), "b").mapInArrow(verify, "a long, b long"))
    links = alike(close, hashed.select("row", "text"), width, similarity)
    grouped = components(links)
    often = found.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(MOST_OFTEN).toArrow()
    shingle, times = often["shingle"].to_numpy().view(np.uint64), often["times"].to_numpy()
    order = np.argsort(shingle)
    common = context.broadcast((shingle[order], times[order]))
    of_row = stored(reps.join(grouped, reps["row"] == grouped["node"], "left").select("row", F.coalesce("root", "row").alias("part")))
    first = hashed.select("row", "text").mapInArrow(starts, "row long, n long, first binary").groupBy("row").agg(F.first("n").alias("n"), F.first("first").alias("first")).join(of_row.hint("merge"), "row")
    met = first.select("row", "n", "first", "part").mapInArrow(dealt, "shingle long, n long, place long, row long, part long").repartition(parts, "shingle").sortWithinPartitions("shingle", "n", "row")
    together = met.mapInArrow(lambda batches: meeting(batches, similarity), "a long, b long, na long, nb long").groupBy("a", "b", "na", "nb").count()
    # Of the pair, the text whose prefix ends first has all other common shingles behind it: at most ceil(0.8 n) - 1.
    behind = F.greatest(*(F.ceil(similarity * F.col(n) - 1e-9) for n in ("na", "nb"))) - 1
    rest = stored(together.where(F.col("count") + behind >= similarity / (1 + similarity) * (F.col("na") + F.col("nb")) - 1e-6).select("a", "b"))
    whole = components(links.unionByName(alike(rest, hashed.select("row", "text"), width, similarity)))
    rooted = stored(reps.join(whole, reps["row"] == whole["node"], "left").select(*names, "least", F.coalesce("root", "row").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(smallest.hint("merge"), "root").select(*names, "component_id")
    return marked.drop("row").join(of_print.hint("merge"), names, "left").select("doc_id", "component_id")
