"""Operators for training data against brute force, exact round trips and held-out labels, on small tables."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from waymark.llm import chat_format, decontaminate, html_text, line_dedup, packing, quality_rules, runlength, simhash, suffix_dedup, token_counts, toxicity
from waymark.llm.components import components

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa quebec romeo sierra tango".split()
DOC = "doc_id long, text string"


def prose(seed, n):
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + (str(dice.randrange(50)) if dice.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [(i, "\n".join(prose(100 * i + k, 12) for k in range(4))) for i in range(40)]
    odd = [(100, None), (101, ""), (102, "   \n \t"), (103, "é😀" * 40), (104, "x"), (105, "a " * 400), (106, "long " * 30_000), (None, base[3][1]), (107, base[3][1]), (108, base[5][1].replace("alpha", "zulu", 1)), (109, base[0][1]), (109, base[1][1]), (110, base[0][1]), (110, base[0][1])]
    return base + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = ["fp", "start", "score", "n_lines", "doc", "tag", "packed", "good", "sequence_id", "key", "place"]
    return spark.createDataFrame(rows, DOC).repartition(3).select("*", *[F.lit(1).alias(c) for c in clash])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def test_token_counts_equal_a_count_from_scratch(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    counter = token_counts.Counter(path)
    dice = random.Random(5)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "1", ".", "é", "word", " the", "!?", "\t"]
    for _ in range(400):
        text = "".join(dice.choice(alphabet) for _ in range(dice.choice([0, 1, 5, 60, 200])))
        leaf = dice.choice([1, 2, 8])
        tree, _ = token_counts.build(text, counter, leaf)
        edits = []
        for _ in range(dice.randrange(4)):
            start = dice.randrange(len(text) + 2)
            edits.append((start, start + dice.randrange(4), "".join(dice.choice(alphabet) for _ in range(dice.randrange(4)))))
        new, after, _ = token_counts.edited(text, tree, edits, counter, leaf)
        assert after.total == token_counts.build(new, counter, leaf)[0].total == sum(counter.counts(counter.split.findall(new)))
    trees = token_counts.build_trees(docs, path)
    edits = spark.createDataFrame([(1, 5, 9, "new words"), (1, 0, 0, "Start "), (2, None, 4, "x"), (999, 0, 1, "y"), (106, 60_000, 60_005, "")], "doc_id long, start long, end long, text string")
    got = {r["doc_id"]: r for r in token_counts.apply_edits(token_counts.with_edits(trees, edits), path).collect() if r["doc_id"] in (1, 2, 100, 106)}
    for r in got.values():
        assert r["sums"][1] == token_counts.build(r["text"], counter, 32)[0].total
    assert got[106]["n_reencoded"] < 200 and got[2]["n_reencoded"] == 0 and got[100]["sums"][1] == 0
    assert token_counts.build_trees(none, path).count() == 0


def brute_repeats(rows, width=50):
    first, out = {}, []
    plain = [(-1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in sorted(plain):
        for p in range(len(t) - width + 1):
            first.setdefault(t[p : p + width], i)
    for i, t in plain:
        mark = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < i:
                mark[p : p + width] = b"\1" * width
        kept = bytes(c for c, m in zip(t, mark, strict=True) if not m)
        out.append((i, len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup_equals_brute_force(docs, rows, none):
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["sha256"]) for r in got) == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_of_hot_anchors_equals_brute_force(spark):
    phrase = "a phrase of some forty bytes that is common"
    rows = [(k % 150, prose(k, 9) + phrase + prose(3000 + k % 90, 9)) for k in range(200)] + [(None, f"{k} {phrase} {k}" + "!" * 70) for k in range(20)]
    for hot in (1, 64):
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOC).repartition(3), hot=hot).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["sha256"]) for r in got) == brute_repeats(rows)


def test_matching_statistics_equal_brute_force():
    dice = random.Random(3)
    for width in (9, 20, 50):
        alphabet = bytes(range(256)) if width == 9 else b"ab\x00\xff"
        strings = [bytes(dice.choice(alphabet) for _ in range(dice.randrange(60))) for _ in range(30)]
        strings += [s[3:] + t[:20] for s, t in zip(strings, strings[5:], strict=False)] + [b"", strings[2], strings[2]]
        labels = np.array([dice.randrange(20) for _ in strings])
        index = runlength.RunLengthIndex.of(strings, labels, width)
        least = {}
        for s, label in zip(strings, labels.tolist(), strict=True):
            for n in range(width + 1):
                for p in range(len(s) - n + 1):
                    least[s[p : p + n]] = min(least.get(s[p : p + n], 99), label)
        expected = {(k, p): (min(width, len(s) - p), least[s[p : p + width]] if len(s) - p >= width else -1) for k, s in enumerate(strings) for p in range(len(s))}
        assert {(k, p): (n, x) for k, p, n, x in zip(*(c.tolist() for c in index.matches(strings)), strict=True)} == expected
        assert len(index.rows) < index.n


def test_anchors_that_occur_once_are_not_unpacked_together():
    rng = np.random.default_rng(4)
    rows = np.zeros(600_000, suffix_dedup.ROW)
    rows["h"], rows["pos"] = rng.choice(1 << 31, len(rows), replace=False), rng.integers(0, 5000, len(rows))
    rows["h"][::50] = rows["h"][1::50]
    rows["left"][7] = suffix_dedup.MARK
    blobs = [suffix_dedup.pack_rows(x) for x in np.array_split(rows, 60)]
    tracemalloc.start()
    kept, marked = suffix_dedup.repeated(blobs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.7 * rows.nbytes and marked.tolist() == [rows["h"][7]]
    assert sorted(kept["h"].tolist()) == sorted([*rows["h"][::50].tolist(), *rows["h"][1::50].tolist()])


def test_a_bucket_of_many_blobs_takes_no_more_time_than_one_of_few():
    rng = np.random.default_rng(6)
    rows = np.zeros(400_000, suffix_dedup.ROW)
    rows["h"] = np.repeat(rng.choice(1 << 31, len(rows) // 2, replace=False), 2)
    took = {}
    for n in (4, 200, 4, 200):
        blobs = [suffix_dedup.pack_rows(x) for x in np.array_split(rows, n)]
        began = time.process_time()
        kept, marked = suffix_dedup.repeated(blobs)
        took[n] = min(time.process_time() - began, took.get(n, np.inf))
        assert len(kept) == len(rows) and not len(marked)
    assert took[200] < 5 * took[4]
    assert suffix_dedup.among(rows["h"][:3], np.zeros(0, np.uint32)).tolist() == [False] * 3
    assert suffix_dedup.among(np.array([1, 5, 9, 12], np.uint32), np.array([5, 9], np.uint32)).tolist() == [False, True, True, False]


def test_suffix_dedup_over_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 400)
    dice = random.Random(1)
    text = "".join(dice.choice("abcd") for _ in range(3000)).encode()
    found = set()
    for start in range(0, len(text) - 49, 400 - 50):
        part, pos, left, right, _, _ = suffix_dedup.anchors([(start, text[start : start + 399])], 50, 24)
        for p, a, b in zip(pos, left, right, strict=True):
            found |= set(range(p - a, p + 24 + b - 49))
    assert found == set(range(len(text) - 49))  # every string has an anchor that sees it whole


def test_toxicity_learns_and_holds_out(spark, none):
    bad = ["vile", "scumbag", "rotten", "vilest", "scumbags"]
    dice = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        words = prose(i, 60).split()
        for _ in range(6 if toxic else 0):
            words.insert(dice.randrange(len(words)), dice.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (2000, None), (2001, ""), (None, "x")], DOC)
    marks = spark.createDataFrame([*labels, (5000, 1), (None, 1), (2000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, marks).collect()}
    assert len(got) == 903 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [r for r in got.values() if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] for r in held)
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.97
    assert toxicity.score_toxicity(none, marks).count() == 0
    assert {r["score"] for r in toxicity.score_toxicity(docs, marks.where("false")).collect()} == {0.0}


def test_chats_round_trip(spark):
    texts = ["<|im_end|>", "\\<|", "<\\|x", "\\\\", "", None, "a\nb", "<\\n>", "<|im_start|>assistant\nhi"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)] + [(2, 0, None, "x"), (2, 0, "we\nird<|", "y"), (3, None, "user", "q"), (3, None, "user", "q"), (None, 0, "user", "n"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("state", F.lit(0))
    chats = chat_format.format_chats(df).withColumn("back", chat_format.read_back(F.col("formatted"))).withColumn("learnt", chat_format.loss_text(F.col("segments")))
    got = {r["conv_id"]: r for r in chats.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["back"]] == [(r, t or "") for _, _, r, t in rows[:9]]
    assert got[1]["learnt"] == "".join(t or "" for t in texts[1::2])
    assert [(t["role"], t["text"]) for t in got[2]["back"]] == [("", "x"), ("we\nird<|", "y")]
    assert got[3]["n_turns"] == 2 and not got[3]["valid"] and got[4]["valid"] and not got[1]["valid"]
    assert chat_format.format_chats(df.where("false")).count() == 0


def test_leaks_of_a_benchmark_searched_in_parts(spark):
    items = [(k, prose(9000 + k, 20 + k)) for k in range(30)] + [(None, prose(9100, 30)), (None, prose(9101, 30)), (3, prose(9102, 30))]
    rows = [(i, prose(i, 150) + " " + items[i][1] + " " + prose(700 + i, 60) if i < len(items) else prose(i, 200)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items + items[:5], "item_id long, text string")
    result = lambda **more: sorted((tuple(r) for r in decontaminate.find_leaks(docs, benchmark, **more).select("doc_id", "item_id").collect()), key=str)
    whole, parts = result(), result(most_items=4)
    assert whole == parts == sorted([(i, items[i][0]) for i in range(len(items))], key=str)


def test_leaks_are_found_and_clean_documents_are_not(spark, none):
    items = [(k, prose(9000 + k, 20 + k) + ". " + prose(9500 + k, 6) + ".") for k in range(12)]
    rows = [(i, prose(i, 300)) for i in range(120)]
    hit = {}
    for k, (item, text) in enumerate(items):
        words = rows[k][1].split()
        planted = text if k % 2 else " ".join(w for j, w in enumerate(text.split()) if j % 9 != 4)  # every second one with words left out
        rows[k] = (k, " ".join([*words[:77], planted, *words[77:]]))
        hit[k] = item
    docs = spark.createDataFrame([*rows, (500, None), (501, ""), (None, "x y z")], DOC)
    benchmark = spark.createDataFrame([*items, (99, None), (98, ""), (97, "too short")], "item_id long, text string")
    found = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(hit.items())
    assert decontaminate.find_leaks(none, benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.where("false")).count() == 0


def test_paraphrases_of_items_without_an_answer_apart_are_found(spark):
    items = [(k, prose(9000 + k, 24) + "?") for k in range(8)] + [(k, prose(9000 + k, 6) + ". " + prose(9500 + k, 24) + ".") for k in range(8, 16)]
    rows, shares = [(i, prose(i, 300)) for i in range(120)], []
    for k, (_, text) in enumerate(items):
        words, own = rows[k][1].split(), text.split()
        altered = [f"other{k}x{j}" if j % 10 in (1, 4, 8) else w for j, w in enumerate(own)]
        shares.append(sum(a == b for a, b in zip(altered, own, strict=True)) / len(own))
        rows[k] = (k, " ".join([*words[:64], *altered, *words[64:]]))
    found = decontaminate.find_leaks(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(0.65 < x < 0.75 for x in shares)
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(16)} and all(r["lcs_share"] < 0.8 and r["answer_found"] for r in found)


def test_the_basis_is_that_of_all_documents(spark, monkeypatch):
    texts = F.array(*[F.lit(prose(k, 40)) for k in range(150)])
    docs = spark.range(4200).select(F.col("id").alias("doc_id"), F.element_at(texts, (F.col("id") % 150 + 1).cast("int")).alias("text"))
    fitted, plain = [], decontaminate.fit_basis
    monkeypatch.setattr(decontaminate, "fit_basis", lambda words, *more: fitted.append(words.count()) or plain(words, *more))
    found = decontaminate.find_leaks(docs, spark.createDataFrame([(1, prose(0, 40))], "item_id long, text string"))
    assert found.count() == 28 and fitted == [4200]


def test_the_sketch_finds_singular_vectors(spark):
    rows = [(k, prose(k, 70)) for k in range(60)] + [(100, None), (101, "x " * 90)]
    words = decontaminate.looked_up(spark.createDataFrame(rows, DOC)).repartition(3)
    idf = np.random.default_rng(1).random(decontaminate.TERMS).astype(np.float32) + 0.5
    ids, dense = decontaminate.Ids(), []
    for _, text in rows:
        terms = ids.of(text or "") & np.uint32(decontaminate.TERMS - 1)
        for at in range(0, len(terms), 32):
            if len(some := np.unique(terms[at : at + 32])) >= 12:
                dense.append(np.zeros(decontaminate.TERMS, np.float32))
                dense[-1][some] = idf[some] / np.linalg.norm(idf[some])
    terms, weights = zip(*(x for r in words.collect() for x in decontaminate.passages([r["ids"]], idf, 32)), strict=True)
    made = np.zeros((len(dense), decontaminate.TERMS), np.float32)
    for row, t, w in zip(made, np.concatenate(terms), np.concatenate(weights), strict=True):
        np.add.at(row, t, w)
    assert np.allclose(sorted(made.sum(axis=1)), sorted(np.sum(dense, axis=1)), atol=1e-4)
    found = np.array(dense) @ decontaminate.fit_basis(words, idf, 100)
    found = found[:, np.linalg.norm(found, axis=0) > 0.5]
    assert found.shape[1] > 90 and np.allclose(found.T @ found, np.eye(found.shape[1]), atol=0.02)


def test_lcs():
    dice = random.Random(4)
    for _ in range(200):
        a, b = ([dice.randrange(5) for _ in range(dice.randrange(15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs(decontaminate.places(a), len(a), b) == table[-1][-1]
        shared = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(shared) == table[-1][-1] and all(a[i] in rest for i in shared)


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_equal_brute_force(spark, docs, rows, none):
    got = simhash.near_duplicates(docs).collect()
    expected = [(i, brute_fingerprint(t)) for i, t in rows]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % 2**64) for r in got) == sorted((i is None, i or 0, f) for i, f in expected)
    dice = random.Random(6)
    base = [dice.getrandbits(64) for _ in range(60)]
    fps = base + [x ^ sum(1 << dice.randrange(64) for _ in range(dice.randrange(1, 4))) for x in base for _ in range(5)]
    fps += [1 << i | 1 << j for i in range(12) for j in range(12)]  # one dense ball
    fps = np.array(sorted(set(fps)), np.uint64)
    frame = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, rep long")
    met = frame.mapInArrow(simhash.replicate, "anchor long, fp long, rep long, at_home boolean").repartition(4, "anchor").sortWithinPartitions("anchor", "rep")
    found = {r["node"]: r["root"] for r in components(met.mapInArrow(simhash.link, "a long, b long")).collect()}
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3), strict=True):
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    assert [found.get(i, i) for i in range(len(fps))] == [root(i) for i in range(len(fps))]
    assert simhash.near_duplicates(none).count() == 0


def test_similar_documents_have_most_shingles_in_common(spark, docs, none):
    dice, rows, near = random.Random(11), [(i, prose(5000 + i, 220)) for i in range(120)], set()
    for k in range(60):
        words = rows[k][1].split()
        for at in range(9, 220, 220 // (1 + k % 3)):  # a word exchanged costs five shingles
            words[at] = f"other{k}x{at}"
        rows.append((1000 + k, " ".join(words)))
        near.add((k, 1000 + k))
    for k in range(60, 100):  # 0.5 of the shingles or less
        words = rows[k][1].split()
        for at in range(3, 220, 12):
            words[at] = f"other{k}x{at}"
        rows.append((2000 + k, " ".join(words)))
    dice.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(spark.createDataFrame([*rows, (7000, rows[0][1].upper() + " "), (None, "x y z")], DOC)).collect()}
    hit = sum(got[b] == a for a, b in near)
    assert hit >= 0.9 * len(near) and got[7000] == got[rows[0][0]] and got[None] is None
    assert all(got[i] == i for i, _ in rows if i < 1000 or i >= 2000)
    assert simhash.similar_documents(docs).count() == docs.count() and simhash.similar_documents(none).count() == 0


def test_similar_documents_equal_brute_force(spark, docs):
    """No link of 0.8 or more is left out, none below it is there; exchanged words bring the pairs close to it."""
    dice, rows = random.Random(5), [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] < 400]
    for k in range(150):
        words = prose(9000 + k, dice.randrange(8, 260)).split()
        rows.append((10_000 + 10 * k, " ".join(words)))
        for j in range(1, 4):
            for _ in range(max(1, len(words) // 60)):
                words[dice.randrange(len(words))] = f"x{k}y{dice.randrange(10**6)}"
            rows.append((10_000 + 10 * k + j, " ".join(words)))
    rows += [(20_000 + k, "the same opening words are here " + prose(100 + k, 9)) for k in range(80)]  # a crowded shingle
    rows = list({i: (i, t) for i, t in rows}.values())
    sets = {i: set(simhash.shingles((t or "").encode(), 5)) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    borderline = 0
    for a in sorted(sets):
        for b in sorted(sets):
            both, all_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and (10 * both >= 8 * all_):
                borderline += 10 * both < 8.5 * all_
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(spark.createDataFrame(rows, DOC).repartition(5)).collect()}
    assert borderline > 20 and got == {i: find(i) for i, _ in rows}


def test_quality_counts_equal_brute_force(docs, rows, none):
    got = quality_rules.score_quality(docs).collect()

    def brute(text):
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)

    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in got) == sorted((str(i), *brute(t)) for i, t in rows)
    assert quality_rules.score_quality(none).count() == 0


def test_a_rule_that_sees_alone_is_trusted():
    patterns = np.array([[1, 1, 1, 1], [-1, 1, 1, 1], [1, -1, -1, 1], [1, 1, 1, 0]])
    good, model = quality_rules.fit(patterns, np.array([800.0, 90.0, 60.0, 50.0]))
    assert good[0] > 0.9 and good[1] < 0.5 and good[2] < 0.1 and good[3] > 0.9 and model["accuracy"][0] > 0.7


PAGE = '<html><head><title>t</title><script>var x = "</p>";</script></head><body><header>Site</header><nav><a>m</a></nav><div class="cookie-notice">c</div><aside>s</aside>{}<footer>f</footer></body></html>'


def test_html(spark):
    article = "<article><h1>T &amp; U</h1><p>One <b>two</b>\n three<p>five <span class='ad'>buy</span> six<ul><li>a<li>b</ul><div class='comments'>nice</div><form>q</form></article>"
    plain = "<p>Shared line</p><p>Own {}</p><p>Last shared</p>"
    rows = [(1, "http://h/a/1", PAGE.format(article)), (2, "http://h/a/2", PAGE.format(article)), (3, "http://p/x/1", PAGE.format(plain.format(1))), (4, "http://p/x/2?q", PAGE.format(plain.format(2))), (5, None, None), (6, "http://[bad", "a < b"), (7, "http://alone/", PAGE.format(plain.format(3)))]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()}
    assert got[1] == got[2] == "T & U\nOne two three\nfive six\na\nb"
    assert (got[3], got[4], got[5], got[6], got[7]) == ("Own 1", "Own 2", "", "a < b", "Shared line\nOwn 3\nLast shared")
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_pages(rows):
    """Texts by comparing every run of equal pages with its neighbours, in one list."""
    parsed = [(html_text.parse(h or ""), *html_text.place(u), i, html_text.text_hash(f"{u}\n{h}".encode()), u) for i, u, h in rows]
    shared, order = {}, sorted(range(len(rows)), key=lambda k: parsed[k][1:5])
    lines = [[t for t, _ in p[0]] for p in parsed]
    for k, other in zip(order, order[1:], strict=False):
        if parsed[k][1] == parsed[other][1] and lines[k] != lines[other]:
            for x, y in ((k, other), (other, k)):
                shared.setdefault((parsed[x][1], *lines[x]), set()).update(html_text.common_lines(lines[x], lines[y]))
    return [(rows[k][0], html_text.main_text(lines[k], "".join(x for _, x in p[0]), shared.get((p[1], *lines[k]), set()))) for k, p in enumerate(parsed)]


def test_html_is_the_same_over_any_partitions(spark):
    dice, pages = random.Random(9), []
    for k in range(60):
        own = [f"own {k % 23} {j}" for j in range(dice.randrange(4))] + [f"menu {k // 8}", "foot", f"line {dice.randrange(6)}"]
        dice.shuffle(own)
        pages.append((k, f"http://h{k // 30}/p/{k % 40}", "".join(f"<p>{x}</p>" for x in own)))
    pages += pages[:5] + [(100 + k, f"http://h0/p/{k}x", pages[7][2]) for k in range(9)] + [(200, "http://h1/long", "<p>foot</p>" + "<p>x y</p>" * 5000)]
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(n)).collect()
            assert sorted((r["page_id"], r["text"]) for r in got) == sorted(brute_pages(pages))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", plain)


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    expected = {}
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        expected.setdefault(i, []).append(ids)
    filled = {}
    for r in got:
        ids = next(x for x in expected[r["doc_id"]] if len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"])
        assert len(ids[r["start"] : r["start"] + r["length"]]) == r["length"]
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in filled.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]] and sum(n for _, n in pieces) <= 2048
    assert sum(r["length"] for r in got) == sum(len(x) for xs in expected.values() for x in xs)
    assert packing.pack(none, path).count() == 0


def test_tokenizer_ids_are_the_library_s():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = packing.Words(path, cached=3)
    whole = lambda text: np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    for text in ["Σίσυφος ΟΔΟΣ", "İstanbul's don't", "a\x1cb ć", "😀 x‍y 123 ½", "<|endoftext|> hi", "　\x85\xa0x", "ﬁne Ǆ", "'s'S 'T", "Größe ÉTÉ, (x)!", "ab" * 400]:
        assert words.encode(text) == whole(text)
    points = [chr(i) for i in range(1, 0x3000)] + [chr(i) for i in range(0xA000, 0xABFF)] + [chr(i) for i in range(0x1D000, 0x1E900, 7)]
    for text in ["".join(points[i : i + 40]) for i in range(0, len(points), 40)] + [f"a\u0301{p}\u0323 {p} x{p}Y" for p in points]:
        assert words.encode(text) == whole(text), text


def repeats(words, earlier):
    return words in earlier or (len(words) >= 5 and any(line_dedup.within(words, e) for e in earlier if len(e) >= 5))


def test_line_dedup_equals_brute_force(spark, docs, rows, none):
    dice = random.Random(8)
    lines = [prose(k, 8).split() for k in range(30)]
    near = []
    for k, words in enumerate(lines):
        words = list(words)
        at, how = dice.randrange(len(words)), k % 3
        words[at : at + (how != 1)] = [["other"], ["put"], []][how]
        near.append(words)
    template = [["order", "number", str(k), "has", "been", "shipped"] for k in range(50)]
    pool = [" ".join(w) for w in lines + near + template] + ["short line", "Short  line", "short lines", ""]
    dice.shuffle(pool)
    rows = [(i, "\n".join(pool[4 * i : 4 * i + 4] + [pool[0].upper() + "  "])) for i in range(len(pool) // 4)] + [(200, None), (201, ""), (None, pool[0] + "\nsome other text of its own here")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOC).withColumn("place", F.lit(1))).collect()
    earlier, expected = [], {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        expected[i] = []
        for n, line in enumerate((t or "").split("\n")):
            words = line.lower().encode().split()
            if words and repeats(words, earlier):
                expected[i].append(n)
            earlier.append(words)
    assert {r["doc_id"]: r["dropped"] for r in got} == expected
    by = {r["doc_id"]: r for r in got}
    assert by[200]["text"] is None and by[201]["text"] == "" and all(r["place"] == 1 for r in got)
    for i, t in rows:
        if t:
            assert by[i]["text"] == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in expected[i])
    assert line_dedup.dedup_lines(docs).count() == docs.count() and line_dedup.dedup_lines(none).count() == 0


@pytest.mark.parametrize("pieces", [1, 6])
def test_line_dedup_keeps_a_copy_of_repeated_rows(spark, rows, pieces):
    rows = [*rows, *rows[:3], (300, prose(77, 12)), (300, prose(77, 12)), (300, prose(77, 12)), (301, prose(77, 12) + " more"), (None, base := prose(78, 9)), (None, base), (302, base)]
    rows = [r for r in rows if len(r[1] or "") < 10_000]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOC).repartition(pieces)).collect()
    keyed = {(line_dedup.NO_ID if i is None else i, line_dedup.text_hash((t or "").encode())): (i, t) for i, t in rows}
    earlier, kept = [], {}
    for key in sorted(keyed):
        i, t = keyed[key]
        left = []
        for line in (t or "").split("\n"):
            words = line.lower().encode().split()
            if not words or not repeats(words, earlier):
                left.append(line)
            earlier.append(words)
        kept[i, t] = t if t is None else "\n".join(left)
    plain = lambda pairs: sorted((str(i), str(t)) for i, t in pairs)
    assert plain((r["doc_id"], r["text"]) for r in got) == plain((i, kept[i, t]) for i, t in rows)


def test_line_dedup_tells_rows_without_an_id_apart(spark):
    rows = [(None, "\n".join([f"unique line {4 * k + j} of its own kind w{j}x{k} y{k * j}" for j in range(4)] + [f"u{k}"])) for k in range(2000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(r["text"] for r in got) == sorted(t for _, t in rows)
