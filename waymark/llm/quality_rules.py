"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates how far each can be
trusted, and a document's posterior probability of being good replaces "all rules must pass".

`text_counts` measures whole texts; `votes` turns the measures into one vote per rule (1 good, -1 bad, 0 abstains);
`fit` runs expectation-maximisation over the counts of the vote patterns of ALL documents (there are at most
3 ** rules patterns, whatever the corpus; only they reach the driver); `score_quality` puts it together.

Defined results: a null or empty text has no words; every row of the input gives one row, repeated ids too; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import WHITE, as_documents, checkpointed, runs, texts

SYMBOLS = b"#*$%&|<>"
MARKS = b".!?;:,"
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct_words long, n_upper long, n_digits long, n_letters long, n_bangs long"
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(0xC2, 0xF5))


def repeated(words: list[bytes], width: int = 3) -> tuple[int, int]:
    """How many words lie in windows of `width` words found twice or more, and how many words are distinct."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    n = len(words) - width + 1
    if n < 2 or len(numbers) == len(words):
        return 0, len(numbers)
    key, kinds = ids[:n], len(numbers)
    for k in range(1, width):
        if kinds >= 2**62 // len(numbers):  # number the windows so far anew, so that keys fit
            _, key = np.unique(key, return_inverse=True)
            kinds = int(key.max()) + 1
        key, kinds = key * len(numbers) + ids[k : n + k], kinds * len(numbers)
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    starts = order[np.r_[same, False] | np.r_[False, same]]
    cover = np.zeros(len(words) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover) > 0).sum()), len(numbers)


def measure(text: bytes) -> tuple[int, ...]:
    words, solid, seen, dup, filled = text.split(), text.translate(None, WHITE), set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            filled += 1
            dup += line in seen
            seen.add(line)
    repeat, distinct = repeated(words)
    less = lambda drop: len(solid) - len(solid.translate(None, drop))
    return len(words), len(solid) - less(FOLLOWING), less(SYMBOLS), dup, repeat, filled, distinct, less(UPPER), less(DIGITS), less(LETTERS), less(b"!")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the measures named in COUNTS."""
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 8 << 20):
            rows = np.array([measure(t) for t in texts(batch.column("text"))], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(rows[:, i]) for i in range(len(names)))], ["doc_id", *names])

    return as_documents(docs).mapInArrow(run, f"doc_id long, {COUNTS}")


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """One vote per rule, from the measures; a rule abstains between its two limits and where the text is too short for it."""
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda x, of: F.col(x) / F.greatest(of, F.lit(1))
    long = words >= 50
    return {
        "length": vote(words >= 80, words < 50),
        "symbols": vote(share("n_symbols", words) < 0.02, share("n_symbols", words) > 0.1),
        "repeat_words": vote(share("n_repeat_words", words) < 0.2, share("n_repeat_words", words) > 0.5),
        "repeat_lines": vote(share("n_dup_lines", F.col("n_lines")) < 0.1, share("n_dup_lines", F.col("n_lines")) > 0.3),
        "capitals": vote(F.col("n_upper") / chars < 0.1, F.col("n_upper") / chars > 0.4),
        "digits": vote(F.col("n_digits") / chars < 0.05, F.col("n_digits") / chars > 0.2),
        "letters": vote(F.col("n_letters") / chars > 0.85, F.col("n_letters") / chars < 0.65),
        "exclaims": vote(share("n_bangs", words) < 0.02, share("n_bangs", words) > 0.2),
        "variety": vote(long & (share("n_distinct_words", words) > 0.3), long & (share("n_distinct_words", words) < 0.1)),
        "word_length": vote((F.col("word_chars") / F.greatest(words, F.lit(1))).between(3, 10), ~(F.col("word_chars") / F.greatest(words, F.lit(1))).between(2, 14)),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 1.0, trust: float = 0.05) -> tuple[np.ndarray, dict]:
    """Posterior of "good" for each vote pattern, and the model.

    Bad documents are bad in different ways, and two classes alone would let nine rules that see nothing outvote the
    one that does.  So the latent classes are "good" and one failure mode per rule; each class has, per rule, the
    probabilities of its three votes, and expectation-maximisation estimates them and the classes' shares.  It starts
    with each pattern in the modes of the rules that say bad, and in "good" where none does.  A mode's own rule always
    says bad in it, and `trust` of all documents are added to "good" with the votes that don't say bad: without that,
    a mode whose other votes look like "good" could be told as either.  `prior` documents are added to every (class,
    rule, vote).  The model holds the shares, the votes' probabilities, and each rule's
    accuracy: the posterior share of bad among the documents that it calls bad.
    """
    rules = patterns.shape[1]
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    fired = (patterns == -1).astype(float)
    member = np.concatenate([(fired.sum(axis=1, keepdims=True) == 0).astype(float), fired], axis=1)
    member /= member.sum(axis=1, keepdims=True)
    modes = np.arange(1, rules + 1)
    seldom = np.einsum("p,prv->rv", counts, onehot) * (0, 1, 1)
    for _ in range(rounds):
        weight = member * counts[:, None]
        total = np.einsum("pc,prv->crv", weight, onehot) + prior
        total[0] += trust * seldom
        chance = total / total.sum(axis=2, keepdims=True)
        chance[modes, modes - 1] = (1 - 2e-9, 1e-9, 1e-9)
        share = (weight.sum(axis=0) + prior) / (counts.sum() + prior * (rules + 1))
        logs = np.log(share) + np.einsum("prv,crv->pc", onehot, np.log(chance))
        new = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-np.inf))
        new /= new.sum(axis=1, keepdims=True)
        moved, member = np.abs(new - member).max(initial=0), new
        if moved < 1e-9:
            break
    good = member[:, 0]
    trusted = (fired * (counts * (1 - good))[:, None]).sum(axis=0) / np.maximum((fired * counts[:, None]).sum(axis=0), 1)
    return good, {"shares": share, "votes": chance, "accuracy": trusted}


def score_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the measures, one vote column per rule (vote_<rule>), quality (posterior, 0 to 1) and good (>= threshold)."""
    rules = list(votes())
    measured = checkpointed(text_counts(docs).withColumns({f"vote_{k}": v for k, v in votes().items()}))
    pattern = F.concat_ws("", *[(F.col(f"vote_{k}") + 1).cast("string") for k in rules])
    found = measured.groupBy(pattern.alias("pattern")).count().collect()  # at most 3 ** len(rules) rows
    found.sort(key=lambda r: r["pattern"])
    if found:
        posterior, _ = fit(np.array([[int(c) - 1 for c in r["pattern"]] for r in found]), np.array([r["count"] for r in found], float))
    else:
        posterior = []
    lookup = docs.sparkSession.createDataFrame([(r["pattern"], float(p)) for r, p in zip(found, posterior, strict=True)], "pattern string, quality double")
    scored = measured.withColumn("pattern", pattern).join(F.broadcast(lookup), "pattern", "left").drop("pattern")
    return scored.withColumn("good", F.col("quality") >= threshold)
