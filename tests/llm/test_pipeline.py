"""The corpus pipeline: stages work on what their predecessor kept."""

import public_tokenizers

import corpus_pipeline
from waymark.llm import queries, token_counts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(corpus_pipeline.COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.dtypes == docs.dtypes
        assert after.join(before, "doc_id", "left_anti").isEmpty() and after.count() <= before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_rows_are_judged_by_their_own_texts(spark):
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(4)]
    rows = [(None, clean[0]), (None, clean[0]), (None, clean[1]), (None, clean[2] + " " + leak), (7, clean[2]), (7, clean[2] + " " + leak), (8, clean[3]), (8, clean[3]), (9, clean[3].upper()), (10, None), (11, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda stage: sorted((str(r["doc_id"]), str(r["text"])) for r in stage(spark, docs, SF).collect())
    plain = lambda some: sorted((str(i), str(t)) for i, t in some)
    assert left(corpus_pipeline.decontamination) == plain(r for r in rows if leak not in (r[1] or ""))
    near = left(corpus_pipeline.near_dedup)
    assert [r for r in near if r[1].lower() == clean[3]] == [("8", clean[3])] and near.count(("None", clean[0])) == 1 and ("None", clean[1]) in near
    assert ("10", "None") in near and ("11", "") not in near  # without words both are alike; the smaller doc_id stays
    assert len(left(corpus_pipeline.toxicity)) == len(rows)
    empty = docs.where("false")
    assert all(stage(spark, empty, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_edited_counts_equal_a_count_from_scratch(spark):
    counter = token_counts.Counter(public_tokenizers.path(queries.BYTE_TOKENIZER))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op1_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text, n = texts[r["doc_id"]], len(texts[r["doc_id"]])
        assert r["n_tokens"] == sum(counter.counts(counter.split.findall(text)))
        if n > 40:  # the three edits are apart
            a, b, c = n // 3, 2 * n // 3, n - 5
            new = text[:a] + " (edited)" + text[a:b] + "don't" + text[min(b + 7, n) : c] + "."
            assert r["n_tokens_edited"] == sum(counter.counts(counter.split.findall(new)))
