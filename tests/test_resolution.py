"""Candidates, merged sites and routes against brute force, and encodings of CSV files."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from waymark.functions import fuzzy, text
from waymark.operators import graph
from waymark.plans import resolution
from waymark.sources import readers

PLACES = "kind string, area string, name string, address string, x double, y double"
NAMES = ["Farmacia Rossi", "Rossi dott. Mario", "Ospedale Civile Maggiore", "Osp. Maggiore", "Farmacia Bianchi", "Bianchi"]
STREETS = ["Via Roma 12", "Via G. Verdi 3", "Viale Giuseppe Verdi 3", None, "Piazza Duomo 1"]


def places(spark, name, n, seed):
    rows = [(f"{name}{k:02d}", "hospital" if k % 3 == 0 else "pharmacy", "A" if k % 2 else "B", NAMES[(k * seed) % 6], STREETS[(k + seed) % 5], float(k * 40 % 300), float(k * seed % 70)) for k in range(n)]
    return rows, spark.createDataFrame(rows, f"{name} string, {PLACES}")


def test_blocked_candidates_lose_no_match(spark):
    (a, sources), (b, candidates) = places(spark, "source_id", 24, 5), places(spark, "candidate_id", 30, 7)
    got = {(r["source_id"], r["candidate_id"]): r for r in resolution.scored(sources, candidates).collect()}
    fold = {r["t"]: r["f"] for r in spark.createDataFrame([(t,) for t in [*NAMES, *STREETS]], "t string").select("t", text.fold(F.col("t")).alias("f")).collect()}
    for one in a:
        for two in b:
            if one[1:3] != two[1:3]:
                assert (one[0], two[0]) not in got
                continue
            name = max(fuzzy.weighted_ratio(fold[one[3]], fold[two[3]]), fuzzy.token_set_ratio(fold[one[3]], fold[two[3]]))
            address = max(fuzzy.ratio(fold[one[4]], fold[two[4]]), fuzzy.token_sort_ratio(fold[one[4]], fold[two[4]])) if one[4] and two[4] else None
            if (one[0], two[0]) in got:
                r = got[one[0], two[0]]
                assert r["name_score"] == pytest.approx(name) and (r["address_score"] is None if address is None else r["address_score"] == pytest.approx(address))
            else:
                assert name < 80 and (address or 0) < 75  # neither is strong evidence


def test_merged_sites_equal_brute_force(spark):
    rows, sites = places(spark, "site_id", 20, 3)
    got = {r["site_id"]: r["merged_id"] for r in resolution.merged_sites(sites, 60.0, 90.0, 95.0).collect()}
    fold = {r["t"]: r["f"] or "" for r in spark.createDataFrame([(t,) for t in [*NAMES, *STREETS]], "t string").select("t", text.fold(F.col("t")).alias("f")).collect()}
    root = {r[0]: r[0] for r in rows}
    for a, b in combinations(rows, 2):
        near = (a[5] - b[5]) ** 2 + (a[6] - b[6]) ** 2 <= 3600
        alike = fuzzy.token_set_ratio(fold[a[3]], fold[b[3]]) >= 90 or (a[4] and b[4] and fuzzy.token_sort_ratio(fold[a[4]], fold[b[4]]) >= 95)
        if near and alike:
            low, high = sorted((root[a[0]], root[b[0]]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert got == root


def test_routes_run_in_many_tasks(spark):
    arcs = spark.createDataFrame([(str(i), str((i + 1) % 40), 1.0, 2.0) for i in range(40)], "src string, dst string, time_s double, length_m double")
    targets = spark.range(40).select(F.col("id").cast("string").alias("target"))
    costs = graph.costs_to_targets(arcs, targets)
    assert costs.count() == 1600 and costs.select(F.spark_partition_id().alias("p")).distinct().count() > spark.sparkContext.defaultParallelism // 2


def test_numbers_in_a_total_order(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"))
    assert all(r["n"] == r["v"] + 1 for r in graph.numbered(df, [F.col("v")], "n").collect())


@pytest.mark.parametrize(("encoding", "word"), [("utf-8", "Kočevar"), ("utf-8-sig", "Kočevar"), ("cp1252", "Città €"), ("latin-1", "Città \x81")])
def test_csv_encodings(spark, tmp_path, encoding, word):
    path = tmp_path / "t.csv"
    path.write_bytes(f"code;name\n007;{word}\n008;plain\n".encode(encoding))
    assert [tuple(r) for r in readers.read_csv(spark, str(path)).collect()] == [("007", word), ("008", "plain")]
    path.write_text("code,n\n007,1\n")
    assert readers.read_table(spark, str(path), ("code",)).dtypes == [("code", "string"), ("n", "int")] and readers.read_table(spark, str(path), ("code",)).first()["code"] == "007"


def test_any_accent_folds(spark):
    got = spark.createDataFrame([("Kočevar Šimić",), ("e\u0301tude ﬁne",), ("Ǆ Straße",)], "t string").select(text.fold(F.col("t"))).collect()
    assert [r[0] for r in got] == ["KOCEVAR SIMIC", "ETUDE FINE", "DZ STRASSE"]


def test_equal_texts_are_scored_once_and_equal_questions_answered_once(spark):
    (_, sources), (_, candidates) = places(spark, "source_id", 24, 5), places(spark, "candidate_id", 30, 7)
    sources = sources.unionByName(sources.withColumn("source_id", F.concat(F.lit("copy"), "source_id")))
    texts = resolution.blocked(sources, candidates)
    pairs = resolution.scored(sources, candidates)
    assert texts.columns == ["kind", "area", "a_name", "a_address", "b_name", "b_address"] and 2 * texts.count() == pairs.count()
    assert pairs.select("source_id", "candidate_id").distinct().count() == pairs.count()
    towns = resolution.dimension(spark.createDataFrame([("1", "Roma", "RM", "L"), ("2", "ROMA", "XX", "L"), ("3", "Bari", "BA", "P")], "istat_code string, name string, province_code string, region_code string"))
    names = spark.createDataFrame([(1, "roma", None, None), (2, "Roma", None, None), (3, "Roma", "RM", None), (4, "Bari", None, "P"), (5, "Bari", "RM", None), (6, None, None, None)], "query_id int, name string, province_code string, region_code string")
    got = {r["query_id"]: (r["status"], r["istat_code"], r["candidates"]) for r in resolution.resolve_names(names, towns).collect()}
    both = ("ambiguous", None, ["1", "2"])
    assert got == {1: both, 2: both, 3: ("resolved", "1", ["1"]), 4: ("resolved", "3", ["3"]), 5: ("unknown", None, []), 6: ("unknown", None, [])}
