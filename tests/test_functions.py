"""Scalar functions, geometry, fuzzy scores, readers and sinks."""

import zipfile

import pytest
from pyspark.sql import functions as F

from waymark.functions import fuzzy, geo, hashes, numbers, text
from waymark.operators import spatial
from waymark.operators.relational import ContractError
from waymark.sources import readers, sinks


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("raw", "kmh"), [("50", 50.0), ("70;50", 50.0), ("30 mph", 30 * 1.609344), ("IT:urban", None), (None, None), ("['70', '40']", 40.0)])
def test_speeds(spark, raw, kmh):
    assert value(spark, text.speed_kmh(F.lit(raw).cast("string"))) == kmh


def test_text(spark):
    assert value(spark, text.fold(F.lit(" L'Aquila, è  così "))) == "L AQUILA E COSI"
    assert value(spark, text.name_core(F.lit("SCUOLA PRIMARIA DANTE PARMA"), ("SCUOLA", "PRIMARIA"), F.lit("Parma"))) == "DANTE"
    assert value(spark, text.name_core(F.lit("SCUOLA"), ("SCUOLA",))) == "SCUOLA"
    parts = text.civic(F.lit("Via Roma, 012/b"))
    assert [value(spark, parts[k]) for k in ("street", "number", "exponent")] == ["VIA ROMA", "12", "B"]
    for raw in ("Via Roma", "Via XX Settembre 1870", "Via Roma 12-14"):
        assert value(spark, text.civic(F.lit(raw))["number"]) is None
    assert value(spark, text.node_id(F.lit(" 12.0 "))) == "12"
    assert value(spark, text.padded_code(F.lit("77014"), 6)) == "077014"
    assert value(spark, text.split_letters_digits(F.lit("VIA5A"))) == "VIA 5 A"


def test_numbers(spark):
    assert value(spark, numbers.decimal_comma(F.lit("1.234,5"))) == 1234.5
    assert [value(spark, numbers.whole_number(F.lit(x))) for x in ("1.234,5", "2,5", "3,5", "x")] == [1234, 2, 4, None]
    assert value(spark, numbers.tolerant_date(F.lit("31/02/2020"))) is None
    assert value(spark, numbers.weighted_average([(F.lit(None).cast("double"), 0.5), (F.lit(80.0), 0.25)])) == 80.0
    assert value(spark, numbers.percent_change(F.lit(0.0), F.lit(1.0))) is None


def test_geometry(spark):
    assert value(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(111195.08, abs=0.1)
    east, north = geo.utm(F.lit(9.0), F.lit(45.0), 32)
    assert value(spark, east) == pytest.approx(500000.0, abs=1e-6) and value(spark, north) == pytest.approx(4982950.40, abs=0.05)
    square = geo.rectangle(*[F.lit(x) for x in (0.0, 0.0, 4.0, 2.0)])
    assert value(spark, geo.ring_area(square)) == 8.0
    edge, inside = (F.lit(0.0), F.lit(1.0)), (F.lit(1.0), F.lit(1.0))
    assert (value(spark, geo.within(*edge, square)), value(spark, geo.covered(*edge, square)), value(spark, geo.within(*inside, square))) == (False, True, True)
    assert value(spark, geo.distance_to_ring(F.lit(7.0), F.lit(6.0), square)) == 5.0
    assert tuple(value(spark, geo.interior_point(square))) == (2.0, 1.0)


def test_nearest_ties_and_far_points(spark):
    left = spark.createDataFrame([("a", 0.0, 0.0), ("far", 9000.0, 9000.0), ("none", None, 1.0)], "id string, x double, y double")
    right = spark.createDataFrame([("q", 3.0, 0.0), ("p", 0.0, 3.0)], "other_id string, ox double, oy double")
    got = {r["id"]: (r["other_id"], round(r["distance_m"], 3)) for r in spatial.nearest(left, right, 10.0).collect()}
    assert got["a"] == ("p", 3.0) and got["far"][0] in "pq" and "none" not in got


def test_fuzzy():
    assert fuzzy.ratio("abcd", "abcf") == 75.0
    assert fuzzy.token_sort_ratio("roma via", "via roma") == 100.0
    assert fuzzy.token_set_ratio("via roma", "via roma interno 5") == 100.0
    assert fuzzy.weighted_ratio("", "x") == 0.0
    assert fuzzy.street_score("VIA G VERDI", "VIA GIUSEPPE VERDI") > 80 > fuzzy.street_score("VIA ROMA", "VIA TORINO")
    assert fuzzy.street_score("VIA MARIO ROSARIO GRECO", "VIA MR GRECO") == 98 and fuzzy.street_score("VIA MARIO ROSARIO GRECO", "VIA ROSARIO") <= 65
    assert fuzzy.street_score("VIA GARIBALDI", "CORSO GARIBALDI") == 100 and fuzzy.street_score("VIA GIUSEPPE GARIBALDI", "VIA GARIBALDI") >= 92


def test_hashes():
    assert hashes.digest({"b": 1, "a": [float("nan"), {3, 2}]}) == hashes.digest({"a": [None, [2, 3]], "b": 1})


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y;z\n1;2;3\n", encoding="utf-8")
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).first().asDict() == {"x": "1", "y": "2", "z": "3"}
    assert readers.unique_file(tmp_path, "*.csv").name == "a.csv"
    with pytest.raises(readers.SourceError):
        readers.unique_file(tmp_path, "*.xlsx")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("r.csv", "x;y\n1;2\n3;4\n")
    assert readers.zipped_rows(spark, str(tmp_path / "a.zip"), ("x", "y")).count() == 2
    df = spark.createDataFrame([(1, 0.1), (2, None)], "k int, v double")
    digest = sinks.write_once(df, str(tmp_path / "out"))
    assert sinks.write_once(df.orderBy(F.desc("k")), str(tmp_path / "out")) == digest
    with pytest.raises(FileExistsError):
        sinks.write_once(df.where("k = 1"), str(tmp_path / "out"))
    sinks.canonical_csv(df, "k", tmp_path / "out.csv")
    assert (tmp_path / "out.csv").read_text() == "k,v\n1,0.10000000000000001\n2,\n"
    assert readers.inventory(spark, str(tmp_path / "a.zip")).first()["length"] > 0


def test_published_results_and_source_states(spark, tmp_path):
    df = spark.createDataFrame([(2, "č"), (1, None)], "k int, v string")
    said = sinks.publish(df, tmp_path, "sites", "k", {"graph": "abc"})
    assert said["rows"] == 2 and sinks.publish(df, tmp_path, "sites", "k", {"graph": "abc"}) == said
    assert (tmp_path / "sites.csv").read_bytes() == "\ufeffk,v\n1,\n2,č\n".encode()
    sinks.verify_inputs(tmp_path / "sites.json", {"graph": "abc"})
    with pytest.raises(ContractError, match="another graph"):
        sinks.verify_inputs(tmp_path / "sites.json", {"graph": "abd"})
    with pytest.raises(FileExistsError):
        sinks.publish(df.where("k = 1"), tmp_path, "sites", "k", {"graph": "abc"})
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in ("osm_20250102T030405Z.parquet", "osm_20260102T030405Z.parquet", "osm_latest.parquet", "mim.csv"):
        (folder / name).write_text(name)
    assert readers.latest_snapshot(folder, "osm_").name == "osm_20260102T030405Z.parquet"
    with pytest.raises(readers.SourceError):
        readers.latest_snapshot(folder, "health_")
    wanted = {"schools": r"mim\.csv", "osm": r"osm_\d.*", "census": r"istat.*"}
    states = readers.source_states(spark, str(folder), wanted)
    assert {r["source"]: (r["state"], r["length"]) for r in states.collect()} == {"schools": ("ready", 7), "osm": ("ambiguous", None), "census": ("missing", None)}
    assert not readers.all_ready(states) and readers.all_ready(states.where("source = 'schools'"))
