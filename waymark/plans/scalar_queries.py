"""Text, numbers, dates, JSON, hashes and geometry, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import fuzzy, geo, hashes, numbers, text
from waymark.operators.gates import first_reason
from waymark.plans import supply
from waymark.plans.registry import query, table

FOLD = "trim(regexp_replace(upper(strip_accents(replace(%s, 'ß', 'SS'))), '[^A-Z0-9]+', ' ', 'g'))"
WORDS = {"THE": "A", "AND": "ET"}
PARTS = {"TH": "Z", "ER": "X"}


@query("t1_fold", f"SELECT doc_id, {FOLD % 'text'} AS folded FROM documents")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query("t2_name_key", f"SELECT p_partkey, lower({FOLD % 'p_name'}) AS name_key FROM part")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.name_key(F.col("p_name")).alias("name_key"))


@query("t3_replace_words", f"SELECT doc_id, regexp_replace(regexp_replace({FOLD % 'text'}, '\\bTHE\\b', 'A', 'g'), '\\bAND\\b', 'ET', 'g') AS text FROM documents WHERE lang = 'en'")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("lang = 'en'").select("doc_id", text.replace_words(text.fold(F.col("text")), WORDS).alias("text"))


@query("t4_replace_parts", f"SELECT doc_id, replace(replace({FOLD % 'text'}, 'TH', 'Z'), 'ER', 'X') AS text FROM documents")
def t4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.replace_parts(text.fold(F.col("text")), PARTS).alias("text"))


@query("t5_name_core", "SELECT p_partkey, coalesce(nullif(array_to_string(list_filter(string_split(upper(p_name), ' '), lambda x: x NOT IN ('SMALL', 'RED', 'BOLT')), ' '), ''), upper(p_name)) AS core FROM part")
def t5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.name_core(text.fold(F.col("p_name")), ("SMALL", "RED", "BOLT")).alias("core"))


@query(
    "t6_civic",
    "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 400 BETWEEN 1 AND 9999 THEN 'VIA ' || c_mktsegment END AS street, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 400 > 0 THEN CAST(c_custkey % 400 AS VARCHAR) END AS number, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 400 > 0 THEN CASE c_custkey % 3 WHEN 1 THEN 'B' ELSE '' END END AS exponent FROM customer WHERE c_custkey % 400 > 0",
)
def t6(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    number = F.lpad((key % 400).cast("string"), 4, "0")
    raw = F.when(key % 3 == 0, F.concat(F.lit("Via "), "c_mktsegment", F.lit(", 12-14"))).otherwise(F.concat(F.lit("Via "), "c_mktsegment", F.lit(", "), number, F.when(key % 3 == 1, "/b").otherwise("")))
    parts = text.civic(raw)
    return table(spark, d, "customer").where("c_custkey % 400 > 0").select("c_custkey", *[c.alias(n) for n, c in parts.items()])


@query("t7_house_number", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(c_custkey % 100 AS VARCHAR) END AS number FROM customer")
def t7(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("c_custkey") % 5 == 0, " snc").otherwise(F.concat(F.lit("00"), (F.col("c_custkey") % 100).cast("string")))
    return table(spark, d, "customer").select("c_custkey", text.house_number(raw).alias("number"))


@query("t8_missing_tokens", "SELECT doc_id, CASE WHEN source NOT IN ('src1', 'src2') THEN source END AS source FROM documents")
def t8(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.missing_to_null(F.concat(F.lit(" "), F.col("source")), ("", "src1", "src2")).alias("source"))


@query("t9_node_id", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS node FROM lineitem")
def t9(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.node_id(F.col("l_quantity")).alias("node"))


@query("t12_speed", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 50.0::DOUBLE WHEN 1 THEN 30 * 1.609344::DOUBLE WHEN 2 THEN NULL ELSE least(p_size + 20, 70)::DOUBLE END AS kmh FROM part")
def t12(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 4 == 0, "70;50").when(F.col("p_partkey") % 4 == 1, "30 mph").when(F.col("p_partkey") % 4 == 2, "IT:urban").otherwise(F.concat(F.lit("['70', '"), (F.col("p_size") + 20).cast("string"), F.lit("']")))
    return table(spark, d, "part").select("p_partkey", text.speed_kmh(raw).alias("kmh"))


@query("t13_first_class", "SELECT p_partkey, lower(p_type) AS road FROM part")
def t13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.first_class(F.concat(F.lit("['"), "p_type", F.lit("', 'x']"))).alias("road"))


@query("t14_padded_code", "SELECT c_custkey, CASE WHEN c_custkey < 1000000 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS code FROM customer")
def t14(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.padded_code(F.col("c_custkey"), 6).alias("code"))


@query("t15_address", "SELECT c_custkey, concat_ws(' ', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, c_name) AS address FROM customer")
def t15(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.address(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")), F.lit(" "), F.col("c_name")).alias("address"))


@query("t10_exact_scores", "SELECT p_partkey, 100.0::DOUBLE AS same, 100.0::DOUBLE AS sorted, 100.0::DOUBLE AS subset FROM part")
def t10(spark: SparkSession, d: str) -> DataFrame:
    turned = F.concat_ws(" ", F.reverse(F.split("p_name", " ")))
    more = F.concat(F.col("p_name"), F.lit(" extra"))
    score = {"same": fuzzy.scorer(fuzzy.ratio)(F.col("p_name"), F.col("p_name")), "sorted": fuzzy.scorer(fuzzy.token_sort_ratio)(F.col("p_name"), turned), "subset": fuzzy.scorer(fuzzy.token_set_ratio)(F.col("p_name"), more)}
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in score.items()])


@query("t10_name_scores")
def t10_names(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select(F.col("p_name").alias("a")).distinct()
    pairs = names.join(names.withColumnRenamed("a", "b"), F.split_part("a", F.lit(" "), F.lit(1)) == F.split_part("b", F.lit(" "), F.lit(1))).where("a < b")
    each = {f.__name__: fuzzy.scorer(f)(F.col("a"), F.col("b")) for f in (fuzzy.ratio, fuzzy.token_sort_ratio, fuzzy.token_set_ratio, fuzzy.weighted_ratio)}
    return pairs.select("a", "b", *[F.round(c, 6).alias(n) for n, c in each.items()])


@query("t11_street_scores")
def t11(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select(F.upper("p_name").alias("a")).distinct()
    pairs = names.join(names.withColumnRenamed("a", "b"), F.split_part("a", F.lit(" "), F.lit(2)) == F.split_part("b", F.lit(" "), F.lit(2))).where("a < b")
    return pairs.select("a", "b", F.round(fuzzy.scorer(fuzzy.street_score)(F.col("a"), F.col("b")), 6).alias("score"))


@query("d1_tolerant_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders")
def d1(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 9 == 0, "31/02/1999").otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "dd/MM/yyyy")))
    return table(spark, d, "orders").select("o_orderkey", numbers.tolerant_date(raw).cast("string").alias("day"))


@query("d2_iso_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def d2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", numbers.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("day"))


@query("d4_reference_period", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y') END AS period FROM orders")
def d4(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "pharmacy").when(F.col("o_orderstatus") == "O", "hospital")
    return table(spark, d, "orders").select("o_orderkey", numbers.reference_period(kind, F.col("o_orderdate")).alias("period"))


@query("m1_haversine", "SELECT c_custkey, round(2 * 6371008.8 * asin(sqrt(least(1, pow(sin(radians(0.001 * (c_custkey % 500)) / 2), 2) + cos(radians(45)) * cos(radians(45 + 0.001 * (c_custkey % 500))) * pow(sin(radians(0.002 * (c_custkey % 300)) / 2), 2)))), 4) AS metres FROM customer")
def m1(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    metres = geo.haversine_m(F.lit(9.0), F.lit(45.0), 9.0 + 0.002 * (key % 300), 45.0 + 0.001 * (key % 500))
    return table(spark, d, "customer").select("c_custkey", F.round(metres, 4).alias("metres"))


@query("m2_utm")
def m2(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    east, north = geo.utm(9.0 + 0.002 * (key % 300), 45.0 + 0.001 * (key % 500), 32)
    return table(spark, d, "customer").select("c_custkey", F.round(east, 3).alias("easting"), F.round(north, 3).alias("northing"))


@query("m8_proximity", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN m <= 50 THEN 100.0 WHEN m <= 100 THEN 95 WHEN m <= 250 THEN 80 WHEN m <= 500 THEN 60 WHEN m <= 1000 THEN 30 ELSE 0 END::DOUBLE AS score FROM (SELECT *, l_quantity * 25 AS m FROM lineitem)")
def m8(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", numbers.proximity_score(F.col("l_quantity") * 25).alias("score"))


@query("m9_weighted_evidence", "SELECT doc_id, round((coalesce(quality * 0.6, 0) + 0.4 * n_chars) / (CASE WHEN quality IS NOT NULL THEN 0.6 ELSE 0 END + 0.4), 6)::DOUBLE AS score FROM documents LEFT JOIN labels USING (doc_id)")
def m9(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.round(numbers.weighted_average([(F.col("quality").cast("double"), 0.6), (F.col("n_chars").cast("double"), 0.4)]), 6).alias("score"))


@query(
    "m10_speed_model",
    "WITH e AS (SELECT p_partkey, p_type AS road, p_retailprice AS length_m, CASE WHEN p_partkey % 3 = 0 AND p_type <> 'PROMO' THEN p_size + 20.0 END AS observed FROM part), c AS (SELECT road, median(observed) AS m FROM e GROUP BY 1) SELECT p_partkey, round(length_m / (coalesce(observed, m, (SELECT median(observed) FROM e)) * (1000.0 / 3600.0)), 6)::DOUBLE AS seconds, CASE WHEN observed IS NOT NULL THEN 'osm_maxspeed' WHEN m IS NOT NULL THEN 'highway_median_osm_maxspeed' ELSE 'global_median_osm_maxspeed' END AS speed_source FROM e JOIN c USING (road)",
)
def m10(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("road"), F.col("p_retailprice").alias("length_m"), F.when((F.col("p_partkey") % 3 == 0) & (F.col("p_type") != "PROMO"), F.col("p_size") + 20.0).alias("observed"))
    by_class, overall = edges.groupBy("road").agg(F.median("observed").alias("m")), edges.agg(F.median("observed").alias("all"))
    joined = edges.join(by_class, "road", "left").crossJoin(F.broadcast(overall))  # one row
    source = first_reason((F.col("observed").isNotNull(), "osm_maxspeed"), (F.col("m").isNotNull(), "highway_median_osm_maxspeed"), (F.col("all").isNotNull(), "global_median_osm_maxspeed"), otherwise="explicit_fallback")
    return joined.select("p_partkey", F.round(numbers.travel_seconds(F.col("length_m"), F.coalesce("observed", "m", "all")), 6).alias("seconds"), source.alias("speed_source"))


@query("m12_percent_change", "SELECT s_suppkey, CASE WHEN s_nationkey <> 0 THEN round((s_acctbal - s_nationkey) / s_nationkey * 100, 6) END AS change FROM supplier")
def m12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", F.round(numbers.percent_change(F.col("s_nationkey").cast("double"), F.col("s_acctbal")), 6).alias("change"))


@query("m13_tolerance", "SELECT c_custkey, abs(c_acctbal - round(c_acctbal, 1)) <= 0.02 AS near FROM customer")
def m13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", numbers.is_close(F.col("c_acctbal"), F.round("c_acctbal", 1), 0.0, 0.02).alias("near"))


@query("parse_integer", "SELECT s_suppkey, CAST(round_even(s_suppkey * 1000 + 0.5, 0) AS BIGINT) AS n FROM supplier WHERE s_suppkey BETWEEN 1 AND 899")
def parse_integer(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").where("s_suppkey BETWEEN 1 AND 899").select("s_suppkey", numbers.whole_number(F.concat(F.col("s_suppkey").cast("string"), F.lit(".000,5"))).alias("n"))


@query("r1_ordered_distinct", "SELECT p_partkey, p_name || ',' || p_type AS words FROM part")
def r1(spark: SparkSession, d: str) -> DataFrame:
    values = F.array(F.col("p_name"), F.lit(""), F.col("p_type"), F.col("p_name"), F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", F.array_join(text.ordered_distinct(values), ",").alias("words"))


@query("r3_array_overlap", "SELECT p_partkey, list_has_any(string_split(p_name, ' '), ['red', 'blue']) AS hit FROM part")
def r3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.arrays_overlap(F.split("p_name", " "), F.array(F.lit("red"), F.lit("blue"))).alias("hit"))


@query("n1_json_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def n1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("n3_json_without_nulls", "SELECT doc_id, CASE WHEN quality IS NULL THEN '{}' ELSE '{\"quality\":' || quality || ',\"toxic\":' || toxic || '}' END AS evidence FROM documents LEFT JOIN labels USING (doc_id)")
def n3(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.to_json(F.struct("quality", "toxic")).alias("evidence"))


@query("h3_row_digest", "SELECT p_partkey, sha256('v' || p_partkey || chr(31) || coalesce('v' || p_name, 'n') || chr(31) || CASE WHEN p_size > 25 THEN 'v' || p_size ELSE 'n' END) AS digest FROM part")
def h3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", hashes.row_digest(F.col("p_partkey"), F.col("p_name"), F.when(F.col("p_size") > 25, F.col("p_size"))).alias("digest"))


@query("h5_site_key", "SELECT p_brand, substr(sha1(string_agg(DISTINCT p_type, '|' ORDER BY p_type)), 1, 16) AS site FROM part GROUP BY 1")
def h5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(hashes.site_key(F.collect_set("p_type")).alias("site"))


#: Labels of the registry with the level that each stands for; null where it tells none.
GRADES = (
    ("SCUOLA DELL'INFANZIA", "preschool"), ("Scuola Primaria", "primary_school"), ("SCUOLA SECONDARIA DI I GRADO", "lower_secondary_school"), ("SCUOLA PRIMO GRADO", "lower_secondary_school"),
    ("SCUOLA SEC. DI 1° GRADO", "lower_secondary_school"), ("SCUOLA SECONDARIA DI II GRADO", "upper_secondary_school"), ("SCUOLA SECONDO GRADO", "upper_secondary_school"),
    ("LICEO SCIENTIFICO", "upper_secondary_school"), ("ISTITUTO TECNICO INDUSTRIALE", "upper_secondary_school"), ("IST TEC COMMERCIALE E PER GEOMETRI", "upper_secondary_school"),
    ("ISTITUTO D'ARTE", "upper_secondary_school"), ("ISTITUTO MAGISTRALE", "upper_secondary_school"), ("IST PROF INDUSTRIA E ARTIGIANATO", "upper_secondary_school"),
    ("IST PROF PER I SERVIZI COMMERCIALI E TURISTICI", "upper_secondary_school"), ("IST PROF PER I SERVIZI ALBERGHIERI E RISTORAZIONE", "upper_secondary_school"),
    ("MEDIA SUPERIORE", "upper_secondary_school"), ("SCUOLA MEDIA STATALE", "lower_secondary_school"), ("ISTITUTO COMPRENSIVO", None), ("ISTITUTO SUPERIORE", None), (" - ", None),
)
GRADES_SQL = ", ".join("({}, '{}', {})".format(i, label.replace("'", "''"), f"'{kind}'" if kind else "NULL") for i, (label, kind) in enumerate(GRADES))


@query(
    "f9_school_type",
    f"SELECT p_partkey, kind AS service_type, CASE WHEN label = ' - ' THEN 'missing_grade_description' WHEN kind IS NULL THEN 'unclassified_grade_description' ELSE 'mim_grade_description' END AS method FROM part JOIN (VALUES {GRADES_SQL}) AS g(i, label, kind) ON p_partkey % {len(GRADES)} = i",
)
def f9(spark: SparkSession, d: str) -> DataFrame:
    grade = text.fold(F.element_at(F.array(*[F.lit(x) for x, _ in GRADES]), (F.col("p_partkey") % len(GRADES) + 1).cast("int")))
    return table(spark, d, "part").select("p_partkey", supply.school_type(grade).alias("service_type"), supply.school_type_method(grade).alias("method"))


@query("f13_strict_boolean", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag FROM orders")
def f13(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "F", " True").when(F.col("o_orderstatus") == "O", "FALSE").otherwise("yes")
    return table(spark, d, "orders").select("o_orderkey", numbers.strict_boolean(raw).alias("flag"))


EVIDENCE = "e AS (SELECT o_orderkey AS source_id, l_linenumber * 100000 + l_partkey AS candidate_id, CASE WHEN o_orderkey % 2 = 0 THEN 'hospital' ELSE 'pharmacy' END AS kind, l_quantity * 2 AS name_score, CASE WHEN l_partkey % 3 <> 0 THEN 100 - l_discount * 400 END AS address_score, CASE WHEN l_partkey % 5 <> 0 THEN 60.0 END AS proximity_score FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


@query(
    "e7_health_matching",
    f"WITH {EVIDENCE}, w AS (SELECT *, CASE kind WHEN 'hospital' THEN 0.55 ELSE 0.35 END::DOUBLE AS a, CASE kind WHEN 'hospital' THEN 0.40 ELSE 0.50 END::DOUBLE AS b, CASE kind WHEN 'hospital' THEN 0.05 ELSE 0.15 END::DOUBLE AS c FROM e), s AS (SELECT *, (name_score * a + coalesce(address_score * b, 0) + coalesce(proximity_score * c, 0)) / (a + CASE WHEN address_score IS NULL THEN 0 ELSE b END + CASE WHEN proximity_score IS NULL THEN 0 ELSE c END) AS score FROM w), r AS (SELECT *, row_number() OVER p AS rank, round(score - coalesce(lead(score) OVER p, 0), 9) AS margin FROM s WINDOW p AS (PARTITION BY source_id ORDER BY round(score, 9) DESC, candidate_id)) SELECT source_id, candidate_id, round(score, 6) AS score, abs(round(margin, 6)) AS margin, CASE WHEN round(score, 9) >= 82 AND margin >= 8 AND (coalesce(address_score, 0) >= 75 OR name_score >= 80) THEN 'matched' WHEN round(score, 9) >= 65 THEN 'review' ELSE 'unmatched' END AS status FROM r WHERE rank = 1",
)
def e7(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders").select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "hospital").otherwise("pharmacy")
    scored = lines.select(
        F.col("o_orderkey").alias("source_id"),
        (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("candidate_id"),
        kind.alias("kind"),
        (F.col("l_quantity") * 2).alias("name_score"),
        F.when(F.col("l_partkey") % 3 != 0, 100 - F.col("l_discount") * 400).alias("address_score"),
        F.when(F.col("l_partkey") % 5 != 0, 60.0).alias("proximity_score"),
    )
    best = supply.resolved(scored)
    return best.select("source_id", "candidate_id", F.round("score", 6).alias("score"), F.abs(F.round("margin", 6)).alias("margin"), "status")


@query("e8_coordinate_fusion", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN a AND b AND m > 250 THEN 'review_conflict' WHEN a AND b AND m <= 120 THEN 'osm_confirmed' WHEN a THEN 'osm' WHEN b THEN 'geocoder' WHEN c THEN 'review' ELSE 'unresolved' END AS source FROM (SELECT *, l_returnflag = 'A' AS a, l_linestatus = 'F' AS b, l_tax > 0.04 AS c, l_quantity * 8 AS m FROM lineitem)")
def e8(spark: SparkSession, d: str) -> DataFrame:
    source = supply.fused(F.col("l_returnflag") == "A", F.col("l_linestatus") == "F", F.col("l_tax") > 0.04, F.col("l_quantity") * 8)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", source.alias("source"))


@query("e9_geocoder_score", "SELECT p_partkey, greatest(0, least(100, CASE WHEN p_size % 2 = 0 THEN 70 ELSE 0 END + CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 15 ELSE -10 END + CASE WHEN p_type = 'SMALL' THEN 10 ELSE 0 END + 5 * (p_size / 50.0)))::DOUBLE AS score FROM part")
def e9(spark: SparkSession, d: str) -> DataFrame:
    postcode = F.when(F.col("p_size") % 3 == 1, True).when(F.col("p_size") % 3 == 2, False)
    score = supply.geocoder_score(F.col("p_size") % 2 == 0, postcode, F.col("p_type") == "SMALL", F.col("p_size") / 50.0)
    return table(spark, d, "part").select("p_partkey", score.alias("score"))


@query(
    "e23_address_evidence",
    "WITH r AS (SELECT l_suppkey % 50 AS street, l_partkey % 40 AS number, count(*) AS accesses, count(DISTINCT l_returnflag) AS positions FROM lineitem WHERE l_discount = 0.05 GROUP BY 1, 2), s AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 50 END AS street, c_custkey % 41 AS number FROM customer) SELECT c_custkey, CASE WHEN s.street IS NULL THEN 'missing_or_unparseable' WHEN accesses IS NULL THEN 'no_exact_address_match' WHEN positions > 1 THEN 'ambiguous_multiple_positions' WHEN accesses > 1 THEN 'multiple_accesses_review' ELSE 'exact_single_access_candidate' END AS evidence_status, false AS coordinate_accepted_for_accessibility FROM s LEFT JOIN r ON s.street = r.street AND s.number = r.number",
)
def e23(spark: SparkSession, d: str) -> DataFrame:
    register = table(spark, d, "lineitem").where("l_discount = 0.05").select((F.col("l_suppkey") % 50).alias("street"), (F.col("l_partkey") % 40).alias("number"), F.col("l_returnflag").alias("x"), F.lit(0).alias("y"))
    key = F.col("c_custkey")
    sources = table(spark, d, "customer").select("c_custkey", F.when(key % 10 != 0, key % 50).alias("street"), (key % 41).alias("number"))
    return supply.address_evidence(sources, register).select("c_custkey", "evidence_status", "coordinate_accepted_for_accessibility")
