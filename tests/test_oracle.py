"""Every registered query against its SQL, and the rules of the text functions."""

import math

import duckdb
import pytest
from gridloom.fixtures import TABLES
from gridloom.functions import text as tx
from gridloom.plans import builders, discovery, index, layouts, normalize, records
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
GROUPS = (index, discovery, normalize, layouts, builders, records)
NAMES = [(g, n) for g in GROUPS for n in g.QUERIES if n in g.ORACLE_SQL]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if type(v).__name__ == "Decimal":
        v = float(v)
    return round(v, 6) if isinstance(v, float) else v


def rows(found, columns):
    return sorted((tuple(plain(r[i]) for i in columns) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("group,name", NAMES, ids=[n for _, n in NAMES])
def test_query_equals_its_sql(spark, duck, group, name):
    df = group.QUERIES[name](spark, SF)
    cursor = duck.execute(group.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = rows(cursor.fetchall(), [columns.index(c) for c in order])
    assert rows(df.collect(), [df.columns.index(c) for c in order]) == want


def values(spark, function, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_clean_text(spark):
    assert values(spark, tx.clean_text, " / a – (cid:12)b *", None, "“q”", "x\x00y/ ") == ["a - b", "", '"q"', "xy"]


def test_english_of_bilingual_text(spark):
    assert values(spark, tx.extract_english, "हिन्दी / Goa", "गोवा", None) == ["Goa", "", ""]


def test_numbers(spark):
    assert values(spark, tx.parse_number, "1,234.5 Rs", "-3", "none", None) == [1234.5, -3.0, None, None]
    assert values(spark, tx.parse_sentinel_number, "Nil", "N/A", "Rs 1.13 (x)", "Rs 12", "--", "a") == [0.0, None, 1.13, 12.0, None, None]


def test_voltage_words_count_whole(spark):
    assert values(spark, tx.extract_voltage, "EHT supply", "HT 33 kV", "right", "11 kV", "LT") == ["EHT", "HT - 33 kV", "all", "11 kV", "LT"]


def test_split_multi_value(spark):
    df = spark.createDataFrame([(1, "Apr-Sep25 - 1.13 (Partial OA) 1.53 (Full OA)"), (2, "2.5 (one)")], "i int, raw string")
    got = [(r.i, r.value, r.qualifier) for r in builders.bd.split_multi_value(df, "raw").orderBy("i", "part").collect()]
    assert got == [(1, 1.13, "Partial OA"), (1, 1.53, "Full OA"), (2, 2.5, None)]


def test_title_number_is_lower_case(spark):
    pages = spark.createDataFrame([("r", 4, "TABLE 5(A): Cross Subsidy Surcharge\nrest")], "report_id string, pdf_page int, page_text string")
    row = index.ix.detect_titles(pages).first()
    assert (row.table_number, row.title_text) == ("5(a)", "Cross Subsidy Surcharge")


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_writers_read_back(spark, tmp_path):
    from gridloom.sources import writers

    f = records.facts(spark, SF).limit(50).select("parameter_id", "state", "utility", "value").cache()
    writers.write_by_group(f, str(tmp_path / "g"), "state", ["utility", "value"])
    assert spark.read.parquet(str(tmp_path / "g")).count() == 50
    writers.write_page_index_csv(index.page_index(spark, SF), str(tmp_path / "csv"))
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "csv")).count() == index.page_index(spark, SF).count()


def test_two_headers_keep_all_rows(spark):
    body = normalize.clean(spark, SF)
    heads = sum(3 if r.report_id % 3 == 0 else 2 for r in body.select("report_id").distinct().collect())
    assert layouts.two_headers(spark, SF).count() == body.count() + heads


def test_utility_names_inside_values_and_the_reverse(spark):
    from gridloom.operators.entities import canonicalize_utility, match_utility

    catalog = spark.createDataFrame([("Torrent Power", 1, "GJ"), ("BRPL", 2, "DL"), ("UP PCL", 3, "UP"), ("TPL", 4, "GJ")], "canonical string, priority int, state string")
    values = spark.createDataFrame([("torr", "GJ"), ("xbrplx", "DL"), ("UP PCL Ltd", "UP"), ("tp", "GJ"), ("tp", "DL"), ("zz", "GJ"), ("", "GJ"), (None, "GJ")], "value string, st string")
    got = {(r.value, r.state): (r.canonical, r.confidence) for r in match_utility(values, catalog, [], state=F.col("st")).collect()}
    assert got["torr", "GJ"] == ("Torrent Power", 0.9) and got["xbrplx", "DL"] == ("BRPL", 0.9) and got["UP PCL Ltd", "UP"] == ("UP PCL", 0.9)
    assert got["tp", "GJ"] == ("TPL", 0.85) and got["tp", "DL"] == (None, 0.0) and got["zz", "GJ"] == (None, 0.0) and got["", "GJ"] == (None, 0.0) and got[None, "GJ"] == (None, 0.0)
    labels = spark.createDataFrame([("BRPL Ltd (DL)", "DL"), ("old tpl - 2024-25", "DL"), ("none", "GJ"), (None, "GJ")], "utility string, state string")
    steps = {r.utility: (r.canonical, r.step) for r in canonicalize_utility(labels, [], catalog).collect()}
    assert steps["BRPL Ltd (DL)"] == ("BRPL", "state") and steps["old tpl"] == ("TPL", "catalog") and steps["none"][1] == "as_is" and len(steps) == 4
