"""CSV texts, layer paths, schema fallback, listings of files, JDBC options."""

import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from khodat.operators.files import write_csv, write_parquet
from khodat.operators.rows import newest
from khodat.schema import LISTING_RAW, spark_type, struct
from khodat.session import scratch_path, shared_root
from khodat.sources import files, jdbc, layers
from khodat.sources.records import csv_records


def text_file(scratch, spark, lines):
    path = scratch("text")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


CSV = struct(name="string", n="bigint", price="double")


def test_csv_missing_values_and_whole_numbers_with_a_point(spark, scratch):
    path = text_file(scratch, spark, [
        "name,n,price", '"a ""b"", c",3.0,1.5', "NaN,,NA", "None,4,nan", '"line', 'two",5,2',
    ])
    rows = files.read_csv(spark, path, CSV, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        ('a "b", c', 3, 1.5), (None, None, None), (None, 4, None), ("line\ntwo", 5, 2.0),
    ]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_csv(spark, path, CSV).collect()
    plain = text_file(scratch, spark, ["name,n,price", "NA,1,", "x,2,1"])
    assert [tuple(r) for r in files.read_csv(spark, plain, CSV, missing=("",)).collect()] == [("NA", 1, None), ("x", 2, 1.0)]


def test_large_csv_is_split(spark, scratch):
    path = text_file(scratch, spark, ["name,n,price", *[f"name number {i},{i},1.5" for i in range(20000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = files.read_csv(spark, path, CSV)
        assert rows.rdd.getNumPartitions() > 4 and rows.agg(F.sum("n")).first()[0] == 19999 * 10000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


BREAKS = [
    "name,n,price", '"a\nb",1,1.5', "plain,2,", '"\n\n",3,0', '"x ""quoted\n"" and\r\n, more",4,2', '"many\nlines\nof\none field, with a comma",5,7\r',
    "", '""",""",6,8', '"ends with a break\n",7,9', "last,8,10",
]


def by_the_parser(spark, path):
    reader = spark.read.schema(files.as_strings(CSV)).option("header", True).option("multiLine", True).option("escape", '"')
    return sorted(map(str, reader.option("mode", "FAILFAST").csv(path).selectExpr("name", "cast(n as long)", "cast(price as double)").collect()))


@pytest.mark.parametrize("header", ["name,n,price", 'name,"the\nnumber",price'])
def test_line_breaks_at_every_edge_of_a_split(spark, scratch, header):
    path = text_file(scratch, spark, [header, *BREAKS[1:], *BREAKS[1:]])
    wanted = by_the_parser(spark, path)
    assert len(wanted) == 16
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (*range(5, 40, 3), 61, 100, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            rows = files.read_csv(spark, path, CSV, multi_line=True)
            assert sorted(map(str, rows.collect())) == wanted, size
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
        assert csv_records(spark, path).count() == 16 and csv_records(spark, path, header=False).count() == 17
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_of_several_files_and_many_batches(spark, scratch):
    path = scratch("csv")
    frame = spark.range(5000).selectExpr("repeat('line\n', cast(id % 4 as int)) || id as name", "id as n", "id / 2 as price")
    write_csv(frame.repartition(3), path)
    rows = files.read_csv(spark, path, CSV, multi_line=True)
    assert sorted(map(str, rows.collect())) == by_the_parser(spark, path) == sorted(map(str, frame.collect()))


def test_a_file_that_ends_within_quotes_raises(spark, scratch):
    path = text_file(scratch, spark, ["name,n,price", "a,1,2", '"b,2,3', "c,3,4"])
    with pytest.raises(Exception, match="a quoted field is open at the end of"):
        files.read_csv(spark, path, CSV, multi_line=True).collect()
    empty = text_file(scratch, spark, ["name,n,price"])
    assert files.read_csv(spark, empty, CSV, multi_line=True).collect() == []


def test_csv_bad_number_raises(spark, scratch):
    path = text_file(scratch, spark, ["name,n,price", "a,x,1"])
    with pytest.raises(Exception, match="cannot cast to bigint: x"):
        files.read_csv(spark, path, CSV).collect()
    with pytest.raises(Exception, match="cannot cast to bigint: 3.5"):
        files.read_csv(spark, text_file(scratch, spark, ["name,n,price", "a,3.5,1"]), CSV).collect()


def test_csv_round_trip(spark, scratch):
    rows = [("quote \" and, comma", 1, 0.1), ("back\\slash", 2, None), ("two\nlines", None, 1e10), (" pad ", 3, -1.0)]
    path = scratch("csv")
    write_csv(spark.createDataFrame(rows, CSV), path)
    assert sorted(map(str, (tuple(r) for r in files.read_csv(spark, path, CSV, multi_line=True).collect()))) == sorted(map(str, rows))


def test_paths():
    assert layers.layer_uri("raw", "t", "20241209", root="/lake/") == "/lake/raw/t/20241209"
    assert layers.layer_uri("raw", "t", "d", prefix="t", fmt="parquet", root="r") == "r/raw/t/d/t_*.parquet"
    assert layers.layer_uri("raw", "t", fmt="json") == "raw/t/*.json"
    assert layers.file_set_uri("/d", "src", "t", codec="gz") == "/d/src_t/t_*.json.gz"
    assert layers.file_set_uri("/d", "src", "t", "parquet", "snappy") == "/d/src_t/t_*.snappy.parquet"
    assert layers.file_set_uri("/d", "src", "t", "parquet") == "/d/src_t/t_*.parquet"


def test_business_date_stays_text_and_is_pruned(spark, scratch):
    path = scratch("t")
    rows = spark.range(10).select("id", F.format_string("2001010%d", F.col("id") % 3).alias("business_date"))
    write_parquet(rows, path, by=["business_date"])
    one_day = layers.read_business_date(spark, path, "20010102")
    assert [tuple(r) for r in one_day.orderBy("id").collect()] == [(2, "20010102"), (5, "20010102"), (8, "20010102")]
    declared = layers.read_business_date(spark, path, "20010102", struct(id="bigint"))
    for frame in (one_day, declared):
        assert frame.inputFiles() and all("/business_date=20010102/" in f for f in frame.inputFiles())
        assert frame.dtypes == [("id", "bigint"), ("business_date", "string")] and frame.count() == 3
    missing = layers.read_business_date(spark, path, "20010109", struct(id="bigint"))
    assert missing.dtypes == declared.dtypes and missing.count() == 0
    with pytest.raises(AnalysisException):
        layers.read_business_date(spark, path, "20010109")


def test_business_date_with_odd_characters(spark, scratch):
    path, odd = scratch("a folder"), "2001-01-02 10:00/ä%"
    rows = spark.createDataFrame([(1, odd), (2, "x")], "id bigint, business_date string")
    write_parquet(rows, path, by=["business_date"])
    assert [tuple(r) for r in layers.read_business_date(spark, path, odd).collect()] == [(1, odd)]


def test_partition_filter(spark):
    rows = spark.createDataFrame([(2024, 1, 2), (2024, 2, 1), (2023, 1, 2)], "year int, month int, day int")
    assert rows.where(layers.partition_date_filter(["20240102", "20230102"])).count() == 2
    assert rows.where(layers.partition_date_filter([])).count() == 0


def test_partition_filter_of_ten_years(spark, scratch):
    path = scratch("t")
    dates = spark.sql("select explode(sequence(date'2014-12-30', date'2015-01-04')) as d")
    rows = dates.selectExpr("day(d) * 1L as id", "year(d) as year", "month(d) as month", "day(d) as day")
    write_parquet(rows, path, by=["year", "month", "day"])
    wanted = [f"{y}{m:02}{d:02}" for y in range(2015, 2025) for m in range(1, 13) for d in range(1, 32)]
    start = time.perf_counter()
    found = spark.read.parquet(path).where(layers.partition_date_filter(wanted))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 10
    assert len(wanted) > 3650 and "PartitionFilters: [" in plan and "INSET" in plan.upper()
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 4] and len(found.inputFiles()) > 0


def test_declared_schema_and_options_hold_for_parquet(spark, scratch):
    path = scratch("p")
    spark.createDataFrame([(1, "x")], "a bigint, b string").write.parquet(f"{path}/1")
    spark.createDataFrame([(2, "y", 1.5)], "a bigint, b string, c double").write.parquet(f"{path}/2")
    glob, merged = f"{path}/*", {"mergeSchema": "true"}
    assert sorted(files.read_source(spark, glob, options=merged).columns) == ["a", "b", "c"]
    rows = files.read_source(spark, glob, schema=struct(a="string", c="double", d="date"), options=merged)
    assert rows.dtypes == [("a", "string"), ("c", "double"), ("d", "date")]
    assert sorted(map(tuple, rows.collect())) == [("1", None, None), ("2", 1.5, None)]
    with pytest.raises(Exception, match="cannot cast to bigint: [xy]"):
        files.read_source(spark, glob, schema=struct(b="bigint")).collect()
    none = files.read_source(spark, glob, schema=struct(a="bigint"), options={"pathGlobFilter": "*.none"})
    assert none.dtypes == [("a", "bigint")] and none.count() == 0
    plan = files.read_source(spark, glob, schema=struct(a="bigint", b="string")).where("a = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(a,1)" in plan


def test_only_a_directory_without_files_falls_back(spark, scratch):
    empty, schema = scratch("empty"), struct(id="bigint")
    write_parquet(spark.range(0).withColumn("p", F.lit(1)), empty, by=["p"])
    assert layers.read_parquet(spark, empty, schema).schema == schema
    with pytest.raises(AnalysisException):
        layers.read_parquet(spark, empty)
    with pytest.raises(AnalysisException):
        layers.read_parquet(spark, scratch("missing"), schema)


def test_other_formats_need_a_schema(spark):
    with pytest.raises(ValueError, match="schema is required"):
        files.read_source(spark, "/nowhere", "json")


def test_all_string_parquet(spark, scratch):
    path = scratch("p")
    spark.createDataFrame([("1", "x")], "a string, b string").write.parquet(path)
    rows = files.read_source(spark, path, schema=struct(a="bigint"), all_string=True)
    assert rows.dtypes == [("a", "string")] and rows.first().a == "1"


def test_newest_of_a_directory(spark, scratch):
    path = scratch("p")
    spark.range(4).repartition(4).write.parquet(path)
    listing = files.list_files(spark, path)
    assert listing.columns == ["path", "mtime", "size"] and "content" not in listing.schema.simpleString()
    last = max(((r.mtime, r.path) for r in listing.collect()))
    assert tuple(newest(listing).first()) == (last[1], last[0])
    assert "TakeOrderedAndProject" in newest(listing)._jdf.queryExecution().executedPlan().toString()


def test_types():
    assert spark_type("BIGINT") == spark_type("long")
    assert spark_type("decimal(38, 6)").simpleString() == "decimal(38,6)"
    with pytest.raises(ValueError):
        spark_type("str")
    assert LISTING_RAW.columns[10] == "So_tang"
    assert LISTING_RAW.table_properties()["format-version"] == "1"


class Session:
    """As much of a session as the folder functions ask for."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, *default):
        return self.settings.get(key, *default)


def test_shared_folder_comes_from_the_session():
    cluster = Session(spark__checkpoint__dir="hdfs://n/shared/", spark__master="yarn")
    assert shared_root(cluster) == "hdfs://n/shared"
    assert scratch_path(cluster, "x").startswith("hdfs://n/shared/khodat-")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session(spark__master="yarn"))
    local = Session(spark__master="local[2]", spark__app__id="a-test")
    assert shared_root(local).startswith("/tmp/run-") and shared_root(local) == shared_root(local)


def test_jdbc_options():
    plain = jdbc.extract_options("jdbc:x", "SELECT 1;", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "(SELECT 1) extract_query", "fetchsize": "10000", "user": "u"}
    split = jdbc.extract_options("jdbc:x", "SELECT 1", "id", (1, 9), 3)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "9", "3")
    with pytest.raises(ValueError):
        jdbc.extract_options("jdbc:x", "SELECT 1", "id")
    assert [jdbc.partitions_for(n) for n in (0, 500_000, 500_001)] == [1, 1, 2]
    assert jdbc.spread_predicates("CRC32(id)", 2) == [
        "(MOD(ABS(CRC32(id)), 2) = 0 OR CRC32(id) IS NULL)", "(MOD(ABS(CRC32(id)), 2) = 1)",
    ]
    assert jdbc.replace_options("jdbc:x", "t")["truncate"] == "true"


def test_whole_numbers_are_matched_against_a_pattern_only_if_they_end_in_zero(spark, scratch):
    path = scratch("whole.csv")
    texts = ["30", "3.0", "10.00", "0", "-7", None, "NA"]
    spark.createDataFrame([(t, "x") for t in texts], "n string, t string").write.option("header", True).csv(path)
    rows = files.read_csv(spark, path, struct(n="bigint", t="string"))
    assert sorted((r.n for r in rows.collect()), key=str) == sorted([30, 3, 10, 0, -7, None, None], key=str)
    assert "EndsWith(n" in rows._jdf.queryExecution().executedPlan().toString()
