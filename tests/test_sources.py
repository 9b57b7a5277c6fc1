"""Files and tables: what is written comes back."""

import threading

import pytest
from pyspark.sql import functions as F

from reviewtide.schemas import LAKE, POPULATION_RAW, STAGING, conform, ddl, names
from reviewtide.session import (
    INITIAL_PARTITIONS,
    SCAN_BYTES,
    SHUFFLE_PARTITIONS,
    Sizing,
    Workspace,
    input_bytes,
    partition_settings,
    shared_root,
    sized_for,
    workspace,
)
from reviewtide.sources import readers, writers


def lake_frame(spark, categories):
    row = {"gPlusPlaceId": "p", "rating": 1.0, "reviewText": "text", "price": 2}
    rows = [tuple({**row, "category": c}.get(n) for n in names(LAKE)) for c in categories]
    return spark.createDataFrame(rows, ddl(LAKE))


def write_lake(df, path, **options):
    counts = df.groupBy("category").agg(F.count("*").alias("num_reviews"))
    writers.write_partitioned(df, path, counts, **options)


def test_partition_values(spark, tmp_path):
    values = ["A/B: C", "Café", "007", None, ""]
    path = str(tmp_path / "lake")
    write_lake(lake_frame(spark, values), path)
    back = readers.read_lake(spark, path)
    assert back.columns == names(LAKE)
    got = sorted((r.category for r in back.collect()), key=str)
    assert got == sorted(["A/B: C", "Café", "007", None, None], key=str)
    assert back.filter("category = '007'").count() == 1
    own = readers.read_lake_values(spark, path)
    assert {r.categoryValue for r in own.collect()} == set(values)


def test_static_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_lake(lake_frame(spark, ["a", "b"]), path)
    write_lake(lake_frame(spark, ["b", "b", "c"]), path, touched_only=True)
    assert sorted(r.category for r in readers.read_lake(spark, path).collect()) == ["a", "b", "b", "c"]
    write_lake(lake_frame(spark, ["d"]), path)
    assert [r.category for r in readers.read_lake(spark, path).collect()] == ["d"]


def test_hot_category_is_written_by_many_tasks(spark, tmp_path):
    hot = spark.range(200_000, numPartitions=8).selectExpr(
        "if(id % 3 < 2, 'hot', 'c' || id % 50) category", "id v"
    )
    path = tmp_path / "hot"
    write_lake(hot, str(path), rows_per_slice=10_000)
    assert len(list((path / "category=hot").glob("*.parquet"))) > 4
    assert len(list((path / "category=c7").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(path)).count() == 200_000


def test_sliced_write_changes_no_setting(spark, tmp_path):
    """A thread beside the write sees the same settings all the time."""
    df = spark.range(300_000).selectExpr("if(id % 3 = 0, 'hot', 'c' || id % 9) category", "id v")
    key, seen, done = "spark.sql.adaptive.coalescePartitions.enabled", set(), threading.Event()

    def watch():
        while not done.is_set():
            seen.add((spark.conf.get(key), spark.conf.get(SHUFFLE_PARTITIONS)))

    watcher = threading.Thread(target=watch)
    watcher.start()
    write_lake(df, str(tmp_path / "w"), rows_per_slice=50_000)
    done.set()
    watcher.join()
    assert seen == {(spark.conf.get(key), spark.conf.get(SHUFFLE_PARTITIONS))}


def test_projection_has_the_staging_columns(spark, tmp_path):
    path = str(tmp_path / "temp")
    writers.write_projected(lake_frame(spark, ["a", None, ""]), path)
    back = readers.read_parquet(spark, path)
    assert back.dtypes == list(STAGING)
    assert {r.category for r in back.collect()} == {"a", None, ""}


def test_text_and_json(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, 2)], "s string, n bigint")
    for _ in range(2):  # writing again is no error
        writers.write_json(df, str(tmp_path / "j"))
    fields = (("s", "string"), ("n", "bigint"))
    back = readers.read_json(spark, str(tmp_path / "j"), fields)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    lines = readers.read_text(spark, str(tmp_path / "j"))
    assert {r.value for r in lines.collect()} == {'{"s":"a"}', '{"n":2}'}


def test_json_modes_drop_malformed_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text("{'a': 1}\n{'a':\n\n{'a': 2}\n")
    fields = (("a", "bigint"),)
    back = readers.read_json(spark, str(tmp_path / "x.json"), fields, "DROPMALFORMED")
    assert sorted(r.a for r in back.collect()) == [1, 2]
    fused = readers.read_dirty_json(spark, str(tmp_path / "x.json"), fields)
    assert sorted(r.a for r in fused.collect()) == [1, 2]


def test_csv_is_all_strings_and_checked(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("Zip Code ZCTA,2010 Census Population\n00501,12\n")
    for fields in (None, POPULATION_RAW):
        df = readers.read_csv(spark, str(path), fields)
        assert df.columns == names(POPULATION_RAW)
        assert [tuple(r) for r in df.collect()] == [("00501", "12")]
    with pytest.raises(Exception, match="CSV header"):
        readers.read_csv(spark, str(path), (("other", "string"), ("x", "string"))).collect()


def test_conform_goes_by_name(spark):
    df = spark.createDataFrame([(1, "2")], "b int, a string")
    assert conform(df, (("a", "int"), ("b", "string"))).collect() == [(2, "1")]
    with pytest.raises(Exception, match="UNRESOLVED"):
        conform(df, (("missing", "int"),))


def test_workspace_tables_end_with_it(spark, tmp_path):
    with workspace(spark) as ws:
        table = ws.write(spark.range(5), "t")
        assert table.count() == 5
        path = ws.path("f")
        spark.range(3).write.parquet(path)
        name = ws.name
    assert not spark.catalog.databaseExists(name)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_shared_root_is_the_configured_one(spark):
    assert Workspace(spark).location.startswith(shared_root(spark))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_sizes(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 1000)
    (tmp_path / "b.txt").write_text("y" * 500)
    assert input_bytes(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt")) == 1500
    before = {SHUFFLE_PARTITIONS: "8", SCAN_BYTES: "128MB"}
    assert partition_settings(1500, before) == {
        SHUFFLE_PARTITIONS: "8", INITIAL_PARTITIONS: "8", SCAN_BYTES: f"{128 << 20}b",
    }
    total = 100 << 40
    assert partition_settings(total, before) == {
        SHUFFLE_PARTITIONS: "50000",
        INITIAL_PARTITIONS: "50000",
        SCAN_BYTES: f"{-(-total // 100_000)}b",
    }
    wide = partition_settings(total, before, Sizing(max_shuffle_partitions=10**6, max_scan_tasks=10**6))
    assert wide[SHUFFLE_PARTITIONS] == str(total >> 27) and wide[SCAN_BYTES] == f"{128 << 20}b"
    before = spark.conf.get(SCAN_BYTES)
    with sized_for(spark, 10 << 30):
        assert spark.conf.get(INITIAL_PARTITIONS) == spark.conf.get(SHUFFLE_PARTITIONS) == "80"
    assert spark.conf.get(SCAN_BYTES) == before
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
