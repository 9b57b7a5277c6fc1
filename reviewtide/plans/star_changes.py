"""Star tables kept by signed changes.

The star is made from lake folders. When some of these are replaced, the staging rows of the
former folders count -1 and those of the new ones +1; rows that stay cancel out, and what is
left is all that the tables have to take in. No other lake folder is read.

Each table is dealt into parts by a hash, and a part is the unit that is written. A dimension
keeps, in a column of its files, how many staging rows support each of its rows: changes are
added, and a row is there while the number is not zero. Parts without a change stay. The fact
has a row for each staging row: parts that only gain rows get a further folder, parts that
lose some are written anew, and so are those of many folders.

The full star is the same with no former folders and no former parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.operators.categories import filter_category_like
from reviewtide.operators.quality import (
    check_counted,
    check_reference,
    check_unique_key,
    union_all,
)
from reviewtide.plans.snapshot import STAR, VERSION, Star, new_version, replace
from reviewtide.plans.store import Store, category_of
from reviewtide.schemas import STAR_KEYS, STAR_REFERENCES, Fields, ddl, names, star_fields
from reviewtide.session import Workspace, concurrently
from reviewtide.sources.files import children
from reviewtide.sources.readers import read_folders
from reviewtide.sources.writers import project_staging

FACT = "reviews"
ROWS_PER_PART = 2_000_000
MOST_FOLDERS = 8  # of a part of the fact, before they are brought together
SUPPORT = ("support", "bigint")
PART = ("part", "int")

#: What the parts of each table go by. The fact goes by place and user, so that a place with a
#: third of its rows is in all parts.
PART_KEYS = {
    "users": ["gPlusUserId"],
    "places": ["gPlusPlaceId"],
    "population": ["postcode"],
    FACT: ["gPlusPlaceId", "gPlusUserId"],
}
#: Staging columns under the names that the tables have.
RENAMED = {"users": {"avgRating": "userAvgRating"}}


def staging_rows(store: Store, folders: dict[str, str], category: str) -> DataFrame:
    """Staging rows of some lake folders, without text. Null and '' are told apart by the value
    that each row keeps."""
    rows = filter_category_like(store.lake_values(folders), category)
    rows = rows.withColumn("category", F.col("categoryValue")).drop("categoryValue")
    return filter_category_like(project_staging(rows), category)


def replaced_folders(
    before: dict[str, str], now: dict[str, str], category: str
) -> tuple[dict[str, str], dict[str, str]]:
    """Folders of the star's categories that are no longer live, and that have become so."""
    gone = {f: v for f, v in before.items() if now.get(f) != v}
    new = {f: v for f, v in now.items() if before.get(f) != v}
    return _like(gone, category), _like(new, category)


def _like(folders: dict[str, str], category: str) -> dict[str, str]:
    """Those that can hold the category. A text with wildcards is left to the rows' filter."""
    if "%" in category or "_" in category or "\\" in category:
        return folders
    return {f: v for f, v in folders.items() if (c := category_of(f)) is None or category in c}


def signed_staging(ws: Workspace, gone: DataFrame | None, new: DataFrame) -> DataFrame:
    """A written table of staging rows with ``change``: how many more there are of each. Without
    former rows, each new row is by itself."""
    signed = new.withColumn("change", F.lit(1).cast("bigint"))
    if gone is not None:
        signed = signed.unionByName(gone.withColumn("change", F.lit(-1).cast("bigint")))
        signed = (
            signed.groupBy(new.columns).agg(F.sum("change").alias("change")).filter("change != 0")
        )
    return ws.write(signed, "staging_changes")


def part_of(table: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(*PART_KEYS[table]), F.lit(parts)).cast("int").alias("part")


def table_changes(changes: DataFrame, table: str, fields: Fields, parts: int) -> DataFrame:
    """Changes of one table's rows: its columns, ``change``, ``part``."""
    renamed = RENAMED.get(table, {})
    columns = [F.col(renamed.get(n, n)).cast(t).alias(n) for n, t in fields]
    rows = changes.select(*columns, "change")
    return rows.withColumn("part", part_of(table, parts))


def read_part_files(
    spark: SparkSession, root: str, table: str, star: Star, fields: Fields, only: set[str] | None = None
) -> DataFrame:
    live = star.tables.get(table, {})
    folders = [
        f"{VERSION}{v}/{part}" for part, versions in live.items() if only is None or part in only for v in versions
    ]
    return read_folders(spark, f"{root}/{STAR}/{table}", folders, fields)


def star_rows(spark: SparkSession, root: str, star: Star) -> dict[str, DataFrame]:
    """The published tables of a star that is kept in parts."""
    return {
        table: read_part_files(spark, root, table, star, fields)
        for table, fields in star_fields(star.scale).items()
    }


def _written(df: DataFrame, path: str, parts: int) -> None:
    """One folder a part. Adaptive execution leaves the number of tasks as it is."""
    df.repartition(parts, "part").write.partitionBy("part").parquet(path)


def _parts_named(rows: DataFrame) -> set[str]:
    """Folder names of the parts that occur; there are as many as parts at most."""
    return {f"part={row['part']}" for row in rows.select("part").distinct().collect()}


def _checked(rows: DataFrame) -> DataFrame:
    """A number below zero means that the tables are not what the lake folders gave."""
    return rows.withColumn(
        "support", F.when(F.col("support") < 0, F.raise_error(F.lit("the star is out of step with the lake"))
                          ).otherwise(F.col("support"))
    )


def merge_dimension(
    ws: Workspace, store: Store, star: Star, table: str, changes: DataFrame
) -> dict[str, list[str]]:
    """The live parts of a dimension after the changes."""
    fields = star_fields(star.scale)[table]
    columns = names(fields)
    net = table_changes(changes, table, fields, star.parts).groupBy(*columns, "part").agg(
        F.sum("change").alias("support")
    )
    touched: set[str] = set()
    merged = net
    if star.tables:
        net = ws.write(net.filter("support != 0"), f"{table}_changes")
        touched = _parts_named(net)
        was = read_part_files(
            store.spark, store.root, table, star, (*fields, SUPPORT, PART), only=touched
        )
        merged = was.unionByName(net).groupBy(*columns, "part").agg(F.sum("support").alias("support"))
    version = new_version()
    path = f"{store.root}/{STAR}/{table}/{VERSION}{version}"
    _written(_checked(merged).filter("support > 0"), path, star.parts)
    live = {p: v for p, v in star.tables.get(table, {}).items() if p not in touched}
    return live | {p: [version] for p in children(store.spark, path) if "=" in p}


def merge_fact(ws: Workspace, store: Store, star: Star, changes: DataFrame) -> dict[str, list[str]]:
    """The live parts of the fact after the changes."""
    fields = star_fields(star.scale)[FACT]
    columns = names(fields)
    live = star.tables.get(FACT, {})
    net = table_changes(changes, FACT, fields, star.parts)
    if live:
        net = net.groupBy(*columns, "part").agg(F.sum("change").alias("change")).filter("change != 0")
        net = ws.write(net, "fact_changes")
        losing = _parts_named(net.filter("change < 0"))
        full = {p for p in _parts_named(net) if len(live.get(p, [])) >= MOST_FOLDERS}
        anew = (losing | full) & live.keys()
        was = read_part_files(store.spark, store.root, FACT, star, (*fields, PART), only=anew)
        is_anew = F.concat(F.lit("part="), F.col("part").cast("string")).isin(sorted(anew))
        merged = (
            was.withColumn("change", F.lit(1).cast("bigint"))
            .unionByName(net.filter(is_anew))
            .groupBy(*columns, "part")
            .agg(F.sum("change").alias("support"))
        )
        kept = _checked(merged).filter("support > 0").withColumnRenamed("support", "change")
        gained = net.filter(~is_anew) if anew else net
        net = gained.unionByName(kept) if anew else gained
    else:
        anew = set()
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("change")))
    version = new_version()
    path = f"{store.root}/{STAR}/{FACT}/{VERSION}{version}"
    rows = net.withColumn("copy", copies).select(*columns, "part")
    _written(rows, path, star.parts)
    after = {p: list(v) for p, v in live.items() if p not in anew}
    for part in children(store.spark, path):
        if "=" in part:
            after.setdefault(part, []).append(version)
    return after


def parts_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_PART))


def updated_star(
    ws: Workspace, store: Store, category: str, scale: int, parts: int | None = None, anew: bool = False
) -> Star:
    """The star of the published lake, written but not published.

    It goes on from the published star if that is kept in parts, for the same category and
    scale; else, or with ``anew``, it is made from all folders.
    """
    snapshot = store.snapshot()
    star = snapshot.star
    usable = star and not anew and star.tables and (star.category, star.scale) == (category, scale)
    before = star.lake if usable else {}
    gone, new = replaced_folders(before, snapshot.lake, category)
    rows_gone = staging_rows(store, gone, category) if before else None
    changes = signed_staging(ws, rows_gone, staging_rows(store, new, category))
    if not usable:
        n = parts or parts_for(changes.count())
        star = Star(category, scale, new_version(), parts=n)
    dimensions = [t for t in star_fields(scale) if t != FACT]
    merged = concurrently(
        ws.spark,
        *(lambda t=t: merge_dimension(ws, store, star, t, changes) for t in dimensions),
        lambda: merge_fact(ws, store, star, changes),
    )
    tables = dict(zip([*dimensions, FACT], merged))
    after = replace(star, tables=tables, lake=_like(snapshot.lake, category))
    return replace(after, rows=_row_counts(store, star, after))


def changed_parts(before: Star, now: Star) -> dict[str, set[str]]:
    """Per table the parts whose files are not the same in both."""
    return {
        table: {p for p in parts | before.tables.get(table, {}) if parts.get(p) != before.tables.get(table, {}).get(p)}
        for table, parts in now.tables.items()
    }


def _row_counts(store: Store, before: Star, now: Star) -> dict[str, dict[str, int]]:
    """Rows of each part; only files of changed parts are counted (by what they say of themselves)."""
    changed = changed_parts(before, now)
    frames = [
        read_part_files(store.spark, store.root, table, now, (PART,), only=parts)
        .groupBy("part")
        .agg(F.count("*").alias("n"))
        .select(F.lit(table).alias("table"), "part", "n")
        for table, parts in changed.items()
    ]
    counted = union_all(frames).collect()  # a row for each changed part
    rows = {}
    for table, parts in changed.items():
        same = {p: n for p, n in before.rows.get(table, {}).items() if p not in parts}
        rows[table] = same | {f"part={r['part']}": r["n"] for r in counted if r["table"] == table}
    return rows


def check_changes(store: Store, before: Star, now: Star) -> DataFrame:
    """The checks of the whole star, at the cost of what has changed.

    All rows of a key are in one part of its dimension, so a key can only have become double
    in a changed part; and only keys of fact rows that are new, or of dimension rows that are
    gone, can have lost their dimension row. The latter are counted against the support that
    the dimension keeps: a row without support is not written, and one whose support falls
    below zero stops the merge. How many rows there are is known from each part.
    """
    spark, root = store.spark, store.root
    changed = changed_parts(before, now)
    fields = star_fields(now.scale)
    report = []
    for table in fields:
        n = sum(now.rows.get(table, {}).values())
        counted = spark.createDataFrame([(n,)], "rows bigint")
        report.append(check_counted(counted, table))
    for table, key in STAR_KEYS:
        rows = read_part_files(spark, root, table, now, fields[table], only=changed[table])
        report.append(check_unique_key(rows, table, key))
    gained = _gained_files(spark, root, before, now, fields[FACT])
    for table, key in STAR_REFERENCES:
        keys = gained.select(key).distinct()
        needed = keys.filter(F.col(key).isNotNull()).withColumn("part", part_of(table, now.parts))
        dimension = read_part_files(spark, root, table, now, fields[table], only=_parts_named(needed))
        report.append(check_reference(gained, dimension, table, key))
    return union_all(report)


def _gained_files(spark: SparkSession, root: str, before: Star, now: Star, fields: Fields) -> DataFrame:
    """Rows of the fact's files that are new."""
    known = {(p, v) for p, versions in before.tables.get(FACT, {}).items() for v in versions}
    new = {
        p: [v for v in versions if (p, v) not in known] for p, versions in now.tables[FACT].items()
    }
    return read_part_files(spark, root, FACT, replace(now, tables={FACT: new}), fields)


def register_parts(
    spark: SparkSession, root: str, star: Star, database: str
) -> dict[str, DataFrame]:
    """Let the catalog's tables name the live files. ``<table>_parts`` is partitioned, with a
    place for each part, and ``<table>`` is a view of its columns."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found = {}
    for table, fields in star_fields(star.scale).items():
        base, files = f"{root}/{STAR}/{table}", f"{database}.{table}_parts"
        folders = [(p, v) for p, versions in star.tables[table].items() for v in versions]
        spark.sql(f"DROP TABLE IF EXISTS {files}")
        spark.sql(
            f"CREATE TABLE {files} ({ddl(fields)}, part int, version string) USING parquet "
            f"PARTITIONED BY (part, version) LOCATION '{base}'"
        )
        for at in range(0, len(folders), 500):
            places = " ".join(
                f"PARTITION (part={p.removeprefix('part=')}, version='{v}') LOCATION '{base}/{VERSION}{v}/{p}'"
                for p, v in folders[at : at + 500]
            )
            spark.sql(f"ALTER TABLE {files} ADD {places}")
        replace_by_view(spark, f"{database}.{table}", f"SELECT {', '.join(names(fields))} FROM {files}")
        found[table] = spark.table(f"{database}.{table}")
    return found


def replace_by_view(spark: SparkSession, name: str, query: str) -> None:
    """A former table of that name (its files stay) makes place."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")

