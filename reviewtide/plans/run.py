"""The whole batch: raw files to lake, staging, star tables and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession

from reviewtide.operators.categories import MIN_REVIEWS
from reviewtide.operators.layout import without_slices
from reviewtide.operators.quality import (
    enforce,
    guard_filter_effective,
    guard_join_fanout,
    guard_populated,
    run_checks,
)
from reviewtide.operators.star import replace_table
from reviewtide.plans.incremental import add_batch, withdraw_batch
from reviewtide.plans.lake import usa_places
from reviewtide.plans.prepare import prepare_places, review_features
from reviewtide.plans.rollups import refresh
from reviewtide.plans.snapshot import STAR, VERSION, Star, new_version, replace
from reviewtide.plans.star_changes import (
    check_changes,
    register_parts,
    staging_rows,
    star_rows,
    updated_star,
)
from reviewtide.plans.store import FIRST_BATCH, Store, checked_batch_name
from reviewtide.plans.warehouse import StarTable, register_layout, write_star
from reviewtide.schemas import (
    PLACES_RAW,
    POPULATION_RAW,
    REVIEWS_RAW,
    STAR_KEYS,
    STAR_REFERENCES,
    star_fields,
)
from reviewtide.session import (
    Sizing,
    Workspace,
    concurrently,
    input_bytes,
    sized_for,
    use_utc,
    workspace,
)
from reviewtide.sources.readers import read_csv, read_dirty_json_whole


@dataclass(frozen=True)
class Published:
    """What a run leaves: its files, star tables, check rows and parse counts."""

    store: Store
    tables: dict[str, DataFrame]
    report: list[Row]
    parsed: dict[str, dict[str, int]]


@dataclass(frozen=True)
class Warehouse:
    """Which categories go into the star tables, and how and where those are kept.

    ``parts``: into how many parts each table is dealt (by default so many that one has about
    two million fact rows); only parts with changed rows are written again. ``buckets``: a
    number, or "auto" for one that follows from the size, lays the tables out for joins
    without a shuffle instead; such a star is written anew each time.
    """

    category: str
    database: str = "default"
    scale: int = 0
    buckets: int | str | None = None
    parts: int | None = None


def star_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The published star tables below ``out``, for a session whose catalog lacks them."""
    star = Store(spark, out).snapshot().star
    if star.tables:
        return star_rows(spark, out, star)
    folder = f"{out}/{STAR}/{VERSION}{star.version}"
    return {name: spark.read.parquet(f"{folder}/{name}") for name in star_fields()}


def register_star(
    spark: SparkSession, root: str, star: Star, written: dict[str, StarTable] | None, database: str
) -> dict[str, DataFrame]:
    """Let the tables of ``database`` name the files of a written star."""
    if written is not None:
        return register_layout(spark, written, database)
    return register_parts(spark, root, star, database)


def publish_star(
    ws: Workspace, store: Store, warehouse: Warehouse, anew: bool = False
) -> tuple[dict[str, DataFrame], list[Row]]:
    """Star tables and their checks; only tables that pass are published.

    Nothing that is published is overwritten, so if writing or checking fails, the published
    tables stay as they are. Unless ``anew``, the published star is gone on from.
    """
    written = None
    if warehouse.buckets is None:
        star = updated_star(ws, store, warehouse.category, warehouse.scale, warehouse.parts, anew)
        tables = star_rows(ws.spark, store.root, star)
        populated = {"staging": tables["reviews"]}
        before = store.snapshot().star
    else:
        rows = staging_rows(store, store.snapshot().lake, warehouse.category)
        staging = replace_table(rows, ws.table_name("staging"))
        star = Star(warehouse.category, warehouse.scale, new_version())
        folder = store.path(STAR, star.version)
        written = write_star(ws, staging, folder, warehouse.scale, warehouse.buckets)
        tables = without_slices({name: table.rows for name, table in written.items()})
        populated = {"staging": staging}
    if written is None and before and before.version == star.version:
        report = check_changes(store, before, star)
    else:
        populated["reviews_lake"] = store.lake()
        report = run_checks(tables, STAR_KEYS, STAR_REFERENCES).unionByName(guard_populated(populated))
    checks = enforce(report)
    published = register_star(ws.spark, store.root, star, written, warehouse.database)
    store.change(lambda s: replace(s, star=star))
    return published, checks


def run(
    spark: SparkSession,
    places_path: str,
    reviews_path: str,
    population_path: str,
    out: str,
    warehouse: Warehouse,
    min_reviews: int = MIN_REVIEWS,
    repair: str = "blind",
    sizing: Sizing = Sizing(),
) -> Published:
    """Raw text is read, repaired and parsed once; everything after reads Parquet.

    All files go below ``out``; the catalog's tables name the star files there. The lake
    is computed once, and staging is read from it. A failed check raises before anything
    is published that depends on it.
    """
    use_utc(spark)
    published = Store(spark, out)
    raw_bytes = input_bytes(spark, places_path, reviews_path)
    with sized_for(spark, raw_bytes, sizing), workspace(spark) as ws:
        published.clean_up()
        store = published.draft()
        seen = {"places": Observation("places"), "reviews": Observation("reviews")}
        population = read_csv(spark, population_path, POPULATION_RAW)
        raw_places = read_dirty_json_whole(spark, places_path, PLACES_RAW, repair, seen["places"])
        raw_reviews = read_dirty_json_whole(spark, reviews_path, REVIEWS_RAW, repair, seen["reviews"])
        concurrently(
            spark,
            lambda: store.write_places(prepare_places(raw_places, population)),
            lambda: store.write_reviews(review_features(raw_reviews), FIRST_BATCH, first=True),
        )
        fanout, _ = concurrently(
            spark,
            lambda: enforce(guard_join_fanout(store.reviews(), usa_places(store.places()))),
            lambda: store.write_states(FIRST_BATCH, first=True, raw_bytes=raw_bytes),
        )
        inputs, effective = concurrently(
            spark,
            lambda: store.lake_inputs(ws),
            lambda: enforce(guard_filter_effective(store.category_counts(), min_reviews)),
        )
        store.write_lake(ws, min_reviews, inputs)
        store.publish()
        tables, checks = publish_star(ws, published, warehouse, anew=True)
        refresh(ws, published)
    parsed = {name: o.get for name, o in seen.items()}
    return Published(published, tables, [*fanout, *effective, *checks], parsed)


def run_increment(
    spark: SparkSession,
    reviews_path: str,
    batch: str,
    out: str,
    warehouse: Warehouse,
    min_reviews: int = MIN_REVIEWS,
    repair: str = "blind",
    sizing: Sizing = Sizing(),
) -> Published:
    """Add the raw reviews of one ``batch`` to the store below ``out``.

    Lake folders without a change stay, and so do the parts of the star tables. A batch that
    is there already is corrected: its reviews are the given ones from now on. Batches that an
    earlier run did not finish are brought into the lake as well. Shuffles are sized by the raw
    bytes of all batches.
    """
    checked_batch_name(batch)
    use_utc(spark)
    store = Store(spark, out)
    new_bytes = input_bytes(spark, reviews_path)
    with sized_for(spark, store.raw_bytes() + new_bytes, sizing), workspace(spark) as ws:
        seen = Observation("reviews")
        raw_reviews = read_dirty_json_whole(spark, reviews_path, REVIEWS_RAW, repair, seen)
        features = review_features(raw_reviews)
        report = add_batch(ws, store, features, batch, min_reviews, new_bytes)
        tables, checks = publish_star(ws, store, warehouse)
        refresh(ws, store)
    return Published(store, tables, report + checks, {"reviews": seen.get})


def run_withdrawal(
    spark: SparkSession,
    batch: str,
    out: str,
    warehouse: Warehouse,
    min_reviews: int = MIN_REVIEWS,
    sizing: Sizing = Sizing(),
) -> Published:
    """Take a batch back: lake and star become those of the other batches."""
    use_utc(spark)
    store = Store(spark, out)
    with sized_for(spark, store.raw_bytes(), sizing), workspace(spark) as ws:
        withdraw_batch(ws, store, batch, min_reviews)
        tables, checks = publish_star(ws, store, warehouse)
        refresh(ws, store)
    return Published(store, tables, checks, {})
