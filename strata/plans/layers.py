"""End-to-end run over stored landing tables: bronze -> silver -> gold -> checks.

Layout (layer names used verbatim): ``<root>/landing_zone/<park>_<entity>``
in, ``<root>/bronze/raw_<entity>`` (appended batches by park and day),
``<root>/silver/<model>`` (versioned, keyed upsert) and ``<root>/gold/<model>``
(versions published through the catalog) out.  Each layer is written and read
back before the next one is planned, so every model reads stored tables
(lineage cut at each layer; a lost executor repeats only its own stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import VersionedTable, changed_rows, partitions_since, region_marks, upsert_table
from ..operators.quality import Relation, ri_report, run_suite
from ..sources.catalog import AppendedTable, LayerCatalog
from ..sources.bronze import scrub_null_text, tag_union
from ..sources.landing import ENTITIES, layer_path, read_landing, write_landing
from . import gold as G
from . import silver as S
from .warehouse import GOLD_MODELS, bronze_suite, gold_suite, singular_suite

BRONZE_MODELS = [f"raw_{e}" for e in ENTITIES]

#: Gold table that names the silver versions and settings it was built from.
BUILT = "_built_from"

#: Silver columns that the facts look up in the calendar.
FACT_DATES = [("silver_transactions", "transaction_date"), ("silver_gate_events", "event_date"), ("silver_ride_opeartions", "poll_date"),
              ("silver_feedback", "feedback_date"), ("silver_weather", "weather_date")]

# Foreign keys checked before a load
# (child entity, column, parent entity, column, NULL allowed).
LANDING_RELATIONS = [
    ("transactions", "customer_id", "customers", "source_customer_id", True),
    ("transactions", "product_code", "products", "product_code", False),
    ("transactions", "cashier_id", "staff", "source_employee_id", False),
    ("gate_events", "customer_id", "customers", "source_customer_id", False),
    ("ride_operations", "lead_operator_id", "staff", "source_employee_id", False),
    ("feedback", "customer_id", "customers", "source_customer_id", False),
]

# Key columns scrubbed of null-like text before a load.
SCRUB_COLUMNS = ("customer_id", "source_customer_id", "cashier_id", "lead_operator_id",
                 "product_code", "source_employee_id")


def landing_ri_report(frames: dict[str, DataFrame]) -> DataFrame:
    """RI report over the six landing relations of one park."""
    return ri_report([
        Relation(f"{c}.{fk} -> {p}.{pk}", frames[c], fk, frames[p], pk, nullable)
        for c, fk, p, pk, nullable in LANDING_RELATIONS if c in frames and p in frames])


def load_landing(spark: SparkSession, root: str, park: str, frames: dict[str, DataFrame],
                 require_integrity: bool = True) -> DataFrame:
    """Scrub key columns, check referential integrity, then write each
    ``<park>_<entity>`` landing table (``bronze_id`` first; empty frames skipped).

    With ``require_integrity`` nothing is written when a relation fails.
    Returns the RI report.
    """
    clean = {e: scrub_null_text(df, [c for c in SCRUB_COLUMNS if c in df.columns])
             for e, df in frames.items()}
    report = landing_ri_report(clean)
    failed = report.filter("status = 'FAIL'").limit(1).count() > 0
    if require_integrity and failed:
        return report
    for entity, df in clean.items():
        write_landing(df, root, f"{park}_{entity}", order_by=[df.columns[0]])
    return report


def build_bronze(spark: SparkSession, root: str, entity: str,
                 parks: Sequence[str] = ("sf", "aq"), tag_col: str = "source_region") -> DataFrame:
    """``raw_<entity>``: every park's landing table, tagged with the park code."""
    return tag_union({p.upper(): read_landing(spark, root, f"{p}_{entity}") for p in parks},
                     tag_col=tag_col)


DAY = "ingestion_day"


def bronze_table(spark: SparkSession, root: str, entity: str, tag_col: str = "source_region") -> AppendedTable:
    """``raw_<entity>``: batches of landing rows by park and ingestion day."""
    return AppendedTable(spark, layer_path(root, "bronze", f"raw_{entity}"), [tag_col, DAY])


def append_bronze(spark: SparkSession, root: str, entity: str, parks: Sequence[str] = ("sf", "aq"),
                  tag_col: str = "source_region", ts_col: str = "ingestion_timestamp", ignore: Sequence[str] = ("bronze_id",)) -> DataFrame:
    """Add the landing rows that bronze does not hold yet; the whole table.

    New are rows later than the newest instant stored of their park, and rows
    of that instant, or without one, that equal no stored row (but for
    ``ignore``: row ids are given anew with each landing load).  Only the
    partitions of those days are read for that; nothing stored is copied.
    """
    landed = build_bronze(spark, root, entity, parks, tag_col)
    landed = landed.withColumn(DAY, F.col(ts_col).try_cast("timestamp").cast("date"))
    table = bronze_table(spark, root, entity, tag_col)
    stored = table.read(landed.schema)
    new = landed
    if stored is not None:
        marks = region_marks(stored.select(tag_col, F.col(ts_col).try_cast("timestamp").alias("wm")), "wm", tag_col)
        ts, source = F.col(ts_col).try_cast("timestamp"), F.upper(F.trim(F.col(tag_col)))
        late = ts.isNull()
        for k, wm in marks.items():
            late = late | (source == k) & (F.lit(True) if wm is None else ts >= F.lit(wm))
        known = [k for k in marks if k is not None]
        cand = landed.where(late | ~source.isin(known))
        edge = partitions_since(stored, marks, tag_col, DAY)
        cols = [c for c in landed.columns if c not in ignore]
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("__hash")
        edge = edge.select(digest, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"))
        cand = cand.select("*", digest.alias("__own"))
        new = (cand.join(edge, (F.col("__own") == F.col("__hash")) & F.struct(*[cand[f"`{c}`"] for c in cols]).eqNullSafe(F.col("__row")), "left_anti")
               .drop("__own"))
    table.append(new)
    return table.read(landed.schema)


def run_layers(spark: SparkSession, root: str, parks_dim: Sequence[tuple[int, str, str]],
               as_of=None, calendar: tuple[str, str] | None = ("2025-01-01", "2026-12-31"),
               park_prefixes: Sequence[str] = ("sf", "aq"),
               silver_params: dict | None = None, watermark_rule: str = "ingestion", catalog_prefix: str = "") -> DataFrame:
    """Run all layers once and return the check report of all layers.

    A first run loads everything.  Later ones append the new landing rows to
    bronze, read only the bronze partitions that can hold rows newer than each
    silver table has, and rebuild gold only if a silver table has changed since
    gold was built.  Gold tables are published as views ``<catalog_prefix>gold.<model>``.
    ``calendar`` None lets the calendar cover the facts' dates.
    """
    silver_params = silver_params or {}
    bronze = {f"raw_{entity}": append_bronze(spark, root, entity, park_prefixes) for entity in ENTITIES}

    silver, versions = {}, []
    for model, builder in S.SILVER_BUILDERS.items():
        table = VersionedTable(spark, layer_path(root, "silver", model))
        stored = table.read()
        source = bronze[S.SILVER_SOURCES[model]]
        own = S.INGEST_WATERMARK[model][1]
        if watermark_rule == "ingestion" and own != "silver_loaded_at":
            source = partitions_since(source, region_marks(stored, own, "source_region"), "source_region", DAY)
        batch = builder(source, as_of=as_of, target=stored, watermark_rule=watermark_rule, **silver_params.get(model, {}))
        batch = changed_rows(batch, stored, ignore=("silver_loaded_at",))
        silver[model] = upsert_table(spark, table.path, batch, S.MERGE_KEYS[model])
        versions.append((model, table.current_version()))

    catalog = LayerCatalog(spark, root, catalog_prefix)
    built = catalog.table("gold", BUILT)
    key = [(*v, str((list(map(tuple, parks_dim)), calendar))) for v in versions]
    if built is not None and sorted(map(tuple, built.collect()), key=str) == sorted(key, key=str):
        g = {m: catalog.table("gold", m) for m in GOLD_MODELS}
        return check_layers(bronze, silver, g, parks_dim, calendar)
    g = {}

    def put(name, df):
        g[name] = catalog.publish(df, "gold", name)

    if calendar is None:
        put("dim_date", G.build_dim_date_covering([(silver[m], c) for m, c in FACT_DATES]))
    else:
        put("dim_date", G.build_dim_date(spark, *calendar))
    put("dim_park", G.build_dim_park(spark, parks_dim))
    put("dim_customer", G.build_dim_customer(silver["silver_customers"], as_of))
    put("dim_product", G.build_dim_product(silver["silver_products"], as_of))
    put("dim_staff", G.build_dim_staff(silver["silver_staff"], as_of))
    put("dim_ride", G.build_dim_ride(silver["silver_ride_opeartions"], g["dim_park"], as_of))
    put("dim_gate", G.build_dim_gate(silver["silver_gate_events"], g["dim_park"], as_of))
    put("dim_weather", G.build_dim_weather(silver["silver_weather"], as_of))
    put("fact_transaction", G.build_fact_transaction(
        silver["silver_transactions"], g["dim_date"], g["dim_park"], g["dim_product"],
        g["dim_customer"], g["dim_staff"], as_of))
    put("fact_gate_event", G.build_fact_gate_event(
        silver["silver_gate_events"], g["dim_date"], g["dim_park"], g["dim_gate"],
        g["dim_customer"], as_of))
    put("fact_ride_operations", G.build_fact_ride_operations(
        silver["silver_ride_opeartions"], g["dim_date"], g["dim_park"], g["dim_ride"],
        g["dim_staff"], as_of))
    put("fact_customer_feedback", G.build_fact_customer_feedback(
        silver["silver_feedback"], g["dim_date"], g["dim_park"], g["dim_customer"], as_of))
    put("fact_weather_observation", G.build_fact_weather_observation(
        silver["silver_weather"], g["dim_date"], g["dim_park"], g["dim_weather"], as_of))
    catalog.publish(spark.createDataFrame(key, "model string, version long, settings string"), "gold", BUILT)  # last: all of gold is there

    return check_layers(bronze, silver, g, parks_dim, calendar)


def check_layers(bronze: dict[str, DataFrame], silver: dict[str, DataFrame], gold: dict[str, DataFrame],
                 parks_dim: Sequence[tuple[int, str, str]],
                 calendar: tuple[str, str] | None = ("2025-01-01", "2026-12-31")) -> DataFrame:
    """Every declared test of the bronze and gold layers, and the singular
    tests, as ``model, test, failures, severity, status``."""
    lo, hi = (int(x.replace("-", "")) for x in calendar or ("0001-01-01", "9999-12-31"))
    parks = [(p[0], p[1]) for p in parks_dim]
    report = run_suite(bronze, bronze_suite([c for _, c in parks]))
    report = report.unionByName(run_suite(gold, gold_suite(lo, hi, parks)))
    return report.unionByName(singular_suite(silver, gold))


def stored_layers(spark: SparkSession, root: str) -> tuple[dict, dict, dict]:
    """The stored bronze, silver and gold tables under ``root``."""
    catalog = LayerCatalog(spark, root)
    bronze = {f"raw_{e}": bronze_table(spark, root, e).read() for e in ENTITIES}
    silver = {m: VersionedTable(spark, layer_path(root, "silver", m)).read() for m in S.SILVER_BUILDERS}
    gold = {m: catalog.table("gold", m) for m in GOLD_MODELS}
    return bronze, silver, gold
