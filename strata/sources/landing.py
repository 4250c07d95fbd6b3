"""Landing tables: named reads, layer paths, typed writes, row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import nan_to_null

# The layer names, used verbatim as schema / folder names.
LAYERS = ("landing_zone", "bronze", "silver", "gold")

# Landing table names, one per entity and park.
ENTITIES = ("customers", "feedback", "gate_events", "master_data", "products",
            "ride_operations", "staff", "transactions", "weather")
PARK_PREFIXES = ("sf", "aq")


def landing_names() -> list[str]:
    return [f"{p}_{e}" for p in PARK_PREFIXES for e in ENTITIES]


def layer_path(root: str, layer: str, name: str) -> str:
    """``<root>/<layer>/<name>``: the layer name is used as given."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_landing(spark: SparkSession, root: str, name: str, layer: str = "landing_zone",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Read one named table (parquet); ``columns`` prunes at the scan."""
    return read_table(spark, layer_path(root, layer, name), columns)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def with_row_id(df: DataFrame, order_by: Sequence, name: str = "bronze_id",
                start: int = 1) -> DataFrame:
    """Consecutive ids ``start..start+n-1`` in ``order_by`` order, as first column.

    Distributed instead of a global ``row_number()`` (which moves every row
    into one task): the sorted rows are written once to the shared scratch
    folder, each with its partition and its position there.  Counts per
    partition (one small row each) and the ids are both read from that copy,
    so no row can be lost or numbered twice, whatever adaptive execution does
    to the sort.  ``order_by`` must be a total order for the ids to be the
    same in every run; they are consecutive and distinct in any case.

    Large tables are stored first, apart by ranges of the first column, and
    sorted range by range, so that disk holds one range's shuffle at a time.
    """
    return _numbered(df, order_by, name, start)[0]


def _range_of(df: DataFrame, column: str, n: int):
    """Number (0 to n - 1) of the range of ``column`` that a row is in, ranges in its
    order, nulls in the first; cut at values of at most 1000 rows, as a range
    sort does, so where they lie steers the sizes only."""
    some = df.select(column).where(F.col(column).isNotNull()).orderBy(F.rand(1)).limit(1000)
    found = sorted((r[0] for r in some.orderBy(column).collect()), key=lambda x: (x != x, x))
    cuts = sorted({len(found) * i // n for i in range(1, n)}) if found else []
    out = F.lit(0)
    for i in cuts:
        out = out + F.when(F.col(column) > F.lit(found[i]), 1).otherwise(0)
    return out


def _numbered(df: DataFrame, order_by: Sequence, name: str, start: int) -> tuple[DataFrame, object]:
    """``with_row_id`` and the stage that holds the rows."""
    from pyspark.sql import Window

    from ..operators.staged import Stage, shuffles_freed, slices_for
    spark = df.sparkSession
    n = slices_for(df) if isinstance(order_by[0], str) else 1

    def place(part: DataFrame, i: int) -> DataFrame:
        return part.orderBy(*order_by).withColumns({
            "__pid": (F.spark_partition_id() + F.lit(i << 26)),
            "__pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})

    stage = Stage(spark, "row-ids")
    if n == 1:
        from ..session import PACKED
        placed = place(df, 0)
        with shuffles_freed(spark):
            placed.write.options(**PACKED).parquet(f"{stage.root}/rows")
        stored = spark.read.schema(placed.schema).parquet(f"{stage.root}/rows")
    else:
        with shuffles_freed(spark):
            ranges = _range_of(df, order_by[0], n)
        stored = stage.run(df, [(ranges, place)], n)
    counts = stored.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    # one row per partition of the sort: a few megabytes at a hundred thousand partitions
    out = stored.join(F.broadcast(offsets), "__pid")
    rid = (F.col("__off") + F.col("__pos") + F.lit(start)).alias(name)
    return out.select(rid, *[F.col(c) for c in df.columns]), stage


def infer_landing_schema(df: DataFrame) -> T.StructType:
    """Declared landing types: primitive types kept, timestamps without a zone
    as TIMESTAMP, anything else as STRING."""
    keep = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType,
            T.BooleanType, T.StringType, T.TimestampType, T.DateType)
    fields = []
    for f in df.schema.fields:
        t = f.dataType if isinstance(f.dataType, keep) else T.StringType()
        if isinstance(f.dataType, T.TimestampNTZType):
            t = T.TimestampType()
        fields.append(T.StructField(f.name, t, True))
    return T.StructType(fields)


def write_landing(df: DataFrame, root: str, name: str, order_by: Sequence[str] | None = None,
                  layer: str = "landing_zone") -> bool:
    """Drop-and-create a landing table with ``bronze_id`` first.

    NaN becomes NULL.  ``order_by`` names the leading columns of the id order;
    all others follow, so equal rows apart the order is total.  Returns False
    (and writes nothing) for empty input.
    """
    if not order_by and df.isEmpty():
        return False
    schema = infer_landing_schema(df)

    def typed(f: T.StructField):
        c = F.col(f.name)
        if isinstance(df.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        return c.cast(f.dataType).alias(f.name)

    from ..operators.staged import shuffles_freed
    from ..session import PACKED
    out, stage = df.select(*[typed(f) for f in schema.fields]), None
    if order_by:
        out, stage = _numbered(out, [*order_by, *[c for c in out.columns if c not in order_by]], "bronze_id", 1)
        if out.isEmpty():  # told from the stored rows: a look at ``df`` may shuffle all it is joined from
            return False
    with shuffles_freed(df.sparkSession):
        out.write.mode("overwrite").options(**PACKED).parquet(layer_path(root, layer, name))
    if stage is not None:
        stage.clear()
    return True
