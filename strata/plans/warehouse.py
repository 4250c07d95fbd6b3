"""The warehouse over the driver tables: bronze -> silver -> gold -> checks.

``Warehouse(spark, sf_dir)`` builds every model lazily as a DataFrame (one
logical plan per model; only the parquet footers are read before an action).  ``materialize`` writes
the layers to storage in dependency order, so that downstream models read
the written tables instead of recomputing the lineage, and a lost executor
only repeats the stage it was running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Check, ReconcilePair, inactive_dim_rows, null_fk_report, reconcile, reconcile_counts, run_suite
from ..operators.staged import Stage, settle, shuffles_freed, slices_for
from ..functions.keys import UUID_PATTERN
from ..session import delete_path
from . import driver_tables as D
from . import gold as G
from . import silver as S


def decimals_to_double(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE (for engine-neutral comparison)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str | None = D.AS_OF,
                 tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        # already materialised models (name -> DataFrame) override the lazy plans
        self.tables = dict(tables or {})
        # rows of written models, and of those that a fact is loaded from (see materialize)
        self.counts: dict[str, dict[str, int]] = {}
        # settings of single silver models beside those of the driver data
        self.silver_params: dict[str, dict] = {}
        # where the lookups of a large fact are stored step by step; None builds plans only
        self.stage: Stage | None = None
        # columns that are wanted of single facts; all of the others'
        self.only: dict[str, Sequence[str]] = {}
        # folders of written models
        self.paths: dict[str, str] = {}

    def staged(self) -> "Warehouse":
        """This warehouse, with the lookups of large facts stored step by step: building
        ``fact_transaction`` then runs jobs."""
        self.stage = Stage(self.spark, "lookups")
        return self

    def _get(self, name: str, build):
        if name not in self.tables:
            self.tables[name] = build()
        return self.tables[name]

    # ----------------------------------------------------------------- bronze
    def bronze(self, name: str) -> DataFrame:
        return self._get(name, lambda: D.landing(self.spark, self.sf_dir, name))

    # ----------------------------------------------------------------- silver
    def silver(self, name: str) -> DataFrame:
        def build():
            src = self.bronze(S.SILVER_SOURCES[name])
            kwargs = {}
            if name == "silver_products":
                kwargs = dict(category_groups=D.PRODUCT_CATEGORY_GROUPS,
                              price_rules=D.PRODUCT_PRICE_RULES)
            return S.SILVER_BUILDERS[name](src, as_of=self.as_of, **kwargs, **self.silver_params.get(name, {}))
        return self._get(name, build)

    # ------------------------------------------------------------------- gold
    @cached_property
    def dim_date(self) -> DataFrame:
        return self._get("dim_date", lambda: G.build_dim_date_covering(
            [(D.read(self.spark, self.sf_dir, t), c) for t, c in D.DATED]))

    @cached_property
    def dim_park(self) -> DataFrame:
        return self._get("dim_park", lambda: D.dim_park_from_region(self.spark, self.sf_dir))

    def gold(self, name: str) -> DataFrame:
        a = self.as_of
        builders = {
            "dim_date": lambda: self.dim_date,
            "dim_park": lambda: self.dim_park,
            "dim_customer": lambda: G.build_dim_customer(self.silver("silver_customers"), a),
            "dim_product": lambda: G.build_dim_product(self.silver("silver_products"), a),
            "dim_staff": lambda: G.build_dim_staff(self.silver("silver_staff"), a),
            "dim_ride": lambda: G.build_dim_ride(self.silver("silver_ride_opeartions"),
                                                 self.dim_park, a),
            "dim_gate": lambda: G.build_dim_gate(self.silver("silver_gate_events"),
                                                 self.dim_park, a),
            "dim_weather": lambda: G.build_dim_weather(self.silver("silver_weather"), a),
            "fact_transaction": lambda: G.build_fact_transaction(
                self.silver("silver_transactions"), self.dim_date, self.dim_park,
                self.gold("dim_product"), self.gold("dim_customer"), self.gold("dim_staff"), a,
                self.stage, self.only.get("fact_transaction")),
            "fact_gate_event": lambda: G.build_fact_gate_event(
                self.silver("silver_gate_events"), self.dim_date, self.dim_park,
                self.gold("dim_gate"), self.gold("dim_customer"), a),
            "fact_ride_operations": lambda: G.build_fact_ride_operations(
                self.silver("silver_ride_opeartions"), self.dim_date, self.dim_park,
                self.gold("dim_ride"), self.gold("dim_staff"), a),
            "fact_customer_feedback": lambda: G.build_fact_customer_feedback(
                self.silver("silver_feedback"), self.dim_date, self.dim_park,
                self.gold("dim_customer"), a),
            "fact_weather_observation": lambda: G.build_fact_weather_observation(
                self.silver("silver_weather"), self.dim_date, self.dim_park,
                self.gold("dim_weather"), a),
        }
        return self._get(name, builders[name])

    # ------------------------------------------------------------- write out
    @classmethod
    def materialized(cls, spark: SparkSession, sf_dir: str, as_of: str | None = D.AS_OF,
                     root: str | None = None, models: Sequence[str] | None = None) -> "Warehouse":
        """A warehouse whose silver and gold tables are written (under ``root``,
        default a fresh folder in the shared checkpoint directory) and read
        back: all of them, or ``models`` and what those are built from."""
        if root is None:
            import uuid
            from ..session import scratch_path
            root = scratch_path(spark, f"warehouse-{uuid.uuid4().hex[:12]}")
        w = cls(spark, sf_dir, as_of).staged()
        w.root = root
        w.materialize(root, models)
        return w

    def drop(self, *names: str) -> None:
        """Delete written models that nothing reads any more; their counts stay."""
        for n in names:
            if n in self.paths:
                delete_path(self.spark, self.paths.pop(n))
                del self.tables[n]

    def materialize(self, root: str, models: Sequence[str] | None = None, parallel: int = 4) -> dict[str, str]:
        """Write silver, then the dimensions, then the facts under ``root`` and
        re-read each table, so later models read stored tables.  ``models``
        limits this to some models and what they are built from.

        Tables of one wave do not depend on each other; the write jobs of small ones are
        submitted from ``parallel`` threads so that they share the
        cluster instead of queueing one after another.  Large ones follow each other, and
        all shuffle files go with the write, so disk holds one table's at a time.
        Models that are written already are left out.

        Rows are counted while they are written (``counts``: all, and those that a fact
        takes), as metrics of the write job's last stage.
        """
        from pyspark.sql import Observation
        from concurrent.futures import ThreadPoolExecutor

        from ..sources.sinks import write_table
        paths = self.paths

        def wave(layer, names, build):
            names = [n for n in names if n not in self.counts]
            plans = {n: build(n) for n in names}          # plan on the caller thread
            small = [n for n in names if slices_for(plans[n]) == 1]

            def one(n):
                seen = Observation()
                taken = F.count_if(F.expr(FACT_ROWS.get(n, "true")))
                path = write_table(plans[n].observe(seen, F.count(F.lit(1)).alias("rows"), taken.alias("taken")), root, layer, n)
                return n, path, seen.get
            with shuffles_freed(self.spark):
                for some, threads in ((small, max(1, parallel)), ([n for n in names if n not in small], 1)):
                    with ThreadPoolExecutor(max_workers=threads) as pool:
                        for n, path, seen in pool.map(one, some):
                            paths[n] = path
                            self.counts[n] = seen
                            self.tables[n] = self.spark.read.parquet(path)

        need = set(S.SILVER_BUILDERS) | set(GOLD_MODELS) if models is None else set()
        queue = list(models or [])
        while queue:
            m = queue.pop()
            need.add(m)
            queue += BUILT_FROM.get(m, [])
        wave("silver", [m for m in S.SILVER_BUILDERS if m in need], self.silver)
        wave("gold", [m for m in GOLD_DIMS if m in need], self.gold)
        for m in GOLD_FACTS:  # one by one: the stored steps of a fact go with its write
            wave("gold", [m] if m in need else [], self.gold)
            if self.stage is not None:
                self.stage.clear()
        return paths

    def each_fact(self, use: Callable[[str], DataFrame | None]) -> list[DataFrame]:
        """``use(fact)`` of all facts, one after the other: each is written with what it is
        built from, used and deleted again with its silver table, so that disk holds one at
        a time.  Dimensions stay.  The rows that ``use`` gives (few, as of a report) are stored.
        """
        out = []
        for fact, silver in zip(GOLD_FACTS, FACT_SILVER):
            self.materialize(self.root, BUILT_FROM[fact])
            plan = self.gold(fact)
            if self.stage is not None and not any(self.paths[silver].rsplit("/", 1)[1] in f for f in plan.inputFiles()):
                self.drop(silver)  # its rows are in the stored lookups
            self.materialize(self.root, [fact])
            found = use(fact)
            if found is not None:
                out.append(settle(found, "report"))
            self.drop(fact, silver)
        return out


GOLD_DIMS = ["dim_date", "dim_park", "dim_customer", "dim_product", "dim_staff", "dim_ride",
             "dim_gate", "dim_weather"]
GOLD_FACTS = ["fact_transaction", "fact_gate_event", "fact_ride_operations",
              "fact_customer_feedback", "fact_weather_observation"]
GOLD_MODELS = GOLD_DIMS + GOLD_FACTS

#: What each gold model reads.
BUILT_FROM = {
    "dim_customer": ["silver_customers"], "dim_product": ["silver_products"], "dim_staff": ["silver_staff"],
    "dim_ride": ["silver_ride_opeartions", "dim_park"], "dim_gate": ["silver_gate_events", "dim_park"],
    "dim_weather": ["silver_weather"],
    "fact_transaction": ["silver_transactions", "dim_date", "dim_park", "dim_product", "dim_customer", "dim_staff"],
    "fact_gate_event": ["silver_gate_events", "dim_date", "dim_park", "dim_gate", "dim_customer"],
    "fact_ride_operations": ["silver_ride_opeartions", "dim_date", "dim_park", "dim_ride", "dim_staff"],
    "fact_customer_feedback": ["silver_feedback", "dim_date", "dim_park", "dim_customer"],
    "fact_weather_observation": ["silver_weather", "dim_date", "dim_park", "dim_weather"],
}

_UUID = f"RLIKE '{UUID_PATTERN}'"


#: Parks of the driver data: the regions, by key and code.
DRIVER_PARKS = [(0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"), (4, "MIDDLE EAST")]


def bronze_suite(park_codes: Sequence[str]) -> dict[str, list[Check]]:
    """The declared tests of the bronze layer (park codes as given)."""
    nn = lambda c: Check("not_null", c)
    av = lambda c, *values: Check("accepted_values", c, values=values)
    return {
        "raw_customers": [nn("source_customer_id"), nn("gender"), av("gender", "M", "F"),
                          nn("loyalty_points"), av("app_installed", "True", "False"),
                          av("email_opt_in", "Y", "N"), av("sms_opt_in", "Y", "N")],
        "raw_gate_events": [nn("source_event_id")],
        "raw_products": [nn("product_code")],
        "raw_ride_operations": [nn("source_record_id")],
        "raw_staff": [nn("source_employee_id")],
        "raw_transactions": [nn("source_transaction_id")],
        "raw_feedback": [nn("source_feedback_id")],
        "raw_weather": [nn("park_code"), av("park_code", *park_codes)],
    }


#: Mandatory foreign keys of each fact.
MANDATORY_KEYS = {
    "fact_transaction": ["date_key", "park_key", "product_key"],
    "fact_gate_event": ["date_key", "park_key", "gate_key"],
    "fact_ride_operations": ["date_key", "park_key", "ride_key"],
    "fact_weather_observation": ["date_key", "park_key", "weather_key"],
    "fact_customer_feedback": ["park_key"],
}


STAFF_FACTS = {"fact_transaction": "transaction_key", "fact_ride_operations": "ride_ops_key"}


def _inactive_staff(gold: Mapping[str, DataFrame]) -> DataFrame | None:
    facts = [(f, gold[f], key, "staff_key") for f, key in STAFF_FACTS.items() if f in gold]
    return inactive_dim_rows(facts, gold["dim_staff"], "staff_key") if facts else None


#: Singular tests and their severities.
SINGULAR = {"gold_audit_reconciliation": "warn", "gold_inactive_staff_in_facts": "warn", "gold_late_arriving_dimensions": "error"}


def singular_suite(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """The singular tests as rows of the check report: facts below the
    retention floor (warn), fact rows of inactive staff (warn), mandatory keys
    that are NULL (error).  ``failures`` counts the rows that each test returns."""
    return _singular_rows(_singular_counts(reconcile(reconcile_pairs(silver, gold), failing_only=True), gold, _inactive_staff(gold)))


def _singular_counts(unreconciled: DataFrame, gold: Mapping[str, DataFrame], inactive: DataFrame | None) -> DataFrame:
    """Rows that each singular test returns for the facts in ``gold``."""
    tests = {"gold_audit_reconciliation": unreconciled, "gold_inactive_staff_in_facts": inactive,
             "gold_late_arriving_dimensions": null_fk_report({f: (gold[f], cols) for f, cols in MANDATORY_KEYS.items() if f in gold})}
    out = None
    for name, rows in tests.items():
        if rows is not None:
            one = rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
            out = one if out is None else out.unionByName(one)
    return out


def _singular_rows(counts: DataFrame) -> DataFrame:
    """The report's rows from counts, which add up over facts."""
    severity = F.when(F.col("test").isin([t for t, s in SINGULAR.items() if s == "warn"]), F.lit("warn")).otherwise(F.lit("error"))
    return (counts.groupBy("test").agg(F.sum("failures").alias("failures"))
            .select(F.lit("singular").alias("model"), "test", "failures", severity.alias("severity"))
            .withColumn("status", F.when(F.col("failures") == 0, F.lit("PASS")).when(F.col("severity") == "warn", F.lit("WARN")).otherwise(F.lit("FAIL"))))


def gold_suite(date_min: int, date_max: int, parks: Sequence[tuple[int, str]] = DRIVER_PARKS) -> dict[str, list[Check]]:
    """The declared tests of the gold layer (date range from the calendar,
    ``parks`` as (key, code))."""
    nn = lambda c: Check("not_null", c)
    un = lambda c: Check("unique", c)
    fk = lambda c, p, pc: Check("relationships", c, parent=p, parent_column=pc)
    rng = lambda c, lo=None, hi=None: Check("accepted_range", c, min_value=lo, max_value=hi)
    uuid = lambda c: Check("expression_is_true", expression=f"{c} {_UUID}")
    return {
        "dim_date": [Check("unique_combination", columns=("date_key", "full_date")),
                     Check("expression_is_true",
                           expression="date_iso RLIKE '^[0-9]{2}/[0-9]{2}/[0-9]{4}$'"),
                     un("date_key"), nn("date_key"), rng("date_key", date_min, date_max),
                     un("full_date"), nn("full_date"), un("date_iso"), nn("date_iso"),
                     nn("is_weekend"), Check("accepted_values", "is_weekend", values=(True, False))],
        "dim_park": [un("park_key"), nn("park_key"),
                     Check("accepted_values", "park_key", values=tuple(k for k, _ in parks)),
                     un("park_code"), nn("park_code"),
                     Check("accepted_values", "park_code", values=tuple(c for _, c in parks)),
                     Check("row_count", expected=len(parks))],
        "dim_customer": [uuid("customer_key"), Check("at_least_one", "customer_key"),
                         un("customer_key"), nn("customer_key"), un("source_customer_id"),
                         nn("source_customer_id")],
        "dim_product": [uuid("product_key"), Check("at_least_one", "product_key"),
                        un("product_key"), nn("product_key"), un("product_code"),
                        nn("product_code"), nn("list_price"), rng("list_price", 0)],
        "dim_staff": [uuid("staff_key"), Check("at_least_one", "staff_key"), un("staff_key"),
                      nn("staff_key"), un("source_employee_id"), nn("source_employee_id"),
                      Check("accepted_values", "staff_status", values=("ACTIVE", "INACTIVE"))],
        "dim_ride": [uuid("ride_key"), un("ride_key"), nn("ride_key"), un("ride_code"),
                     nn("ride_code"), nn("park_key"), fk("park_key", "dim_park", "park_key")],
        "dim_gate": [uuid("gate_key"), Check("unique_combination", columns=("gate_id", "park_key")),
                     un("gate_key"), nn("gate_key"), nn("gate_id"), nn("park_key"),
                     fk("park_key", "dim_park", "park_key")],
        "dim_weather": [uuid("weather_key"), un("weather_key"), nn("weather_key"),
                        un("weather_code"), nn("weather_code")],
        "fact_transaction": [Check("unique_combination", columns=("source_transaction_id",)),
                             un("transaction_key"), nn("transaction_key"), nn("date_key"),
                             fk("date_key", "dim_date", "date_key"),
                             rng("date_key", date_min, date_max), nn("park_key"),
                             fk("park_key", "dim_park", "park_key"), nn("product_key"),
                             fk("product_key", "dim_product", "product_key"),
                             fk("customer_key", "dim_customer", "customer_key"),
                             fk("staff_key", "dim_staff", "staff_key"), nn("quantity"),
                             nn("total_charged")],
        "fact_gate_event": [Check("unique_combination", columns=("source_event_id",)),
                            un("gate_event_key"), nn("gate_event_key"), nn("date_key"),
                            fk("date_key", "dim_date", "date_key"), nn("park_key"),
                            fk("park_key", "dim_park", "park_key"), nn("gate_key"),
                            fk("gate_key", "dim_gate", "gate_key"),
                            fk("customer_key", "dim_customer", "customer_key"),
                            nn("event_count"), Check("accepted_values", "event_count", values=(1,))],
        "fact_ride_operations": [Check("unique_combination", columns=("source_record_id",)),
                                 un("ride_ops_key"), nn("ride_ops_key"), nn("date_key"),
                                 fk("date_key", "dim_date", "date_key"), nn("park_key"),
                                 fk("park_key", "dim_park", "park_key"), nn("ride_key"),
                                 fk("ride_key", "dim_ride", "ride_key"),
                                 fk("staff_key", "dim_staff", "staff_key"),
                                 nn("operational_status")],
        "fact_customer_feedback": [un("feedback_key"), nn("feedback_key"), nn("park_key"),
                                   fk("park_key", "dim_park", "park_key"),
                                   fk("date_key", "dim_date", "date_key"),
                                   fk("customer_key", "dim_customer", "customer_key"),
                                   rng("overall_score", 0, 10), rng("nps_raw", 0, 10)],
        "fact_weather_observation": [un("weather_obs_key"), nn("weather_obs_key"),
                                     nn("date_key"), fk("date_key", "dim_date", "date_key"),
                                     nn("park_key"), fk("park_key", "dim_park", "park_key"),
                                     nn("weather_key"),
                                     fk("weather_key", "dim_weather", "weather_key"),
                                     rng("temperature_c", -20, 65)],
    }


def _gold_checks() -> dict[str, list[Check]]:
    return gold_suite(*(int(x.replace("-", "")) for x in D.CALENDAR))


def _fact_suite(w: Warehouse, fact: str) -> DataFrame:
    """The declared tests of one fact."""
    dims = {c.parent for c in _gold_checks()[fact] if c.parent}
    return run_suite({n: w.gold(n) for n in (fact, *dims)}, {fact: _gold_checks()[fact]})


def _dim_suite(w: Warehouse) -> DataFrame:
    """The declared tests of all dimensions."""
    return run_suite({n: w.gold(n) for n in GOLD_DIMS}, {n: _gold_checks()[n] for n in GOLD_DIMS})


def run_gold_suite(w: Warehouse) -> DataFrame:
    """The declared gold tests; facts are written, tested and deleted one after the other."""
    facts = w.each_fact(lambda fact: _fact_suite(w, fact))
    return reduce(DataFrame.unionByName, facts, _dim_suite(w))


#: Rows of a silver table that its fact takes.
FACT_ROWS = {
    "silver_transactions": "transaction_date IS NOT NULL",
    "silver_gate_events": "event_date IS NOT NULL",
    "silver_ride_opeartions": "poll_date IS NOT NULL",
    "silver_weather": "weather_date IS NOT NULL AND weather_code IS NOT NULL",
}


def observed_reconciliation(w: Warehouse, failing_only: bool = False) -> DataFrame:
    """``reconciliation`` of a materialised warehouse from the counts taken while it was written."""
    return _observed(w, GOLD_FACTS, failing_only)


def _observed(w: Warehouse, facts: Sequence[str], failing_only: bool) -> DataFrame:
    counts = [(g, w.counts[g]["rows"], w.counts[s]["taken"]) for g, s in zip(GOLD_FACTS, FACT_SILVER) if g in facts]
    return reconcile_counts(w.spark, counts, failing_only=failing_only)


def reconcile_pairs(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> list[ReconcilePair]:
    """Facts and the silver rows that they are loaded from."""
    return [ReconcilePair(g, gold[g], silver[s], F.expr(FACT_ROWS[s]) if s in FACT_ROWS else None) for g, s in zip(GOLD_FACTS, FACT_SILVER)]


FACT_SILVER = ["silver_transactions", "silver_gate_events", "silver_ride_opeartions",
               "silver_feedback", "silver_weather"]


def reconciliation(w: Warehouse, failing_only: bool = False) -> DataFrame:
    return reconcile(reconcile_pairs({n: w.silver(n) for n in FACT_SILVER}, {n: w.gold(n) for n in GOLD_FACTS}),
                     failing_only=failing_only)


def run_all_checks(w: Warehouse) -> DataFrame:
    """Bronze, gold and singular tests over one warehouse of the driver data; facts are
    written, tested and deleted one after the other, and reconciled by the counts observed then."""
    suite = bronze_suite([c for _, c in DRIVER_PARKS])
    bronze = [settle(run_suite({n: w.bronze(n)}, {n: suite[n]}), "report") for n in suite]

    counts = []

    def use(fact: str) -> DataFrame:
        gold = {fact: w.gold(fact), "dim_staff": w.gold("dim_staff")}
        counts.append(settle(_singular_counts(_observed(w, [fact], True), gold, _inactive_staff(gold)), "report"))
        return _fact_suite(w, fact)

    facts = w.each_fact(use)
    return reduce(DataFrame.unionByName, [*bronze, *facts, _dim_suite(w), _singular_rows(reduce(DataFrame.unionByName, counts))])
