"""Raw batches to Gold: store, validate, clean, validate, aggregate.

Each layer is a versioned table, and each step is one Spark job over all the
requested batches. A batch that fails validation goes no further; the others
are not held up by it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators import gold, quality
from tierwise.operators.bronze import audit_trips, audit_weather
from tierwise.operators.dimension import trips_with_zones
from tierwise.operators.rules import Rule, observed, trip_rules, weather_rules
from tierwise.operators.silver import silver_trips, silver_weather, stage_trips, stage_weather
from tierwise.operators.versions import Batch, VersionedTable
from tierwise.session import configure, fresh_dir

GoldBuilder = Callable[[DataFrame], dict[str, DataFrame]]


@dataclass(frozen=True)
class Domain:
    """What differs between trips and station days."""

    name: str
    batch: tuple[str, ...]
    audit: Callable[[DataFrame], DataFrame]
    clean: Callable[[DataFrame], DataFrame]
    rules: Sequence[Rule]
    bronze_suite: Sequence[quality.Check]
    silver_suite: Sequence[quality.Check]


def trip_domain(
    bronze_rows: tuple[int, int] = quality.TRIP_BRONZE_ROWS,
    silver_rows: tuple[int, int] = quality.TRIP_SILVER_ROWS,
) -> Domain:
    return Domain(
        "taxi",
        quality.MONTHLY,
        audit_trips,
        silver_trips,
        trip_rules(),
        quality.trip_bronze_suite(bronze_rows),
        quality.trip_silver_suite(silver_rows),
    )


def weather_domain(
    bronze_rows: tuple[int, int] = quality.WEATHER_BRONZE_ROWS,
    silver_rows: tuple[int, int] = quality.WEATHER_SILVER_ROWS,
) -> Domain:
    return Domain(
        "weather",
        quality.YEARLY,
        audit_weather,
        silver_weather,
        weather_rules(),
        quality.weather_bronze_suite(bronze_rows),
        quality.weather_silver_suite(silver_rows),
    )


class Medallion:
    """The tables of one domain below a root folder."""

    def __init__(self, spark: SparkSession, root: str, domain: Domain):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.domain = domain
        self.bronze = self._table("bronze")
        self.silver = self._table("silver")
        # Totals of what cleaning has read, kept and dropped, a row per step.
        self._cleaned: list[dict[str, int]] = []

    def _table(self, layer: str, model: str = "") -> VersionedTable:
        return VersionedTable(
            self.spark, "/".join(p for p in (self.root, layer, self.domain.name, model) if p)
        )

    def gold(self, model: str) -> VersionedTable:
        return self._table("gold", model)

    @property
    def report_path(self) -> str:
        return f"{self.root}/reports"

    # --- steps -----------------------------------------------------------

    def ingest(self, raw: DataFrame, batches: Sequence[Batch] | None = None) -> list[Batch]:
        """Store raw batches, by default those that the rows are in; returns those that had any rows."""
        if batches is None:
            version = self.bronze.commit(self.domain.audit(raw), replace_by=self.domain.batch)
            return [] if version is None else self.bronze.replaced(version)
        self._replace(self.bronze, self.domain.audit(raw), batches)
        return self._present(self.bronze, batches)

    def validate(
        self, layer: str, batches: Sequence[Batch], requested: Sequence[Batch] = ()
    ) -> list[Batch]:
        """Run a layer's suite over the batches and keep the report; returns
        the batches that passed. A requested batch without rows is reported,
        and fails by its row count."""
        table, suite = (
            (self.bronze, self.domain.bronze_suite)
            if layer == "bronze"
            else (self.silver, self.domain.silver_suite)
        )
        keys = self.domain.batch
        wanted = self._batch_rows({*batches, *requested})
        report = quality.evaluate(
            self._rows(table, batches), suite, keys, self.domain.name, layer, requested=wanted
        )
        quality.write_report(report, self.report_path)
        stored = quality.read_report(self.spark, self.report_path).where(
            (F.col("domain") == self.domain.name) & (F.col("layer") == layer)
        )
        labels = wanted.selectExpr(f"{quality.batch_label(keys)} AS batch", *keys)
        passed = quality.verdicts(stored).where("success").join(labels, "batch")
        return sorted(
            (r.source_year, r.source_month if "source_month" in keys else None)
            for r in passed.select(*keys).collect()
        )

    def clean(self, batches: Sequence[Batch]) -> None:
        """Clean batches into Silver. What is dropped is counted while it is written."""
        rows, seen = observed(self._rows(self.bronze, batches), self.domain.rules)
        self._replace(self.silver, self.domain.clean(rows), batches, laid_out=True)
        self._cleaned.append(seen.get)

    def aggregate(self, batches: Sequence[Batch], build: GoldBuilder) -> None:
        """Write the Gold models. They are separate tables, so their jobs run
        side by side and fill the cluster between them."""

        def write(model: str, df: DataFrame) -> None:
            order = [k for k in gold.ORDER[model] if not k.startswith("-")]
            self._replace(self.gold(model), df, batches, sort=order)

        models = build(self._rows(self.silver, batches))
        with ThreadPoolExecutor(max_workers=len(models)) as pool:
            for done in [pool.submit(write, *model) for model in models.items()]:
                done.result()

    def run(self, raw: DataFrame, batches: Sequence[Batch] | None, build: GoldBuilder) -> DataFrame:
        """All steps for the batches, or those that the rows are in, each as far as
        it gets; returns `summary`."""
        landed = self.ingest(raw, batches)
        passed = self.validate("bronze", landed, requested=batches or ()) if landed else []
        if passed:
            self.clean(passed)
            kept = self._present(self.silver, passed)
            passed = self.validate("silver", kept, requested=passed) if kept else []
        if passed:
            self.aggregate(passed, build)
        return self.summary()

    # --- results ---------------------------------------------------------

    def models(self) -> tuple[str, ...]:
        return tuple(gold.TRIP_MODELS if self.domain.name == "taxi" else gold.WEATHER_MODELS)

    def summary(self) -> DataFrame:
        """Live rows and batches of every table of the domain."""
        tables = {"bronze": self.bronze, "silver": self.silver}
        tables |= {f"gold_{m}": self.gold(m) for m in self.models()}
        parts = [
            t.lifetimes()
            .where("to_version IS NULL")
            .agg(F.count("*").alias("partitions"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
            .select(F.lit(self.domain.name).alias("domain"), F.lit(name).alias("table"), "partitions", "rows")
            for name, t in tables.items()
        ]
        result = parts[0]
        for part in parts[1:]:
            result = result.unionAll(part)
        return result

    def drops(self) -> DataFrame:
        """Rows read, kept, dropped and failing each rule, for every cleaning step of this run."""
        names = ["rows_read", "rows_kept", "rows_dropped", *(f"failed_{r.name}" for r in self.domain.rules)]
        rows = [(self.domain.name, step, *(seen[n] for n in names)) for step, seen in enumerate(self._cleaned)]
        fields = ", ".join(["domain STRING", "step INT", *(f"{n} BIGINT" for n in names)])
        return self.spark.createDataFrame(rows, fields)

    # --- helpers ---------------------------------------------------------

    def _replace(self, table, df, batches, sort=(), laid_out=False) -> None:
        table.commit(df, replace=batches, sort=sort, laid_out=laid_out)

    def _batch_rows(self, batches) -> DataFrame:
        rows = [(y, m)[: len(self.domain.batch)] for y, m in sorted(batches, key=str)]
        types = ("source_year SMALLINT", "source_month TINYINT")[: len(self.domain.batch)]
        return self.spark.createDataFrame(rows, ", ".join(types))

    def _present(self, table: VersionedTable, batches: Sequence[Batch]) -> list[Batch]:
        """Those batches that have live rows, from the commits table."""
        live = table.lifetimes().where("to_version IS NULL")
        monthly = "source_month" in self.domain.batch
        found = {
            (r.source_year, r.source_month if monthly else None)
            for r in live.select("source_year", "source_month").distinct().collect()
        }
        return [b for b in batches if b in found]

    def _rows(self, table: VersionedTable, batches: Sequence[Batch]) -> DataFrame:
        """A table's live rows in the batches, as a partition filter."""
        by_year: dict[int, list[int | None]] = {}
        for year, month in batches:
            by_year.setdefault(year, []).append(month)
        wanted = []
        for year, months in by_year.items():
            in_months = "" if None in months else f" AND source_month IN ({', '.join(map(str, months))})"
            wanted.append(f"(source_year = {year}{in_months})")
        return table.read().where(" OR ".join(wanted))


def trip_gold(spark: SparkSession, zones: DataFrame) -> GoldBuilder:
    """The five trip models. They are aggregated together in one pass, kept in
    a working table, and written out one by one from there."""

    def build(silver: DataFrame) -> dict[str, DataFrame]:
        zoned = trips_with_zones(stage_trips(silver), zones)
        work = fresh_dir(spark, "gold-work")
        gold.trip_models_in_one_pass(zoned).write.partitionBy("model").parquet(work)
        combined = spark.read.parquet(work)
        return {name: gold.pick_trip_model(combined, name) for name in gold.TRIP_MODELS}

    return build


def weather_gold(silver: DataFrame) -> dict[str, DataFrame]:
    staged = stage_weather(silver)
    return {name: build(staged) for name, build in gold.WEATHER_MODELS.items()}


def batches_of(df: DataFrame, keys: Sequence[str]) -> list[Batch]:
    """The batches present in raw rows: one entry per month or year."""
    found = df.select(*keys).distinct().collect()
    return sorted((r[0], r[1] if len(keys) > 1 else None) for r in found)


def run_trips(
    spark: SparkSession, raw: DataFrame, zones: DataFrame, root: str, domain: Domain | None = None
) -> Medallion:
    flow = Medallion(spark, root, domain or trip_domain())
    flow.run(raw, None, trip_gold(spark, zones))
    return flow


def run_weather(
    spark: SparkSession, raw: DataFrame, root: str, domain: Domain | None = None
) -> Medallion:
    flow = Medallion(spark, root, domain or weather_domain())
    flow.run(raw, None, weather_gold)
    return flow
