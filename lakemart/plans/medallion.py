"""Bronze, silver and gold as separate steps that hand over written tables; no step calls the one before it.

Zones of a lake: ``bronze`` holds the clean raw rows, ``silver`` the entities, ``gold`` the marts, ``stream`` the landed
topics, ``observability`` rejects, issues, counts and checks. Zone tables are versioned, so a reader sees a step's
result before or after a rerun and nothing in between. What people download lies as CSV below ``exports``.
Intermediate tables lie in the session's work folder until ``Run.close``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.contracts import (
    Validation,
    contract_summary,
    union_rejected,
    validate_all,
)
from lakemart.plans import marts, quality, silver
from lakemart.sources import lake
from lakemart.sources.model import CONTRACTS, TABLES, TableContract, raw_schema
from lakemart.sources.versions import PublishedSpace
from lakemart.streaming.landing import Landing


@dataclass(frozen=True)
class Run:
    """Where one run of the lake lives and how it is labelled."""

    spark: SparkSession
    root: str
    profile: str
    run_date: str
    _spaces: list[lake.Workspace] = field(default_factory=list, compare=False, repr=False)

    @property
    def partition(self) -> str:
        return f"run_date={self.run_date}"

    def zone(self, name: str) -> str:
        return f"{self.root}/lake/{name}/profile={self.profile}/{self.partition}"

    def path(self, zone: str, table: str) -> str:
        return f"{self.zone(zone)}/{table}"

    def store(self, zone: str) -> PublishedSpace:
        """The tables of a zone; a step that runs again publishes new versions, and the ones before stay readable."""
        return PublishedSpace(self.spark, self.zone(zone))

    def read(self, zone: str, table: str, version: int | None = None) -> DataFrame:
        return self.store(zone).table(table).read(version)

    def write(self, frame: DataFrame, zone: str, table: str) -> DataFrame:
        return self.store(zone).save(frame, table)

    def workspace(self) -> lake.Workspace:
        space = lake.Workspace(self.spark)
        self._spaces.append(space)
        return space

    def close(self) -> None:
        """Delete the intermediate tables of this run; what the steps returned before silver can no longer be read."""
        while self._spaces:
            self._spaces.pop().close()

    def export(self, frame: DataFrame, name: str) -> None:
        """Whole tables go out as text, so the parts of an export are compressed; ``read_export`` reads them as they are."""
        lake.write_csv(frame, f"{self.root}/exports/{name}.csv", codec="gzip")

    def observe(self, frame: DataFrame, name: str) -> DataFrame:
        """Write an observability table and its CSV export; returns the written table."""
        written = self.write(frame, "observability", name)
        self.export(written, name)
        return written

    def landing(self, topic: str = "commerce.events", table: str = "web_events") -> Landing:
        """The landing of a topic, which goes on from run to run of the profile."""
        return Landing(self.spark, f"{self.root}/lake/stream/profile={self.profile}/{table}", self.profile, topic)


def latest_run(spark: SparkSession, root: str, zone: str, profile: str) -> Run:
    """The newest run of a profile that has reached ``zone``."""
    folder = lake.latest_folder(spark, f"{root}/lake/{zone}/profile={profile}")
    return Run(spark, root, profile, folder.rsplit("run_date=", 1)[1])


def read_export(run: Run, mart: str) -> DataFrame:
    """The CSV export of a mart as text columns; empty when there is none."""
    return lake.read_csv_or_empty(run.spark, f"{run.root}/exports/{mart}.csv")


def land_raw(run: Run, batch_dir: str) -> tuple[dict[str, DataFrame], dict[str, Sequence[str]]]:
    """Raw files as text tables with a fixed file position, which serves as the row order."""
    raw = {}
    for table in TABLES:
        if table == "web_events":
            rows = lake.read_jsonl(run.spark, f"{batch_dir}/{table}.jsonl", raw_schema(table))
        else:
            rows = lake.read_csv(run.spark, f"{batch_dir}/{table}.csv")
        raw[table] = lake.with_position(rows)
    return run.workspace().save_all(raw), dict.fromkeys(raw, lake.POSITION)


def land_stream(run: Run, events: DataFrame, max_events: int | None = None) -> Landing:
    """Consume what is new in a topic, at most ``max_events``, and record its freshness."""
    landing = run.landing()
    landing.consume(events, max_events)
    run.observe(landing.freshness(), "streaming_freshness")
    return landing


def bronze(
    run: Run,
    raw: Mapping[str, DataFrame],
    row_order: Mapping[str, Sequence[str]],
    contracts: Mapping[str, TableContract] = CONTRACTS,
) -> dict[str, Validation]:
    """Validate every table; clean rows go to the bronze zone, rejects, issues and counts to observability.

    Each table is validated once into a work table with a clean and a rejected partition, which keeps the row order for
    silver. Key sets are deleted on return.
    """
    tagged = {table: lake.ingest_metadata(frame, run.profile, run.run_date) for table, frame in raw.items()}
    keys = lake.Workspace(run.spark)
    results = validate_all(tagged, contracts, row_order, keys, run.workspace())
    keys.close()
    run.store("bronze").save_all({table: result.clean().drop(*lake.POSITION) for table, result in results.items()})
    found = list(results.values())
    run.observe(union_rejected(found).drop(*lake.POSITION, *silver.METADATA), "rejected_rows")
    run.observe(issue_log(found, raw), "contract_issues")
    run.observe(summary(run, found), "contract_summary")
    return results


def summary(run: Run, results: Sequence[Validation]) -> DataFrame:
    labels = [F.lit(run.profile).alias("profile"), F.lit(run.partition).alias("run_partition")]
    return contract_summary(results).select(*labels, "*")


def issue_log(results: Sequence[Validation], raw: Mapping[str, DataFrame]) -> DataFrame:
    """All issues in one table, with the zero-based row number in the source file where the position is known."""
    logs = []
    for result in results:
        if set(lake.POSITION) <= set(result.annotated.columns):
            log = lake.row_numbers(result.issues(*lake.POSITION), raw[result.table])
        else:
            log = result.issues().withColumn("row_number", F.lit(None).cast("bigint"))
        logs.append(log.select("table_name", "column_name", "issue_type", "row_number", "value"))
    return reduce(DataFrame.unionByName, logs)


def build_silver(
    run: Run,
    results: Mapping[str, Validation],
    row_order: Mapping[str, Sequence[str]],
    stream: DataFrame | None = None,
    late_before: str = silver.LATE_BEFORE,
) -> dict[str, DataFrame]:
    """Silver from validated tables; keys that their contract made unique are not deduplicated again."""
    clean = {table: result.clean() for table, result in results.items()}
    unique = {table: result.unique for table, result in results.items()}
    built = silver.build_all(clean, row_order, stream, late_before, unique, run.profile)
    written = run.store("silver").save_all({table: frame.drop(*lake.POSITION) for table, frame in built.items()})
    counts = lake.manifest(written, run.profile, run.partition, "table_name", "silver_rows")
    run.observe(counts, "silver_manifest")
    return written


def build_gold(run: Run, entities: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts; each is written once, and later marts, exports and counts read the written table."""
    gold = marts.build_all(entities, run.profile, run.partition, run.store("gold"))
    for name, frame in gold.items():
        run.export(marts.ordered(frame, name), name)
    counts = lake.manifest(gold, run.profile, run.partition, "mart_name", "row_count")
    run.observe(counts, "gold_manifest")
    return gold


def evaluate(run: Run, gold: Mapping[str, DataFrame], rules: quality.Rules = quality.Rules()) -> dict[str, DataFrame]:
    """Quality checks and scorecard over the tables that the steps before have written."""

    def observed(name: str) -> DataFrame:
        return run.read("observability", name)

    absent = set(missing_outputs(run, rules.required_outputs))
    present = [name for name in rules.required_outputs if name not in absent]
    results = quality.checks(
        observed("contract_summary"),
        observed("gold_manifest"),
        gold["mart_revenue_daily"],
        gold["mart_funnel_conversion"],
        gold["mart_fulfillment_sla"],
        present,
        rules,
    )
    written = run.observe(results, "quality_checks")
    card = run.observe(quality.scorecard(written), "platform_scorecard")
    return {"quality_checks": written, "platform_scorecard": card, "failed_checks": quality.failed(written)}


def missing_outputs(run: Run, names: Sequence[str]) -> list[str]:
    """Those of the named exports that the lake does not hold (a look-up of names, no file is opened)."""
    return [name for name in names if not lake.path_exists(run.spark, f"{run.root}/exports/{name}")]


def require_outputs(run: Run, names: Sequence[str] = (*quality.Rules().required_outputs, "platform_scorecard.csv")) -> None:
    """Raise if a finished run lacks one of its exports."""
    absent = missing_outputs(run, names)
    if absent:
        raise FileNotFoundError(f"missing exports: {', '.join(absent)}")
