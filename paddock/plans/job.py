"""Stages of a run: cleaning, joins, production, reports. Parquet lies between the stages.

Every table is written by one step. Its rules are measured in the pass that writes it, and a mark of what it was built from is
left behind when it is done, so that a run that broke can go on at the first step that is not (`resume`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.operators.checks import Finding, Rule, RowsKept, Watch, as_table
from paddock.operators.summaries import count_violations, inventory
from paddock.plans import clean, dashboards, gates, hypotheses, joined
from paddock.plans.joined import Options
from paddock.session import configure
from paddock.sources.marks import Marks, digest, fingerprint
from paddock.sources.schemas import RAW_ENCODINGS
from paddock.sources.tables import exists, load_all, load_parquet, load_raw, replace_partitions, save_csv, save_parquet

JOINED = [
    "J1_master_race_results", "J2_driver_alpha", "J3_qualifying_analysis", "J4_championship_progression",
    "J5_pit_strategy", "J6_lap_by_lap", "J7_reliability_dnf", "J8_constructor_reliability",
]


# Tables at race-entry or lap grain are stored by season; the others are small beside them.
BY_YEAR = {
    "J1_master_race_results", "J3_qualifying_analysis", "J4_championship_progression", "J6_lap_by_lap",
    "J7_reliability_dnf", "MASTER_tableau_ready", "MASTER_wide",
}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; the partition column, which comes last in the files, keeps that place."""
    return spark.read.parquet(path)


@dataclass
class Folder:
    """Where the steps of a stage write. `source` says what the stage starts from; steps that are done on it are not repeated."""

    spark: SparkSession
    path: str
    source: str = ""
    resume: bool = False
    findings: list[Finding] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")
        self.marks = Marks(self.spark, self.path)

    def step(
        self, name: str, build: Callable[[], DataFrame | RowsKept], rules: Callable[[DataFrame], Sequence[Rule]] | None = None,
        required: Sequence[str] = (), after: Callable[[], Sequence[Finding]] | None = None,
    ) -> DataFrame:
        """Write a table and read it back, so that later tables start from stored rows, not from the whole lineage.

        A join that must keep its rows comes as `RowsKept`; if it does not, the step fails and leaves no mark.
        """
        path = f"{self.path}/{name}"
        notes = self.marks.read(name, self.source) if self.resume else None
        if notes is not None and exists(self.spark, path):
            self.findings += [Finding(*n) for n in notes]
            return _read(self.spark, path)
        self.marks.clear(name)
        made = build()
        kept = made if isinstance(made, RowsKept) else None
        df = kept.df if kept else made
        watch = Watch(name, df, list(rules(df)) if rules else [], required)
        save_parquet(watch.df, path, "year" if name in BY_YEAR else None)
        if kept:
            kept.require()
        found = [*watch.findings(), *(after() if after else [])]
        self.findings += found
        self.marks.write(name, self.source, [[f.table_name, f.rule, f.found, f.low, f.high] for f in found])
        return _read(self.spark, path).select(*df.columns)


@dataclass
class Outcome:
    """What a run has made: row and column counts of its tables, and what their rules measured."""

    inventory: DataFrame
    findings: list[Finding]
    spark: SparkSession

    @property
    def broken(self) -> list[Finding]:
        return [f for f in self.findings if f.broken]

    def as_table(self) -> DataFrame:
        return as_table(self.spark, self.findings)


def run_clean(
    spark: SparkSession, raw_dir: str, out_dir: str, encodings: Mapping[str, str] = RAW_ENCODINGS, partial: bool = False,
    resume: bool = False, findings: list[Finding] | None = None,
) -> dict[str, DataFrame]:
    """Clean all raw files into Parquet folders named after the tables, which `run` reads.

    What the rules on raw and cleaned tables measure is added to `findings`.
    """
    raw = load_raw(spark, raw_dir, clean.CLEANERS, encodings=encodings, partial=partial)
    out = Folder(spark, out_dir, digest("clean", fingerprint(spark, raw_dir), sorted(encodings.items())), resume,
                 [] if findings is None else findings)

    def cleaned(name: str, df: DataFrame) -> DataFrame:
        before: list[Watch] = []

        def build() -> DataFrame:
            rules = gates.raw_rules(name)
            if not rules:
                return clean.CLEANERS[name](df)
            before.append(Watch(f"raw {name}", df, rules))
            return clean.CLEANERS[name](before[0].df)

        return out.step(name, build, lambda _: gates.cleaned_rules(name), after=lambda: [f for w in before for f in w.findings()])

    return {name: cleaned(name, df) for name, df in raw.items()}


def probe(cleaned: dict[str, DataFrame]) -> DataFrame:
    """table_name, rule, violations of every rule on the cleaned tables that are there."""
    rules = {
        "circuits": clean.circuit_probes(), "lap_times": clean.lap_probes(),
        "driver_standings": clean.standings_probes(), "constructor_standings": clean.standings_probes(),
    }
    found = [count_violations(cleaned[n], r).withColumn("table_name", F.lit(n)) for n, r in rules.items() if n in cleaned]
    if not found:
        raise ValueError("none of the tables has a rule")
    return reduce(DataFrame.unionByName, found).select("table_name", "rule", "violations")


def run_joins(
    tables: dict[str, DataFrame], out_dir: str, options: Options = Options(), *, source: str = "", resume: bool = False,
    findings: list[Finding] | None = None,
) -> dict[str, DataFrame]:
    """The joined tables, each written as soon as it is built; J1 and J7 feed others from storage."""
    t = joined.enrich(tables, options)
    spark = t["results"].sparkSession
    out = Folder(spark, out_dir, digest("joins", source, options), resume and bool(source), [] if findings is None else findings)

    def results_with(left: DataFrame) -> DataFrame:
        return joined.master_results(t | {"results": left})

    j1 = out.step(JOINED[0], lambda: RowsKept(JOINED[0], t["results"], results_with))
    j7 = out.step(JOINED[6], lambda: RowsKept(JOINED[6], j1, lambda left: joined.reliability_entries(left, options)))
    rest = {
        JOINED[1]: lambda: joined.driver_alpha(j1),
        JOINED[2]: lambda: joined.qualifying_analysis(t),
        JOINED[3]: lambda: joined.championship(j1),
        JOINED[4]: lambda: joined.pit_strategy(t),
        JOINED[5]: lambda: joined.lap_by_lap(t, options),
        JOINED[7]: lambda: joined.constructor_reliability(j7),
    }
    made = {JOINED[0]: j1, JOINED[6]: j7} | {n: out.step(n, build) for n, build in rest.items()}
    return {n: made[n] for n in JOINED}


def refresh_season(tables: dict[str, DataFrame], out_dir: str, year: int, options: Options = Options()) -> None:
    """Rebuild one season of the stored joined tables from the cleaned ones.

    The season's partitions of the tables kept by season are replaced and no other file of them is touched. The tables
    that look across seasons (career, stops, teams) are small and written anew.
    """
    races = tables["races"].where(F.col("year") == year)
    ids = races.select("raceId").distinct()
    of_season = {"results", "qualifying", "lap_times", "pit_stops"}
    part = {n: df.join(ids, "raceId", "left_semi") if n in of_season else df for n, df in tables.items()} | {"races": races}
    t = joined.enrich(part, options)
    spark, folder = races.sparkSession, out_dir.rstrip("/")

    def replaced(name: str, df: DataFrame) -> DataFrame:
        replace_partitions(df.where(F.col("year") == year), f"{folder}/{name}", "year")
        return _read(spark, f"{folder}/{name}")

    season = replaced(JOINED[0], joined.master_results(t)).where(F.col("year") == year)
    replaced(JOINED[2], joined.qualifying_analysis(t))
    replaced(JOINED[3], joined.championship(season))
    replaced(JOINED[5], joined.lap_by_lap(t, options))
    j7 = replaced(JOINED[6], joined.reliability_entries(season, options))
    save_parquet(joined.driver_alpha(_read(spark, f"{folder}/{JOINED[0]}")), f"{folder}/{JOINED[1]}")
    save_parquet(joined.pit_strategy(joined.enrich(tables, options)), f"{folder}/{JOINED[4]}")
    save_parquet(joined.constructor_reliability(j7), f"{folder}/{JOINED[7]}")


def run_production(
    joins: dict[str, DataFrame], out_dir: str, options: Options = Options(), *, source: str = "", resume: bool = False,
    findings: list[Finding] | None = None,
) -> dict[str, DataFrame]:
    """The dashboard files and the flat table; required columns and mostly empty ones are among the findings."""
    spark = joins[JOINED[0]].sparkSession
    out = Folder(spark, out_dir, digest("production", source, options), resume and bool(source), [] if findings is None else findings)
    flat = {"MASTER_tableau_ready": dashboards.master}

    def build(name: str, df: DataFrame) -> DataFrame | RowsKept:
        if name not in flat:
            return df
        return RowsKept(name, joins[JOINED[0]], lambda left: flat[name](joins | {JOINED[0]: left}, options))

    return {
        n: out.step(n, lambda n=n, df=df: build(n, df), gates.output_rules, gates.required(n))
        for n, df in dashboards.build_all(joins, options).items()
    }


def run_reports(joins: dict[str, DataFrame], out_dir: str, production_dir: str | None = None, options: Options = Options()) -> None:
    """Test log, KPI tables, regressions, bins, pivot and open questions as CSV; with `production_dir` also the wide flat table."""
    folder = out_dir.rstrip("/")
    for name, df in hypotheses.build_all(joins).items():
        save_csv(df, f"{folder}/{name}", single_file=name != "KPI_driver_career")
    if production_dir:
        wide = RowsKept("MASTER_wide", joins[JOINED[0]], lambda left: dashboards.wide_master(joins | {JOINED[0]: left}, options))
        save_parquet(wide.df, f"{production_dir.rstrip('/')}/MASTER_wide", "year")
        wide.require()


def run(
    spark: SparkSession, stage: str, input_dir: str, joins_dir: str, production_dir: str,
    reports_dir: str | None = None, options: Options = Options(), raw_dir: str | None = None,
    encodings: Mapping[str, str] = RAW_ENCODINGS, resume: bool = False,
) -> DataFrame:
    """Run `all`, `joins` or `production`; production alone starts from stored joins. Returns the inventory, with the rules that
    each table breaks. See `run_checked`.
    """
    done = run_checked(spark, stage, input_dir, joins_dir, production_dir, reports_dir, options, raw_dir, encodings, resume)
    found = as_table(spark, done.findings).where("broken").groupBy("table_name").agg(F.array_sort(F.collect_list("rule")).alias("broken_rules"))
    return done.inventory.join(F.broadcast(found), "table_name", "left").withColumn(  # a few rows
        "broken_rules", F.coalesce("broken_rules", F.array().cast("array<string>")))


def run_checked(
    spark: SparkSession, stage: str, input_dir: str, joins_dir: str, production_dir: str,
    reports_dir: str | None = None, options: Options = Options(), raw_dir: str | None = None,
    encodings: Mapping[str, str] = RAW_ENCODINGS, resume: bool = False,
) -> Outcome:
    """As `run`, with all findings.

    With `raw_dir` the raw files there are cleaned first, into `input_dir`. With `resume`, steps that an earlier run has
    finished on the same files and options are read back instead of repeated.
    """
    if stage not in ("all", "joins", "production"):
        raise ValueError(f"unknown stage {stage!r}")
    configure(spark)
    findings: list[Finding] = []
    if stage == "production":
        joins = load_parquet(spark, joins_dir, JOINED)
    else:
        if raw_dir:
            run_clean(spark, raw_dir, input_dir, encodings, resume=resume, findings=findings)
        joins = run_joins(load_all(spark, input_dir), joins_dir, options, source=fingerprint(spark, input_dir), resume=resume, findings=findings)
    outputs = dict(joins)
    if stage != "joins":
        outputs |= run_production(
            joins, production_dir, options, source=fingerprint(spark, joins_dir), resume=resume, findings=findings)
        if reports_dir:
            run_reports(joins, reports_dir, production_dir, options)
    return Outcome(inventory(outputs), findings, spark)
