"""Stages with declared inputs and outputs, run in the order of their tables, and taken up again after a failure.

A stage names the tables it reads and writes; who comes first follows from that. While a table is written, its rows and the
violations of its constraints are counted in the same pass (``Observation``). When all tables of a stage are whole, the stage is
recorded below ``root/_stages``; a run that died is started again under the same name and goes on with the first stage that has no
record of this run. A stage's record is emptied before its tables are replaced, so a record always means whole tables.
Stages that do not wait for each other may run side by side (``at_once``): most are too short to keep a cluster busy alone.
The driver holds names and counts only, a few for each stage.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelweave.plans.tables import Tables
from reelweave.schemas import TABLE_CONTRACTS, TABLES
from reelweave.sinks.writers import write_table
from reelweave.sources.readers import read_or_empty

RECORD = "run STRING, table STRING, rows BIGINT, violations BIGINT"
REPORT = "position INT, stage STRING, table STRING, rows BIGINT, violations BIGINT, state STRING"


class Stage(NamedTuple):
    name: str
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    build: Callable[[Tables], dict[str, DataFrame]]


def in_order(stages: Collection[Stage], given: Collection[str] = ()) -> list[Stage]:
    """The stages so that every table is written before it is read; as declared where the tables leave a choice.

    Raises for a table with two writers, for one that no stage writes and that is not ``given``, and for a cycle.
    """
    writer: dict[str, str] = {}
    for stage in stages:
        for table in stage.writes:
            if table in writer:
                raise ValueError(f"{table} is written by {writer[table]} and by {stage.name}")
            writer[table] = stage.name
    before: dict[str, set[str]] = {}
    for stage in stages:
        unknown = [t for t in stage.reads if t not in writer and t not in given]
        if unknown:
            raise ValueError(f"{stage.name} reads {unknown}, which no stage writes")
        before[stage.name] = {writer[t] for t in stage.reads if t in writer}
    sorter = TopologicalSorter(before)
    try:
        sorter.prepare()
    except CycleError as error:
        raise ValueError(f"stages wait for each other: {' -> '.join(error.args[1])}") from error
    place = {stage.name: k for k, stage in enumerate(stages)}
    by_name = {stage.name: stage for stage in stages}
    ordered, ready = [], []
    while sorter.is_active():
        ready = sorted([*ready, *sorter.get_ready()], key=place.__getitem__)
        name = ready.pop(0)
        ordered.append(by_name[name])
        sorter.done(name)
    return ordered


def dependants(stages: list[Stage], name: str) -> set[str]:
    """Names of all stages that read what the named one writes, directly or through others."""
    reached, tables = set(), {t for s in stages if s.name == name for t in s.writes}
    for stage in stages:  # in order, so one pass is enough
        if tables & set(stage.reads):
            reached.add(stage.name)
            tables |= set(stage.writes)
    return reached


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns a declared table has, in its order and types; other tables stay as they are."""
    if table not in TABLES:
        return df
    fields = df.sparkSession.createDataFrame([], TABLES[table]).schema.fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _violation_count(table: str) -> Column:
    contract = TABLE_CONTRACTS.get(table, {})
    counts = [F.count_if(F.col(c).isNull()) for c in contract.get("required", [])]
    counts += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in contract.get("allowed", {}).items()]
    return reduce(lambda a, b: a + b, counts, F.lit(0).cast("bigint")) if counts else F.max(F.lit(0)).cast("bigint")


def _repeated_ids(spark: SparkSession, path: str) -> int:
    """Rows of a written dimension beyond one per id: ids are hashes of unique natural keys, so these are collisions."""
    ids = read_or_empty(spark, path, "id BIGINT", enforce=True)
    return ids.groupBy("id").agg((F.count("*") - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0))).first()[0]


def _write(df: DataFrame, root: str, table: str, name: str, dry_run: bool) -> tuple[int, int]:
    counted = Observation(name)
    rows = conform(df, table).observe(counted, F.count(F.lit(1)).alias("rows"), _violation_count(table).alias("violations"))
    if dry_run:
        rows.write.format("noop").mode("overwrite").save()
    else:
        write_table(rows, f"{root}/{table}")
    found = counted.get
    violations = found["violations"] or 0
    if not dry_run and TABLE_CONTRACTS.get(table, {}).get("unique_id"):
        violations += _repeated_ids(df.sparkSession, f"{root}/{table}")
    return found["rows"], violations


def _record_path(root: str, stage: str) -> str:
    return f"{root}/_stages/{stage}"


def finished(spark: SparkSession, root: str, stage: Stage) -> dict[str, tuple[str, int, int]]:
    """Run, rows and violations of the stage's tables, if the stage has a record; else nothing."""
    rows = read_or_empty(spark, _record_path(root.rstrip("/"), stage.name), RECORD, enforce=True).collect()
    found = {r["table"]: (r["run"], r["rows"], r["violations"]) for r in rows}
    return found if set(stage.writes) <= found.keys() else {}


def _side_by_side(spark: SparkSession, ordered: list[Stage], at_once: int, perform: Callable[[Stage], None]) -> None:
    """Performs the stages, ``at_once`` at most at a time, each when all that write its tables are through.

    After a failure no further stage is begun; those under way are waited for, and the error of the first one is raised.
    """
    writer = {t: s.name for s in ordered for t in s.writes}
    waiting, running = list(ordered), {}
    failed: dict[str, BaseException] = {}
    with ThreadPoolExecutor(at_once) as pool:
        while running or (waiting and not failed):
            undone = {s.name for s in waiting} | {s.name for s in running.values()}
            ready = [s for s in waiting if not failed and not undone & {writer[t] for t in s.reads if t in writer}]
            for stage in ready[: at_once - len(running)]:
                waiting.remove(stage)
                run: Future = pool.submit(inheritable_thread_target(spark)(perform), stage)
                running[run] = stage
            for run in wait(running, return_when=FIRST_COMPLETED).done:
                stage = running.pop(run)
                if run.exception():
                    failed[stage.name] = run.exception()
    for stage in ordered:
        if stage.name in failed:
            raise failed[stage.name]


def run_graph(
    spark: SparkSession, stages: Collection[Stage], root: str, run: str = "run", skip: Collection[str] = (),
    dry_run: bool = False, given: Collection[str] = (), at_once: int = 1,
) -> DataFrame:
    """Runs the stages and returns (position, stage, table, rows, violations, state), one row per table.

    States: ``written``; ``finished`` for stages that a former attempt of the same run had done; ``skipped``. A stage may be
    skipped if its tables are whole from any run, or if all stages that depend on it are skipped too. A dry run computes and
    counts every stage whose input tables exist, and writes nothing. ``at_once`` stages run side by side at most.
    """
    root = root.rstrip("/")
    ordered = in_order(stages, given)
    unknown = set(skip) - {s.name for s in ordered}
    if unknown:
        raise ValueError(f"no stages {sorted(unknown)}")
    records = {s.name: finished(spark, root, s) for s in ordered}
    for stage in ordered:
        waiting = dependants(ordered, stage.name) - set(skip)
        if stage.name in skip and waiting and not records[stage.name]:
            raise ValueError(f"{stage.name} has no tables yet, which {sorted(waiting)} need")
    again, due, rows = set(), [], {}
    for stage in ordered:
        record = records[stage.name]
        if stage.name in skip:
            rows[stage.name] = [(t, None, None, "skipped") for t in stage.writes]
        elif not dry_run and stage.name not in again and record and all(r[0] == run for r in record.values()):
            rows[stage.name] = [(t, *record[t][1:], "finished") for t in stage.writes]
        else:
            again |= dependants(ordered, stage.name)
            due.append(stage)

    def perform(stage: Stage) -> None:
        if not dry_run:
            write_table(spark.createDataFrame([], RECORD), _record_path(root, stage.name))
        built = stage.build(Tables.from_parquet(spark, root))
        if set(built) != set(stage.writes):
            raise ValueError(f"{stage.name} built {sorted(built)}, not {sorted(stage.writes)}")
        counts = [(t, *_write(built[t], root, t, f"{stage.name}-{t}", dry_run)) for t in stage.writes]
        if not dry_run:
            write_table(spark.createDataFrame([(run, *c) for c in counts], RECORD), _record_path(root, stage.name))
        rows[stage.name] = [(*c, "counted" if dry_run else "written") for c in counts]

    _side_by_side(spark, due, at_once, perform)
    report = [(k, s.name, *row) for k, s in enumerate(ordered) for row in rows[s.name]]
    return spark.createDataFrame(report, REPORT)
