"""One monthly load through all layers, in a single Spark application."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import ReferencePeriod
from ledgerlake.operators.audit import audit_rows, write_audit
from ledgerlake.operators.book import BOOK, BookSpec, feature_book
from ledgerlake.operators.dedup import latest_load, restamp
from ledgerlake.operators.ingest import ingest_subject, stamp_load
from ledgerlake.operators.seen import SeenIndex
from ledgerlake.operators.stage import stage_features
from ledgerlake.operators.standardise import standardise
from ledgerlake.operators.states import StateStore
from ledgerlake.operators.windows import recency_windows
from ledgerlake.sources.landing import split_landing
from ledgerlake.sources.layers import LakePaths, newest_load, read_table, spread_by
from ledgerlake.sources.manifest import (
    committed,
    counting_rows,
    current,
    in_parts,
    remove_replaced,
    write_load,
)
from ledgerlake.sources.scratch import shuffles_removed
from ledgerlake.sources.subjects import SUBJECTS, SubjectSpec
from ledgerlake.streaming.landing import land_new_files

STEPS = ("raw", "trusted", "refined", "book")


@dataclass
class RunReport:
    """Rows written per table and the reason for every table that was not written.

    `resumed` are the tables that an earlier attempt had written.
    """

    rows: dict[str, int] = field(default_factory=dict)
    failures: dict[str, Exception] = field(default_factory=dict)
    resumed: list[str] = field(default_factory=list)


class RunFailed(RuntimeError):
    """Some tables could not be written; the others are complete."""

    def __init__(self, report: RunReport):
        self.report = report
        super().__init__(
            "; ".join(f"{table}: {error}" for table, error in report.failures.items())
        )


@dataclass(frozen=True)
class MonthlyRun:
    spark: SparkSession
    paths: LakePaths
    dt_proc: str
    as_of: date
    landing: str = "batch"
    clean: str = "off"
    on_bad_row: str = "FAILFAST"
    dedup: str = "business"
    null_keys: str = "drop"
    loads: str = "new"
    snapshots: str = "run"
    book: BookSpec = BOOK
    book_from: str = "stage"
    resume: bool = False
    replaced: str = "remove"
    subjects: tuple[SubjectSpec, ...] = tuple(SUBJECTS.values())
    report: RunReport = field(default_factory=RunReport)
    _begun: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        if self.landing == "batch" and self.clean != "off":
            raise ValueError("only landing='stream' can clean up landing files")
        if self.loads not in ("new", "own", "all"):
            raise ValueError(f"unknown choice of loads {self.loads!r}")
        if self.replaced not in ("remove", "keep"):
            raise ValueError(f"unknown choice for replaced versions {self.replaced!r}")
        if self.book_from not in ("stage", "states"):
            raise ValueError(f"unknown source of the book {self.book_from!r}")
        if self.book_from == "states" and (self.loads != "new" or self.dedup != "business"):
            raise ValueError("states are kept up to date from the rows that are new")

    def write_raw(self, spec: SubjectSpec) -> int:
        if self.landing == "stream":
            return self._land_new_files(spec)
        path, raw = self.paths.landing(spec.name), self.paths.raw(spec.name)
        if self.on_bad_row != "reject":
            df = ingest_subject(self.spark, path, spec, self.dt_proc, on_bad_row=self.on_bad_row)
            return self._replace(df, raw)
        fitting, rejected = split_landing(self.spark, path, spec)
        table = f"tb_raw_rejected_{spec.name}"
        self.report.rows[table] = self._replace(rejected, self.paths.rejected(spec.name))
        return self._replace(stamp_load(fitting, self.dt_proc), raw)

    def _land_new_files(self, spec: SubjectSpec) -> int:
        raw, rejected = self.paths.raw(spec.name), self.paths.rejected(spec.name)
        land_new_files(
            self.spark, self.paths.landing_drops(spec.name), spec, self.dt_proc, raw,
            self.paths.landing_checkpoint(spec.name), clean=self.clean,
            archive_dir=self.paths.landing_archive(spec.name) if self.clean == "archive" else None,
            on_bad_row=self.on_bad_row,
            rejected_path=rejected if self.on_bad_row == "reject" else None,
        )
        if self.on_bad_row == "reject":
            table = f"tb_raw_rejected_{spec.name}"
            self.report.rows[table] = read_table(self.spark, rejected, self.dt_proc).count()
        return read_table(self.spark, raw, self.dt_proc).count()

    def write_trusted(self, spec: SubjectSpec) -> int:
        inner = tuple(name for name in spec.partition_by if name != "dt_proc")
        if self.loads == "new" and self.dedup == "business":
            standardised = self._rows_not_seen_before(spec, inner)
        else:
            only = self.dt_proc if self.loads == "own" else None
            raw = read_table(self.spark, self.paths.raw(spec.name), only)
            if self.loads == "new":
                raw = self._loads_since(raw, self._previous_trusted(spec))
            standardised = standardise(raw, spec, self.dt_proc, self.as_of, self.dedup)
            if inner:
                standardised = spread_by(standardised, *inner)
        return self._replace(standardised, self.paths.trusted(spec.name), inner)

    def _rows_not_seen_before(self, spec: SubjectSpec, spread: tuple[str, ...]) -> list[DataFrame]:
        """Trusted rows of the raw loads since the one before, without what the index has.

        Only these loads and the index are read, neither older raw nor older trusted loads.
        The rows are spread as they landed; columns that derive from others are added behind that.
        Many rows are spread in parts, each with all rows of its directories.
        """
        index = SeenIndex(self.spark, self.paths.seen(spec.name))
        raw = read_table(self.spark, self.paths.raw(spec.name))
        raw = self._loads_since(raw, index.previous(self.dt_proc))
        taken = index.take(raw.drop("dt_proc"), self.dt_proc)
        parts = [index.rows(self.dt_proc)]
        if spread:
            place = dict(zip(spec.order, spec.trusted_columns(self.as_of)))
            places = {f"_{name}": place[name] for name in spread}
            placed = in_parts(parts[0].withColumns(places), *places, rows=taken)
            parts = [spread_by(part, *places).drop(*places) for part in placed]
        columns = [*spec.trusted_columns(self.as_of), F.lit(self.dt_proc).alias("dt_proc")]
        return [part.select(*columns) for part in parts]

    def _loads_since(self, raw: DataFrame, previous: str | None) -> DataFrame:
        """Raw loads after `previous` up to this run; a step may have a stamp of its own."""
        stamp = F.col("dt_proc").cast("bigint")
        since = raw.where(stamp <= int(self.dt_proc))
        return since if previous is None else since.where(stamp > int(previous))

    def _previous_trusted(self, spec: SubjectSpec) -> str | None:
        known = current(committed(self.spark, self.paths.trusted(spec.name)) or [])
        return max((load for load in known if int(load) < int(self.dt_proc)), key=int, default=None)

    def write_snapshot(self, spec: SubjectSpec) -> int:
        """Every row that was ever taken in, under the stamp of the run.

        With `loads="new"` these are the rows of all trusted loads, each in one of them; with "all"
        the newest trusted load has them. A row counts as of the newest load either way, so
        every row is of the newest version of its key and nothing has to be compared.
        With "own" loads the newest version of each key is looked up.
        """
        trusted = read_table(self.spark, self.paths.trusted(spec.name))
        if self.loads == "own":
            current_rows = latest_load(trusted, spec.key, null_keys=self.null_keys)
        else:
            current_rows = newest_load(trusted) if self.loads == "all" else trusted
            if self.null_keys == "drop":
                current_rows = current_rows.dropna("any", subset=[spec.key])
        restated = current_rows.withColumns(spec.restated(self.as_of))
        return self._replace(restamp(restated, self.dt_proc), self.paths.snapshot(spec.name))

    def write_stage(self) -> int:
        """The stage of many lines is made in parts, each with all lines of its invoices."""
        rows = counting_rows(self.spark, self.paths.snapshot("transactions"))
        parts = in_parts(self._snapshot(), "invoice_id", rows=rows)
        stages = [stage_features(part, self.dt_proc, self.as_of) for part in parts]
        return self._replace(stages, self.paths.stage, ("ref",))

    def _snapshot(self) -> DataFrame:
        path = self.paths.snapshot("transactions")
        if self.snapshots == "run":
            return read_table(self.spark, path, self.dt_proc)
        every = read_table(self.spark, path)
        return newest_load(every) if self.snapshots == "newest" else every

    def write_book(self) -> int:
        ref = int(ReferencePeriod.of(self.as_of).ref)
        stage = read_table(self.spark, self.paths.stage, self.dt_proc).where(F.col("ref") == ref)
        df = feature_book(recency_windows(stage, self.as_of, self.book.months), self.book)
        return self._replace(df, self.paths.book, ("ref",))

    def write_states(self) -> int:
        """Bring the states of the months up to date that the rows of this run change."""
        late = read_table(self.spark, self.paths.trusted("transactions"), self.dt_proc)
        self._states.refresh(self._snapshot(), late, self.dt_proc, self.as_of)
        return self._states.states().count()

    def write_book_of_states(self) -> int:
        return self._replace(self._states.book(self.as_of), self.paths.book, ("ref",))

    @property
    def _states(self) -> StateStore:
        return StateStore(self.spark, self.paths.states, self.book)

    def _replace(
        self, df: DataFrame | Sequence[DataFrame], path: str, partition_by: tuple[str, ...] = ()
    ) -> int:
        """Write the load of this run; what it replaced is removed when the new rows count."""
        rows = write_load(df, path, self.dt_proc, partition_by)
        if self.replaced == "remove":
            remove_replaced(self.spark, path, self.dt_proc)
        return rows

    def _done(self, table: str, path: str) -> bool:
        """Whether an attempt before has committed this load, by the log of the table."""
        load = current(committed(self.spark, path) or []).get(self.dt_proc)
        if load is None:
            return False
        self.report.rows[table] = sum(version.rows for version in load)
        self.report.resumed.append(table)
        return True

    def _attempt(self, table: str, step: Callable[[], int]) -> bool:
        try:
            self.report.rows[table] = step()
            return True
        except Exception as error:
            self.report.failures[table] = error
            return False

    def _layer(
        self, prefix: str, control: str, step: Callable[[SubjectSpec], int],
        path: Callable[[str], str], subjects: Iterable[SubjectSpec],
    ) -> list[SubjectSpec]:
        """Run one step for all subjects side by side; returns those that went through."""
        subjects = list(subjects)
        if not subjects:
            return []

        def attempt(spec: SubjectSpec) -> bool:
            table = f"{prefix}_{spec.name}"
            if self.resume and spec.name not in self._begun and self._done(table, path(spec.name)):
                return True
            # What comes after a step that had to be done is done as well.
            self._begun.add(spec.name)
            return self._attempt(table, lambda: step(spec))

        with ThreadPoolExecutor(max_workers=len(subjects)) as pool:
            done = list(pool.map(attempt, subjects))
        written = [spec for spec, ok in zip(subjects, done) if ok]
        self._audit(control, [f"{prefix}_{spec.name}" for spec in written])
        return written

    def _audit(self, control: str, tables: list[str]) -> None:
        counts = [(table, self.dt_proc, self.report.rows[table]) for table in tables]
        if counts:
            write_audit(audit_rows(self.spark, counts), self.paths.control(control))

    def _write_books(self) -> None:
        """Stage or states, and then the book; the second only after the first."""
        if self.book_from == "stage":
            steps = [("tb_refined_stage", self.paths.stage, self.write_stage)]
        else:
            # States have no load of the run to tell by: bringing them up to date once more is safe.
            steps = [("tb_refined_states", "", self.write_states)]
        write_book = self.write_book if self.book_from == "stage" else self.write_book_of_states
        steps.append(("tb_refined_book", self.paths.book, write_book))
        for table, path, step in steps:
            resumed = self.resume and "transactions" not in self._begun and path and self._done(table, path)
            if not resumed:
                self._begun.add("transactions")
                if not self._attempt(table, step):
                    return
            self._audit("refined", [table])

    def execute(self, steps: Collection[str] = STEPS) -> RunReport:
        ready = list(self.subjects)
        layers = (
            ("raw", "tb_raw", self.write_raw, self.paths.raw),
            ("trusted", "tb_trusted", self.write_trusted, self.paths.trusted),
            ("refined", "tb_refined_data_viz", self.write_snapshot, self.paths.snapshot),
        )
        for layer, prefix, step, path in layers:
            if layer in steps:
                ready = self._layer(prefix, layer, step, path, ready)
        if "book" in steps and any(spec.name == "transactions" for spec in ready):
            self._write_books()
        if self.report.failures:
            raise RunFailed(self.report)
        return self.report


def run_month(
    spark: SparkSession,
    paths: LakePaths,
    dt_proc: str,
    as_of: date,
    steps: Collection[str] = STEPS,
    **options,
) -> RunReport:
    """Landing to book for one load, or some of the steps of it.

    A subject that fails is left out of the later layers while the others go on;
    the run then ends with `RunFailed`, which carries the report. Every layer
    reads what the layer before it committed, nothing is computed twice, and the
    control counts come from the writes themselves.

    A run may be repeated with the same stamp, after a failure or without one: each
    layer writes the load of that stamp anew, and the control tables hold one row per table
    and load. A delivery without rows goes through as 0 rows in every layer. A load that was written
    anew replaces the version before, whose files are deleted once the new one is committed; with
    `replaced="keep"` they stay until `remove_replaced`, for readers that began before.

    `landing="batch"` reads one file per subject, "stream" all files dropped for
    it since the last run, and `clean` says what becomes of them. A raw table is
    written in one of the two ways, not in both: its stream keeps a list of its
    own files, and readers go by that list. `on_bad_row` is the mode of the CSV reader for
    rows that do not fit the schema; with "reject" they go to a table of their own and the
    others on.

    Each write is committed in the log of its table (`sources.manifest`): a run that dies leaves
    the loads it was to replace as they were.

    `loads="new"` standardises the raw loads since the run before and keeps the rows that no
    earlier load brought; a kept index of all rows finds them, so that a run reads what is new and
    the index, not the history. `loads="all"` standardises every raw load again and writes
    the whole history into every trusted load. Both end in the same snapshot, stage and book.
    `loads="own"` takes the load of this run alone and merges nothing over loads; its
    snapshot has the newest version of each key. A row compared with its load
    (`dedup="with_load"`) is never a copy of one in another load and needs no index.

    `resume=True` goes on where an earlier attempt with the same stamp ended: a step whose load
    its table's log has is not done again, unless a step before it had to be. A layer that a
    stream lands has no such log; its step is simply repeated, which takes in no file twice.

    `book_from="states"` keeps states of every month instead of a stage: the new rows of the run
    change the states of their months, and the book is put together from those of its windows.

    The stage is made from the snapshot of this run, or with `snapshots` from the "newest" one or
    from "all" of them, which counts the amounts of a sale once per snapshot.
    """
    with shuffles_removed(spark):
        return MonthlyRun(spark, paths, dt_proc, as_of, **options).execute(steps)
