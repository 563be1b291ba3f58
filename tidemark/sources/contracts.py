"""Contract validation and all-or-nothing snapshot publication.

Every publish writes its tables into a folder of its own, ``<root>/snapshots/<id>/<attempt>``, which no reader knows. The
stored tables are then validated and gated, and only then one commit is added to the log ``<root>/_commits``: a file named
by the next number that says id and attempt. The file is made by renaming a finished one to a name that must be free, so of
two publishers that take the same number one has to look again, and no reader sees half a commit. A publisher whose id was
committed by another run since it began fails and changes nothing. Readers follow the log: the current snapshot is the last
one committed, and an id's tables are those of its last commit. Committed folders are never written again;
:func:`remove_dead_attempts` deletes those that no commit names. (The rename is atomic on HDFS and local disks; an object
store needs a committer with conditional puts for concurrent publishers.)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.sources.schemas import CONTRACTS, TableContract


class ContractError(ValueError):
    """A raw table breaks its contract."""


def missing_columns(columns: Iterable[str], contract: TableContract) -> list[str]:
    return sorted(contract.required - set(columns))


def check_required_columns(columns: Iterable[str], contract: TableContract) -> None:
    """Every required column is present (extras are allowed and dropped on typing)."""
    missing = missing_columns(columns, contract)
    if missing:
        raise ContractError(f"{contract.name} {K.MISSING_COLUMNS}: {missing}")


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """S7 + S8 as a relation: (table, check, failures).

    Duplicate keys are counted by grouping on the key (NULL keys group together, as in the
    load check); NULLs in NOT NULL columns are counted in one aggregation.
    """
    dup = (
        df.groupBy(*contract.key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(contract.name).alias("table"), F.lit("duplicate_key").alias("check"), "failures")
    )
    nulls = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in contract.not_null]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(contract.name).alias("table"),
                        F.lit(f"not_null:{c}").alias("check"),
                        F.col(c).cast("long").alias("failures"),
                    )
                    for c in contract.not_null
                ]
            )
        )
    )
    return dup.unionAll(nulls)


def validate_frame(df: DataFrame, table_name: str) -> None:
    """Raise :class:`ContractError` for missing columns, duplicate keys or NULLs.

    Runs one small job per table; only failing checks reach the driver.
    """
    contract = CONTRACTS[table_name]
    check_required_columns(df.columns, contract)
    failed = contract_violations(df, contract).filter(F.col("failures") > 0).collect()
    for row in failed:
        if row["check"] == "duplicate_key":
            raise ContractError(f"{table_name} {K.DUPLICATE_KEYS} {list(contract.key)}")
    if failed:
        cols = sorted(r["check"].split(":", 1)[1] for r in failed)
        raise ContractError(f"{table_name} {K.NULL_KEYS}: {cols}")


ATTEMPT_TIME = "%Y%m%dT%H%M%S%fZ"


def new_snapshot_id() -> str:
    return datetime.now(timezone.utc).strftime(ATTEMPT_TIME)


def _commit_dir(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def attempt_path(root: str, snapshot_id: str, attempt: str, table: str | None = None) -> str:
    base = f"{root.rstrip('/')}/snapshots/{snapshot_id}/{attempt}"
    return f"{base}/{table}" if table else base


def commit_log(spark: SparkSession, root: str) -> list[tuple[int, str, str]]:
    """(number, snapshot id, attempt) of every commit, in order."""
    from tidemark.sources.io import hadoop_path

    fs, p = hadoop_path(spark, _commit_dir(root))
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        if status.getPath().getName().isdigit():
            text = _read_text(spark, fs, status.getPath())
            out.append((int(status.getPath().getName()), *text.rstrip("\n").split("\t")))
    return sorted(out)


def _read_text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def _add_commit(spark: SparkSession, root: str, number: int, snapshot_id: str, attempt: str) -> bool:
    """Write commit ``number`` unless it exists already."""
    from py4j.protocol import Py4JJavaError

    from tidemark.sources.io import hadoop_path

    jvm = spark.sparkContext._jvm
    fs, folder = hadoop_path(spark, _commit_dir(root))
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{attempt}")
    stream = fs.create(draft, True)
    stream.write(f"{snapshot_id}\t{attempt}\n".encode())
    stream.close()
    place = jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), fs.getConf())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(place), spark.sparkContext._gateway.new_array(kind, 0))
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in exc.java_exception.getClass().getName():
            raise
        fs.delete(draft, False)
        return False
    return True


def commit(spark: SparkSession, root: str, snapshot_id: str, attempt: str, seen: int | None) -> int:
    """Commit an attempt; ``seen`` is the number of the id's commit that the publisher started from."""
    while True:
        log = commit_log(spark, root)
        if _last_of(log, snapshot_id) != seen:
            raise ContractError(f"snapshot {snapshot_id} {K.PUBLISHED_ELSEWHERE}")
        number = log[-1][0] + 1 if log else 1
        if _add_commit(spark, root, number, snapshot_id, attempt):
            return number


def _last_of(log: list[tuple[int, str, str]], snapshot_id: str) -> int | None:
    return max((n for n, i, _ in log if i == snapshot_id), default=None)


def committed_attempt(spark: SparkSession, root: str, snapshot_id: str) -> str | None:
    """The attempt of an id's last commit."""
    attempts = [a for _, i, a in commit_log(spark, root) if i == snapshot_id]
    return attempts[-1] if attempts else None


def committed_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Committed snapshot ids in the order of their last commits."""
    last = {i: n for n, i, _ in commit_log(spark, root)}
    return sorted(last, key=last.get)


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    ids = committed_snapshots(spark, root)
    return ids[-1] if ids else None


def remove_dead_attempts(spark: SparkSession, root: str, older_than: timedelta) -> list[str]:
    """Delete the attempts that no commit names and that began longer ago than ``older_than`` (longer than any run takes)."""
    from tidemark.sources.io import hadoop_path

    named = {(i, a) for _, i, a in commit_log(spark, root)}
    limit = (datetime.now(timezone.utc) - older_than).strftime(ATTEMPT_TIME)
    fs, top = hadoop_path(spark, f"{root.rstrip('/')}/snapshots")
    gone = []
    for snapshot in fs.listStatus(top) if fs.exists(top) else ():
        for attempt in fs.listStatus(snapshot.getPath()):
            key = (snapshot.getPath().getName(), attempt.getPath().getName())
            if key not in named and key[1] < limit:
                fs.delete(attempt.getPath(), True)
                gone.append("/".join(key))
    return sorted(gone)


def snapshot_path(spark: SparkSession, root: str, snapshot_id: str | None = None, table: str | None = None) -> str:
    """The visible folder of a committed snapshot (the newest one by default)."""
    snapshot_id = snapshot_id or current_snapshot(spark, root)
    attempt = committed_attempt(spark, root, snapshot_id) if snapshot_id else None
    if attempt is None:
        raise FileNotFoundError(f"no committed snapshot {snapshot_id or ''} under {root}")
    return attempt_path(root, snapshot_id, attempt, table)


def publish_snapshot(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    snapshot_id: str | None = None,
    gate: Callable[[dict[str, DataFrame]], None] | None = None,
    validate: bool = True,
    receipt: dict[str, int] | None = None,
    then: Sequence[Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]]] = (),
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> str:
    """Write every frame into a new attempt, validate what was stored, run the gate, then commit.

    ``then`` is a sequence of functions from the tables stored so far to further tables (marts over staged events, reports
    over marts), stored in the same attempt in turn and committed with it; a later gate is such a function that raises or
    returns nothing to store. Nothing becomes visible when any step fails. Returns the snapshot id; ``receipt`` (S11), when given, receives the rows stored per table.
    """
    from tidemark.sources.io import write_table

    snapshot_id = snapshot_id or new_snapshot_id()
    attempt = f"{new_snapshot_id()}-{uuid.uuid4().hex[:8]}"
    seen = _last_of(commit_log(spark, root), snapshot_id)
    stored: dict[str, DataFrame] = {}

    def keep(tables: Mapping[str, DataFrame]) -> None:
        for name, df in tables.items():
            path = attempt_path(root, snapshot_id, attempt, name)
            rows = write_table(df, path, mode="error", partition_by=(partition_by or {}).get(name, ()))
            stored[name] = spark.read.schema(df.schema).parquet(path)
            if receipt is not None:
                receipt[name] = rows

    keep(frames)
    if validate:
        for name, df in stored.items():
            if name in CONTRACTS:
                validate_frame(df, name)
    if gate is not None:
        gate(stored)
    for step in then:
        keep(step(stored))
    commit(spark, root, snapshot_id, attempt, seen)
    return snapshot_id


def read_source(spark: SparkSession, root: str, name: str, snapshot_id: str | None = None) -> DataFrame:
    """A named table of the current (or given) committed snapshot."""
    return spark.read.parquet(snapshot_path(spark, root, snapshot_id, name))


def read_snapshot(spark: SparkSession, root: str, snapshot_id: str | None = None) -> dict[str, DataFrame]:
    base = snapshot_path(spark, root, snapshot_id)
    return {name: spark.read.parquet(f"{base}/{name}") for name in CONTRACTS}
