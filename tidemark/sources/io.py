"""Reading and writing snapshots.

CSV snapshots are read as text with an explicit header check, then cast to the contract
types (never inferred). Parquet tables are the stored form of every layer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import lenient_utc, strict_utc
from tidemark.sources.contracts import check_required_columns
from tidemark.sources.schemas import CONTRACTS, TableContract


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` on whatever file system the cluster uses."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def csv_reader(spark: SparkSession, strict: bool = True, line_breaks: bool = False):
    """CSV with a header. ``line_breaks`` allows line breaks inside quoted cells; such files cannot be split, so one task
    reads each file, and it is off by default."""
    # `escape='"'`: JSON properties are quoted with doubled quotes inside the cell.
    # Only the empty field is NULL (no "NA"/"null" tokens).
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )


# wide enough to see decimals that the contract's type would round away
WIDE = T.DecimalType(38, 18)


def _loses_decimals(c: Column, kind: T.DecimalType) -> Column:
    return F.coalesce(c.try_cast(WIDE) != c.try_cast(kind), F.lit(False))


def to_contract_types(text: DataFrame, contract: TableContract, strict: bool = True) -> DataFrame:
    """Cast the contract's columns from text; extra columns are dropped (:func:`extra_columns` names them).

    Strict: a value that does not fit its type, or a decimal with more places than its type, fails the read. Tolerant:
    such values become NULL, and decimals are rounded; :func:`conversion_failures` counts both.
    """
    cols = []
    for f in contract.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            c = strict_utc(c) if strict else lenient_utc(c)
        elif isinstance(f.dataType, T.DecimalType) and strict:
            c = F.when(
                _loses_decimals(c, f.dataType),
                F.raise_error(F.concat(F.lit(f"{contract.name}.{f.name} has more than {f.dataType.scale} decimals: "), c)).cast(f.dataType),
            ).otherwise(c.cast(f.dataType))
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return text.select(*cols)


def extra_columns(columns: Sequence[str], contract: TableContract) -> list[str]:
    """Columns of a source that the contract does not know; the typed table is without them."""
    return sorted(set(columns) - contract.required)


def conversion_failures(text: DataFrame, contract: TableContract) -> DataFrame:
    """(table, column, failures): values of the text that a tolerant read turns into NULL or rounds, from one aggregation."""
    bad = {}
    for f in contract.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            bad[f.name] = c.isNotNull() & lenient_utc(c).isNull()
        elif isinstance(f.dataType, T.DecimalType):
            bad[f.name] = (c.isNotNull() & c.try_cast(f.dataType).isNull()) | _loses_decimals(c, f.dataType)
        elif not isinstance(f.dataType, T.StringType):
            bad[f.name] = c.isNotNull() & c.try_cast(f.dataType).isNull()
    counts = text.agg(*[F.count_if(cond).alias(name) for name, cond in bad.items()])
    rows = [F.struct(F.lit(contract.name).alias("table"), F.lit(n).alias("column"), F.col(n).alias("failures")) for n in bad]
    return counts.select(F.inline(F.array(*rows)))


def read_csv_text(
    spark: SparkSession, path: str, contract: TableContract, strict: bool = True, line_breaks: bool = False
) -> DataFrame:
    """The untyped cells of a CSV table whose header fits the contract."""
    text = csv_reader(spark, strict, line_breaks).csv(path)
    check_required_columns(text.columns, contract)
    return text


def read_csv_table(
    spark: SparkSession, path: str, contract: TableContract, strict: bool = True, line_breaks: bool = False
) -> DataFrame:
    """One CSV table, header checked against the contract (S6), typed by the contract."""
    return to_contract_types(read_csv_text(spark, path, contract, strict, line_breaks), contract, strict)


def read_csv_snapshot(
    spark: SparkSession, root: str, strict: bool = True, suffix: str = ".csv"
) -> dict[str, DataFrame]:
    """The three raw tables of a CSV snapshot folder (``<root>/<table>.csv``)."""
    return {
        name: read_csv_table(spark, f"{root.rstrip('/')}/{name}{suffix}", c, strict)
        for name, c in CONTRACTS.items()
    }


def read_csv_snapshot_tolerant(
    spark: SparkSession, root: str, suffix: str = ".csv"
) -> dict[str, DataFrame]:
    """S3: like :func:`read_csv_snapshot`, but a missing table becomes an empty typed frame."""
    out = {}
    for name, c in CONTRACTS.items():
        path = f"{root.rstrip('/')}/{name}{suffix}"
        if path_exists(spark, path):
            out[name] = read_csv_table(spark, path, c, strict=False)
        else:
            out[name] = spark.createDataFrame([], c.schema)
    return out


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "error",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    batch_size: int | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Write ``df`` and return the number of rows stored by this call.

    Stored files are counted after the write (for Parquet from the footers, no data page is read); an append counts before
    and after. A target that is no file format is counted on its input. Partitioned writes are rebalanced by the partition
    columns first, so small dates merge into few files and a hot date is split into even ones.
    ``batch_size`` maps to the JDBC ``batchsize`` option for database targets.
    """
    spark = df.sparkSession
    files = fmt in ("parquet", "orc", "json", "csv", "text")

    def stored() -> int:
        reader = spark.read.format(fmt)
        return (reader.schema(df.schema) if fmt != "text" else reader).load(path).count() if path_exists(spark, path) else 0

    before = stored() if files and mode == "append" else 0
    out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if batch_size is not None:
        writer = writer.option("batchsize", str(batch_size))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)
    return (stored() - before) if files else df.count()


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Row count, and smallest and largest value of whole-number or date columns, of a Parquet table: one row.

    The aggregates are pushed into the scan, which answers them from the files' footers, so no data page is read however
    large the table is. The relation belongs to a session of its own, where the scan that can do this is on.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    bounds = [a for c in columns for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = ("event_ts",)) -> None:
    """CSV export with header, optionally globally ordered (range-partitioned sort)."""
    out = df.orderBy(*order_by) if order_by else df
    # the writer's own formats cut times to milliseconds
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    out.write.mode("overwrite").option("header", True).option("escape", '"').options(**times).csv(path)
