"""Rejected rows (S3, S8): a tolerant load keeps what it cannot use, with the reasons, instead of counting it.

A row is accepted if every value fits its contract type, no NOT NULL column is empty and, in a CSV file, the line has the
header's cells. All others go to a table ``<name>_rejected`` (record, reasons) that is published with the snapshot: the
record is the row's cells as JSON, or the line where it could not be cut in cells. Nothing is lost and nothing is repaired:
accepted and rejected rows together are all rows. One pass decides both, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import lenient_utc
from tidemark.sources.contracts import check_required_columns
from tidemark.sources.io import _loses_decimals, csv_reader, to_contract_types
from tidemark.sources.schemas import TableContract

CORRUPT = "_corrupt_line"


def reasons(contract: TableContract, broken_line: Column | None = None) -> Column:
    """The names of the columns that keep a row out, in contract order; ``line`` first if its cells could not be read."""
    found = []
    for f in contract.schema.fields:
        c = F.col(f.name)
        bad = F.lit(False)
        if isinstance(f.dataType, T.TimestampNTZType):
            bad = c.isNotNull() & lenient_utc(c).isNull()
        elif isinstance(f.dataType, T.DecimalType):
            bad = (c.isNotNull() & c.try_cast(f.dataType).isNull()) | _loses_decimals(c, f.dataType)
        elif not isinstance(f.dataType, T.StringType):
            bad = c.isNotNull() & c.try_cast(f.dataType).isNull()
        if f.name in contract.not_null:
            bad = bad | c.isNull()
        found.append(F.when(bad, F.lit(f.name)))
    cells = F.array_compact(F.array(*found))
    return cells if broken_line is None else F.when(broken_line, F.array(F.lit("line"))).otherwise(cells)


def split_rows(text: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """(typed accepted rows, rejected rows as (record, reasons)) of a table of text cells."""
    check_required_columns(text.columns, contract)
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in text.columns else None
    judged = text.withColumn("_reasons", reasons(contract, corrupt))
    cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns if c != CORRUPT]))
    record = cells if corrupt is None else F.coalesce(F.col(CORRUPT), cells)
    rejected = judged.filter(F.size("_reasons") > 0).select(record.alias("record"), F.col("_reasons").alias("reasons"))
    return to_contract_types(judged.filter(F.size("_reasons") == 0), contract, strict=False), rejected


def read_csv_split(spark: SparkSession, path: str, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a CSV file with a header. Lines with too few or too many cells are kept whole."""
    header = csv_reader(spark, strict=False).csv(path).columns
    check_required_columns(header, contract)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    # with column pruning a line is not cut far enough to see that it has too many cells
    reader = csv_reader(spark, strict=False).option("columnPruning", False)
    reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return split_rows(reader.csv(path), contract)
