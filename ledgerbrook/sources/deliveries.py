"""Raw deliveries: files whose columns differ, and lines that don't fit their file.

Columns of a CSV file are bound by the file's own header: files may have them in any order, leave out optional
ones (NULL) or bring others (ignored). One pass over the first blocks finds the header of every file; files of one header are
then read together, so there are as many readers as different headers. What can't be read is kept as raw text:
a row with more or fewer fields than its header is MALFORMED, and so is a broken JSON line; all rows of a CSV file that lacks
a required column are SCHEMA. Nothing fails a load but a dataset none of whose files has the columns.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerbrook.sources import lake
from ledgerbrook.sources.schemas import OPTIONAL, RAW

MALFORMED, SCHEMA = "MALFORMED", "SCHEMA"
REASONS = {MALFORMED: "Row does not fit the columns of its file", SCHEMA: "File lacks required columns"}
#: What a delivery adds to the declared columns. `defect` is NULL for a readable row, whose text isn't kept.
EXTRA = StructType().add("file_path", "string").add("file_time", "timestamp").add("raw_text", "string").add("defect", "string")
#: Different headers of one dataset beyond which a delivery is refused: each is a reader in the plan.
MOST_LAYOUTS = 200


@dataclass(frozen=True)
class Layout:
    """Files that share a header line, and its column names in order."""

    header: str
    names: tuple[str, ...]
    files: tuple[str, ...]

    def place(self, column: str) -> int | None:
        """Where a declared column stands: names are compared without case or surrounding blanks."""
        return self.names.index(column.lower()) if column.lower() in self.names else None

    def missing(self, expected: StructType) -> list[str]:
        return [f.name for f in expected if self.place(f.name) is None and f.name not in OPTIONAL]

    @property
    def repeated(self) -> list[str]:
        return sorted({n for n in self.names if self.names.count(n) > 1})

    def fits(self, expected: StructType) -> bool:
        return not self.missing(expected) and not any(f.name in self.repeated for f in expected)


def _named(header: str) -> tuple[str, ...]:
    return tuple(n.strip().lower() for n in next(csv.reader([header.removeprefix("\ufeff")], skipinitialspace=True)))


def literal(path: str) -> str:
    """A file path without meaning as a pattern, for a reader."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def layouts(spark: SparkSession, path: str | list[str], modified_after: dt.datetime | None = None) -> list[Layout]:
    """The headers of CSV files with the files that have them; files without any line are left out.

    Only the header of a file leaves its task. The list of files comes to the driver, as it does in any listing.
    """
    lines = lake.reader_of(spark, modified_after).text(path).select(
        "value", F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    heads = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").limit(MOST_LAYOUTS + 1).collect()
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"{path}: more than {MOST_LAYOUTS} different headers")
    return [Layout(r["header"], _named(r["header"]), tuple(literal(unquote(f)) for f in r["files"])) for r in found]


def findings(spark: SparkSession, found: list[Layout], expected: StructType) -> DataFrame:
    """column_name, finding, files, example_file: MISSING (required), ABSENT (optional), EXTRA, REPEATED and MOVED columns per header."""
    rows = []
    for layout in found:
        wanted = [f.name.lower() for f in expected]
        common = [n for n in layout.names if n in wanted]
        told = [(n, "MISSING") for n in layout.missing(expected)]
        told += [(f.name, "ABSENT") for f in expected if layout.place(f.name) is None and f.name in OPTIONAL]
        told += [(n, "EXTRA") for n in dict.fromkeys(layout.names) if n not in wanted] + [(n, "REPEATED") for n in layout.repeated]
        told += [(n, "MOVED") for n, m in zip(common, sorted(common, key=wanted.index)) if n != m]
        rows += [(n, kind, len(layout.files), layout.files[0]) for n, kind in told]
    return spark.createDataFrame(rows, "column_name string, finding string, files long, example_file string")


def require_columns(found: list[Layout], expected: StructType, dataset: str) -> None:
    """Refuse a delivery none of whose files has the required columns, before any row is read."""
    if found and not any(layout.fits(expected) for layout in found):
        missing = sorted({n for layout in found for n in (*layout.missing(expected), *layout.repeated)})
        raise ValueError(f"{dataset}: missing or repeated columns {', '.join(missing)}")


# ---- reading -------------------------------------------------------------------------------------


def _extra(raw: Column, defect: Column) -> list[Column]:
    values = (F.col("_metadata.file_path"), F.col("_metadata.file_modification_time"), raw, defect)
    return [v.cast(f.dataType).alias(f.name) for v, f in zip(values, EXTRA)]


def _of_layout(spark: SparkSession, layout: Layout, expected: StructType) -> DataFrame:
    if not layout.fits(expected):
        lines = spark.read.text(list(layout.files)).where((F.col("value") != layout.header) & (F.trim("value") != ""))
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in expected]
        return lines.select(*nothing, *_extra(F.col("value"), F.lit(SCHEMA)))
    names = [f"c{i}" for i in range(len(layout.names))]
    schema = StructType()
    for name in names:
        schema = schema.add(name, "string")
    reader = spark.read.schema(schema.add("raw_text", "string")).option("header", True).option("mode", "PERMISSIVE")
    # a pruned read would not count the fields of a row
    rows = reader.option("columnNameOfCorruptRecord", "raw_text").option("columnPruning", False).csv(list(layout.files))
    return rows.select(*_bound(expected, {f.name: names[i] for f in expected if (i := layout.place(f.name)) is not None}, names[0]))


def _bound(expected: StructType, source: dict[str, str], any_column: str) -> list[Column]:
    """The declared columns of readable rows, NULL where the file has none, and what a delivery adds."""
    # Spark refuses to read the raw text alone, so another column is looked at
    broken = F.col("raw_text").isNotNull() & (F.length(F.coalesce(any_column, F.lit(""))) >= 0)
    readable = ~broken
    values = [
        F.when(readable, F.col(source[f.name])).cast(f.dataType).alias(f.name) if f.name in source else F.lit(None).cast(f.dataType).alias(f.name)
        for f in expected
    ]
    return [*values, *_extra(F.when(broken, F.col("raw_text")), F.when(broken, MALFORMED))]


def read_layouts(spark: SparkSession, found: list[Layout], expected: StructType) -> DataFrame:
    if not found:
        return spark.createDataFrame([], StructType([*expected, *EXTRA]))
    return lake.union_batches([_of_layout(spark, layout, expected) for layout in found])


def read(spark: SparkSession, path: str | list[str], dataset: str, fmt: str = "csv", modified_after: dt.datetime | None = None) -> DataFrame:
    """The files of a dataset: declared columns and EXTRA, one row per row of the files, whatever their columns.

    `modified_after` (UTC) leaves out older files when they are listed. Parquet files lack no row and no
    required column of theirs is looked for here (`lake.delivered_schema`).
    """
    expected = RAW[dataset]
    if fmt == "csv":
        return read_layouts(spark, layouts(spark, path, modified_after), expected)
    if fmt == "json":
        reader = lake.reader_of(spark, modified_after).schema(StructType([*expected]).add("raw_text", "string"))
        rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw_text").json(path)
        return rows.select(*_bound(expected, {f.name: f.name for f in expected}, expected[0].name))
    rows = lake.read_files(spark, path, expected, fmt, modified_after)
    return rows.select(*(f.name for f in expected), *_extra(F.lit(None), F.lit(None)))


def defects(df: DataFrame) -> DataFrame:
    """The unreadable rows of a delivery in the shape of rejects."""
    reasons = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return df.where(F.col("defect").isNotNull()).select(
        F.lit(None).cast("string").alias("record_id"), reasons[F.col("defect")].alias("failure_reason"), F.col("defect").alias("failed_rule"),
        F.col("raw_text").alias("raw_data"),
    )
