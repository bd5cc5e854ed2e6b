"""Units sold per product and year, kept beside the stored lines and carried on by what is appended.

The totals are parts, each the sums of some files of the stored order lines, and
a manifest that says which. Files never change once written, so a refresh lists
the files, sums those that no part holds, and writes them as one more part under
the next version of the manifest; the manifest of a version names everything it
needs, and a refresh that fails half way leaves the last one valid. A part with
a file that is gone (a table that was saved again) is dropped, and what is left
of its files is summed anew. More than ``MOST_PARTS`` parts become one, from
their sums. Lines are taken to belong to stored orders, as the rules demand.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.functions.periods import year_column
from verdure.sources.catalog import CATALOG, INT
from verdure.sources.store import file_system, hadoop_path, load_table, stored_schema, table_path

LINES = "sale_detail"
TOTALS = "sold_totals"
MOST_PARTS = 16
_TOTAL = "id_flower bigint, year int, units bigint"
_MANIFEST = "file string, size bigint, part int"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: its version, the files it summed and the parts that hold now."""

    version: int
    files_read: tuple[str, ...]
    parts: tuple[int, ...]


def _listed(spark: SparkSession, base: str) -> dict[tuple[str, int], None]:
    """Data files of the stored lines, by path and size."""
    files = file_system(spark, base)
    root = hadoop_path(spark, table_path(base, LINES))
    found = {}
    if files.exists(root):
        walk = files.listFiles(root, True)
        while walk.hasNext():
            entry = walk.next()
            if not entry.getPath().getName().startswith(("_", ".")):
                found[entry.getPath().toString(), entry.getLen()] = None
    return found


def _versions(spark: SparkSession, base: str) -> list[int]:
    files = file_system(spark, base)
    folder = hadoop_path(spark, f"{table_path(base, TOTALS)}/manifest")
    if not files.exists(folder):
        return []
    names = [entry.getPath() for entry in files.listStatus(folder)]
    # A version counts once its writer has finished.
    done = [p for p in names if files.exists(hadoop_path(spark, f"{p.toString()}/_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def _part_path(base: str, part: int) -> str:
    return f"{table_path(base, TOTALS)}/parts/{part}"


def _known(spark: SparkSession, base: str, version: int) -> dict[tuple[str, int], int]:
    path = f"{table_path(base, TOTALS)}/manifest/version={version}"
    return {(r.file, r.size): r.part for r in spark.read.schema(_MANIFEST).parquet(path).collect()}


def _read(spark: SparkSession, base: str, parts: Iterable[int]) -> DataFrame:
    paths = [_part_path(base, p) for p in parts]
    return spark.read.schema(_TOTAL).parquet(*paths) if paths else spark.createDataFrame([], _TOTAL)


def _sums(lines: DataFrame) -> DataFrame:
    year = F.col(year_column(CATALOG[LINES].year_of)).alias("year")
    return lines.groupBy(F.col("id_flower").cast("bigint").alias("id_flower"), year).agg(
        F.sum(F.col("amount").cast("bigint")).alias("units")
    )


def refresh_totals(spark: SparkSession, base: str, wide: bool = False) -> Refresh:
    """Bring the totals up to the stored lines, reading only files that they do not hold yet."""
    now = _listed(spark, base)
    versions = _versions(spark, base)
    known = _known(spark, base, versions[-1]) if versions else {}
    broken = {part for entry, part in known.items() if entry not in now}
    held = {entry: part for entry, part in known.items() if part not in broken}
    new = [file for file, size in now if (file, size) not in held]
    parts = sorted(set(held.values()))
    if versions and not new and not broken:
        return Refresh(versions[-1], (), tuple(parts))
    version = versions[-1] + 1 if versions else 1
    if new:
        if held:
            schema = stored_schema(CATALOG[LINES], wide).add(year_column(CATALOG[LINES].year_of), INT)
            lines = spark.read.schema(schema).option("basePath", table_path(base, LINES)).parquet(*new)
        else:
            lines = load_table(spark, base, LINES, wide)
        _sums(lines).write.mode("overwrite").parquet(_part_path(base, version))
        held.update({entry: version for entry in now if entry not in held})
        parts.append(version)
    if len(parts) > MOST_PARTS:
        # Numbers of merged parts are negative, so they meet no other part's.
        merged = _read(spark, base, parts).groupBy("id_flower", "year").agg(F.sum("units").alias("units"))
        merged.write.mode("overwrite").parquet(_part_path(base, -version))
        held, parts = dict.fromkeys(held, -version), [-version]
    rows = [(file, size, part) for (file, size), part in held.items()]
    manifest = f"{table_path(base, TOTALS)}/manifest/version={version}"
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(manifest)
    return Refresh(version, tuple(new), tuple(parts))


def sold_units(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """``id_flower, year, units`` by the last version of the totals, or an earlier one."""
    versions = _versions(spark, base)
    if version is None and versions:
        version = versions[-1]
    if version not in versions:
        raise ValueError("the totals have no such version; refresh them first")
    parts = sorted(set(_known(spark, base, version).values()))
    return _read(spark, base, parts).groupBy("id_flower", "year").agg(F.sum("units").alias("units"))
