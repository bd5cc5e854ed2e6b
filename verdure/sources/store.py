"""Read, append and snapshot the declared tables as Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.functions.periods import AsOf, year_column
from verdure.operators.identity import assign_ids, fill_defaults
from verdure.operators.quality import quality_report
from verdure.sources.catalog import CATALOG, INT, LONG, Relation


def stored_schema(relation: Relation, wide: bool = False) -> T.StructType:
    """Declared schema; ``wide`` stores whole numbers as bigint for big key ranges."""
    fields = relation.schema.fields
    return T.StructType(
        [T.StructField(f.name, LONG if wide and f.dataType == INT else f.dataType) for f in fields]
    )


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def load_table(spark: SparkSession, base: str, name: str, wide: bool = False) -> DataFrame:
    """Scan one stored table with its declared schema; nothing is inferred."""
    relation = CATALOG[name]
    schema = stored_schema(relation, wide)
    if relation.year_of:
        schema = schema.add(year_column(relation.year_of), INT)
    return spark.read.schema(schema).parquet(table_path(base, name))


def load_tables(
    spark: SparkSession, base: str, names: Iterable[str] = tuple(CATALOG), wide: bool = False
) -> dict[str, DataFrame]:
    return {name: load_table(spark, base, name, wide) for name in names}


def _with_year(
    rows: DataFrame, relation: Relation, tables: Mapping[str, DataFrame], dated: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows with the year of their date; NULL where the dated table is not at hand.

    ``dated`` has tables that come with the year.
    """
    year = year_column(relation.year_of)
    owner = relation.dated_by
    if owner is None:
        return rows.withColumn(year, F.year(relation.year_of))
    if owner.parent not in tables:
        return rows.withColumn(year, F.lit(None).cast(INT))
    parents = dated.get(owner.parent)
    if parents is None:
        parents = _with_year(tables[owner.parent], CATALOG[owner.parent], tables, dated)
    years = parents.select(F.col("id").alias("_owner"), year)
    return rows.join(years, F.col(owner.column) == F.col("_owner"), "left").drop("_owner")


def _owners(name: str) -> int:
    """Number of tables between a table and the one that has the date."""
    owner = CATALOG[name].dated_by
    return 0 if owner is None else 1 + _owners(owner.parent)


def _write(
    df: DataFrame,
    base: str,
    relation: Relation,
    mode: str,
    wide: bool,
    tables: Mapping[str, DataFrame],
    dated: Mapping[str, DataFrame] | None = None,
) -> None:
    schema = stored_schema(relation, wide)
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if not relation.year_of:
        rows.write.mode(mode).parquet(table_path(base, relation.name))
        return
    year = year_column(relation.year_of)
    # Ranges of year and order: a year that holds most of the data is written by
    # many tasks, and a file holds few neighbouring orders, in their order.
    place = [year, *_order_columns(relation)]
    rows = _with_year(rows, relation, tables, dated or {}).repartitionByRange(*place).sortWithinPartitions(*place)
    # An overwrite replaces the table, not only the years that come again.
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    for column in _order_columns(relation):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy(year).parquet(table_path(base, relation.name))


def _order_columns(relation: Relation) -> list[str]:
    """What the files of a dated table are sorted by: its owner, if any, and its key."""
    owner = [relation.dated_by.column] if relation.dated_by else []
    return list(dict.fromkeys([*owner, *relation.key]))


def largest_stored_id(spark: SparkSession, base: str, name: str, wide: bool = False) -> int | None:
    """Largest id of a stored table from the footers of its files; None without rows.

    The maximum is pushed into the reader, which takes it from the statistics of
    the row groups, so no rows are read. Only the session of this one plan reads
    Parquet in the way that allows it.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return _largest_id(session, base, name, wide).first()["last"]


def _largest_id(session: SparkSession, base: str, name: str, wide: bool) -> DataFrame:
    schema = T.StructType([f for f in stored_schema(CATALOG[name], wide) if f.name == "id"])
    return session.read.schema(schema).parquet(table_path(base, name)).agg(F.max("id").alias("last"))


def numbered(
    df: DataFrame, base: str, name: str, wide: bool = False, order_by: Iterable[str] | None = None
) -> DataFrame:
    """``df`` with ids above all stored ones, for tables with the key ``id``.

    Rows are numbered in the order of ``order_by``, by default of all columns.
    """
    spark = df.sparkSession
    stored = file_system(spark, base).exists(hadoop_path(spark, table_path(base, name)))
    last = largest_stored_id(spark, base, name, wide) if stored else None
    return assign_ids(df, list(order_by or df.columns), start=(last or 0) + 1)


def append_rows(
    df: DataFrame,
    base: str,
    name: str,
    as_of: AsOf = None,
    wide: bool = False,
    tables: Mapping[str, DataFrame] | None = None,
) -> None:
    """Append rows that name only some columns; defaults fill the absent ones.

    Rows without the column ``id`` are numbered above all that are stored, see
    ``numbered``; one append at a time, as for any table without locks. Order
    lines and their lots are stored by the year of the order if ``tables`` has
    the orders (and lines); otherwise under no year, where every report still
    finds them.
    """
    relation = CATALOG[name]
    if relation.key == ("id",) and "id" not in df.columns:
        df = numbered(df, base, name, wide)
    _write(fill_defaults(df, relation, as_of), base, relation, "append", wide, tables or {})


def save_table(
    df: DataFrame,
    base: str,
    name: str,
    wide: bool = False,
    tables: Mapping[str, DataFrame] | None = None,
) -> None:
    _write(df, base, CATALOG[name], "overwrite", wide, tables or {})


MANIFEST = "snapshot_manifest"


def fingerprints(df: DataFrame, name: str) -> DataFrame:
    """``table_name, column_name, row_count, fingerprint``: one row per column.

    A fingerprint does not depend on the order of the rows: the sums of both
    halves of a 48-bit hash of each value.
    """
    low = (1 << 24) - 1

    def print_of(field: T.StructField) -> Column:
        hashed = F.xxhash64(F.col(field.name), F.col(field.name).isNull())
        halves = [hashed.bitwiseAND(low), F.shiftrightunsigned(hashed, 24).bitwiseAND(low)]
        sums = [F.coalesce(F.sum(h), F.lit(0)).cast("string") for h in halves]
        return F.struct(F.lit(field.name).alias("column_name"), F.concat_ws(".", *sums).alias("fingerprint"))

    listed = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*map(print_of, df.schema.fields)).alias("columns"))
    return listed.select(F.lit(name).alias("table_name"), "row_count", F.inline("columns")).select(
        "table_name", "column_name", "row_count", "fingerprint"
    )


def save_snapshot(tables: Mapping[str, DataFrame], base: str, wide: bool = False) -> None:
    """Write every table given, and counts and fingerprints of what was written.

    A table that is stored by the year of its owner takes the year from the
    stored owner, which is written before, and not from the owner's plan again.
    """
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    dated = {}
    for name in sorted(tables, key=_owners):
        _write(tables[name], base, CATALOG[name], "overwrite", wide, tables, dated)
        if CATALOG[name].year_of:
            dated[name] = load_table(spark, base, name, wide)
    written = load_snapshot(spark, base, tables, wide)
    prints = reduce(DataFrame.unionByName, [fingerprints(written[name], name) for name in tables])
    prints.coalesce(1).write.mode("overwrite").parquet(table_path(base, MANIFEST))


def load_snapshot(
    spark: SparkSession, base: str, names: Iterable[str] = tuple(CATALOG), wide: bool = False
) -> dict[str, DataFrame]:
    """Reload a snapshot without the partition columns of its layout."""
    loaded = load_tables(spark, base, names, wide)
    return {name: df.select(CATALOG[name].schema.names) for name, df in loaded.items()}


def restore(
    spark: SparkSession, base: str, as_of: AsOf = None, wide: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables of a snapshot, checked, and the report of the declared rules on them.

    Refuses a snapshot that is not as it was saved: a table without its rows,
    or a column with another fingerprint, because a file is missing or changed.
    The rules are judged after the data is there, and broken ones are reported,
    not refused: ``table_name, rule, violations``.
    """
    manifest = spark.read.parquet(table_path(base, MANIFEST)).collect()
    names = list(dict.fromkeys(r.table_name for r in manifest))
    files = file_system(spark, base)
    gone = [name for name in names if not files.exists(hadoop_path(spark, table_path(base, name)))]
    if gone:
        raise ValueError(f"tables of the snapshot are missing: {', '.join(gone)}")
    tables = load_snapshot(spark, base, names, wide)
    found = reduce(DataFrame.unionByName, [fingerprints(tables[name], name) for name in names]).collect()
    differing = sorted({(r.table_name, r.column_name) for r in set(manifest) ^ set(found)})
    if differing:
        raise ValueError("the snapshot is not as it was saved: " + ", ".join(".".join(d) for d in differing))
    return tables, quality_report(tables, as_of)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system of any path that Spark reads."""
    return hadoop_path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def save_total(df: DataFrame, column: str, base: str, name: str = "sale_sum") -> None:
    """Keep the sum of a column as a stored one-row table; NULL for no rows."""
    total = df.agg(F.sum(column).cast("bigint").alias("sum"))
    total.write.mode("overwrite").parquet(table_path(base, name))
