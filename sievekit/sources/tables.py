"""Sources, sinks and catalog.  Data always moves storage -> executors ->
storage; nothing is built on the driver and shipped out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, else files at a path.  Lazy: filters and
    projections applied later reach the scan."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    return spark.read.format(fmt).load(name_or_path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             corrupt_col: str | None = "_corrupt_record", sep: str = ",") -> DataFrame:
    """CSV with a declared schema (no inference pass).  Malformed rows keep
    their raw text in ``corrupt_col`` instead of failing the job."""
    s = schema
    r = spark.read.option("header", header).option("sep", sep)
    if corrupt_col:
        s = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return r.schema(s).csv(path)


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Select exactly the declared columns in declared order and types.

    Missing columns become typed nulls.  Values that do not convert become
    null (``try_cast``; ``rejects`` lists them and ``schema_drift`` counts them),
    or fail the job with ``strict=True``."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def schema_drift(df: DataFrame, schema: T.StructType) -> DataFrame:
    """How a table differs from the declared columns, a row for each column of
    either: ``(column_name, change, declared, found, n_lost)``.  ``change`` is
    ``missing`` (declared, not there), ``extra`` (there, not declared), ``retyped``
    or ``same``; ``n_lost`` counts values that do not survive the conversion.
    One aggregate pass, over the retyped columns only."""
    found, declared = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    retyped = [c for c, t in declared.items() if c in found and found[c] != t]
    lost = {c: F.count_if(_lost(c, declared[c])) for c in retyped}
    rows = []
    for c in [*declared, *(c for c in found if c not in declared)]:
        change = "missing" if c not in found else "extra" if c not in declared else "retyped" if c in retyped else "same"
        name = lambda kind: F.lit(kind.simpleString() if kind else None).cast("string")
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(change).alias("change"), name(declared.get(c)).alias("declared"), name(found.get(c)).alias("found"),
                             (F.col(f"n_{c}") if c in lost else F.lit(0).cast("bigint")).alias("n_lost")))
    counts = df.agg(F.count(F.lit(1)).alias("n"), *(x.alias(f"n_{c}") for c, x in lost.items())) if lost else df.sparkSession.range(1)
    return counts.select(F.inline(F.array(*rows)))


def _lost(c: str, kind: T.DataType) -> Column:
    return F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull()


def rejects(df: DataFrame, schema: T.StructType, key_cols: Sequence[str]) -> DataFrame:
    """The values that ``conform`` turns into null, a row for each: the key
    columns, ``column_name``, ``declared`` and the ``value`` as text.  A map over
    the rows; what it finds can be written beside the conformed table."""
    found = {f.name: f.dataType for f in df.schema}
    retyped = [f for f in schema.fields if f.name in found and found[f.name] != f.dataType]
    if not retyped:
        return df.limit(0).select(*key_cols, F.lit("").alias("column_name"), F.lit("").alias("declared"), F.lit("").alias("value"))
    each = F.array(*(F.when(_lost(f.name, f.dataType), F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("declared"),
                                                                F.col(f"`{f.name}`").cast("string").alias("value"))) for f in retyped))
    return df.select(*key_cols, F.explode(each).alias("_x")).filter(F.col("_x").isNotNull()).select(*key_cols, "_x.*")


def write_table(df: DataFrame, target: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), fmt: str = "parquet",
                as_table: bool | None = None) -> str:
    """Write once (``overwrite`` or ``append``) and return the target.
    ``target`` is a path if it contains '/', else a catalog table name.
    (Row counts come from ``verify_persisted``: in Spark 4.1 an
    ``Observation`` on the session breaks later ML transforms.)"""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table if as_table is not None else "/" not in target:
        w.saveAsTable(target)
    else:
        w.save(target)
    return target


def write_batches(df: DataFrame, target: str, batch_col: str = "batch_id", fmt: str = "parquet") -> str:
    """An incremental load that can be repeated: each batch is a partition of the
    target, and the batches in ``df`` replace what the target has of them;
    others stay.  A run that failed half-way is run again as it was.  Batches
    without rows are not in ``df`` and so not replaced: see ``drop_batch``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch_col).format(fmt).save(target)
    return target


def drop_batch(spark: SparkSession, target: str, batch, batch_col: str = "batch_id") -> bool:
    """Delete one batch of ``write_batches``; whether there was one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{batch_col}={batch}")
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))


def content_digest(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, hash_xor, hash_sum)`` that does not depend on the order
    of rows or columns.  A row's hash covers names, nulls and values; repeated
    rows cancel out in the xor but not in the sum.  Maps and variants count by
    their JSON text.  One aggregate pass."""
    cols = sorted(df.columns)
    kind = {f.name: f.dataType for f in df.schema}
    value = lambda c: F.to_json(F.struct(F.col(f"`{c}`"))) if isinstance(kind[c], (T.MapType, T.VariantType)) else F.col(f"`{c}`")
    h = F.xxhash64(*(x for c in cols for x in (F.lit(c), F.col(f"`{c}`").isNull(), value(c))))
    return df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), F.expr("bit_xor(h)").alias("hash_xor"), F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"))


def verify_persisted(spark: SparkSession, target: str, source: DataFrame,
                     fmt: str = "parquet") -> DataFrame:
    """One row: rows in the source, rows read back from the target, and
    whether their contents agree (``content_digest``; a changed cell shows).
    The source is read as it is: pass one that was written or read from files,
    or write with ``write_verified``, which runs the source's plan once."""
    back = content_digest(read_table(spark, target, fmt).select(*(F.col(f"`{c}`") for c in source.columns)))
    src = content_digest(source).first()  # three numbers
    same = F.lit(True)
    for c in ("n_rows", "hash_xor", "hash_sum"):
        same = same & F.col(c).eqNullSafe(F.lit(src[c]))
    return back.select(F.lit(src["n_rows"]).cast("bigint").alias("rows_written"), F.col("n_rows").alias("rows_read"), same.alias("matches"))


def write_verified(df: DataFrame, target: str, **options) -> DataFrame:
    """``write_table``, then ``verify_persisted`` against the very rows that were
    meant to be written: the plan of ``df`` runs once, into scratch files."""
    once = cut_lineage(df, "to-write")
    write_table(once, target, **options)
    return verify_persisted(df.sparkSession, target, once, options.get("fmt", "parquet"))


def use_namespace(spark: SparkSession, database: str, location: str | None = None) -> str:
    """Create the database if needed, make it current, return its name."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    spark.catalog.setCurrentDatabase(database)
    return spark.catalog.currentDatabase()


def schema_report(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type, non-null count; one aggregate pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"),
                     F.col(f"`{c}`").alias("non_null")) for c in df.columns]
    return wide.select(F.inline(F.array(*rows)))


def write_splits(df: DataFrame, target: str, split_col: str = "split",
                 mode: str = "overwrite") -> DataFrame:
    """One write of all splits, partitioned by ``split_col`` (readers of one
    split prune the others).  Returns rows per split as read back."""
    write_table(df, target, mode=mode, partition_by=[split_col], as_table="/" not in target)
    back = read_table(df.sparkSession, target)
    return back.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
