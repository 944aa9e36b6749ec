"""Row rules and table contracts.

Everything here is a projection, a filter or a bounded window: no rule ever
moves a whole group to one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewflow.functions import exprs as X
from reviewflow.schemas import TableSpec


def require(df: DataFrame, cols: list) -> DataFrame:
    """Drop rows where any required column is NULL (or NaN for floating types).

    Same rows as ``dropna(how="any", subset=cols)``, written as plain
    ``IS NOT NULL`` / ``NOT isnan`` predicates: Catalyst folds them away for
    columns that can never be NULL, and pushes the rest to the scan.
    (``dropna``'s AtLeastNNonNulls is opaque: pushed below a projection it
    drags the projected expressions along and evaluates them twice.)
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if isinstance(types.get(c), (T.FloatType, T.DoubleType)):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill NULL (missing or JSON null) values with a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_element_defaults(df: DataFrame, array_col: str, defaults: dict) -> DataFrame:
    """P8 inside an array<struct>: fill NULL fields of every element (no explode)."""
    fields = set(df.schema[array_col].dataType.elementType.fieldNames())
    todo = {k: v for k, v in defaults.items() if k in fields}
    if not todo:
        return df

    def fill(x):
        for k, v in todo.items():
            x = x.withField(k, F.coalesce(x[k], F.lit(v)))
        return x
    return df.withColumn(array_col, F.transform(array_col, fill))


def only_unlabelled(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """P5: rows still to label — label NULL or empty.  Pushes into parquet/JDBC scans."""
    c = F.col(col)
    return df.filter(c.isNull() | (c == F.lit("")))


def with_audit(df: DataFrame, load_ts: str | datetime | None = None, ts_col: str = "loaddatetime",
               constants: dict | None = None) -> DataFrame:
    """One load time chosen once per run (passed in, so repeatable), plus literal columns."""
    if load_ts is None:
        load_ts = datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(load_ts, datetime):
        load_ts = load_ts.strftime("%Y-%m-%d %H:%M:%S")
    cols = {ts_col: F.to_timestamp(F.lit(load_ts))}
    for k, v in (constants or {}).items():
        cols[k] = v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(cols)


def dedup_on_key(df: DataFrame, key: list, order: list) -> DataFrame:
    """K1: keep the first row per key under ``order`` (repeatable, unlike dropDuplicates).

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit below
    the shuffle, so every map task forwards at most one row per key: a key
    holding a third of the rows costs one row per map task after the shuffle.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_n_per_key(df: DataFrame, key: list, order: list, n: int, rank_col: str | None = None) -> DataFrame:
    """L1 on flat rows: the first ``n`` rows per key (partial top-n before the shuffle).

    ``rank_col`` keeps the 0-based position among the kept rows.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    if rank_col:
        return out.withColumn(rank_col, F.col("__rn") - 1).drop("__rn")
    return out.drop("__rn")


def author_collisions(df: DataFrame, name: str = "author_name") -> DataFrame:
    """F1 audit: author ids that unlike names share: author_id, n_rows, first_name, last_name, n_names >= 2.

    The id has 32 bits, so among tens of thousands of authors some share one,
    and K1 would take their reviews for repeats.  Every name has a 128-bit
    shadow key; an id whose smallest and greatest shadow differ has unlike
    names.  Both are combined before the shuffle; names are counted only for
    the ids found.  A missing name is hashed as such and is a name of its own.
    """
    shadow = F.coalesce(F.md5(F.col(name)), F.lit(""))
    rows = df.select(X.author_id(name).alias("author_id"), F.col(name).alias("__name"), shadow.alias("__shadow"))
    shared = (rows.groupBy("author_id").agg(F.min("__shadow").alias("__lo"), F.max("__shadow").alias("__hi")).filter("__lo < __hi")
              .select("author_id"))
    names = rows.join(shared, "author_id").groupBy("author_id", "__shadow").agg(F.count(F.lit(1)).alias("n"), F.min("__name").alias("__name"))
    return names.groupBy("author_id").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_names"),
                                          F.min("__name").alias("first_name"), F.max("__name").alias("last_name"))


# -------------------------------------------------------------- conformance

_FLOAT_MAX = 3.4028234663852886e38
_TEXT_BYTES = 65_535


def _check(c: Column, col) -> tuple[Column, Column]:
    """(converted value, violation flag) for one target column."""
    base = col.sql.split("(")[0].lower()
    target = col.spark_type
    if base in ("text", "varchar"):
        v = c.cast("string")
        bad = F.lit(False)
        if col.max_length is not None:
            bad = F.coalesce(F.length(v) > F.lit(col.max_length), F.lit(False))
        else:
            bad = F.coalesce(F.octet_length(v) > F.lit(_TEXT_BYTES), F.lit(False))
    elif base == "float":
        d = c.try_cast("double")
        v = d.cast("float")
        bad = (c.isNotNull() & d.isNull()) | F.coalesce(F.isnan(d) | (F.abs(d) > F.lit(_FLOAT_MAX)), F.lit(False))
    elif base == "double":
        v = c.try_cast("double")
        bad = (c.isNotNull() & v.isNull()) | F.coalesce(F.isnan(v), F.lit(False))
    elif base == "datetime":
        v = c.try_cast("timestamp")
        bad = c.isNotNull() & v.isNull()
    else:
        v = c.try_cast(target)
        bad = c.isNotNull() & v.isNull()
    if not col.nullable:
        bad = bad | c.isNull()
    return v, bad


def conform_to_schema(df: DataFrame, spec: TableSpec, errors_col: str = "_errors",
                      keep: list | None = None) -> DataFrame:
    """K3: cast every column to the target type and flag rows that would not fit.

    Returns the target columns (converted) plus ``_errors``: the names of the
    violating columns, in table order ('' when the row fits).  Over-long
    VARCHAR, TEXT beyond 65,535 bytes, integer overflow (TINYINT/INT), float
    overflow, NaN, unparseable DATETIME and NULL in a NOT NULL column are
    violations.  Missing source
    columns are NULL.  ``keep`` columns pass through unchanged (e.g. lineage).
    """
    have = set(df.columns)
    vals, flags = [], []
    for col in spec.columns:
        src = F.col(col.name) if col.name in have else F.lit(None)
        v, bad = _check(src, col)
        vals.append(v.alias(col.name))
        flags.append(F.when(bad, F.lit(col.name)))
    return df.select(*vals, F.concat_ws(",", *flags).alias(errors_col), *(keep or []))


def split_conformed(conformed: DataFrame, errors_col: str = "_errors") -> tuple[DataFrame, DataFrame]:
    """(good rows without the flag column, bad rows with it)."""
    good = conformed.filter(F.col(errors_col) == "").drop(errors_col)
    bad = conformed.filter(F.col(errors_col) != "")
    return good, bad


def reject_reasons(conformed: DataFrame, errors_col: str = "_errors") -> DataFrame:
    """G1/K3: rows per violated column, and rows that fit (reason 'fits'); partially aggregated."""
    reason = F.explode(F.split(F.col(errors_col), ",")).alias("reason")
    return conformed.select(reason).groupBy(F.when(F.col("reason") == "", F.lit("fits")).otherwise(F.col("reason")).alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
