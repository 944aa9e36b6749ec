"""Landing documents as JSON.

Documents are written as JSON Lines: one compact document per line, files
ending in ``.json``, partitioned into one folder per city slug.  Every line
is a complete ``{"disclaimer":…, "data":[…]}`` (or ``{"results":[…]}``)
document of bounded size, so landing and re-reading both split across
tasks; a city is a folder, not one unbounded document.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions import exprs as X


def landing_name(city, ts, folder: str | None = None, kind: str = "reviews") -> Column:
    """Object name for a city: reviews '<slug>_hospital_reviews.json' (lower-case slug),
    lists 'hospitals_in_<City_Slug>_<yyyyMMdd_HHmmss>.json' (case kept); optional folder."""
    if kind == "reviews":
        name = F.concat(X.slug(city), F.lit("_hospital_reviews.json"))
    else:
        name = F.concat(F.lit("hospitals_in_"), X.slug(city, lower=False), F.lit("_"), X.compact_time_text(ts),
                        F.lit(".json"))
    return F.concat(F.lit(folder.rstrip("/") + "/"), name) if folder else name


def landing_folder(path: str, ts=None) -> str:
    """Folder of one landing below ``path``, named by its time as the list objects are (yyyyMMdd_HHmmss)."""
    if ts is None:
        ts = datetime.now()
    if isinstance(ts, str):
        ts = datetime.fromisoformat(ts)
    return f"{path.rstrip('/')}/landed_{ts.strftime('%Y%m%d_%H%M%S')}"


def write_envelope(docs: DataFrame, path: str, partition_col: str | None = "city_slug",
                   root: str = "data", constants: dict | None = None, mode: str = "append",
                   rebalance: bool = True, keep: list | None = None) -> None:
    """Write documents (one row each, holding the ``root`` array) to any Hadoop path.

    ``constants`` become top-level document fields (e.g. a disclaimer), and
    so do the ``keep`` columns.
    NULL fields are written as ``null`` so the shape of every record is
    complete.  The path can be local (``file:``) or any shared file system.

    ``mode="overwrite"`` with a partition column replaces only the cities
    being written (dynamic partition overwrite), so re-running a landing job
    is idempotent; a failed job commits nothing.

    ``rebalance``: documents arrive scattered by place, so every task would
    write a file into every city folder.  A REBALANCE on the city groups a
    city's documents into few, advisory-sized files, and AQE splits a city
    that is too big for one task instead of funnelling it into one.
    """
    fields = [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    cols = fields + [F.col(c) for c in keep or [] if c in docs.columns] + [F.col(root)]
    if partition_col:
        cols.append(F.col(partition_col))
    out = docs.select(*cols)
    if partition_col and rebalance:
        out = out.hint("rebalance", partition_col)
    w = out.write.mode(mode).option("ignoreNullFields", "false")
    if partition_col and mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.json(path)


def write_single_documents(docs: DataFrame, path: str, document, partition_col: str | None = None, mode: str = "overwrite") -> None:
    """S8 in the source's form: every row one indented JSON document in a file of its own (read back with ``multi_line=True``).

    ``document``: the struct column to write.  For documents of bounded size
    and a bounded number of files; landings at scale use ``write_envelope``.
    """
    from reviewflow.operators.flatten import to_json_text

    keep = [partition_col] if partition_col else []
    out = docs.select(to_json_text(document, pretty=True).alias("value"), *keep).write.mode(mode).option("maxRecordsPerFile", 1)
    (out.partitionBy(*keep) if keep else out).text(path)
