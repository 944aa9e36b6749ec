"""The three flows, each one planned DataFrame and one writing action.

* A — places:  landed ``{"results":[…]}`` → flatten → project → required
  columns → audit columns → conform → guarded append.
* B — reviews: landed ``{"data":[{…,"reviews":[…]}]}`` → two-level flatten →
  audit columns → conform → guarded append; and the landing side: attach
  details → defaults → top up → nest → JSON documents.
* C — labels:  reviews table → still-unlabelled rows → scorer → one row per
  author id → conform → guarded append.

``*_frame`` builds the plan (testable, lazy); ``load_*`` runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow import schemas as S
from reviewflow.functions import exprs as X
from reviewflow.operators import clean as C
from reviewflow.operators import flatten as FL
from reviewflow.operators import sentiment as SE
from reviewflow.sinks.tables import guarded_append_rows, observed, target_exists
from reviewflow.sources.landing import landed_file_count, scan_landing

PLACE_REQUIRED = ["name", "rating", "address", "latitude", "longitude"]


# ------------------------------------------------------------------ flow A

def places_frame(docs: DataFrame, load_ts, counts: dict | None = None) -> DataFrame:
    """Flow A plan: place documents → one row per place (A1, P2, A3) → rows with name, rating,
    address and coordinates present, NaN counting as missing (P4) → load time (P6) → the list
    table's types, with an ``_errors`` column (K3)."""
    flat = _counted(FL.flatten_places(docs), counts, "read")
    flat = C.require(flat, PLACE_REQUIRED)
    flat = C.with_audit(flat, load_ts)
    return C.conform_to_schema(flat, S.HOSPITAL_LISTS)


CORRUPT_COL = "_corrupt_record"


def _scan_counted(spark: SparkSession, path, schema, multi_line: bool):
    """Landed documents plus an observation counting malformed ones (read on the writing job)."""
    from pyspark.sql import Observation

    docs = scan_landing(spark, path, schema, multi_line=multi_line, corrupt_col=CORRUPT_COL)
    obs = Observation("landing")
    docs = docs.observe(obs, F.count(F.col(CORRUPT_COL)).alias("corrupt_documents"))
    return docs.drop(CORRUPT_COL), {"landing": obs}


class RejectedRows(ValueError):
    """Rows do not fit the target and no ``rejects_path`` says where they go; nothing was appended."""

    def __init__(self, counts: dict):
        super().__init__(f"{counts['rejected']} rows do not fit the target; give a rejects_path, nothing was appended: {counts}")
        self.counts = counts


def _counted(df: DataFrame, counts: dict | None, name: str) -> DataFrame:
    """``df``, its rows counted by the job that reads it; the observation goes to ``counts``."""
    if counts is None:
        return df
    from pyspark.sql import Observation

    counts[name] = Observation(name)
    return df.observe(counts[name], F.count(F.lit(1)).alias(name))


def _append_with_rejects(conformed: DataFrame, table: str, url, rejects_path: str | None, jdbc: dict,
                         counts: dict | None = None) -> dict:
    """Append the conforming rows; write the others to ``rejects_path`` (parquet).

    Every row read is accounted for.  The conformed rows are staged once as
    Parquet below the shared checkpoint folder: that job counts what was
    read, dropped and kept (``counts``: observations by name), both outputs
    read the stage, and a failed append can be retried from it.  Rows that do
    not fit fail the load before anything is appended unless there is a
    rejects path.  Without the target table nothing is read.
    """
    from reviewflow.session import scratch_path

    spark = conformed.sparkSession
    if not target_exists(spark, table, url, **jdbc):
        print(f"target table {table} does not exist; load skipped")
        return {"written": False, "rows": 0}
    from pyspark.sql import Observation

    stage, seen = scratch_path(spark, "conformed-stage"), Observation("conformed")
    bad = F.col("_errors") != ""
    conformed.observe(seen, F.count(F.lit(1)).alias("conformed"), F.count(F.when(bad, 1)).alias("rejected")) \
        .write.mode("overwrite").parquet(stage)
    out = {k: int(v or 0) for k, v in seen.get.items()}
    for obs in (counts or {}).values():
        out |= {k: int(v or 0) for k, v in obs.get.items()}
    if out["rejected"] and not rejects_path:
        raise RejectedRows(out)
    good, rejects = C.split_conformed(spark.read.schema(conformed.schema).parquet(stage))
    if rejects_path:
        rejects.write.mode("append").parquet(rejects_path)
    rows = guarded_append_rows(good, table, url, **jdbc)
    return {"written": rows is not None, "rows": rows or 0, **out}


def load_places(spark: SparkSession, path, load_ts=None, table: str = S.HOSPITAL_LISTS.name,
                url: str | None = None, multi_line: bool = False, rejects_path: str | None = None,
                **jdbc) -> dict:
    """Flow A job.  ``multi_line=True`` for pretty-printed single documents per file
    (the source's landing); the default reads JSON Lines (this library's landing)."""
    docs, counts = _scan_counted(spark, path, S.PLACES_DOCUMENT, multi_line)
    out = _append_with_rejects(places_frame(docs, load_ts, counts), table, url, rejects_path, jdbc, counts)
    if out["written"]:
        out["missing_required"] = out["read"] - out["conformed"]
    return {"files": landed_file_count(docs), **out}


# ------------------------------------------------------------------ flow B

# Narrow read schema for the review loader: the fields the table needs.
REVIEW_READ_SCHEMA = S.narrow(S.REVIEWS_DOCUMENT, {"first_review": True, "data": {
    "name": True, "formatted_address": True, "place_id": True, "rating": True,
    "reviews": {k: True for k in ("author_name", "author_url", "language", "original_language",
                                  "profile_photo_url", "rating", "relative_time_description", "text",
                                  "time", "translated")}}})


def reviews_frame(docs: DataFrame, load_ts, counts: dict | None = None) -> DataFrame:
    """Flow B plan: review documents → one row per review with its hospital's columns (A2),
    author id (F1), timestamp and 0/1 flag (F2, F3) → load time and an empty sentiment (P6)
    → the reviews table's types, with an ``_errors`` column (K3)."""
    flat = _counted(FL.flatten_reviews(docs), counts, "read")
    flat = C.with_audit(flat, load_ts, constants={"sentiments": ""})
    return C.conform_to_schema(flat, S.HOSPITAL_REVIEWS)


def load_reviews(spark: SparkSession, path, load_ts=None, table: str = S.HOSPITAL_REVIEWS.name,
                 url: str | None = None, multi_line: bool = False, rejects_path: str | None = None,
                 **jdbc) -> dict:
    """Flow B job (see ``load_places`` for ``multi_line``)."""
    docs, counts = _scan_counted(spark, path, REVIEW_READ_SCHEMA, multi_line)
    out = _append_with_rejects(reviews_frame(docs, load_ts, counts), table, url, rejects_path, jdbc, counts)
    return {"files": landed_file_count(docs), **out}


# ------------------------------------------------------- loads by ledger

def _load_new(spark: SparkSession, path, ledger, target: str, schema, frame_of, load_ts, multi_line: bool, rejects_path: str | None) -> dict:
    """Load the landed files that no finished load took, each load exactly once.

    A load that was begun and not finished comes first, with just its files.
    The conformed rows, and with them the run's counts, are staged in the
    ledger; rejects go to a folder named by the load, so a run again replaces
    them.  Without the target nothing is taken.
    """
    import os

    from pyspark.sql import Observation

    if not target_exists(spark, target):
        ledger.append_once(spark.createDataFrame([], "x int"), target, "none")
        return {"loads": 0, "files": 0, "rows": 0}
    fresh = ledger.take(ledger.new_files(path, target), target)
    total = {"loads": 0, "files": 0, "rows": 0}
    for load_id in [*[x for x in ledger.pending(target) if x != fresh], *([fresh] if fresh else [])]:
        files = ledger.taken(load_id)
        docs = scan_landing(spark, files, schema, multi_line=multi_line, corrupt_col=CORRUPT_COL)
        seen, counts = Observation(), {}
        docs = docs.observe(seen, F.count(F.col(CORRUPT_COL)).alias("corrupt_documents")).drop(CORRUPT_COL)
        conformed = ledger.staged(frame_of(docs, load_ts, counts), load_id, f"{target}-conformed")
        reasons = {f"rejected {r.reason}": r.n_rows for r in C.reject_reasons(conformed).collect() if r.reason != "fits"}   # one row a column
        good, rejects = C.split_conformed(conformed)
        n_rejected = conformed.where("_errors <> ''").count() if reasons else 0
        first = ledger.state(load_id, target)
        if first:                       # the run before this one counted while it staged
            found = first["counts"]
        else:
            found = {"files": len(files), "rejected": n_rejected, **reasons}
            if ledger.fresh_stage:      # this run staged, so its observations are filled
                for obs in (seen, *counts.values()):
                    found |= {k: int(v or 0) for k, v in obs.get.items()}
        if n_rejected and not rejects_path:
            raise RejectedRows(found)
        if rejects_path and n_rejected:
            rejects.write.mode("overwrite").parquet(os.path.join(rejects_path, f"load={load_id}"))
        done = ledger.append_once(good, target, load_id, found, staged=True)
        total = {"loads": total["loads"] + 1, "files": total["files"] + len(files), "rows": total["rows"] + done["rows"]}
    return total


def load_new_places(spark: SparkSession, path, ledger, load_ts=None, table: str = S.HOSPITAL_LISTS.name, multi_line: bool = False,
                    rejects_path: str | None = None) -> dict:
    """Flow A into a catalog table, by ledger: {loads, files, rows}; run again, it loads what came since, mostly nothing."""
    return _load_new(spark, path, ledger, table, S.PLACES_DOCUMENT, places_frame, load_ts, multi_line, rejects_path)


def load_new_reviews(spark: SparkSession, path, ledger, load_ts=None, table: str = S.HOSPITAL_REVIEWS.name, multi_line: bool = False,
                     rejects_path: str | None = None) -> dict:
    """Flow B into a catalog table, by ledger (see ``load_new_places``)."""
    return _load_new(spark, path, ledger, table, REVIEW_READ_SCHEMA, reviews_frame, load_ts, multi_line, rejects_path)


def review_defaults() -> dict:
    """Defaults the extraction applied to missing fields."""
    return {"formatted_address": K.DEFAULT_ADDRESS}


def child_defaults() -> dict:
    return {"original_language": K.DEFAULT_ORIGINAL_LANGUAGE, "translated": False}


# ------------------------------------------------------------------ flow C

# Columns a labelled row carries beside the target's own; appended where the target has them.
LINEAGE = ["place_id", "method", "loaddatetime"]


def label_frame(reviews: DataFrame, scorer=None, native: bool = True, skip_labelled: bool = True,
                spec: S.TableSpec = S.SCORE_SENTIMENT, variant: str = "score", load_ts=None,
                existing: DataFrame | None = None, counts: dict | None = None) -> DataFrame:
    """Label reviews; one row per author id, conformed to ``spec`` (with ``_errors`` and ``LINEAGE``).

    Rows to label are found first — still unlabelled, with a key, the first
    per key by review text and then all other columns, the key not among
    ``existing`` — and only those are scored.

    ``variant="score"``: score → (label at ±0.25, score); only still-unlabelled
    rows by default.  ``native=True`` scores with the Catalyst lexicon (no
    Python worker); otherwise ``scorer`` runs as an Arrow-batched pandas UDF.
    ``variant="model"``: a classifier's argmax label (blank text → ''), over
    every row unless ``skip_labelled``; ``scorer`` is the classifier (a
    pandas UDF), or the native lexicon classifier when none is given.
    ``counts`` receives the observations read, with_key, authors and new.
    """
    key = ["author_id"]
    if "sentiments" in reviews.columns:         # the reviews table's own name for it
        reviews = reviews.withColumnRenamed("sentiments", "sentiment")
    todo = C.only_unlabelled(reviews, "sentiment") if skip_labelled else reviews
    todo = _counted(todo.drop("sentiment", "loaddatetime", "method"), counts, "read")
    todo = _counted(C.require(todo, key), counts, "with_key")
    rest = [c for c in ("review", "author_name", "hospital_name", "address", "place_id", "hospital_rating") if c in todo.columns]
    todo = todo.select(*key, *rest)
    todo = _counted(C.dedup_on_key(todo, key, [F.col(c).asc_nulls_last() for c in rest]), counts, "authors")
    if existing is not None:
        todo = todo.join(existing, key, "left_anti")
    todo = _counted(todo, counts, "new")
    native = native and scorer is None
    if variant == "model":
        scored = SE.lexicon_classify(todo, "review") if native else SE.label_text(todo, "review", scorer)
    elif native:
        scored = SE.lexicon_score(todo, "review", prefix="__")
        scored = scored.withColumns({"sentiment": F.col("__label"),
                                     "sentiment_score": F.col("__score").cast("float")})
        scored = scored.drop("__n_pos", "__n_neg", "__score", "__label")
    else:
        scored = SE.score_text(todo, "review", scorer)
    if "place_id" not in scored.columns:
        scored = scored.withColumn("place_id", F.lit(None).cast("string"))
    scored = C.with_audit(scored, load_ts, constants={"method": "lexicon" if native else type(scorer).__name__})
    return C.conform_to_schema(scored, spec, keep=LINEAGE)


REVIEW_SOURCE_COLUMNS = ["hospital_name", "address", "place_id", "hospital_rating", "author_name", "author_id",
                             "review", "sentiments"]


def label_reviews(spark: SparkSession, source_table: str, target_table: str | None = None,
                  scorer=None, url: str | None = None, variant: str = "score", rejects_path: str | None = None,
                  partition_column: str | None = None, read_partitions: int = 64, only_new_keys: bool = True,
                  load_ts=None, **jdbc) -> dict:
    """Flow C job: read the reviews table, label, append to the sentiment table if it exists.

    With ``url`` both tables are JDBC tables; the source read is projected to
    the needed columns, the unlabelled filter is pushed into the database,
    and ``partition_column`` (numeric or date) splits the read into
    ``read_partitions`` range queries instead of one.

    Returns the run's counts: rows read, without key, repeated keys, keys
    already stored, rejected and appended; they add up.

    ``only_new_keys``: the target is keyed by author id, so rows whose key is
    already there are left out (a left-anti join on the key column only),
    which makes a re-run append nothing twice.
    """
    from reviewflow.sources.jdbc import read_table, read_table_partitioned

    spec = S.MODEL_SENTIMENT if variant == "model" else S.SCORE_SENTIMENT
    creds = {k: jdbc.get(k) for k in ("user", "password", "driver")}
    if url and partition_column:
        reviews = read_table_partitioned(spark, source_table, partition_column, REVIEW_SOURCE_COLUMNS, url,
                                         num_partitions=read_partitions, **creds)
    elif url:
        reviews = read_table(spark, source_table, REVIEW_SOURCE_COLUMNS, url, **creds)
    else:
        reviews = spark.table(source_table)
    target = target_table or spec.name
    existing, counts = None, {}
    if only_new_keys and spec.primary_key:
        if url:
            from reviewflow.sources.jdbc import jdbc_table_exists
            if jdbc_table_exists(spark, target, url, **creds):
                existing = read_table(spark, target, list(spec.primary_key), url, **creds)
        elif spark.catalog.tableExists(target):
            existing = spark.table(target).select(*spec.primary_key)
    frame = label_frame(reviews, scorer, native=scorer is None, skip_labelled=variant != "model", spec=spec,
                        variant=variant, load_ts=load_ts, existing=existing, counts=counts)
    if url:         # a database table refuses columns it does not have
        frame = frame.select(*spec.column_names, "_errors")
    out = _append_with_rejects(frame, target, url, rejects_path, jdbc, counts)
    if out["written"]:
        out |= {"null_keys": out["read"] - out["with_key"], "repeated_keys": out["with_key"] - out["authors"],
                "already_stored": out["authors"] - out["new"]}
    return out


# ------------------------------------------------------ landing (extraction)

REVIEW_CHILD_COLUMNS = ["author_name", "author_url", "language", "original_language", "profile_photo_url", "rating",
                        "relative_time_description", "text", "time", "translated", "review_type", "date"]


def land_reviews_frame(places: DataFrame, details: DataFrame, key: str = "place_id",
                       limit: int = K.REAL_REVIEWS_LIMIT, min_count: int = K.MIN_REVIEWS_PER_HOSPITAL,
                       salt: str = "land") -> DataFrame:
    """Flow B landing side, flat: one row per (place, review position).

    Successful details are attached (failed or missing ones drop the place),
    the first ``limit`` reviews kept, every place padded to ``min_count``
    reviews with generated ones, and missing fields defaulted.  After the
    attach join (one shuffle on the key) everything is a generator and a
    projection, and the rows stay partitioned by the key.  The place's own
    columns are repeated on every row (its rating should be called
    ``hospital_rating``).
    """
    from reviewflow.operators import assemble as AS
    from reviewflow.operators import augment as AU

    places = C.with_defaults(places, {k: v for k, v in review_defaults().items() if k in places.columns})
    attached = AS.attach_details(places, details, key=key, limit=limit)
    parent_cols = [c for c in attached.columns if c not in (key, "reviews")]
    fanout = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flat = AU.pad_children(attached, "reviews", [key], keep=parent_cols, min_count=min_count, salt=salt,
                           fanout_partitions=fanout)
    flat = C.with_defaults(flat, {k: v for k, v in child_defaults().items() if k in flat.columns})
    # fetched reviews are tagged 'real' and dated from their epoch ('N/A' when NULL or 0)
    tags = {}
    if "review_type" in flat.columns:
        tags["review_type"] = F.coalesce(F.col("review_type"), F.lit(K.REAL_REVIEW_TYPE))
    if "date" in flat.columns and "time" in flat.columns:
        tags["date"] = F.coalesce(F.col("date"), X.epoch_date("time"))
    return flat.withColumns(tags) if tags else flat


def review_documents_frame(flat: DataFrame, city: str = "city", key="place_id",
                           min_count: int = K.MIN_REVIEWS_PER_HOSPITAL,
                           disclaimer: str = K.DEFAULT_DISCLAIMER, spread: bool = False) -> DataFrame:
    """Nest ``land_reviews_frame`` rows back into landed review documents, one per place:
    ``{"disclaimer":…, "data":[hospital]}`` plus ``city_slug``.

    The rows are already partitioned by the key and each place holds a
    bounded number of reviews, so the nesting reuses that partitioning
    (``spread=False``) instead of shuffling again.
    """
    from reviewflow.functions import exprs as X

    keys = [key] if isinstance(key, str) else list(key)
    fields = [c for c in REVIEW_CHILD_COLUMNS if c in flat.columns]
    carry = [c for c in (city, "name", "formatted_address", "place_id", "hospital_rating", "user_ratings_total")
             if c in flat.columns and c not in keys]
    size = max(min_count, FL.DEFAULT_CHUNK)
    nested = FL.nest_children(flat, keys, "pos", fields, array_name="reviews", chunk_size=size, carry=carry, spread=spread)
    cols = set(nested.columns)
    parts = [F.col(c) for c in ("name", "formatted_address", "place_id") if c in cols]
    if "hospital_rating" in cols:
        parts.append(F.col("hospital_rating").alias("rating"))
    if "user_ratings_total" in cols:
        parts.append(F.col("user_ratings_total"))
    hospital = F.struct(*parts, F.col("reviews"))
    slug = X.slug(city) if city in cols else F.lit(None).cast("string")
    return nested.select(slug.alias("city_slug"), F.lit(disclaimer).alias("disclaimer"),
                         (F.col("chunk") * F.lit(size)).cast("int").alias(FL.FIRST_CHILD), F.array(hospital).alias("data"))


def land_places_frame(pages: DataFrame, city: str = "city", request: str = "request_id") -> DataFrame:
    """Flow A landing side: assemble raw pages (follow tokens, stop at the first
    bad page) into ``{"results":[…]}`` documents, one per kept page with results.

    A page's array is landed as it is, so its order needs no position and
    nothing is exploded, nested or shuffled for it; the city rides on the page.
    """
    from reviewflow.functions import exprs as X
    from reviewflow.operators import assemble as AS

    keep_city = [city] if city in pages.columns else []
    docs = AS.kept_pages(pages, request=request, carry=keep_city).filter(F.size("results") > 0)
    return docs.withColumn("city_slug", X.slug(city)) if keep_city else docs


def _observe_totals(flat: DataFrame):
    """G2 on the writing job: reviews = flat rows, hospitals = rows at position 0."""
    from pyspark.sql import Observation

    obs = Observation("totals")
    return flat.observe(obs, F.count(F.lit(1)).alias("total_reviews"),
                        F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("total_hospitals")), obs


def land_reviews(spark: SparkSession, places: DataFrame, details: DataFrame, out_path: str,
                 city: str = "city", **kw) -> dict:
    """Extract job: attach details, pad, nest and write review documents (JSON Lines, folder per city).
    Re-running replaces the cities it writes (dynamic partition overwrite)."""
    from reviewflow.sinks.envelope import write_envelope

    flat, obs = _observe_totals(land_reviews_frame(places, details, **kw))
    docs = review_documents_frame(flat, city=city)
    write_envelope(docs, out_path, partition_col="city_slug", root="data", keep=[FL.FIRST_CHILD],
                   constants={"disclaimer": K.DEFAULT_DISCLAIMER}, mode="overwrite")
    return {k: int(v or 0) for k, v in obs.get.items()}


def land_synthetic(spark: SparkSession, cities: DataFrame, out_path: str, city: str = "city",
                   per_city: int = K.SYNTHETIC_HOSPITALS_PER_CITY,
                   reviews_per_hospital: int = K.MIN_REVIEWS_PER_HOSPITAL) -> dict:
    """Extract job without an API: synthetic hospitals per city, landed as review documents.

    Synthetic hospitals have no place id, so documents are keyed by (city,
    hospital number); generation is spread over the cluster before the
    ``reviews_per_hospital``-fold fan-out.
    """
    from reviewflow.operators import augment as AU
    from reviewflow.sinks.envelope import write_envelope

    flat = AU.generate_hospitals(cities, city, per_city, reviews_per_hospital).withColumnRenamed("review_no", "pos")
    flat, obs = _observe_totals(flat)
    docs = review_documents_frame(flat, city=city, key=[city, "hospital_no"], min_count=reviews_per_hospital,
                                  spread=True)
    write_envelope(docs, out_path, partition_col="city_slug", root="data", keep=[FL.FIRST_CHILD],
                   constants={"disclaimer": K.DEFAULT_DISCLAIMER}, mode="overwrite")
    return {k: int(v or 0) for k, v in obs.get.items()}


def land_places(spark: SparkSession, pages: DataFrame, out_path: str, city: str = "city", load_ts=None,
                request: str = "request_id") -> dict:
    """Extract job: assemble raw pages and write place documents (JSON Lines), one folder per landing.

    The folder is named by the landing's time, below it one folder per city,
    so earlier landings stay; a re-run with the same ``load_ts`` replaces its
    own landing.  Returns the number of requests by outcome (ok, empty,
    failed) and of documents and places written.
    """
    from pyspark.sql import Observation

    from reviewflow.operators import assemble as AS
    from reviewflow.sinks.envelope import landing_folder, write_envelope

    outcomes = {r["outcome"]: r["n"] for r in AS.request_outcomes(pages, request=request)
                .groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}         # three rows
    seen = Observation("landing")
    docs = land_places_frame(pages, city=city, request=request)
    part = "city_slug" if "city_slug" in docs.columns else None
    docs = docs.observe(seen, F.count(F.lit(1)).alias("documents"), F.sum(F.size("results")).alias("places"))
    folder = landing_folder(out_path, load_ts)
    write_envelope(docs, folder, partition_col=part, root="results", mode="overwrite")
    return {"path": folder, **{f"requests_{k}": int(outcomes.get(k, 0)) for k in ("ok", "empty", "failed")},
            **{k: int(v or 0) for k, v in seen.get.items()}}
