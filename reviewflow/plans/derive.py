"""Stand-ins: map the supplied tables onto the pipeline's data model.

The supplied tables are not hospital data, so each flow is fed from a table
with the same shape: a conversation is a hospital and its turns are its
reviews (parent with ordered children), customers are places, events carry
epochs, scores and ratings, documents carry review text.  Every stand-in is a
per-row expression over a whole table — no row is dropped or sampled — so
the work of each query grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.functions import exprs as X
from reviewflow.operators.flatten import DEFAULT_CHUNK, nest_children
from reviewflow.session import spread

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

REVIEW_FIELDS = ["author_name", "author_url", "language", "original_language", "profile_photo_url", "rating",
                 "relative_time_description", "text", "time", "translated", "review_type", "date"]
HOSPITAL_FIELDS = ["name", "formatted_address", "place_id", "rating", "user_ratings_total"]

# A fixed load time keeps query output repeatable (flows take it as an argument).
FIXED_LOAD_TS = "2025-01-01 00:00:00"
EPOCH_BASE = 1_700_000_000


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A supplied table; ``spread_rows`` for CPU-heavy per-row work (see ``session.spread``)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if spread_rows else df


def conversation_reviews(conv: DataFrame) -> DataFrame:
    """Flat review children: one per turn, with the hospital (conversation) columns."""
    epoch = F.lit(EPOCH_BASE) + F.col("conv_id") * 3600 + F.col("turn") * 60
    return conv.select(
        F.col("conv_id"),
        F.col("turn").alias("pos"),
        F.concat(F.lit("Hospital "), F.col("conv_id").cast("string")).alias("name"),
        F.concat(F.col("conv_id").cast("string"), F.lit(" Main Street")).alias("formatted_address"),
        F.concat(F.lit("place-"), F.col("conv_id").cast("string")).alias("place_id"),
        ((F.lit(10) + F.pmod(F.col("conv_id"), F.lit(41))) / F.lit(10.0)).alias("hospital_rating"),
        (F.col("conv_id") * 7 + 50).alias("user_ratings_total"),
        F.col("role").alias("author_name"),
        F.concat(F.lit("https://reviews.invalid/u/"), F.col("conv_id").cast("string"), F.lit("/"),
                 F.col("turn").cast("string")).alias("author_url"),
        F.lit(K.SYNTHETIC_LANGUAGE).alias("language"),
        F.when(F.col("role") != "system", F.lit(K.DEFAULT_ORIGINAL_LANGUAGE)).alias("original_language"),
        F.lit(None).cast("string").alias("profile_photo_url"),
        (F.pmod(F.length("text"), F.lit(5)) + 1).cast("long").alias("rating"),
        X.months_ago_text(F.col("turn") + 1).alias("relative_time_description"),
        F.col("text"),
        epoch.cast("long").alias("time"),
        (F.col("role") == "assistant").alias("translated"),
        F.lit(K.REAL_REVIEW_TYPE).alias("review_type"),
        X.epoch_date(epoch).alias("date"),
    )


def conversation_city() -> Column:
    return F.concat(F.lit("city_"), (F.col("conv_id") / 10).cast("long").cast("string"))


def review_documents(conv: DataFrame, chunk_size: int = DEFAULT_CHUNK, disclaimer: str = K.DEFAULT_DISCLAIMER) -> DataFrame:
    """Landed review documents built from conversations (A8 nest).

    One document per (hospital, chunk): ``{"disclaimer":…, "data":[hospital]}``
    with the hospital's reviews nested in turn order.
    """
    nested = nest_children(conversation_reviews(conv), keys=["conv_id"], pos="pos", fields=REVIEW_FIELDS,
                           array_name="reviews", chunk_size=chunk_size,
                           carry=["name", "formatted_address", "place_id", "hospital_rating", "user_ratings_total"])
    hospital = F.struct(F.col("name"), F.col("formatted_address"), F.col("place_id"),
                        F.col("hospital_rating").alias("rating"), F.col("user_ratings_total"), F.col("reviews"))
    return nested.select(
        conversation_city().alias("city"),
        F.col("conv_id"), F.col("chunk"), (F.col("chunk") * F.lit(chunk_size)).cast("int").alias("first_review"),
        F.lit(disclaimer).alias("disclaimer"),
        F.array(hospital).alias("data"),
    )


# ------------------------------------------------------------------- pages

def conversation_pages(conv: DataFrame) -> DataFrame:
    """Raw search pages: a conversation is one request, turn t is page t+1.

    Status, token and results follow from the turn's text: status
    INVALID_REQUEST when length % 7 = 0, ZERO_RESULTS when 1, else OK; no
    next-page token when length % 5 = 0; results are the text's lines
    (system turns have none).
    """
    n = F.length("text")
    return conv.select(
        F.concat(F.lit("req-"), F.col("conv_id").cast("string")).alias("request_id"),
        (F.col("turn") + 1).cast("int").alias("page_no"),
        F.when(F.pmod(n, F.lit(7)) == 0, F.lit("INVALID_REQUEST"))
         .when(F.pmod(n, F.lit(7)) == 1, F.lit("ZERO_RESULTS")).otherwise(F.lit("OK")).alias("status"),
        F.when(F.pmod(n, F.lit(5)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("-", F.lit("tok"), F.col("conv_id").cast("string"),
                                (F.col("turn") + 1).cast("string"))).alias("next_page_token"),
        F.when(F.col("role") == "system", F.array().cast("array<string>"))
         .otherwise(F.split(F.col("text"), "\n")).alias("results"),
    )


# ------------------------------------------------------------------ places

def customer_places(customer: DataFrame, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Landed place documents: customers nested per nation (``{"results":[place…]}``).

    Missing coordinates: latitude NaN for negative balances, longitude NULL
    for the HOUSEHOLD segment; ``types`` carries a NULL element.
    """
    place = customer.select(
        F.col("c_nationkey"), F.col("c_custkey").alias("pos"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("business_status"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Market Road")).alias("formatted_address"),
        F.struct(F.struct(
            F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal") / 100.0).alias("lat"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("double"))
             .otherwise(F.col("c_nationkey") * 1.5).alias("lng"),
        ).alias("location")).alias("geometry"),
        F.struct((F.col("c_acctbal") > 5000).alias("open_now")).alias("opening_hours"),
        (F.col("c_acctbal") / 2000.0).alias("rating"),
        F.col("c_custkey").alias("user_ratings_total"),
        F.array(F.lit("hospital"), F.lit(None).cast("string"), F.lower("c_mktsegment")).alias("types"),
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("place_id"),
    )
    fields = ["name", "business_status", "formatted_address", "geometry", "opening_hours", "rating",
              "user_ratings_total", "types", "place_id"]
    nested = nest_children(place, ["c_nationkey"], "pos", fields, array_name="results", chunk_size=chunk_size)
    return nested.select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("city"), "results")


# ----------------------------------------------------------------- details

def lineitem_details(lineitem: DataFrame, limit: int) -> DataFrame:
    """Place-detail rows: an order's first ``limit`` lines (by line number, part, supplier),
    nested in that order; the fetch counts as failed when every kept line was returned (R)."""
    from reviewflow.operators.clean import first_n_per_key

    top = first_n_per_key(lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], limit,
                          rank_col="pos")
    fields = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    nested = nest_children(top, ["l_orderkey"], "pos", fields, array_name="reviews", chunk_size=max(limit, 1),
                           spread=False)          # at most `limit` lines per order: reuse the window's partitioning
    return nested.select(
        F.col("l_orderkey").alias("place_id"),
        F.exists("reviews", lambda x: x["l_returnflag"] != "R").alias("ok"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
        "reviews",
    )


# ----------------------------------------------------------------- reviews

def label_sentiments(labels: DataFrame) -> DataFrame:
    """quality 1 → 'Positive' (done), quality 0 → '' (still to label)."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, F.lit("Positive"))
                         .when(F.col("quality") == 0, F.lit("")).alias("sentiment"))


def document_reviews(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A reviews table: a document is a review by 'author <doc_id>' of hospital '<source>';
    labelled documents carry a sentiment (quality 1 → Positive, 0 → '' i.e. still to do)."""
    d = documents.join(label_sentiments(labels), "doc_id", "left")
    return d.select(
        F.concat(F.lit("Hospital "), F.col("source")).alias("hospital_name"),
        F.concat(F.col("source"), F.lit(" Main Street")).alias("address"),
        F.concat(F.lit("place-"), F.col("source")).alias("place_id"),
        (F.col("n_chars") % 50 / 10.0).alias("hospital_rating"),
        F.concat(F.lit("author "), F.col("doc_id").cast("string")).alias("author_name"),
        X.author_id(F.concat(F.lit("author "), F.col("doc_id").cast("string"))).alias("author_id"),
        F.col("text").alias("review"),
        F.col("sentiment"),
        F.col("doc_id"),
    )


# --------------------------------------------------- hospitals and details

def conversation_hospitals(conv: DataFrame) -> DataFrame:
    """Search results (places): one per conversation, whichever turns it has.
    The address is missing when the first turn is a system turn."""
    first = conv.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role"))
    return first.select(
        F.concat(F.lit("place-"), F.col("conv_id").cast("string")).alias("place_id"),
        F.concat(F.lit("Hospital "), F.col("conv_id").cast("string")).alias("name"),
        F.when(F.col("role") != "system", F.concat(F.col("conv_id").cast("string"), F.lit(" Main Street")))
         .alias("formatted_address"))


def conversation_details(conv: DataFrame, limit: int = K.REAL_REVIEWS_LIMIT) -> DataFrame:
    """Place-detail rows: a conversation's first ``limit`` turns (3 at least) as reviews, in turn order;
    the fetch counts as failed when fewer than 3 reviews came back."""
    from reviewflow.operators.clean import first_n_per_key

    limit = max(limit, 3)
    flat = first_n_per_key(conversation_reviews(conv), ["place_id"], [F.col("pos")], limit, rank_col="__rank")
    nested = nest_children(flat, ["place_id"], "__rank", REVIEW_FIELDS, array_name="reviews", chunk_size=limit,
                           spread=False)          # at most `limit` turns per place: reuse the window's partitioning
    return nested.select("place_id", (F.size("reviews") >= 3).alias("ok"),
                        F.lit(None).cast("timestamp").alias("fetched_at"), "reviews")


def conversation_place_pages(conv: DataFrame) -> DataFrame:
    """Raw search pages whose results are place records: every line of a turn is a place
    (name = the line, place_id = 'c<conv>-p<page>-<i>', types from the role)."""
    pages = conversation_pages(conv)

    def place(line, i):
        return F.struct(
            line.alias("name"),
            F.lit("OPERATIONAL").alias("business_status"),
            F.concat(F.lit("line "), (i + 1).cast("string")).alias("formatted_address"),
            F.struct(F.struct(F.col("page_no").cast("double").alias("lat"), i.cast("double").alias("lng"))
                     .alias("location")).alias("geometry"),
            F.struct(F.lit(True).alias("open_now")).alias("opening_hours"),
            F.length(line).cast("double").alias("rating"),
            F.lit(1).cast("long").alias("user_ratings_total"),
            F.array(F.lit("hospital")).alias("types"),
            F.concat(F.col("request_id"), F.lit("-p"), F.col("page_no").cast("string"), F.lit("-"),
                     i.cast("string")).alias("place_id"))

    return pages.withColumn("results", F.transform("results", place))
