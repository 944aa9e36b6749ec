"""Schemas: the landed JSON documents and the four target tables.

Landed documents are always read with an explicit schema, so a batch that
lacks an optional field (``geometry``, ``opening_hours``) still analyses,
integer and fractional ratings land in one type, and no inference job runs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- documents

PLACE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("business_status", T.StringType()),
    T.StructField("formatted_address", T.StringType()),
    T.StructField("geometry", T.StructType([
        T.StructField("location", T.StructType([
            T.StructField("lat", T.DoubleType()),
            T.StructField("lng", T.DoubleType()),
        ])),
    ])),
    T.StructField("opening_hours", T.StructType([T.StructField("open_now", T.BooleanType())])),
    T.StructField("rating", T.DoubleType()),
    T.StructField("user_ratings_total", T.LongType()),
    T.StructField("types", T.ArrayType(T.StringType())),
    T.StructField("place_id", T.StringType()),
])

PLACES_DOCUMENT = T.StructType([T.StructField("results", T.ArrayType(PLACE))])

REVIEW = T.StructType([
    T.StructField("author_name", T.StringType()),
    T.StructField("author_url", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("profile_photo_url", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("relative_time_description", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("translated", T.BooleanType()),
    T.StructField("review_type", T.StringType()),
    T.StructField("date", T.StringType()),
])

HOSPITAL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("formatted_address", T.StringType()),
    T.StructField("place_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("user_ratings_total", T.LongType()),
    T.StructField("reviews", T.ArrayType(REVIEW)),
])

REVIEWS_DOCUMENT = T.StructType([
    T.StructField("disclaimer", T.StringType()),
    T.StructField("first_review", T.IntegerType()),
    T.StructField("data", T.ArrayType(HOSPITAL)),
])

# Raw API pages and place details (inputs of assemble_pages / attach_details).
PAGE = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("next_page_token", T.StringType()),
    T.StructField("results", T.ArrayType(PLACE)),
])

DETAIL = T.StructType([
    T.StructField("place_id", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("reviews", T.ArrayType(REVIEW)),
])


def narrow(schema: T.StructType, keep: dict) -> T.StructType:
    """Prune a nested schema to the fields named in ``keep``.

    ``keep`` maps a field name to ``True`` (keep whole) or to a nested dict
    (for a struct or an array of structs).  Passing the narrowed schema to
    the JSON reader is what prunes nested arrays at the scan: Spark keeps the
    whole nested schema of a file source through two generators otherwise.
    """
    out = []
    for f in schema.fields:
        if f.name not in keep:
            continue
        spec = keep[f.name]
        dt = f.dataType
        if spec is not True:
            if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
                dt = T.ArrayType(narrow(dt.elementType, spec), dt.containsNull)
            elif isinstance(dt, T.StructType):
                dt = narrow(dt, spec)
        out.append(T.StructField(f.name, dt, f.nullable))
    return T.StructType(out)


# ------------------------------------------------------------------- tables

@dataclass(frozen=True)
class Column:
    name: str
    sql: str                 # declared type: text, varchar(n), double, float, int, tinyint, datetime
    nullable: bool = True

    @property
    def spark_type(self) -> T.DataType:
        base = self.sql.split("(")[0].lower()
        return {
            "text": T.StringType(), "varchar": T.StringType(), "double": T.DoubleType(),
            "float": T.FloatType(), "int": T.IntegerType(), "tinyint": T.ByteType(),
            "datetime": T.TimestampType(),
        }[base]

    @property
    def max_length(self) -> int | None:
        if self.sql.lower().startswith("varchar("):
            return int(self.sql[8:-1])
        return None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple
    primary_key: tuple = field(default_factory=tuple)

    @property
    def column_names(self) -> list:
        return [c.name for c in self.columns]

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns])

    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.spark_type.simpleString()}" for c in self.columns)


HOSPITAL_LISTS = TableSpec("hospital_lists_ingestion", (
    Column("name", "text"),
    Column("business_status", "varchar(100)"),
    Column("address", "text"),
    Column("latitude", "double"),
    Column("longitude", "double"),
    Column("open_now", "varchar(10)"),
    Column("rating", "float"),
    Column("user_ratings_total", "int"),
    Column("types", "text"),
    Column("place_id", "text"),
    Column("loaddatetime", "datetime"),
))

HOSPITAL_REVIEWS = TableSpec("hospitals_reviews_ingestion", (
    Column("hospital_name", "text"),
    Column("address", "text"),
    Column("place_id", "varchar(100)"),
    Column("hospital_rating", "float"),
    Column("author_name", "text"),
    Column("author_id", "varchar(64)"),
    Column("author_url", "text"),
    Column("language", "varchar(10)"),
    Column("original_language", "varchar(10)"),
    Column("profile_photo_url", "text"),
    Column("review_rating", "int"),
    Column("relative_time_description", "varchar(100)"),
    Column("review", "text"),
    Column("time", "datetime"),
    Column("translated", "tinyint"),
    Column("loaddatetime", "datetime"),
    Column("sentiments", "text"),
))

_SENTIMENT_COLUMNS = (
    Column("hospital_name", "text"),
    Column("address", "text"),
    Column("hospital_rating", "float"),
    Column("author_name", "text"),
    Column("author_id", "varchar(64)", nullable=False),
    Column("review", "text"),
    Column("sentiment", "varchar(20)"),
)

MODEL_SENTIMENT = TableSpec("noncloud_hospital_sentiments", _SENTIMENT_COLUMNS, ("author_id",))
SCORE_SENTIMENT = TableSpec("gcp_hospital_sentiment",
                            _SENTIMENT_COLUMNS + (Column("sentiment_score", "float"),), ("author_id",))

TARGET_TABLES = (HOSPITAL_LISTS, HOSPITAL_REVIEWS, MODEL_SENTIMENT, SCORE_SENTIMENT)


BUCKET_KEY = "author_id"


def create_target_tables(spark: SparkSession, database: str | None = None, fmt: str = "parquet",
                         buckets: int | None = None) -> list:
    """Create the four target tables in the session catalog if missing.

    Catalog tables enforce neither the primary key nor NOT NULL on insert;
    ``dedup_on_key``, ``require`` and ``conform_to_schema`` do that before
    every append.  ``buckets``: tables carrying ``author_id`` (the reviews
    table and the two keyed sentiment tables) are bucketed by it into that
    many buckets, so the label flow's per-author dedup and its anti-join
    against keys already stored read co-located buckets instead of shuffling.
    """
    created = []
    for spec in TARGET_TABLES:
        name = f"{database}.{spec.name}" if database else spec.name
        if not spark.catalog.tableExists(name):
            clustered = ""
            if buckets and BUCKET_KEY in spec.column_names:
                clustered = f" CLUSTERED BY ({BUCKET_KEY}) INTO {int(buckets)} BUCKETS"
            spark.sql(f"CREATE TABLE {name} ({spec.ddl()}) USING {fmt}{clustered}")
            created.append(name)
    return created
