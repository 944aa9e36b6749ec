"""The query catalogue: one entry per operator group of the blueprint.

Each query reads whole supplied tables (no id subsets, no row caps) and
returns a lazily planned DataFrame; the SQL next to it is the DuckDB oracle.
Column names and types agree between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow import schemas as S
from reviewflow.functions import exprs as X
from reviewflow.operators import assemble as AS
from reviewflow.operators import augment as AU
from reviewflow.operators import clean as C
from reviewflow.operators import flatten as FL
from reviewflow.operators import sentiment as SE
from reviewflow.plans import derive as D
from reviewflow.plans import oracle_sql as O
from reviewflow.plans import flows as PL
from reviewflow.plans.registry import register


# ----------------------------------------------------------------- flatten

_FLAT_REVIEWS_SQL = """
SELECT 'Hospital ' || conv_id AS hospital_name,
       conv_id || ' Main Street' AS address,
       'place-' || conv_id AS place_id,
       (10 + conv_id % 41) / 10.0::DOUBLE AS hospital_rating,
       role AS author_name,
       'https://reviews.invalid/u/' || conv_id || '/' || turn AS author_url,
       'en' AS language,
       CASE WHEN role <> 'system' THEN 'en' END AS original_language,
       CAST(NULL AS VARCHAR) AS profile_photo_url,
       CAST(length(text) % 5 + 1 AS BIGINT) AS review_rating,
       (turn + 1) || ' months ago' AS relative_time_description,
       text AS review,
       make_timestamp((1700000000 + conv_id * 3600 + turn * 60) * 1000000) AS time,
       CAST(role = 'assistant' AS INTEGER) AS translated
FROM conversations
"""


@register("q_flatten_reviews", _FLAT_REVIEWS_SQL)
def q_flatten_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 nest → A2 two-level explode → P2/P3 projection with F2/F3 casts."""
    docs = D.review_documents(D.table(spark, sf_dir, "conversations"))
    return FL.flatten_reviews(docs).drop("author_id")



def _t(spark, sf_dir, name, spread_rows=False):
    return D.table(spark, sf_dir, name, spread_rows)


# ------------------------------------------------------------ nest / arrays

@register("q_nest_children", """
SELECT conv_id, CAST(turn // 1000 AS INTEGER) AS chunk,
       CAST(count(*) AS INTEGER) AS n_children,
       to_json(list({'turn': turn, 'role': role, 'text': text} ORDER BY turn)) AS children_json
FROM conversations GROUP BY conv_id, turn // 1000
""")
def q_nest_children(spark, sf_dir):
    """Children nested per (parent, bounded chunk) in position order, as JSON text."""
    conv = _t(spark, sf_dir, "conversations")
    n = FL.nest_children(conv, ["conv_id"], "turn", ["turn", "role", "text"], array_name="children")
    return n.select("conv_id", "chunk", F.size("children").alias("n_children"),
                    FL.to_json_text("children").alias("children_json"))


@register("q_first_n", """
SELECT conv_id, CAST(turn AS INTEGER) AS pos, role, text
FROM conversations WHERE turn < 5
""")
def q_first_n(spark, sf_dir):
    """L1/A4: first 5 children of each parent, cut before the shuffle, nested, sliced, and back to rows."""
    conv = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    top = C.first_n_per_key(conv, ["conv_id"], [F.col("turn")], K.REAL_REVIEWS_LIMIT, rank_col="pos")
    n = FL.nest_children(top, ["conv_id"], "pos", ["role", "text"], array_name="reviews", chunk_size=K.REAL_REVIEWS_LIMIT,
                         spread=False)        # at most five per parent: the window's partitioning is kept
    n = n.select("conv_id", AS.first_n("reviews", K.REAL_REVIEWS_LIMIT).alias("reviews"))
    return FL.explode_children(n, "reviews", ["conv_id"], pos="pos")


@register("q_concat_array", """
SELECT conv_id, turn, array_to_string(list_filter(string_split(text, ' '), lambda w: length(w) % 3 <> 0), ',') AS types
FROM conversations
""")
def q_concat_array(spark, sf_dir):
    """A3: array<string> → comma text, NULL elements skipped (here the words whose length is a multiple of three)."""
    words = F.transform(F.split("text", " "), lambda w: F.when(F.length(w) % 3 != 0, w))
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(",", words).alias("types"))


@register("q_batch_totals", """
SELECT 'city_' || CAST(conv_id // 10 AS VARCHAR) AS city,
       count(DISTINCT conv_id) AS total_hospitals, count(*) AS total_reviews
FROM conversations GROUP BY 1
""")
def q_batch_totals(spark, sf_dir):
    """Hospitals and reviews per city batch, counted from the flat children."""
    conv = _t(spark, sf_dir, "conversations").select(D.conversation_city().alias("city"), "conv_id")
    return AS.child_totals(conv, "conv_id", ["city"])


@register("q_landed_totals", """
SELECT 'city_' || CAST(conv_id // 10 AS VARCHAR) AS city,
       count(DISTINCT conv_id) AS total_hospitals, count(*) AS total_reviews
FROM conversations GROUP BY 1
""")
def q_landed_totals(spark, sf_dir):
    """The same totals from landed documents of three reviews each, so that hospitals span several."""
    return AS.batch_totals(D.review_documents(_t(spark, sf_dir, "conversations"), chunk_size=3), by=["city"])


# ------------------------------------------------------------ flows A and B

_PLACES_SQL = """
WITH p AS (
  SELECT c_name AS name, c_mktsegment AS business_status, c_custkey || ' Market Road' AS address,
         CASE WHEN c_acctbal < 0 THEN 'NaN'::DOUBLE ELSE c_acctbal / 100.0::DOUBLE END AS latitude,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey * 1.5::DOUBLE END AS longitude,
         c_acctbal > 5000 AS open_now, c_acctbal / 2000.0::DOUBLE AS rating,
         c_custkey AS user_ratings_total, 'hospital,' || lower(c_mktsegment) AS types,
         'cust-' || c_custkey AS place_id
  FROM customer)
SELECT name, business_status, address, latitude, longitude, CAST(open_now AS VARCHAR) AS open_now,
       CAST(rating AS FLOAT) AS rating, CAST(user_ratings_total AS INTEGER) AS user_ratings_total, types, place_id,
       TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime,
       concat_ws(',', CASE WHEN length(business_status) > 100 THEN 'business_status' END,
                 CASE WHEN length(CAST(open_now AS VARCHAR)) > 10 THEN 'open_now' END) AS _errors
FROM p
WHERE name IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating) AND address IS NOT NULL
  AND latitude IS NOT NULL AND NOT isnan(latitude) AND longitude IS NOT NULL AND NOT isnan(longitude)
"""


@register("q_load_places", _PLACES_SQL)
def q_load_places(spark, sf_dir):
    """Flow A: places documents → A1 explode, P1/P2 projection, A3, P4 required (NULL and NaN),
    P6 audit, K3 conformance to the list table."""
    docs = D.customer_places(_t(spark, sf_dir, "customer"))
    return PL.places_frame(docs, D.FIXED_LOAD_TS)


@register("q_require_columns", """
SELECT event_id, event_type, value, lat
FROM (SELECT event_id, event_type,
             CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS value,
             CASE WHEN event_type = 'signup' THEN NULL ELSE user_id / 10.0::DOUBLE END AS lat
      FROM events)
WHERE value IS NOT NULL AND NOT isnan(value) AND lat IS NOT NULL AND NOT isnan(lat)
""")
def q_require_columns(spark, sf_dir):
    """Drop rows with NULL or NaN in any required column."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
         .otherwise(F.col("user_id") / 10.0).alias("lat"))
    return C.require(ev, ["value", "lat"])


def _flat_reviews_author_sql() -> str:
    return f"""
SELECT f.*, CAST({O.murmur3('f.author_name')} AS VARCHAR) AS author_id,
       TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime, '' AS sentiments
FROM ({_FLAT_REVIEWS_SQL}) f
"""


@register("q_load_reviews", f"""
SELECT hospital_name, address, place_id, CAST(hospital_rating AS FLOAT) AS hospital_rating, author_name,
       author_id, author_url, language, original_language, profile_photo_url,
       CAST(review_rating AS INTEGER) AS review_rating, relative_time_description, review, time,
       CAST(translated AS TINYINT) AS translated, loaddatetime, sentiments,
       CASE WHEN octet_length(encode(review)) > 65535 THEN 'review' ELSE '' END AS _errors
FROM ({_flat_reviews_author_sql()})
""")
def q_load_reviews(spark, sf_dir):
    """Flow B: review documents → A2 flatten → F1 author id, F2/F3 → P6 audit → K3 conformance."""
    docs = D.review_documents(_t(spark, sf_dir, "conversations"))
    return PL.reviews_frame(docs, D.FIXED_LOAD_TS)


@register("q_author_id", f"""
SELECT c_custkey, c_name AS author_name, CAST({O.murmur3('c_name')} AS VARCHAR) AS author_id FROM customer
""")
def q_author_id(spark, sf_dir):
    """32-bit Murmur3 (seed 42) of the author name as text."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", F.col("c_name").alias("author_name"), X.author_id("c_name").alias("author_id"))


# --------------------------------------------------------------- row rules

@register("q_only_unlabelled", """
SELECT d.doc_id, d.lang, d.source,
       CASE WHEN l.quality = 1 THEN 'Positive' WHEN l.quality = 0 THEN '' END AS sentiment
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL OR l.quality = 0
""")
def q_only_unlabelled(spark, sf_dir):
    """P5: rows whose sentiment is NULL or ''."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return C.only_unlabelled(docs.join(D.label_sentiments(_t(spark, sf_dir, "labels")), "doc_id", "left"))


@register("q_defaults_audit", """
SELECT event_id,
       coalesce(CASE WHEN event_type <> 'view' THEN event_type || ' desk' END, 'N/A') AS formatted_address,
       coalesce(CASE WHEN event_type <> 'click' THEN 'de' END, 'en') AS original_language,
       coalesce(CASE WHEN value > 100 THEN true END, false) AS translated,
       TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime, '' AS sentiment
FROM events
""")
def q_defaults_audit(spark, sf_dir):
    """P8 defaults for missing fields, P6 run-level load time and placeholder."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.concat(F.col("event_type"), F.lit(" desk"))).alias("formatted_address"),
        F.when(F.col("event_type") != "click", F.lit("de")).alias("original_language"),
        F.when(F.col("value") > 100, F.lit(True)).alias("translated"))
    ev = C.with_defaults(ev, {**PL.review_defaults(), **PL.child_defaults()})
    return C.with_audit(ev, D.FIXED_LOAD_TS, constants={"sentiment": ""})


# ---------------------------------------------------------------- assembly

_PAGES_CTE = """
p AS (
  SELECT 'req-' || conv_id AS request_id, CAST(turn + 1 AS INTEGER) AS page_no,
         CASE length(text) % 7 WHEN 0 THEN 'INVALID_REQUEST' WHEN 1 THEN 'ZERO_RESULTS' ELSE 'OK' END AS status,
         CASE WHEN length(text) % 5 = 0 THEN NULL ELSE 'tok-' || conv_id || '-' || (turn + 1) END AS next_page_token,
         CASE WHEN role = 'system' THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS results
  FROM conversations),
f AS (
  SELECT *, CASE WHEN page_no = 1 THEN (status NOT IN ('OK', 'ZERO_RESULTS') OR len(results) = 0)
                 ELSE (lag(page_no) OVER w IS DISTINCT FROM page_no - 1
                       OR lag(next_page_token) OVER w IS NULL OR status <> 'OK') END AS bad
  FROM p WINDOW w AS (PARTITION BY request_id ORDER BY page_no)),
c AS (
  SELECT *, max(CAST(bad AS INTEGER)) OVER (PARTITION BY request_id ORDER BY page_no
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen_bad
  FROM f),
kept AS (
  SELECT request_id, page_no, CAST(generate_subscripts(results, 1) - 1 AS INTEGER) AS pos,
         unnest(results) AS result
  FROM c WHERE seen_bad = 0)
"""


@register("q_assemble_pages", f"WITH {_PAGES_CTE} SELECT * FROM kept")
def q_assemble_pages(spark, sf_dir):
    """Follow-the-token page assembly, one row per kept result."""
    return AS.assemble_pages(D.conversation_pages(_t(spark, sf_dir, "conversations")))


_WALK_CTE = """
p AS (
  SELECT 'req-' || conv_id AS request_id, CASE WHEN turn > 0 THEN 'tok-' || conv_id || '-' || turn END AS page_token,
         CASE length(text) % 7 WHEN 0 THEN 'INVALID_REQUEST' WHEN 1 THEN 'ZERO_RESULTS' ELSE 'OK' END AS status,
         CASE WHEN length(text) % 5 = 0 THEN NULL WHEN length(text) % 11 = 0 THEN 'tok-' || conv_id || '-' || (turn // 2)
              ELSE 'tok-' || conv_id || '-' || (turn + 1) END AS next_page_token,
         CASE WHEN role = 'system' THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS results
  FROM conversations),
walk AS (
  SELECT request_id, 1 AS page_no, next_page_token, results, [coalesce(page_token, '')] AS seen
  FROM p WHERE page_token IS NULL AND status IN ('OK', 'ZERO_RESULTS') AND len(results) > 0
  UNION ALL
  SELECT p.request_id, page_no + 1, p.next_page_token, p.results, list_append(seen, p.page_token)
  FROM walk JOIN p ON p.request_id = walk.request_id AND p.page_token = walk.next_page_token
  WHERE p.status = 'OK' AND NOT list_contains(seen, p.page_token))
"""


@register("q_follow_tokens", f"""WITH RECURSIVE {_WALK_CTE}
SELECT request_id, CAST(page_no AS INTEGER) AS page_no, CAST(generate_subscripts(results, 1) - 1 AS INTEGER) AS pos, unnest(results) AS result FROM walk
""")
def q_follow_tokens(spark, sf_dir):
    """J2 by the tokens alone: no page numbers; some tokens lead back to earlier pages, some nowhere."""
    conv = _t(spark, sf_dir, "conversations")
    n, turn = F.length("text"), F.col("turn")

    def tok(at):
        return F.concat(F.lit("tok-"), F.col("conv_id").cast("string"), F.lit("-"), at.cast("string"))
    pages = conv.select(
        F.concat(F.lit("req-"), F.col("conv_id").cast("string")).alias("request_id"), F.when(turn > 0, tok(turn)).alias("page_token"),
        F.when(n % 7 == 0, "INVALID_REQUEST").when(n % 7 == 1, "ZERO_RESULTS").otherwise("OK").alias("status"),
        F.when(n % 5 == 0, F.lit(None)).when(n % 11 == 0, tok(F.floor(turn / 2))).otherwise(tok(turn + 1)).alias("next_page_token"),
        F.when(F.col("role") == "system", F.array().cast("array<string>")).otherwise(F.split("text", "\n")).alias("results"))
    return AS.follow_tokens(pages)


@register("q_request_outcomes", f"""
WITH {_PAGES_CTE}
SELECT r.request_id, coalesce(o.outcome, 'failed') AS outcome,
       coalesce(k.n_pages, 0) AS n_pages, coalesce(k.n_results, 0) AS n_results
FROM (SELECT DISTINCT request_id FROM p) r
LEFT JOIN (SELECT request_id,
                  CASE WHEN status NOT IN ('OK', 'ZERO_RESULTS') THEN 'failed'
                       WHEN len(results) = 0 THEN 'empty' ELSE 'ok' END AS outcome
           FROM p WHERE page_no = 1) o USING (request_id)
LEFT JOIN (SELECT request_id, count(DISTINCT page_no) AS n_pages, count(*) AS n_results
           FROM kept GROUP BY 1) k USING (request_id)
""")
def q_request_outcomes(spark, sf_dir):
    """Failed / empty / ok per request, with pages and results kept."""
    return AS.request_outcomes(D.conversation_pages(_t(spark, sf_dir, "conversations")))


@register("q_attach_details", """
WITH k AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem QUALIFY rn <= 5),
ok AS (SELECT l_orderkey FROM k GROUP BY 1 HAVING bool_or(l_returnflag <> 'R'))
SELECT o.o_orderkey AS place_id, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       CAST(k.rn - 1 AS INTEGER) AS pos, k.l_linenumber, k.l_partkey, k.l_suppkey, k.l_quantity, k.l_extendedprice
FROM orders o JOIN ok ON o.o_orderkey = ok.l_orderkey JOIN k ON k.l_orderkey = o.o_orderkey
""")
def q_attach_details(spark, sf_dir):
    """Places ⋈ successful details, first 5 reviews kept; failed/missing details drop the place."""
    places = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("place_id"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    details = D.lineitem_details(_t(spark, sf_dir, "lineitem"), K.REAL_REVIEWS_LIMIT)
    joined = AS.attach_details(places, details, key="place_id", limit=K.REAL_REVIEWS_LIMIT)
    flat = FL.explode_children(joined, "reviews",
                               ["place_id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    return flat.drop("l_returnflag")


@register("q_union_batches", """
SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props
FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, ts, user_id, event_type, CAST(NULL AS DOUBLE) AS value, props
FROM events WHERE event_type NOT IN ('click', 'view')
""")
def q_union_batches(spark, sf_dir):
    """UNION ALL by name of two batches with different columns."""
    ev = _t(spark, sf_dir, "events")
    a = ev.filter(F.col("event_type").isin("click", "view")).select("event_id", "ts", "user_id", "event_type", "value")
    b = ev.filter(~F.col("event_type").isin("click", "view")).select("event_id", "ts", "user_id", "event_type", "props")
    return AS.union_batches(a, b)


# ---------------------------------------------------------- scalar functions

@register("q_epoch_cast", """
SELECT event_id, epoch, make_timestamp(epoch * 1000000) AS time,
       CAST(value > 100 AS INTEGER) AS translated,
       CASE WHEN epoch0 IS NULL OR epoch0 = 0 THEN 'N/A' ELSE strftime(make_timestamp(epoch0 * 1000000), '%Y-%m-%d') END AS date,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS load_text
FROM (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch,
             CASE WHEN event_type = 'error' THEN 0 ELSE CAST(epoch_us(ts) // 1000000 AS BIGINT) END AS epoch0
      FROM events)
""")
def q_epoch_cast(spark, sf_dir):
    """F2 epoch → timestamp, F3 bool → 0/1, F5 epoch → date text or N/A (NULL/0), F6, F4."""
    ev = _t(spark, sf_dir, "events")
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    ev = ev.select("event_id", "ts", "value", "event_type", epoch.alias("epoch"))
    return ev.select(
        "event_id", "epoch", X.epoch_to_timestamp("epoch").alias("time"),
        X.bool_to_int(F.col("value") > 100).alias("translated"),
        X.epoch_date(F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.col("epoch"))).alias("date"),
        X.load_time_text("ts").alias("load_text"))


@register("q_slug", """
SELECT p_partkey, replace(lower(p_name), ' ', '_') AS slug, replace(p_name, ' ', '_') AS slug_kept,
       replace(p_name || chr(10) || p_type, chr(10), ', ') AS address,
       p_brand || ' ' || p_type AS label,
       replace(lower(p_name), ' ', '_') || '_hospital_reviews.json' AS reviews_object,
       'lists/hospitals_in_' || replace(p_name, ' ', '_') || '_20250101_000000.json' AS lists_object
FROM part
""")
def q_slug(spark, sf_dir):
    """F7 slugs, F8 newline → ', ', F15 formatting, F16 compact time, S10 object names."""
    from reviewflow.sinks.envelope import landing_name
    p = _t(spark, sf_dir, "part")
    ts = F.to_timestamp(F.lit(D.FIXED_LOAD_TS))
    return p.select(
        "p_partkey", X.slug("p_name").alias("slug"), X.slug("p_name", lower=False).alias("slug_kept"),
        X.newline_to_comma(F.concat_ws("\n", "p_name", "p_type")).alias("address"),
        F.format_string("%s %s", "p_brand", "p_type").alias("label"),
        landing_name(F.col("p_name"), ts, kind="reviews").alias("reviews_object"),
        landing_name(F.col("p_name"), ts, folder="lists", kind="lists").alias("lists_object"))


@register("q_blank_guard", r"""
SELECT doc_id, variant,
       (t IS NULL OR regexp_replace(t, '^\s+|\s+$', '', 'g') = '') AS blank
FROM (SELECT doc_id, 'original' AS variant, text AS t FROM documents
      UNION ALL
      SELECT doc_id, 'whitespace' AS variant, regexp_replace(text, '\S', '', 'g') AS t FROM documents)
""")
def q_blank_guard(spark, sf_dir):
    """blank test on each whole text and on its whitespace-only skeleton."""
    d = _t(spark, sf_dir, "documents", spread_rows=True)
    v = d.select("doc_id", F.explode(F.array(
        F.struct(F.lit("original").alias("variant"), F.col("text").alias("t")),
        F.struct(F.lit("whitespace").alias("variant"), F.regexp_replace("text", r"\S", "").alias("t")),
    )).alias("v")).select("doc_id", "v.variant", "v.t")
    return v.select("doc_id", "variant", X.is_blank("t").alias("blank"))


@register("q_score_label", f"""
SELECT event_id, CAST(s AS DOUBLE) AS score, {O.score_label('s')} AS label
FROM (SELECT event_id, CAST((value - 50) / 50 AS FLOAT) AS s FROM events)
""")
def q_score_label(spark, sf_dir):
    """±0.25 thresholds, strict (exactly ±0.25 is Mixed)."""
    ev = _t(spark, sf_dir, "events").select("event_id", ((F.col("value") - 50) / 50).cast("float").alias("s"))
    return ev.select("event_id", F.col("s").cast("double").alias("score"), X.score_label("s").alias("label"))


@register("q_rating_class", f"""
SELECT event_id, rating, {O.rating_class('rating')} AS rating_class
FROM (SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL
                            ELSE (CAST(floor(value) AS BIGINT) % 9) / 2.0::DOUBLE + 1 END AS rating FROM events)
""")
def q_rating_class(spark, sf_dir):
    """>=4 positive, ==3 neutral, else negative (3.5 is negative); NULL stays NULL."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
        .otherwise(F.pmod(F.floor("value"), F.lit(9)) / 2.0 + 1).alias("rating"))
    return ev.select("event_id", "rating", X.rating_class("rating").alias("rating_class"))


@register("q_hash_pick", f"""
SELECT event_id,
       {O.pick(O.key_text('pick', ['event_id']), 20)} AS pick,
       {O.hash_int('int', ['event_id'], 50, 5000)} AS n,
       (10 + {O.pick(O.key_text('tenths', ['event_id']), 41)}) / 10.0::DOUBLE AS tenths,
       strftime({O.hash_date('date', ['event_id'])}, '%Y-%m-%d') AS day,
       {O.hash_int('months', ['event_id'], 1, 12)} AS months
FROM events
""")
def q_hash_pick(spark, sf_dir):
    """repeatable hash-drawn list index, integer, tenths and date."""
    ev = _t(spark, sf_dir, "events", spread_rows=True)
    return ev.select(
        "event_id", X.hash_pick("pick", "event_id", 20).alias("pick"),
        X.hash_int("int", "event_id", 50, 5000).alias("n"),
        X.hash_tenths("tenths", "event_id", 1.0, 5.0).alias("tenths"),
        F.date_format(X.hash_date("date", "event_id"), "yyyy-MM-dd").alias("day"),
        X.hash_int("months", "event_id", 1, 12).alias("months"))


@register("q_template_fill", f"""
SELECT event_id, rating, {O.review_text('rating', ['event_id'], 'review')} AS text
FROM (SELECT event_id, {O.hash_int('rating', ['event_id'], 1, 5)} AS rating FROM events)
""")
def q_template_fill(spark, sf_dir):
    """template of the rating's class, four hash-picked adjectives substituted."""
    ev = _t(spark, sf_dir, "events", spread_rows=True).select("event_id", X.hash_int("rating", "event_id", 1, 5).alias("rating"))
    return ev.select("event_id", "rating", AU.review_text(F.col("rating"), [F.col("event_id")], "review").alias("text"))


# ------------------------------------------------------------- augmentation

def _top_up_sql(min_count: int) -> str:
    g = O.synthetic_review_cols(["conv_id", "pos"], "topup")
    return f"""
SELECT conv_id, turn AS pos, role AS author_name, CAST(length(text) % 5 + 1 AS BIGINT) AS rating, text,
       'real' AS review_type
FROM conversations
UNION ALL
SELECT conv_id, pos, {g['author_name']} AS author_name, {g['rating']} AS rating, {g['text']} AS text,
       {g['review_type']} AS review_type
FROM (SELECT conv_id, unnest(generate_series(count(*), {min_count - 1})) AS pos
      FROM conversations GROUP BY conv_id HAVING count(*) < {min_count})
"""


@register("q_top_up", _top_up_sql(5))
def q_top_up(spark, sf_dir):
    """Pad each conversation to 5 children with generated reviews; existing rows untouched."""
    conv = _t(spark, sf_dir, "conversations")
    children = conv.select("conv_id", F.col("turn").alias("pos"), F.col("role").alias("author_name"),
                           (F.pmod(F.length("text"), F.lit(5)) + 1).cast("long").alias("rating"), "text",
                           F.lit(K.REAL_REVIEW_TYPE).alias("review_type"))
    parents = conv.select("conv_id").distinct()
    out = AU.top_up_groups(children, parents, "conv_id", "pos", min_count=5, salt="topup")
    return out.select("conv_id", "pos", "author_name", "rating", "text", "review_type")


def _generate_hospitals_sql() -> str:
    hk = ["city", "hospital_no"]
    types = O.sql_list(K.HOSPITAL_TYPES)
    r = O.synthetic_review_cols(["city", "hospital_no", "review_no"], "hospital:review")
    review_cols = ",\n       ".join(f"{v} AS {k}" for k, v in r.items())
    return f"""
WITH h AS (
  SELECT s_name AS city, CAST(unnest(generate_series(0, 4)) AS INTEGER) AS hospital_no FROM supplier),
r AS (SELECT *, CAST(unnest(generate_series(0, 99)) AS INTEGER) AS review_no FROM h)
SELECT city, hospital_no,
       city || ' ' || {types}[{O.pick(O.key_text('hospital:type', hk), 5)} + 1] AS name,
       replace({O.hash_int('hospital:street', hk, 1, 9999)} || ' Main Street' || chr(10) || city, chr(10), ', ')
         AS formatted_address,
       CAST(NULL AS VARCHAR) AS place_id,
       (10 + {O.pick(O.key_text('hospital:rating', hk), 41)}) / 10.0::DOUBLE AS hospital_rating,
       CAST({O.hash_int('hospital:total', hk, 50, 5000)} AS BIGINT) AS user_ratings_total,
       review_no,
       {review_cols}
FROM r
"""


@register("q_generate_hospitals", _generate_hospitals_sql())
def q_generate_hospitals(spark, sf_dir):
    """5 synthetic hospitals × 100 generated reviews per city (supplier names as the city list,
    which grows with the scale factor)."""
    cities = _t(spark, sf_dir, "supplier", spread_rows=True).select(F.col("s_name").alias("city"))      # before the fan-out
    return AU.generate_hospitals(cities, "city")


# ---------------------------------------------------------------- sentiment

_LEX_POS, _LEX_NEG = ["that", "with"], ["from", "this"]


def _lexicon_sql(label_col: str, score_col: str, counts: bool) -> str:
    p, n = O.lexicon_count("text", _LEX_POS), O.lexicon_count("text", _LEX_NEG)
    cnt = "n_pos, n_neg, " if counts else ""
    score = "CASE WHEN n_pos + n_neg = 0 THEN 0.0::DOUBLE ELSE (n_pos - n_neg) / (n_pos + n_neg)::DOUBLE END"
    s_out = "s" if counts else "CAST(CAST(s AS FLOAT) AS DOUBLE)"
    return f"""
SELECT doc_id, {cnt}{s_out} AS {score_col}, {O.score_label('s')} AS {label_col}
FROM (SELECT doc_id, n_pos, n_neg, {score} AS s FROM (SELECT doc_id, {p} AS n_pos, {n} AS n_neg FROM documents))
"""


@register("q_lexicon_score", _lexicon_sql("label", "score", counts=True))
def q_lexicon_score(spark, sf_dir):
    """Native lexicon score over whole texts, (p-n)/(p+n), label at ±0.25."""
    d = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text")
    return SE.lexicon_score(d, "text", _LEX_POS, _LEX_NEG).select("doc_id", "n_pos", "n_neg", "score", "label")


@register("q_score_text", _lexicon_sql("sentiment", "sentiment_score", counts=False))
def q_score_text(spark, sf_dir):
    """The same scorer through an iterator pandas UDF returning one struct, unpacked."""
    d = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text")
    out = SE.score_text(d, "text", SE.LexiconScorer(_LEX_POS, _LEX_NEG))
    return out.select("doc_id", F.col("sentiment_score").cast("double").alias("sentiment_score"), "sentiment")


def _label_text_sql() -> str:
    text = O.review_text("rating", ["event_id"], "review")
    neg = O.lexicon_count("t", K.ADJECTIVES_NEGATIVE)
    neu = O.lexicon_count("t", K.ADJECTIVES_NEUTRAL)
    pos = O.lexicon_count("t", K.ADJECTIVES_POSITIVE)
    return f"""
WITH g AS (
  SELECT event_id, rating, CASE WHEN event_type = 'error' THEN ' ' || chr(9) ELSE {text} END AS t
  FROM (SELECT event_id, event_type, {O.hash_int('rating', ['event_id'], 1, 5)} AS rating FROM events)),
c AS (SELECT event_id, rating, t, {neg} AS a, {neu} AS b, {pos} AS c FROM g)
SELECT event_id, rating,
       CASE WHEN regexp_replace(t, '^\\s+|\\s+$', '', 'g') = '' THEN ''
            WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS sentiment
FROM c
"""


@register("q_label_text", _label_text_sql())
def q_label_text(spark, sf_dir):
    """Classifier logits (pandas UDF) → argmax → label name; blank text → ''."""
    ev = _t(spark, sf_dir, "events", spread_rows=True).select("event_id", "event_type",
                                             X.hash_int("rating", "event_id", 1, 5).alias("rating"))
    ev = ev.withColumn("t", F.when(F.col("event_type") == "error", F.lit(" \t"))
                       .otherwise(AU.review_text(F.col("rating"), [F.col("event_id")], "review")))
    return SE.label_text(ev, "t").select("event_id", "rating", "sentiment")


@register("q_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS idx,
       'LABEL_' || CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR) AS label
FROM embeddings
""")
def q_argmax(spark, sf_dir):
    """First maximum of a score vector and its label name."""
    e = _t(spark, sf_dir, "embeddings")
    e = e.select("vec_id", X.argmax("embedding").cast("int").alias("idx"))
    return e.select("vec_id", "idx", X.numbered_label(F.col("idx")).alias("label"))


_WEIGHTS_SQL = """
WITH t AS (SELECT d.doc_id, l.quality AS y, unnest(regexp_split_to_array(lower(d.text), '[^a-z-]+')) AS w
           FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL),
c AS (SELECT w, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM t WHERE w <> '' GROUP BY w),
v AS (SELECT * FROM c WHERE w <> ''),
s AS (SELECT sum(p) + count(*) AS sp, sum(n) + count(*) AS sn FROM v),
weights AS (SELECT w, CAST(round(1000000 * (ln((p + 1) / sp::DOUBLE) - ln((n + 1) / sn::DOUBLE))) AS BIGINT) AS weight FROM v, s),
prior AS (SELECT CAST(round(1000000 * (ln(count(*) FILTER (quality = 1) + 1) - ln(count(*) FILTER (quality = 0) + 1))) AS BIGINT) AS b
          FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)
"""


@register("q_train_scorer", f"""{_WEIGHTS_SQL}, scored AS (
  SELECT doc_id, sum(weight) AS x FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z-]+')) AS w FROM documents)
  JOIN weights USING (w) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(x, 0) + b AS BIGINT) AS log_odds,
       CASE WHEN coalesce(x, 0) + b > 0 THEN 'Positive' ELSE 'Negative' END AS sentiment
FROM documents LEFT JOIN scored USING (doc_id), prior
""")
def q_train_scorer(spark, sf_dir):
    """U4: naive Bayes trained by aggregates on the labelled documents, applied to all."""
    docs = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text")
    labels = _t(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    model = SE.train_counts(docs.join(labels, "doc_id"), "text", "y")
    return SE.apply_counts(model, docs, "doc_id", "text", {0: "Negative", 1: "Positive"})


@register("q_train_logistic")
def q_train_logistic(spark, sf_dir):
    """U4: logistic regression on hashed TF-IDF, trained on labelled documents, applied to all."""
    docs = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text")
    labels = _t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    # 2^16 hashed features: the labelled set is a few thousand documents.
    model = SE.train_scorer(docs.join(labels, "doc_id"), "text", "y", num_features=1 << 16, max_iter=10)
    return SE.apply_trained(model, docs, {0: "Negative", 1: "Positive"}).select(
        "doc_id", "sentiment", "sentiment_score")


# ------------------------------------------------------------------- keys

@register("q_dedup_key", """
SELECT user_id, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
""")
def q_dedup_key(spark, sf_dir):
    """K1/K2: one row per key (latest, then lowest id); NULL keys dropped."""
    ev = C.require(_t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value"),
                   ["user_id"])
    return C.dedup_on_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").asc()])


CONFORM_SPEC = S.TableSpec("doc_target", (
    S.Column("doc_id", "int", nullable=False),
    S.Column("lang", "varchar(2)"),
    S.Column("source", "varchar(4)"),
    S.Column("n_chars", "int"),
    S.Column("n_small", "tinyint"),
    S.Column("weight", "float"),
    S.Column("body", "text"),
    S.Column("big", "int"),
))


@register("q_conform", """
SELECT TRY_CAST(doc_id AS INTEGER) AS doc_id, lang, source, TRY_CAST(n_chars AS INTEGER) AS n_chars,
       CAST(CASE WHEN doc_id % 5 = 0 THEN 'NaN'::DOUBLE ELSE n_chars / 7.0::DOUBLE END AS FLOAT) AS weight,
       length(repeat(text, 40)) AS n_body,
       concat_ws(',', CASE WHEN doc_id IS NULL OR TRY_CAST(doc_id AS INTEGER) IS NULL THEN 'doc_id' END,
                 CASE WHEN length(lang) > 2 THEN 'lang' END,
                 CASE WHEN length(source) > 4 THEN 'source' END,
                 CASE WHEN n_chars IS NOT NULL AND TRY_CAST(n_chars AS INTEGER) IS NULL THEN 'n_chars' END,
                 CASE WHEN n_chars IS NOT NULL AND TRY_CAST(n_chars AS TINYINT) IS NULL THEN 'n_small' END,
                 CASE WHEN doc_id % 5 = 0 THEN 'weight' END,
                 CASE WHEN octet_length(encode(repeat(text, 40))) > 65535 THEN 'body' END,
                 CASE WHEN n_chars IS NOT NULL AND TRY_CAST(n_chars * 200000 AS INTEGER) IS NULL THEN 'big' END) AS _errors
FROM documents
""")
def q_conform(spark, sf_dir):
    """K3: typed conformance — VARCHAR(n) and TEXT length, INT/TINYINT range, FLOAT, NaN, NOT NULL — with reasons.

    The verdicts on the TINYINT column and on ``big`` are in ``_errors``; their
    converted values (NULL on overflow) are not part of the compared output.
    """
    d = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "lang", "source", "n_chars",
                                              F.col("n_chars").alias("n_small"),
                                              F.when(F.col("doc_id") % 5 == 0, F.lit(float("nan")))
                                              .otherwise(F.col("n_chars") / 7.0).alias("weight"),
                                              F.repeat("text", 40).alias("body"), (F.col("n_chars") * 200000).alias("big"))
    return C.conform_to_schema(d, CONFORM_SPEC).withColumn("n_body", F.length("body").cast("long")).drop("n_small", "body", "big")


@register("q_reject_accounting", """
WITH r AS (SELECT unnest(string_split(concat_ws(',', CASE WHEN length(lang) > 2 THEN 'lang' END,
                 CASE WHEN length(source) > 4 THEN 'source' END,
                 CASE WHEN n_chars IS NOT NULL AND TRY_CAST(n_chars AS TINYINT) IS NULL THEN 'n_small' END), ',')) AS reason
           FROM documents)
SELECT CASE WHEN reason = '' THEN 'fits' ELSE reason END AS reason, count(*) AS n_rows FROM r GROUP BY 1
""")
def q_reject_accounting(spark, sf_dir):
    """K3/G1: rows that fit and rows per reason why not (a row with two reasons counts under both)."""
    spec = S.TableSpec("doc_reasons", tuple(c for c in CONFORM_SPEC.columns if c.name in ("lang", "source", "n_small")))
    d = _t(spark, sf_dir, "documents").select("lang", "source", F.col("n_chars").alias("n_small"))
    return C.reject_reasons(C.conform_to_schema(d, spec))


# ------------------------------------------------------------ flow C, sinks

def _label_reviews_sql() -> str:
    p = O.lexicon_count("review", K.ADJECTIVES_POSITIVE)
    n = O.lexicon_count("review", K.ADJECTIVES_NEGATIVE)
    return f"""
WITH r AS (
  SELECT 'Hospital ' || d.source AS hospital_name, d.source || ' Main Street' AS address,
         'place-' || d.source AS place_id, (d.n_chars % 50) / 10.0::DOUBLE AS hospital_rating,
         'author ' || d.doc_id AS author_name, d.text AS review, CASE WHEN l.quality = 1 THEN 'Positive' WHEN l.quality = 0 THEN '' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT *, CAST({O.murmur3('author_name')} AS VARCHAR) AS author_id, {p} AS np, {n} AS nn
      FROM r WHERE sentiment IS NULL OR sentiment = ''),
s AS (SELECT *, CASE WHEN np + nn = 0 THEN 0.0::DOUBLE ELSE (np - nn) / (np + nn)::DOUBLE END AS sc FROM t)
SELECT hospital_name, address, CAST(hospital_rating AS FLOAT) AS hospital_rating, author_name, author_id, review,
       {O.score_label('sc')} AS sentiment, CAST(sc AS FLOAT) AS sentiment_score,
       CASE WHEN octet_length(encode(review)) > 65535 THEN 'review' ELSE '' END AS _errors,
       place_id, 'lexicon' AS method, TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime
FROM s
QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY review, author_name, hospital_name, address, place_id,
                           hospital_rating) = 1
"""


@register("q_label_reviews", _label_reviews_sql())
def q_label_reviews(spark, sf_dir):
    """Flow C: reviews table → P5 unlabelled → K1 one row per author id → U3 score → K3 conform, P6 load time."""
    reviews = D.document_reviews(_t(spark, sf_dir, "documents", spread_rows=True), _t(spark, sf_dir, "labels"))
    return PL.label_frame(reviews, load_ts=D.FIXED_LOAD_TS)


@register("q_envelope_round_trip", _FLAT_REVIEWS_SQL)
def q_envelope_round_trip(spark, sf_dir):
    """S8-S10 land documents as JSON (one folder per city) → S1/S2 scan them back → A2 flatten."""
    from reviewflow.session import scratch_path
    from reviewflow.sinks.envelope import write_envelope
    from reviewflow.sources.landing import scan_landing

    docs = D.review_documents(_t(spark, sf_dir, "conversations")).withColumn("city_slug", X.slug("city"))
    path = scratch_path(spark, "landing-reviews")
    write_envelope(docs, path, partition_col="city_slug", root="data",
                   constants={"disclaimer": K.DEFAULT_DISCLAIMER}, mode="overwrite")
    back = scan_landing(spark, path, PL.REVIEW_READ_SCHEMA, multi_line=False)
    return FL.flatten_reviews(back).drop("author_id")


@register("q_multiline_scan", _FLAT_REVIEWS_SQL)
def q_multiline_scan(spark, sf_dir):
    """One indented document per (hospital, chunk), one file each, scanned back as multi-line JSON → A2 flatten."""
    from reviewflow.session import scratch_path
    from reviewflow.sinks.envelope import write_single_documents
    from reviewflow.sources.landing import scan_landing

    # as they come from the nesting, in chunks: no document holds a whole city or a whole hot hospital
    docs = D.review_documents(_t(spark, sf_dir, "conversations"))
    path = scratch_path(spark, "landing-single")
    write_single_documents(docs, path, F.struct("disclaimer", "first_review", "data"))
    back = scan_landing(spark, path, PL.REVIEW_READ_SCHEMA, multi_line=True, suffix=".txt")
    return FL.flatten_reviews(back).drop("author_id")


@register("q_json_pretty", """
SELECT conv_id, turn, '{' || chr(10) || '  "turn" : ' || turn || ',' || chr(10) || '  "role" : "' || role || '",' || chr(10)
       || '  "none" : null,' || chr(10) || '  "size" : [ ' || length(text) || ', ' || turn || ' ]' || chr(10) || '}' AS document
FROM conversations
""")
def q_json_pretty(spark, sf_dir):
    """struct → indented JSON text, nulls written."""
    conv = _t(spark, sf_dir, "conversations")
    doc = F.struct("turn", "role", F.lit(None).cast("string").alias("none"),
                   F.array(F.length("text").cast("long"), F.col("turn")).alias("size"))
    return conv.select("conv_id", "turn", FL.to_json_text(doc, pretty=True).alias("document"))


def _land_reviews_sql(min_count: int = K.MIN_REVIEWS_PER_HOSPITAL) -> str:
    g = O.synthetic_review_cols(["place_id", "pos"], "land")
    child = ("author_name, rating, text, time, translated, original_language, review_type, date")
    gen_cols = ", ".join(f"{g[c.strip()]} AS {c.strip()}" for c in child.split(","))
    return f"""
WITH h AS (
  SELECT 'place-' || conv_id AS place_id,
         coalesce(CASE WHEN role <> 'system' THEN conv_id || ' Main Street' END, 'N/A') AS formatted_address
  FROM conversations WHERE turn = 0),
ok AS (SELECT 'place-' || conv_id AS place_id FROM conversations GROUP BY conv_id HAVING count(*) >= 3),
kept AS (
  SELECT 'place-' || conv_id AS place_id, CAST(turn AS INTEGER) AS pos, role AS author_name,
         CAST(length(text) % 5 + 1 AS BIGINT) AS rating, text,
         CAST(1700000000 + conv_id * 3600 + turn * 60 AS BIGINT) AS time, role = 'assistant' AS translated,
         coalesce(CASE WHEN role <> 'system' THEN 'en' END, 'en') AS original_language, 'real' AS review_type,
         strftime(make_timestamp((1700000000 + conv_id * 3600 + turn * 60) * 1000000), '%Y-%m-%d') AS date
  FROM conversations WHERE turn < {K.REAL_REVIEWS_LIMIT}),
parents AS (SELECT h.* FROM h JOIN ok USING (place_id)),
children AS (SELECT p.formatted_address, k.* FROM kept k JOIN parents p USING (place_id)),
n AS (SELECT p.place_id, p.formatted_address, count(c.place_id) AS n
      FROM parents p LEFT JOIN children c USING (place_id) GROUP BY ALL)
SELECT * FROM children
UNION ALL BY NAME
SELECT place_id, formatted_address, pos, {gen_cols}
FROM (SELECT place_id, formatted_address, CAST(unnest(generate_series(n, {min_count - 1})) AS INTEGER) AS pos
      FROM n WHERE n < {min_count})
"""


@register("q_land_reviews", _land_reviews_sql())
def q_land_reviews(spark, sf_dir):
    """Flow B landing side: J1 attach details (failed → dropped, first 5) → P8 defaults →
    A6 pad each hospital to 100 reviews with generated ones (flat rows, ready to nest and land)."""
    conv = _t(spark, sf_dir, "conversations")
    places = D.conversation_hospitals(conv).drop("name")
    flat = PL.land_reviews_frame(places, D.conversation_details(conv), key="place_id",
                                 limit=K.REAL_REVIEWS_LIMIT, min_count=K.MIN_REVIEWS_PER_HOSPITAL, salt="land")
    cols = ["author_name", "rating", "text", "time", "translated", "original_language", "review_type", "date"]
    return flat.select("place_id", "formatted_address", "pos", *cols)


def _label_reviews_model_sql() -> str:
    neg = O.lexicon_count("review", K.ADJECTIVES_NEGATIVE)
    neu = O.lexicon_count("review", K.ADJECTIVES_NEUTRAL)
    pos = O.lexicon_count("review", K.ADJECTIVES_POSITIVE)
    return f"""
WITH l AS ({_land_reviews_sql()}),
r AS (SELECT 'Hospital ' || regexp_replace(place_id, '^place-', '') AS hospital_name, formatted_address AS address,
             CAST(NULL AS DOUBLE) AS hospital_rating, author_name,
             CAST({O.murmur3('author_name')} AS VARCHAR) AS author_id, text AS review, place_id FROM l),
c AS (SELECT *, {neg} AS a, {neu} AS b, {pos} AS c FROM r)
SELECT hospital_name, address, CAST(hospital_rating AS FLOAT) AS hospital_rating, author_name, author_id, review,
       CASE WHEN review IS NULL OR regexp_replace(review, '^\\s+|\\s+$', '', 'g') = '' THEN ''
            WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS sentiment,
       CASE WHEN octet_length(encode(review)) > 65535 THEN 'review' ELSE '' END AS _errors,
       place_id, 'lexicon' AS method, TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime
FROM c
QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY review, author_name, hospital_name, address, place_id) = 1
"""


@register("q_label_reviews_model", _label_reviews_model_sql())
def q_label_reviews_model(spark, sf_dir):
    """Flow C, model variant: every landed review → classifier (pandas UDF) argmax label →
    K1 one row per author id (real authors repeat; hash key) → K3 conform to the model table."""
    flat = q_land_reviews(spark, sf_dir)
    reviews = flat.select(
        F.concat(F.lit("Hospital "), F.regexp_replace("place_id", "^place-", "")).alias("hospital_name"),
        F.col("formatted_address").alias("address"), F.lit(None).cast("double").alias("hospital_rating"),
        "author_name", X.author_id("author_name").alias("author_id"), F.col("text").alias("review"),
        F.lit(None).cast("string").alias("sentiment"), "place_id")
    return PL.label_frame(reviews, skip_labelled=False, spec=S.MODEL_SENTIMENT, variant="model", load_ts=D.FIXED_LOAD_TS)


@register("q_land_places", f"""
WITH {_PAGES_CTE}
SELECT request_id, result AS name, 'OPERATIONAL' AS business_status, 'line ' || (pos + 1) AS address,
       CAST(page_no AS DOUBLE) AS latitude, CAST(pos AS DOUBLE) AS longitude, 'true' AS open_now,
       CAST(length(result) AS FLOAT) AS rating, 1 AS user_ratings_total, 'hospital' AS types,
       request_id || '-p' || page_no || '-' || pos AS place_id,
       TIMESTAMP '2025-01-01 00:00:00' AS loaddatetime, '' AS _errors
FROM kept
""")
def q_land_places(spark, sf_dir):
    """Flow A landing side: raw pages → J2 assembly → place documents per request (A8) → A1 load
    with P4 required columns and K3 conformance (the loaded rows, tagged with their request)."""
    pages = D.conversation_place_pages(_t(spark, sf_dir, "conversations"))
    flat = FL.flatten_places(PL.land_places_frame(pages), keep=["request_id"])
    flat = C.with_audit(C.require(flat, PL.PLACE_REQUIRED), D.FIXED_LOAD_TS)
    return C.conform_to_schema(flat, S.HOSPITAL_LISTS, keep=["request_id"])


# Two names that Murmur3 with seed 42 gives one 32-bit value.
COLLIDING_NAMES = ("Reviewer 134944", "Reviewer 41889")


@register("q_author_collisions", f"""
WITH n AS (SELECT c_name AS name FROM customer UNION ALL SELECT '{COLLIDING_NAMES[0]}' FROM customer
           UNION ALL SELECT '{COLLIDING_NAMES[1]}' FROM nation UNION ALL SELECT c_name FROM customer),
h AS (SELECT CAST({O.murmur3('name')} AS VARCHAR) AS author_id, name FROM n)
SELECT author_id, count(*) AS n_rows, count(DISTINCT name) AS n_names, min(name) AS first_name, max(name) AS last_name
FROM h GROUP BY author_id HAVING count(DISTINCT name) > 1
""")
def q_author_collisions(spark, sf_dir):
    """ids that unlike authors share, among the customers (each twice) and two names made to collide."""
    names = _t(spark, sf_dir, "customer").select(F.col("c_name").alias("author_name"))
    first = names.select(F.lit(COLLIDING_NAMES[0]).alias("author_name"))
    second = _t(spark, sf_dir, "nation").select(F.lit(COLLIDING_NAMES[1]).alias("author_name"))
    return C.author_collisions(names.union(first).union(second).union(names))
