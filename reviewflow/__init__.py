"""reviewflow — Spark-native place and review ingestion, flattening and sentiment labelling.

Every operator is a DataFrame expression, join, window, aggregate or an
Arrow-batched pandas UDF; nothing is computed on the driver.

The flows (one planned DataFrame and one writing action each)::

    from reviewflow import get_session, load_places, load_reviews, label_reviews
    spark = get_session()
    load_reviews(spark, "s3://…/hospitals_review/", table="hospitals_reviews_ingestion")
    label_reviews(spark, "hospitals_reviews_ingestion", variant="score")
"""

from reviewflow.plans.flows import (  # noqa: F401
    label_frame, label_reviews, land_places, land_places_frame, land_reviews, land_reviews_frame,
    land_synthetic, load_places, load_reviews, places_frame, review_documents_frame, reviews_frame,
)
from reviewflow.schemas import TARGET_TABLES, create_target_tables  # noqa: F401
from reviewflow.session import checkpoint_root, get_session, spread  # noqa: F401

__all__ = [
    "get_session", "checkpoint_root", "spread", "create_target_tables", "TARGET_TABLES",
    "places_frame", "load_places", "reviews_frame", "load_reviews", "label_frame", "label_reviews",
    "land_places_frame", "land_places", "land_reviews_frame", "review_documents_frame", "land_reviews",
    "land_synthetic",
]
