from reviewflow.streaming.landing_stream import landing_stream, stream_labels, stream_places, stream_reviews  # noqa: F401
