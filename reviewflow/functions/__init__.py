from reviewflow.functions.exprs import (  # noqa: F401
    argmax, author_id, bool_to_int, compact_time_text, epoch_date, epoch_to_timestamp, fill_template,
    hash_date, hash_int, hash_pick, hash_tenths, is_blank, load_time_text, lookup, months_ago_text,
    newline_to_comma, pick_from, rating_class, score_label, slug,
)
