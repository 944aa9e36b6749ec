"""SQL fragments for the DuckDB oracles, written independently of the Spark code.

The fixed values (templates, adjective lists, hospital types) are rendered
from ``reviewflow.constants`` as SQL list literals; the logic is SQL.
"""

from __future__ import annotations

from reviewflow import constants as K


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(salt_expr: str, n: int) -> str:
    """First 32 bits of md5(<salt text>) as an unsigned integer, mod n."""
    return f"(('0x' || substr(md5({salt_expr}), 1, 8))::BIGINT % {n})"


def key_text(salt: str, keys: list[str]) -> str:
    return " || ':' || ".join([q(salt)] + [f"CAST({k} AS VARCHAR)" for k in keys])


def rating_class(r: str) -> str:
    return (f"CASE WHEN {r} IS NULL THEN NULL WHEN {r} >= 4 THEN 'positive' "
            f"WHEN {r} = 3 THEN 'neutral' ELSE 'negative' END")


def review_text(rating: str, keys: list[str], salt: str) -> str:
    """Template of the rating's class with four adjectives of that class, all hash-picked."""
    cls = rating_class(rating)
    lists = {"positive": (K.POSITIVE_TEMPLATES, K.ADJECTIVES_POSITIVE),
             "neutral": (K.NEUTRAL_TEMPLATES, K.ADJECTIVES_NEUTRAL),
             "negative": (K.NEGATIVE_TEMPLATES, K.ADJECTIVES_NEGATIVE)}

    def by_class(which: int, salt_suffix: int) -> str:
        arms = []
        for name, pair in lists.items():
            vals = pair[which]
            idx = digits(key_text(f"{salt}:text", keys), 1 + 4 * salt_suffix, 4, len(vals))
            arms.append(f"WHEN {q(name)} THEN {sql_list(vals)}[{idx} + 1]")
        return f"(CASE {cls} " + " ".join(arms) + " END)"

    out = by_class(0, 0)
    for i, ph in enumerate(K.PLACEHOLDERS, start=1):
        out = f"replace({out}, {q(ph)}, {by_class(1, i)})"
    return out


def hash_int(salt: str, keys: list[str], lo: int, hi: int) -> str:
    return f"({lo} + {pick(key_text(salt, keys), hi - lo + 1)})"


def hash_date(salt: str, keys: list[str]) -> str:
    return f"(DATE '2020-01-01' + CAST({pick(key_text(salt, keys), 1827)} AS INTEGER))"


def digits(salt_expr: str, start: int, length: int, n: int) -> str:
    """Some hex digits of md5(<salt text>) as an unsigned integer, mod n."""
    return f"(('0x' || substr(md5({salt_expr}), {start}, {length}))::BIGINT % {n})"


def synthetic_review_cols(keys: list[str], salt: str) -> dict:
    """Columns of one generated review (mirrors the landed review shape)."""
    own = key_text(salt, keys)
    r = f"(1 + {digits(own, 21, 4, 5)})"
    day = f"(DATE '2020-01-01' + CAST({digits(own, 13, 8, 1827)} AS INTEGER))"
    tag = f"substr(md5({key_text(salt, keys)}), 1, 12)"
    return {
        "author_name": f"'Reviewer ' || {tag}",
        "author_url": f"'https://reviews.invalid/a/' || {tag}",
        "language": "'en'",
        "original_language": "'en'",
        "profile_photo_url": "CAST(NULL AS VARCHAR)",
        "rating": f"CAST({r} AS BIGINT)",
        "relative_time_description": f"(1 + {digits(own, 25, 4, 12)}) || ' months ago'",
        "text": review_text(r, keys, salt),
        "time": f"CAST(epoch({day}::TIMESTAMP) AS BIGINT)",
        "translated": "false",
        "review_type": "'fake'",
        "date": f"strftime({day}, '%Y-%m-%d')",
    }


def lexicon_count(text: str, words) -> str:
    inlist = ", ".join(q(w) for w in sorted(set(words)))
    return (f"CAST(len(list_filter(regexp_split_to_array(lower({text}), '[^a-z-]+'), "
            f"lambda t: t IN ({inlist}))) AS INTEGER)")


def score_label(s: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN isnan({s}) THEN 'Mixed' WHEN {s} > 0.25 THEN 'Positive' "
            f"WHEN {s} < -0.25 THEN 'Negative' ELSE 'Mixed' END")


def murmur3(s: str) -> str:
    """Spark's hash(<string>) — Murmur3 x86_32, seed 42, tail bytes mixed one at a time
    as sign-extended ints — as a DuckDB expression; NULL → 42."""
    m = "4294967295::UBIGINT"

    def mask(x):
        return f"(({x}) & {m})"

    def rotl(x, r):
        return mask(f"(({x}) << {r}) | (({x}) >> {32 - r})")

    def mix_k(k):
        k1 = mask(f"({k}) * 3432918353::UBIGINT")
        k1 = rotl(k1, 15)
        return mask(f"({k1}) * 461845907::UBIGINT")

    def mix_h(h, k):
        x = f"xor({h}, {k})"
        x = rotl(x, 13)
        return mask(f"({x}) * 5::UBIGINT + 3864292196::UBIGINT")

    hexs = f"hex(encode({s}))"
    n = f"octet_length(encode({s}))"
    word = (f"('0x' || substr({hexs}, 8*j+7, 2) || substr({hexs}, 8*j+5, 2) || substr({hexs}, 8*j+3, 2) "
            f"|| substr({hexs}, 8*j+1, 2))::UBIGINT")
    byte = f"('0x' || substr({hexs}, 2*i+1, 2))::UBIGINT"
    tail = f"(CASE WHEN {byte} >= 128 THEN {byte} + 4294967040::UBIGINT ELSE {byte} END)"
    body = (f"list_reduce(list_transform(range({n} // 4), lambda j: {word}), "
            f"lambda h, k: {mix_h('h', mix_k('k'))}, 42::UBIGINT)")
    full = (f"list_reduce(list_transform(range(({n} // 4) * 4, {n}), lambda i: {tail}), "
            f"lambda h, k: {mix_h('h', mix_k('k'))}, {body})")
    f1 = f"xor(h0, {n}::UBIGINT)"
    f2 = f"xor(h1, h1 >> 16)"
    f3 = mask("h2 * 2246822507::UBIGINT")
    f4 = f"xor(h3, h3 >> 13)"
    f5 = mask("h4 * 3266489909::UBIGINT")
    f6 = f"xor(h5, h5 >> 16)"
    chain = f"list_transform([{full}], lambda h0: {f1})[1]"
    for i, f in enumerate([f2, f3, f4, f5, f6], start=1):
        chain = f"list_transform([{chain}], lambda h{i}: {f})[1]"
    signed = f"list_transform([{chain}], lambda u: CASE WHEN u >= 2147483648 THEN CAST(u AS BIGINT) - 4294967296 ELSE CAST(u AS BIGINT) END)[1]"
    return f"(CASE WHEN {s} IS NULL THEN 42 ELSE {signed} END)"
