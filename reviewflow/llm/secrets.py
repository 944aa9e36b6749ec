"""Secret scans in DataFrame functions only (operator 2).

Base spans come from fixed patterns.  Candidate strings, long runs of key
characters, are then judged by Shannon entropy in a sliding window: the
window's sum of n log2 n changes by the counts of the character that enters
and the one that leaves.  A candidate belongs to the class hex or
base64, each with its own threshold; an allow-list lets candidates pass that
are words, numbers or a UUID as a whole.  Windows above the threshold are
merged into spans of kind ``entropy``; one goes if all its windows meet a
placeholder, counting or a long repeat, and what base spans cover is cut out
of the others: the pieces left are spans of their own, however short.

Positions are found by cutting the text at the matches: pieces and matches in
turn add up to every match's start, in code points.

Cases: null text is empty text and has no spans; rows that repeat are treated
alike; texts of any length are scanned whole, running sums are kept in blocks
so that many matches in one text cost no quadratic copying, and a run of any
length is cut into pieces that overlap by a window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import whole_text

# Fixed values of the contract: kind, pattern, pattern whose group decides, shortest group.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
# A run of 32 is found faster than all runs; a run matches as a whole either way.
SEARCH = {"hex": r"[0-9a-f]{32,}", "access": r"AKIA[A-Z0-9]{12,}"}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WIDTH = 20
HEX, HEX_BITS, BASE64_BITS = r"^([0-9a-f]+|[0-9A-F]+)$", 2.85, 3.65
# Candidates that as a whole are no secrets: words and paths, numbers, UUIDs.
AS_A_WHOLE = (r"^[A-Za-z/_+-]+$", r"^[0-9/_+-]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
# Placeholders, counting and long repeats: harmless where they stand, not in the rest of their candidate.
HARMLESS = r"(?i:example|placeholder|sample|dummy|your_|x{6,}|0123456|abcdefg)|(.)\1{7,}"
MASK = "."      # no character of a candidate
PIECE = 128     # windows that a running sum covers; longer candidates are cut into pieces of so many
BLOCK = 512
SPAN = "struct<s:int,e:int,m:string>"
NO_SPANS = "cast(array() AS array<struct<s:int,e:int>>)"


def _located(pieces: str, found: str) -> str:
    """SQL, array of (s, e, m): where each match of ``found`` lies, from the text's pieces between the matches."""
    return f"""
        CASE WHEN size({found}) = 0 THEN cast(array() AS array<{SPAN}>) ELSE
        flatten(aggregate(sequence(0, size({found}) - 1, {BLOCK}),
          named_struct('at', 0, 'out', cast(array() AS array<array<{SPAN}>>)),
          (a, c) -> transform(array(aggregate(sequence(c, least(c + {BLOCK - 1}, size({found}) - 1)),
              named_struct('at', a.at, 'out', cast(array() AS array<{SPAN}>)),
              (b, i) -> named_struct('at', b.at + length(get({pieces}, i)) + length(get({found}, i)),
                'out', concat(b.out, array(named_struct('s', b.at + length(get({pieces}, i)),
                  'e', b.at + length(get({pieces}, i)) + length(get({found}, i)), 'm', get({found}, i))))))),
            x -> named_struct('at', x.at, 'out', concat(a.out, array(x.out))))[0],
          a -> a.out)) END"""


def locate(rows: DataFrame, name: str, pattern: str) -> DataFrame:
    """``rows`` (text, ...) with ``name``: the matches of ``pattern`` as (s, e, m).  The text is cut only where there is one."""
    every = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    found = rows.withColumn("_found", every)
    cut = found.withColumn("_pieces", F.when(F.size("_found") > 0, F.split("text", pattern, -1)))
    return cut.withColumn(name, F.expr(_located("_pieces", "_found"))).drop("_found", "_pieces")


def _verdicts() -> str:
    """SQL over a candidate c (m, mask): a character for each window in order: 0 below its class's threshold, else 2 if free of
    masked characters and 1 if not.

    The candidate is cut into pieces that each begin with the last WIDTH - 1 characters of the piece before, so every window
    lies in one of them.  What a character adds as it enters a window, or takes as it leaves, follows from how often it
    stands in the WIDTH - 1 characters that both windows have.
    """
    steps = f"array({', '.join(f'{(n + 1) * math.log2(n + 1) - (n * math.log2(n) if n else 0.0)!r}D' for n in range(WIDTH))})"
    least = f"(CASE WHEN c.m RLIKE '{HEX}' THEN {HEX_BITS}D ELSE {BASE64_BITS}D END)"
    shared = f"substring(x.m, greatest(i - {WIDTH - 2}, 1), IF(i < {WIDTH - 1}, i, {WIDTH - 1}))"

    def change(char):
        return f"get({steps}, length(b) - length(replace(b, {char}, '')))"
    enters, leaves = change("substring(x.m, i + 1, 1)"), f"IF(i >= {WIDTH}, {change(f'substring(x.m, i - {WIDTH - 1}, 1)')}, 0D)"
    free = f"instr(substring(x.mask, i - {WIDTH - 2}, {WIDTH}), '{MASK}') = 0"
    pieces = "transform(parts, (y, k) -> concat(IF(k = 0, '', right(get(parts, k - 1), {0})), y))".format(WIDTH - 1)

    def cut(text):
        return f"transform(array(regexp_extract_all({text}, '.{{1,{PIECE}}}', 0)), parts -> {pieces})[0]"
    return f"""
      array_join(flatten(transform(array({least}), floor_bits -> transform(
        zip_with({cut('c.m')}, {cut('c.mask')}, (m, mask) -> named_struct('m', m, 'mask', mask)), x -> aggregate(sequence(0, length(x.m) - 1),
        named_struct('sum', 0D, 'out', ''),
        (a, i) -> transform(array({shared}), b -> transform(array(a.sum + {enters} - {leaves}), t -> named_struct('sum', t, 'out',
          CASE WHEN i < {WIDTH - 1} THEN a.out WHEN {math.log2(WIDTH)!r}D - t / {WIDTH} < floor_bits THEN concat(a.out, '0')
               WHEN {free} THEN concat(a.out, '2') ELSE concat(a.out, '1') END))[0])[0],
        a -> a.out)))), '')"""


def _entropy_spans() -> str:
    """SQL over a candidate c (s, e, m, mask): spans of the windows that reach their threshold, merged where they touch, if one
    of them is free of masked characters.  WIDTH and more windows below it part two spans."""
    zeros, pad = f"0{{{WIDTH},}}", "0" * WIDTH
    # zeros stand first and last, so the island before each but the first run of zeros ends where that run begins
    return f"""
      flatten(transform(array(concat('{pad}', {_verdicts()}, '{pad}')), v -> IF(instr(v, '2') = 0, {NO_SPANS}, flatten(transform(
        array(named_struct('islands', split(v, '{zeros}', -1), 'zeros', regexp_extract_all(v, '{zeros}', 0))), w ->
        transform(filter(transform({_located('w.islands', 'w.zeros')}, (z, k) -> named_struct('to', z.s, 'm', get(w.islands, k))), y -> instr(y.m, '2') > 0),
          y -> named_struct('s', c.s + y.to - length(y.m) - {WIDTH}, 'e', c.s + y.to - 1)))))))"""


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base and all: arrays of (s, k, e), sorted; k is the kind's place in ``kinds()``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    for kind, pattern, _, _ in BASE:
        rows = locate(rows, f"_{kind}", SEARCH.get(kind, pattern))
    rows = locate(rows, "_runs", CANDIDATE)
    kept = {kind: F.filter(f"_{kind}", _longer(pattern, group, least)) for kind, pattern, group, least in BASE}
    base = F.array_sort(F.concat(*[F.transform(kept[kind], _as_span(k)) for k, (kind, *_) in enumerate(BASE)]))
    suspects = F.transform(F.filter("_runs", lambda c: ~_any(c["m"], AS_A_WHOLE)), lambda c: F.struct(c["s"], c["e"], c["m"], _masked(c["m"]).alias("mask")))
    found = rows.select("doc_id", base.alias("base"), suspects.alias("suspects"))
    extra = F.expr(f"flatten(transform(suspects, c -> {_entropy_spans()}))")
    found = found.select("doc_id", "base", F.when(F.size("suspects") > 0, extra).otherwise(F.expr(NO_SPANS)).alias("extra"))
    free = F.expr(f"""
        flatten(transform(extra, x -> aggregate(filter(base, b -> b.s < x.e AND x.s < b.e),
          named_struct('at', x.s, 'out', cast(array() AS array<struct<s:int,k:int,e:int>>)),
          (a, b) -> named_struct('at', greatest(a.at, b.e), 'out',
            IF(b.s > a.at, concat(a.out, array(named_struct('s', a.at, 'k', {len(BASE)}, 'e', b.s))), a.out)),
          a -> IF(a.at < x.e, concat(a.out, array(named_struct('s', a.at, 'k', {len(BASE)}, 'e', x.e))), a.out))))""")
    return found.select("doc_id", "base", F.array_sort(F.concat("base", free)).alias("all"))


def _longer(pattern: str, group: int, least: int):
    def test(c):
        return F.length(F.regexp_extract(c["m"], pattern, group) if group else c["m"]) >= least
    return test


def _as_span(k: int):
    def span(c):
        return F.struct(c["s"].alias("s"), F.lit(k).alias("k"), c["e"].alias("e"))
    return span


def _any(text: Column, patterns) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | text.rlike(pattern)
    return hit


def _masked(text: Column) -> Column:
    """The text with every character of a harmless stretch replaced by MASK."""
    parts = F.zip_with(F.split(text, HARMLESS, -1), F.regexp_extract_all(text, F.lit(HARMLESS), F.lit(0)),
                       lambda piece, hit: F.concat(piece, F.coalesce(F.repeat(F.lit(MASK), F.length(hit)), F.lit(""))))
    return F.when(text.rlike(HARMLESS), F.array_join(parts, "")).otherwise(text)


def kinds() -> list[str]:
    return [kind for kind, *_ in BASE] + ["entropy"]


def joined(spans: str) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds()])

    def text(x):
        return F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def counted(spans: str, k: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")
