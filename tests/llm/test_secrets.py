import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest

from reviewflow.llm import secrets as op
from reviewflow.llm.queries import QUERIES

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ["assign", "access", "hex", "entropy"]


def brute(text):
    """(base spans, all spans) by definition: every window's entropy counted from nothing."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    taken = {i for a, _, b in base for i in range(a, b)}
    extra = []
    for c in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text):
        if any(re.search(a, c[0]) for a in op.AS_A_WHOLE):
            continue
        harmless = {i for m in re.finditer(r"(?i:example|placeholder|sample|dummy|your_|x{6,}|0123456|abcdefg)|(.)\1{7,}", c[0]) for i in range(*m.span())}
        least = op.HEX_BITS if re.search(op.HEX, c[0]) else op.BASE64_BITS
        spans = []
        for i in range(len(c[0]) - 19):
            n = Counter(c[0][i:i + 20]).values()
            if -sum(k / 20 * math.log2(k / 20) for k in n) >= least:
                free = harmless.isdisjoint(range(i, i + 20))
                if spans and spans[-1][1] >= i:
                    spans[-1][1:] = i + 20, spans[-1][2] or free
                else:
                    spans.append([i, i + 20, free])
        for a, b, free in spans:
            left = {i for i in range(c.start() + a, c.start() + b) if free and i not in taken}
            starts = [i for i in sorted(left) if i - 1 not in left or i == c.start() + a]
            extra += [(i, 3, next(j for j in range(i + 1, c.start() + b + 1) if j in taken or j == c.start() + b)) for i in starts]
    return sorted(base), sorted(base + extra)


def text_of(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


RANDOM = hashlib.sha512(b"1").hexdigest()
MIXED = "aZ9kQ2xW7eR4tY1uI8oP3sD6fG5hJ0lK"
TEXTS = [None, "", "é" * 30 + ' token = "' + RANDOM[:20] + '" end', "PASSWORD:abc token=secret: abcdefghi", "token=secret=abcdefgh", "AKIA" + "A1" * 8 + " AKIAB AKIA",
         RANDOM[:31] + " " + RANDOM[:32], f"x {MIXED} y", f"{MIXED}{'a' * 40}{MIXED}", "key: " + MIXED[:25] + "\nApiKey='" + MIXED + "'", "🙂 api_key : " + MIXED,
         "thatonioningtheandreation" * 3, "123e4567-e89b-12d3-a456-426614174000", RANDOM[:24].upper(), RANDOM[:24], "EXAMPLE" + MIXED,
         "secret_token==abcdefgh password=", "token=aaaaaaaa " * 1500, ("token=" + MIXED + ".") * 40, "x" * 200_000, MIXED * 300]


def test_against_brute_force(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[5])]
    got = op.scan(docs(rows, extra=("base", "suspects", "all", "m")))
    got = got.select("doc_id", op.joined("base").alias("b"), op.joined("all").alias("a")).collect()
    want = [(i, text_of(brute(t)[0]), text_of(brute(t)[1])) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert any("entropy" in a for _, _, a in want)


@pytest.mark.parametrize("seed", range(3))
def test_odd_runs_against_brute_force(docs, seed):
    r = random.Random(seed)
    parts = ["sample", "a" * 9, "0123456789", MIXED, RANDOM, "AKIA" + "B7" * 8, "word", "-", "/", " ", "token=", "XXXXXXXX", "thatonion", "=", "Zz9"]
    texts = ["".join(r.choice(parts)[:r.randint(1, 40)] for _ in range(r.choice([3, 20, 120]))) for _ in range(60)]
    got = op.scan(docs(list(enumerate(texts)))).select("doc_id", op.joined("all").alias("a")).collect()
    for g in got:
        assert g.a == text_of(brute(texts[g.doc_id])[1]), texts[g.doc_id]


def test_one_run_of_a_million_characters(docs):
    r = random.Random(7)
    text = "".join(r.choice(("aB3", "k9", "Qz7_", "the", "/", "xY0w", "ononon" * 6)) for _ in range(220_000))
    assert len(text) > 1_000_000
    rows, began = docs([(1, text)]).coalesce(1).cache(), time.time()
    rows.count()
    spans = op.scan(rows).select("all").collect()[0].all
    assert time.time() - began < 60
    # spans do not touch, and the windows around each border say why it is there
    least = op.BASE64_BITS - 1e-9

    def bits(i):
        return -sum(k / 20 * math.log2(k / 20) for k in Counter(text[i:i + 20]).values())
    assert len(spans) > 1000 and all(x.e < y.s for x, y in zip(spans, spans[1:]))
    for x in spans[:400] + spans[-400:]:
        assert bits(x.s) >= least and bits(x.e - 20) >= least and all(bits(i) < op.BASE64_BITS + 1e-9 for i in range(x.e - 19, min(x.e + 1, len(text) - 19)))


def test_harmless_stretches_and_base_spans_hide_only_themselves(docs):
    key, pem = MIXED, "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gtZW"
    texts = {1: "net/samples/v2/" + key, 2: key + "a" * 40 + key, 3: pem, 4: "your_api_key_example_0123456789", 5: "sample/0123456789abcdefghij/x",
             6: key + "G" + RANDOM[:32] + "G" + key, 7: "G" + key + RANDOM[:32], 8: "sample0Kx/" * 5000 + key}
    got = {r.doc_id: r.a for r in op.scan(docs(list(texts.items()))).select("doc_id", op.joined("all").alias("a")).collect()}
    spans = {i: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in t.split(",") if x)] for i, t in got.items()}

    def hidden(i, word):
        at = [m.start() for m in re.finditer(re.escape(word), texts[i])]
        return [a for a in at if not any(s <= a and a + len(word) <= e for k, s, e in spans[i] if k == "entropy")]
    assert not hidden(1, key) and spans[2] == [("entropy", 0, 32), ("hex", 32, 73), ("entropy", 73, 104)]
    assert spans[3] and not spans[4] and not spans[5]
    assert [k for k, *_ in spans[6]] == ["entropy", "hex", "entropy"] and spans[6][0][2] == spans[6][1][1] and spans[6][1][2] == spans[6][2][1]
    assert not hidden(6, key) and not hidden(7, key) and not hidden(8, key)


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, path).collect()}
    table = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert len(got) == len(table)
    for r in table:
        base, every = brute(r.text)
        g = got[r.doc_id]
        assert [g.n_assign, g.n_access, g.n_hex, g.n_entropy] == [sum(k == x for _, k, _ in every) for x in range(4)]
        assert g.base_sha256 == hashlib.sha256(text_of(base).encode()).hexdigest() and g.spans == text_of(every)


def test_plan_has_no_python_and_no_shuffle(docs):
    plan = op.scan(docs([(1, "a")]).coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan and "Aggregate [" not in plan


def test_empty_table(docs):
    assert op.scan(docs([(1, "a")]).where("false")).collect() == []
