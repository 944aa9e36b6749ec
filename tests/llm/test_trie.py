import hashlib
import random
import zlib

from reviewflow.llm import trie as op
from reviewflow.llm.common import prepare
from reviewflow.llm.queries import QUERIES

from .conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    conv = {}
    for c, t, r, x in rows:
        if c is not None:
            conv.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: sorted(turns) for c, turns in conv.items()}


def paths_of(rows, rebuild):
    conv = {c: [t[2:] for t in turns] for c, turns in ordered(rows).items()}
    if not rebuild:
        return conv
    out = {}
    for c, turns in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        out[c] = conv.get(base, [])[:h] + turns[h:]
    return out


def brute(rows, rebuild=True):
    paths = paths_of(rows, rebuild)
    members, children = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ends = sorted(c for c in members[p] if len(paths[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(spark, rows, rebuild=True, width=op.WIDTH, extra=()):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in extra:
        df = df.selectExpr("*", f"1 AS {c}")
    turns = op.rebuilt(df) if rebuild else op.as_they_are(df)
    return rows_of(op.trie(turns, width).select(COLUMNS))


def some(seed, convs=60, longest=30):
    """Conversations over few turns, so prefixes are shared; copies, gaps in the numbers, and ids far apart."""
    r = random.Random(seed)
    rows, kept = [], []
    for _ in range(convs):
        c = r.choice([r.randrange(400), r.randrange(-300, 0), r.randrange(10 ** 6)])
        if any(c == x for x, _ in kept):
            continue
        turns = [(r.choice(["user", "assistant"]), r.choice("ab") * r.randint(0, 2)) for _ in range(r.randint(1, longest))]
        if kept and r.random() < .5:
            same = r.choice(kept)[1]
            turns = same[:r.randint(1, len(same))] + (turns[:3] if r.random() < .5 else [])
        kept.append((c, turns))
        rows += [(c, 3 * i, role, text) for i, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    return rows


def test_random_conversations(spark):
    for seed in (1, 2):
        rows = some(seed)
        assert made(spark, rows) == brute(rows)


def test_blocks_go_on_with_the_node_before_them(spark):
    rows = some(3)
    for width in (1, 2, 5):
        assert made(spark, rows, rebuild=False, width=width) == brute(rows, rebuild=False)


def test_long_conversations_and_copies(spark):
    """Conversations over several windows of block keys, equal to their last turn but one."""
    r = random.Random(4)
    turns = [(i, "user", str(r.randrange(3))) for i in range(5000)]
    rows = [(c, *t) for c in (11, 12) for t in turns] + [(12, 9999, "user", "more")] + [(13, *t) for t in turns[:2100]]
    assert made(spark, rows, rebuild=False) == brute(rows, rebuild=False)


def test_list_of_ends_in_several_chunks(spark):
    rows = [(c, 0, "user", "hello") for c in range(-5000, 9000)] + [(9500, 0, "user", "hello"), (9500, 1, "user", "x")]
    assert made(spark, rows, rebuild=False) == brute(rows, rebuild=False)


def test_cases(spark):
    assert made(spark, []) == []
    assert made(spark, [(None, 1, "user", "x")]) == []
    rows = [(500, None, None, None), (500, None, "user", "b"), (500, 2, "user", None), (500, 2, "user", None), (501, 1, "", ""),
            (502, 1, "ab", "c"), (503, 1, "a", "bc"), (7, 1, "user", "é𝄞" * 3000), (8, 1, "user", "é𝄞" * 3000), (None, 1, "user", "gone")]
    assert made(spark, rows, extra=("pos", "id", "b", "k1", "t0", "level")) == brute(rows)
    # the root of turnless conversations: c has fewer turns than it gives up, and its base is not there
    alone = next(c for c in range(1101, 1200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    assert made(spark, [(alone, 0, "user", "x")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_nodes_with_their_text(spark):
    prepare(spark)
    rows = some(5, 20, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    paths = paths_of(rows, rebuild=False)
    got = op.with_text(op.trie(op.as_they_are(df)), df).select("conv_id", "depth", "role", "text", "turn_chars").collect()
    assert len(got) == len(brute(rows, rebuild=False))
    for c, d, role, text, chars in got:
        assert ((role, text) == paths[c][d - 1] and chars == len(text)) if d else (role is None and chars == 0)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op11_conversation_trie"](spark, d).select(COLUMNS)) == brute(rows)


def test_one_rollup_takes_every_block(spark):
    """Long conversations cost no further pass: all blocks lie in one grouping."""
    prepare(spark)
    blocks = op.in_blocks(op.as_they_are(spark.createDataFrame([(1, i, "user", str(i)) for i in range(100)], SCHEMA)))
    plan = op.rolled_up(blocks, "min(conv_id) AS owner")._jdf.queryExecution().executedPlan().toString()
    assert blocks.count() == 13 and plan.count("Expand") == 1
