import hashlib
import random

import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewflow.llm import bpe as op
from reviewflow.llm.queries import QUERIES, tokenizer_files

PATH, PATTERN = tokenizer_files()
RANKS = op.read_ranks(open(PATH, "rb").read())
OURS = op.Tokenizer(RANKS, PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = st.text(st.sampled_from("ab e\n\t 'sé漢🙂1.,! 　ßtion"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.one_of(ODD, st.text(max_size=40).filter(lambda s: s.isprintable())))
def test_same_ids_as_the_library_and_exact_round_trip(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode_ordinary(text) and OURS.decode(ids) == text.encode()
    assert op.Tokenizer(RANKS, PATTERN, cut=False).encode(text) == ids


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=10), st.integers(0, 30), st.integers(0, 10))
def test_prefixes_follow_appends_and_edits(data, more, start, length):
    v = OURS.vocabulary
    p = op.Prefixes(v, data)
    p.append(more)
    assert list(p.last) == list(op.Prefixes(v, data + more).last)
    whole = data + more
    start, end = min(start, len(whole)), min(start + length, len(whole))
    p.edit(start, end, more)
    fresh = op.Prefixes(v, whole[:start] + more + whole[end:])
    assert p.data == fresh.data and list(p.last) == list(fresh.last)


def test_edited_text_encodes_like_a_new_one():
    r = random.Random(2)
    letters = "ab c\n  ABé漢🙂1.,'s\t!"
    for _ in range(60):
        x = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        e = op.EditableText(OURS, x)
        for _ in range(6):
            i = r.randint(0, len(x))
            j, y = r.randint(i, min(len(x), i + 4)), "".join(r.choice(letters) for _ in range(r.randint(0, 5)))
            x = x[:i] + y + x[j:]
            e.edit(i, j, y)
            assert e.ids() == THEIRS.encode_ordinary(x)
        e.append("able to")
        assert e.ids() == THEIRS.encode_ordinary(x + "able to")


def test_long_piece_and_long_text():
    for text in ["a" * 5000, "!" * 3000, " " * 4000, "thatonion" * 700, "word and more. " * 80_000]:
        assert OURS.encode(text) == THEIRS.encode_ordinary(text)


def test_small_memories_give_the_same(monkeypatch):
    monkeypatch.setattr(op, "PAIRS_KEPT", 3)
    t = op.Tokenizer(RANKS, PATTERN)
    t.pieces.most = t.stretches.most = 2
    text = "Thntblere of then, edtioner in inea that esly ndstnd " * 5
    assert t.encode(text) == THEIRS.encode_ordinary(text)


def test_query_against_the_library(spark):
    path = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        ids = THEIRS.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_byte_bpe"](spark, path).collect()} == want


def test_nulls_empty_tables_and_clashing_names(spark, docs):
    coder = op.Coder(spark, PATH, PATTERN)
    df = docs([(1, None), (2, ""), (None, "a b")], extra=("texts", "key"))
    got = coder.decode(coder.encode(df)).collect()
    assert sorted((r.doc_id or 0, len(r.ids), bytes(r.decoded)) for r in got) == [(0, 2, b"a b"), (1, 0, b""), (2, 0, b"")]
    assert coder.encode(df.where("false")).collect() == []


def test_which_tokens_may_touch_is_what_merging_their_bytes_gives():
    v, r = OURS.vocabulary, random.Random(4)
    short = sorted(i for t, i in RANKS.items() if len(t) < 6)
    whole = [i for i in short if v.whole(i)]
    pairs = [(r.choice(whole), r.choice(short)) for _ in range(20_000)]
    pairs += [(a, b) for a in whole[:60] for b in whole[200:400]]
    assert all(v.follows(a, b) == (v.merged(v.tokens[a] + v.tokens[b]) == [a, b]) for a, b in pairs)


def same_batch(tokenizer, texts):
    got = tokenizer.encode_batch(pa.array(texts, pa.string()))
    assert got.to_pylist() == [THEIRS.encode_ordinary(x or "") for x in texts]
    assert tokenizer.decode_batch(got).to_pylist() == [(x or "").encode() for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ODD, st.text(st.sampled_from("a  \n\x1c\x85é"), max_size=9)), max_size=8))
def test_batches_give_the_ids_of_the_library(texts):
    same_batch(OURS, texts)


def test_batches_of_uneven_long_and_sliced_texts():
    texts = ["", None, " ", "  a", "a  b", "a \n b c", "if x:\n    return  y \n", "a" * 40 + " " + "漢" * 30 + " x" * 9, "\0 a\0b \0"]
    for at in range(len(texts)):
        same_batch(OURS, texts[at:] + texts[:at])
    whole = pa.array(texts, pa.string())
    got = OURS.encode_batch(whole.slice(3, 4))
    assert got.to_pylist() == [THEIRS.encode_ordinary(x) for x in texts[3:7]]
    assert OURS.decode_batch(got.slice(1, 2)).to_pylist() == [x.encode() for x in texts[4:6]]
    assert OURS.decode_batch(pa.array([None, []], pa.list_(pa.int32()))).to_pylist() == [b"", b""]


def test_full_stores_give_the_same(monkeypatch):
    r, t = random.Random(5), op.Tokenizer(RANKS, PATTERN)
    words = ["".join(r.choice("thaneoringed,.") for _ in range(r.randint(1, 30))) for _ in range(300)]
    monkeypatch.setattr(op, "LONG_TEXT", 25)
    for kept, stored in [(60, 1 << 20), (1 << 20, 150), (200, 1 << 20), (0, 0)]:
        monkeypatch.setattr(op, "PIECES_KEPT", kept)
        monkeypatch.setattr(op, "STORED", stored)
        for _ in range(8):
            same_batch(t, [" ".join(r.choices(words, k=12)) for _ in range(r.choice([1, 3, 30]))])


def test_a_batch_that_comes_twice_is_encoded_once(monkeypatch):
    t, runs = op.Tokenizer(RANKS, PATTERN), []
    work = t._batch
    monkeypatch.setattr(t, "_batch", lambda texts: runs.append(len(texts)) or work(texts))
    first, other = ["the one and", None, "other"], ["the one and", "", "others"]
    for texts in (first, first, other, other, first):
        same_batch(t, texts)
    assert runs == [3, 3, 3]


def test_the_query_encodes_each_batch_once(spark, docs, tmp_path):
    coder = op.Coder(spark, PATH, PATTERN + "|(?!)")      # a tokenizer of its own, so that no other test has the watched one
    key, data, log = coder.key, coder.data, str(tmp_path / "runs")

    @op.F.arrow_udf("long")
    def watched(x: pa.Array) -> pa.Array:
        tokenizer = op._tokenizer(key, data)
        if "_batch" not in vars(tokenizer):
            work = tokenizer._batch

            def noted(texts):
                with open(log, "a") as f:
                    f.write("x")
                return work(texts)
            tokenizer._batch = noted
        return x

    df = docs([(k, f"text {k} of the batch") for k in range(20)]).coalesce(1).withColumn("doc_id", watched("doc_id"))
    coded = coder.decode(coder.encode(df))
    got = coded.select("doc_id", op.F.size("ids").alias("n"), "decoded").collect()
    assert {r.doc_id: bytes(r.decoded) for r in got} == {k: f"text {k} of the batch".encode() for k in range(20)}
    assert open(log).read() == "x"
