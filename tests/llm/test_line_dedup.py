from reviewflow.llm import line_dedup as op


def brute(rows):
    places = {}
    order = sorted({(i is None, i or 0, t or "") for i, t in rows if t is not None})
    for none, i, t in order:
        lines = t.split("\n")
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if any(x.strip(" \t\r\x0b\x0c") for x in w):
                places.setdefault(w, []).append((none, i, t, p))
    gone = {}
    for found in places.values():
        for none, i, t, p in found[1:]:
            gone.setdefault((none, i, t), set()).update(range(p, p + 3))
    out = []
    for i, t in rows:
        g = gone.get((i is None, i or 0, t), set()) if t is not None else set()
        lines = t.split("\n") if t is not None else []
        out.append((i, len(lines), len(g), None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in g)))
    return sorted(out, key=repr)


ROWS = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\na\na\na\na"), (4, "b\nc"), (5, None), (6, ""), (7, "\n\n\n\n"), (8, "\n\n\n"),
        (9, "c\nd\ny\nz"), (None, "a\nb\nc"), (None, "q\nr\ns"), (None, "q\nr\ns"), (10, "a\nb\nc\nd"), (10, "a\nb\nc\nd"),
        (11, "p\r\nq \n\t\nr"), (12, "p\r\nq \n\t\nr"), (13, "\n".join(str(i % 7000) for i in range(20_000)))]


def test_against_brute_force(docs):
    rows = ROWS + [(100 + k, f"only {k}\nshared one\nshared two\nshared three\nlast {k}") for k in range(40)]
    got = op.dedup_lines(docs(rows, extra=("pos", "body", "gone", "starts"))).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_every_line_stays_somewhere(docs):
    got = op.dedup_lines(docs(ROWS), carry=False).collect()
    left = {x for r in got if r.text is not None for x in r.text.split("\n")}
    assert {x for _, t in ROWS if t is not None for x in t.split("\n")} <= left | {""}


def test_clean_keeps_columns_and_counts_anew(docs):
    df = docs([(1, "a\nb\nc\nd"), (2, "a\nb\nc\nnew"), (3, "a\nb\nc"), (4, ""), (5, None)], extra=("n_lines",))
    got = op.clean(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == [
        (1, "a\nb\nc\nd", 7), (2, "new", 3), (4, "", 0), (5, None, None)]
    assert op.clean(df.where("false")).collect() == []
