import re
from math import ceil

import pytest

from reviewflow.llm import licenses as op


def cut(text):
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split(" ")
    return [f"{a} {b}" for a, b in zip(w, w[1:])]


def tagged(text):
    names = set()
    for line in re.findall(r"SPDX-License-Identifier:([^\n]*)", text or ""):
        for x in re.sub(r"WITH\s+\S+", "", line).replace("(", " ").replace(")", " ").split():
            if x in ("AND", "OR"):
                continue
            if not x[0].isalnum():
                break
            names.add(re.sub(r"(-only|-or-later|\+)$", "", x))
    return names


def brute(text, templates=op.TEMPLATES, threshold=op.THRESHOLD):
    """(best, score, names) by definition: every window of either length at every start, all pairs of matches."""
    grams, found = cut(text), []
    for name, t in templates:
        listed, own = cut(t), set(cut(t))
        for size in {len(listed), ceil(1.25 * len(listed))}:
            for s in range(len(grams)):
                unit = set(grams[s:s + size])
                score = 2 * len(unit & own) / (len(unit) + len(own))
                if grams[s] in own and score >= threshold:
                    found.append((name, len(unit & own), score, s, min(s + size, len(grams))))
    kept = [m for m in found if not any(
        o[0] != m[0] and (o[1], o[2]) > (m[1], m[2]) and 2 * (min(o[4], m[4]) - max(o[3], m[3])) >= m[4] - m[3] for o in found)]
    rated = [(-m[2], -m[1], m[0]) for m in kept] + [(-1.0, 0, x) for x in tagged(text)]
    best = min(rated, default=(None, None, None))
    return best[2], best[0] and -best[0], ",".join(sorted({x for *_, x in rated}))


def template(name, longer_than=100):
    return next(t for n, t in op.TEMPLATES if n == name and len(t) > longer_than)


MIT, GPL3 = template("MIT"), template("GPL-3.0")
HEADER = "\n".join("# " + line for line in ["Copyright (C) 2020 Some One", "", *re.findall(r".{1,60}(?: |$)", GPL3), "",
                                            "This program is distributed in the hope that it will be useful,", "but WITHOUT ANY WARRANTY."]) + "\nimport os\n"
WRAPPED = "/*\n" + "".join(f" * {line}\n" for line in re.findall(r".{1,50}(?: |$)", op.BSD + " " + op.BSD_THIRD)) + " */\nint main() {}\n"
NOTICES = {
    "header": (HEADER, "GPL-3.0"),
    "opening": (op.BSD.split(": 1.")[0] + ":\n(the rest is elsewhere)", "BSD"),
    "prose": ("The tool was made by many hands. Released under the MIT License. See the file for more.", "MIT"),
    "tag": ("// SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) OR MIT\nint x;", "GPL-2.0,MIT"),
    "three clauses": (WRAPPED, "BSD-3-Clause"),
    "two clauses": (op.BSD, "BSD-2-Clause"),
    "gpl 3 line": ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    "gpl 2 line": ("Note. This work is licensed under the GNU General Public License, version 2. End", "GPL-2.0"),
    "lesser": (template("LGPL-2.1"), "LGPL-2.1"),
    "affero": (template("AGPL-3.0"), "AGPL-3.0"),
    "no notice": ("The license of the house was general and public, and the work was distributed under the terms of a lease.", ""),
}
TEXTS = [None, "", "word", "Released under the MIT License.", "prose here\nLicensed under CC BY-NC 4.0.\nmore prose", "licensed UNDER the apache  license -- version 2.0",
         MIT.replace(" to ", "\nto "), "Intro\n\n" + MIT.replace(",", ",\n") + "\n\nOutro", "Licensed under the License.", "é " * 5_000, "\n" * 500,
         "Licensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0.\nLicensed under CC BY 4.0.", "released under the mit license " * 30,
         "This work is licensed under the GNU General Public License, version 3.\nLicensed under the MIT License.",
         "filler word " * 480 + op.BSD + " " + "filler word " * 500 + GPL3 + " SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MPL-2.0+ */",
         re.sub(r"\b(the|of|or)\b", "", GPL3), *(t for t, _ in NOTICES.values())]


def test_against_brute_force(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    got = op.scan(docs(rows, extra=("tags", "license", "name", "grams", "places"))).collect()
    assert len(got) == len(rows)
    for r in got:
        name, score, names = brute(TEXTS[4] if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.license, r.licenses) == (name, names) and (r.score == score or abs(r.score - score) < 1e-12), (r, name, score, names)


@pytest.mark.parametrize("segment", [3, 40])
def test_stretches_change_nothing(docs, monkeypatch, segment):
    texts = [TEXTS[i] for i in (4, 6, 7, 11, 12, 13)] + [WRAPPED + HEADER + op.BSD + MIT]
    whole = op.scan(docs(list(enumerate(texts)))).collect()
    monkeypatch.setattr(op, "SEGMENT", segment)
    assert sorted(op.scan(docs(list(enumerate(texts)))).collect()) == sorted(whole)


def test_ordinary_notices(docs):
    got = {r.doc_id: r for r in op.scan(docs([(i, t) for i, (t, _) in enumerate(NOTICES.values())])).collect()}
    assert {k: got[i].licenses for i, k in enumerate(NOTICES)} == {k: want for k, (_, want) in NOTICES.items()}
    place = got[list(NOTICES).index("prose")].places[0]
    assert (place.name, place.s, place.e, place.score) == ("MIT", 7, 11, 1.0)


def test_pruning_loses_no_window(docs):
    for t in (0.3, 0.6, 1.0):
        got = op.scan(docs([(i, x) for i, x in enumerate(TEXTS[:9])]), threshold=t).collect()
        assert {r.doc_id: (r.license, r.licenses) for r in got} == {i: brute(x, threshold=t)[::2] for i, x in enumerate(TEXTS[:9])}


def test_plan_has_no_python_and_no_shuffle(docs):
    plan = op.scan(docs([(1, "a")]).coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_empty_table_and_no_templates(docs):
    assert op.scan(docs([(1, "a")]).where("false")).collect() == []
    assert op.scan(docs([(1, "Released under the MIT License.")]), templates=()).collect()[0].license is None
    with pytest.raises(ValueError):
        op.scan(docs([(1, "a")]), templates=(("it's", "a b c"),))
