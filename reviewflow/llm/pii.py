"""Personal data by a linear-chain CRF over word shapes (operator 8).

Base spans come from fixed patterns.  A linear-chain conditional random
field, trained from a small labelled table, then tags the tokens that hold a
digit or an at sign; its runs of one label on a line become further spans; tokens
that a base span touches are in none.  All other tokens are bound to the label O.  A bound token cuts
the chain: what stands left and right of it is decoded on its own without
changing the best path, so Viterbi runs over short stretches, many of equal
length at once.

Cases: null text is empty text; repeated rows are treated alike; texts are
scanned whole and in time proportional to their length (the patterns start
only where a match can start); other columns are never read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import whole_text

# Fixed values of the contract: kinds in their order.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A token with a digit or an at sign; possessive, so each character is looked at once.
TRIGGER = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
LINE_END = re.compile(r"[\r\n]")
TRIM = "()[]{}<>\"'.,;:!?*#$%&|"
CRF_SPANS = 4       # kinds of CRF spans start here

# The labelled table: sentences with label/text in brackets around every labelled stretch.
LABELLED = (
    "call [phone 555-0142] before noon", "call me on [phone (409) 555-0199] today", "phone [phone 0171 5550133] or write",
    "tel. [phone +1 (409) 555-0134] and ask", "tel [phone 030-5550-2277] please", "my number is [phone 212-555-0187] thanks",
    "reach us at [phone 1-800-555-0101] any time", "fax [phone (212) 555-0146] only", "mobile [phone 07700 900123] works",
    "phone [phone (030) 555 01 66] today", "call [phone 415.555.0171] now", "tel [phone 555 0142] now",
    "mail [email jane@example] instead", "write to [email max@localhost] first", "contact [email ops@intranet] for help",
    "mail [email jane.doe@example.org] instead", "write to [email a_b@mail.example.com] first", "send [email k.l.99@example.net] a note",
    "server [ip 10.0.0.7:8080] is down", "host [ip 192.168.0.12/24] answers", "at address [ip 172.16.4.9] now",
    "card [card 4111-1111-1111] expired", "visa [card 4000 0000 0000] on file", "card [card 4242 4242 4242 4242] paid",
    "card number [card 5500 0055 5555] declined", "account card [card 3782-8224-6310] closed",
    "in 1999 there were 24 of them", "on 2024-01-31 at 10:45 they met", "pages 12-15 and 230 of 411", "costs 1,299.00 or 3.5% less",
    "version 2.0.1 was built 3 times", "the 1st and 22nd of May 2021", "room 101 has 4 beds", "about 1000 people in 50 towns",
    "id 82371 was number 7", "order 55120394 shipped", "chapter 3.2.1 shows 14 cases", "from 1914-1918 and 1939-1945",
    "token = \"24be64439e3e49cf\" is old", "key AKIA2345 and h264 x86 mp3", "see fig. 12a and 12b", "section 4.5 of iso-9001",
    "score 3:2 after 90 minutes", "1.5 million in 2020", "at 8 am on day 365", "sha 78e7d7d6b1c7d0fa1f here", "12 34 56 78 90", "1 2 3",
    "table 4111 rows", "5 @ 3 each", "@home and @work", "handle @jane_doe said 42", "10-20 percent of 300-400", "0.25 to 0.75",
    "http://example.org/a1?b=2 opens", "line 10: 20 30 40", "7### 8*** 9&&&", "call 3 people", "phone 2 is new", "card 12 of 52",
    "server 3 and host 14", "mail 2 letters", "the +1 vote of 5", "tel. 4 is missing", "ip v4 and v6", "number 9 of 10",
)


def parse(sentence: str) -> list[tuple[str, str]]:
    """(token, label) of a labelled sentence."""
    out = []
    for m in re.finditer(r"\[(\w+) ([^\]]*)\]|(\S+)", sentence):
        out += [(t, m[1]) for t in m[2].split()] if m[1] else [(m[3], "O")]
    return out


def shape(token: str) -> str:
    """Letters to a, digits to runs d1 ... d9 by length, other characters as they are, repeats of letters and marks once."""
    out = []
    for m in re.finditer(r"([^\W\d_]+)|(\d+)|(.)", token, re.S):
        out.append("a" if m[1] else f"d{min(len(m[2]), 9)}" if m[2] else m[3] if m[3] in "@.:-()+/=_%," else "?")
    return "".join(out)


def features(tokens: list[str], at: int, before: str) -> list[str]:
    """Features of one token; ``before`` is the bound token left of the stretch."""
    token, left = tokens[at], tokens[at - 1] if at else before
    digits = sum(c.isdigit() for c in token)
    right = shape(tokens[at + 1]) if at + 1 < len(tokens) else "end"
    cue = re.sub(r"\W", "", left.lower())[:12]
    own = shape(token.strip("\"'.,;:!?*#$%&|"))
    return ["bias", f"shape {own}", f"digits {min(digits, 12)}", f"letters {any(c.isalpha() for c in token)}",
            f"at {token.find('@') > 0} {'@' in token}", f"left {cue}", f"left shape {shape(left)}", f"right shape {right}",
            f"dots {min(token.count('.'), 4)} {digits > 0}", f"first {token[0] if token[0] in '+(' else ''}",
            f"cue and size {cue} {min(digits, 6)}", f"hyphens {min(token.count('-'), 3)}"]


class Crf:
    """Weights of a chain over stretches of trigger tokens, O bound at both ends."""

    def __init__(self, labelled=LABELLED, rounds: int = 150, rate: float = 0.5, l2: float = 0.02):
        self.index: dict[str, int] = {}
        stretches = []
        for sentence in labelled:
            before, stretch = "", []
            for token, label in [*parse(sentence), ("", "O")]:
                if TRIGGER.fullmatch(token):
                    stretch.append((token, label))
                    continue
                if stretch:
                    tokens = [t for t, _ in stretch]
                    rows = [[self.index.setdefault(f, len(self.index)) for f in features(tokens, i, before)] for i in range(len(tokens))]
                    stretches.append((np.array(rows), np.array([LABELS.index(y) for _, y in stretch])))
                before, stretch = token, []
        n = len(LABELS)
        self.emit, self.move = np.zeros((len(self.index) + 1, n)), np.zeros((n, n))      # the last row: features never seen
        steps = np.zeros_like(self.emit), np.zeros_like(self.move)
        for _ in range(rounds):
            grad = -l2 * self.emit, -l2 * self.move
            for rows, y in stretches:
                self._gradient(rows, y, *grad)
            for value, g, s in zip((self.emit, self.move), grad, steps):
                s += g * g
                value += rate * g / np.sqrt(s + 1e-9)
        self.emit[-1] = 0

    def _gradient(self, rows, y, emit, move) -> None:
        """Add observed minus expected counts of one stretch, by forward and backward sums."""
        score, n = self.emit[rows].sum(1), len(y)
        ahead, back = np.empty_like(score), np.empty_like(score)
        ahead[0], back[-1] = score[0] + self.move[0], self.move[:, 0]
        for i in range(1, n):
            ahead[i] = score[i] + np.logaddexp.reduce(ahead[i - 1][:, None] + self.move, 0)
        for i in range(n - 2, -1, -1):
            back[i] = np.logaddexp.reduce(self.move + score[i + 1] + back[i + 1], 1)
        total = np.logaddexp.reduce(ahead[-1] + back[-1])
        each = np.exp(ahead + back - total)
        for i in range(n):
            want = -each[i]
            want[y[i]] += 1
            np.add.at(emit, rows[i], want)
        move[0] -= each[0]
        move[:, 0] -= each[-1]
        path = [0, *y, 0]
        for a, b in zip(path, path[1:]):
            move[a, b] += 1
        for i in range(1, n):
            move -= np.exp(ahead[i - 1][:, None] + self.move + score[i] + back[i] - total)

    def score(self, tokens: list[str], before: str) -> np.ndarray:
        unseen = len(self.index)
        return self.emit[[[self.index.get(f, unseen) for f in features(tokens, i, before)] for i in range(len(tokens))]].sum(1)

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of every stretch: Viterbi over all stretches of one length at once."""
        out: list[np.ndarray] = [None] * len(scores)
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(scores):
            by_length.setdefault(len(s), []).append(k)
        for n, group in by_length.items():
            s = np.stack([scores[k] for k in group])
            best, came = s[:, 0] + self.move[0], np.zeros(s.shape, np.int8)
            for i in range(1, n):
                ways = best[:, :, None] + self.move
                came[:, i] = ways.argmax(1)
                best = ways.max(1) + s[:, i]
            path = np.empty((len(group), n), np.int64)
            path[:, -1] = (best + self.move[:, 0]).argmax(1)
            for i in range(n - 1, 0, -1):
                path[:, i - 1] = came[np.arange(len(group)), i, path[:, i]]
            for k, p in zip(group, path):
                out[k] = p
        return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, sorted; one pattern's matches never overlap."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:      # an address lies around an at sign: the local part runs back to the last match at most
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def token_before(text: str, at: int) -> str:
    """The whole token to the left of ``at``, whatever white space lies between; '' where there is none."""
    end = at
    while end and text[end - 1].isspace():
        end -= 1
    start = end
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:end]


def stretches(text: str) -> list[tuple[str, list[tuple[int, int]]]]:
    """Runs of trigger tokens with nothing but white space between: (bound token before, places)."""
    out: list[tuple[str, list[tuple[int, int]]]] = []
    last = -1
    for m in TRIGGER.finditer(text):
        if out and text[last:m.start()].isspace():
            out[-1][1].append(m.span())
        else:
            out.append((token_before(text, m.start()), [m.span()]))
        last = m.end()
    return out


def scan_batch(texts: list[str], crf: Crf) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of every text, sorted: base kinds, then CRF kinds from CRF_SPANS on.

    Neighbouring tokens of one label on one line are a CRF span; tokens that a base span touches are in none.
    """
    base = [base_spans(t) for t in texts]
    starts = [[a for a, _, _ in own] for own in base]
    ends = [list(accumulate((b for _, _, b in own), max)) for own in base]

    def apart(k, token):
        """No base span touches the token."""
        n = bisect_left(starts[k], token[1])
        return not n or ends[k][n - 1] <= token[0]
    places = [(k, left, run) for k, t in enumerate(texts) for left, run in stretches(t)]
    scores = [crf.score([texts[k][a:b] for a, b in run], left) for k, left, run in places]
    extra: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (k, _, run), labels in zip(places, crf.decode(scores)):
        i = 0
        while i < len(run):
            j, alone = i, apart(k, run[i])
            while (j + 1 < len(run) and labels[j + 1] == labels[i] and apart(k, run[j + 1]) == alone
                   and not LINE_END.search(texts[k], run[j][1], run[j + 1][0])):
                j += 1
            if labels[i] and alone:
                a, b = run[i][0], run[j][1]
                while a < b and texts[k][a] in TRIM and texts[k][a] != "(":
                    a += 1
                while b > a and texts[k][b - 1] in TRIM:
                    b -= 1
                if a < b:
                    extra[k].append((a, CRF_SPANS + int(labels[i]) - 1, b))
            i = j + 1
    return [sorted([*own, *more]) for own, more in zip(base, extra)]


def span_kinds() -> list[str]:
    return [*KINDS, *(f"crf_{k}" for k in KINDS)]


def spans_column(text: Column, crf: Crf) -> Column:
    """Array of (s, k, e), sorted; k is the kind's place in ``span_kinds()``."""
    kind = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))

    @F.arrow_udf("array<struct<s:int,k:int,e:int>>")
    def spans(texts: pa.Array) -> pa.Array:
        found = scan_batch([t or "" for t in texts.to_pylist()], crf)
        return pa.array([[{"s": s, "k": k, "e": e} for s, k, e in x] for x in found], kind)

    return spans(text)


def scan(docs: DataFrame, crf: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans."""
    return docs.select(F.col(id_col).alias("doc_id"), spans_column(whole_text(text_col), crf or Crf()).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in span_kinds()])

    def text(x):
        return F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")
