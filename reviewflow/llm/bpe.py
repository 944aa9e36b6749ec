"""Byte-level BPE by prefix dynamic programming (operator 7).

For every prefix of a piece's bytes there is exactly one token that ends the
prefix's encoding.  ``Prefixes`` stores it: at each byte, of the tokens that
end there, it is the one that may follow the last token of the prefix before
it.  Two tokens may follow each other if encoding their joined bytes gives
just those two, which their merges, run side by side, show.  As an entry depends on its prefix alone, appended bytes
extend the table exactly, and after an edit only the entries from the edit
on, up to where they fall in with the old ones, are computed anew.

Cases: null text is empty text; empty text has no tokens and decodes to no
bytes; special tokens do not exist, their strings are ordinary text; pieces
of any length take memory in proportion to their bytes.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm.common import whole_text

# What a worker remembers, at most.
PIECES_KEPT = 300_000       # encodings of short pieces, and of short stretches of text between spaces; twice that while old ones go
PAIRS_KEPT = 1_000_000
NEVER = 1 << 60
SHORT = 64                  # characters or bytes
BRIEF = 24                  # bytes of a piece up to which the prefix program runs for many pieces at once
STORED = 4 << 20            # token ids that the store of pieces holds, at most, before it makes room
LONG_TEXT = 1 << 20         # beyond it pieces are walked one by one, not listed
BEHIND = re.compile(r"(?<=\S) ")       # a space behind a character that is no white space


class Vocabulary:
    """Token bytes by rank, and which tokens may stand next to each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.by_place, self.places = pa.array(ranks, pa.binary()), np.fromiter(ranks.values(), np.int32, len(ranks))
        self.longest = max(map(len, ranks), default=1)
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token)))
        self.matcher.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self._edges: dict[tuple[int, int], list[tuple[bytes, float]]] = {}

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """The definition itself, for the bytes of a token: merge the lowest rank, leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """What stands at one end of a token (side -1: right, 0: left) while it is merged: from the single byte to
        the whole token, each with the rank at which the next one takes its place."""
        found = self._edges.get((token, side))
        if found is None:
            found, t = [(self.tokens[token], NEVER)], token
            while len(self.tokens[t]) > 1:
                if t not in self._halves:
                    self._halves[t] = tuple(self.merged(self.tokens[t], 2))
                t, rank = self._halves[t][side], t
                found.append((self.tokens[t], rank))
            found = self._edges[token, side] = found[::-1]
        return found

    def extend(self, last: list[int], data: bytes) -> None:
        """The prefix program: append the last token of every prefix of ``data`` that ``last`` lacks.

        An automaton over the tokens names those that end at each byte, the
        longest first; the one that may follow the last token of what is left
        of it is the prefix's own.
        """
        known, pairs = len(last) - 1, self.pairs
        begin = max(0, known - self.longest + 1)
        last += [-1] * (len(data) - known)
        for at, (token, size) in self.matcher.iter(data[begin:].decode("latin-1")):
            end = begin + at + 1
            if end <= known or last[end] >= 0 or size > end:
                continue
            start = end - size
            if start:
                left = last[start]
                ok = pairs.get((left, token))
                if ok is None:
                    ok = self.follows(left, token)
            else:
                ok = self.whole(token)
            if ok:
                last[end] = token
        if -1 in last[known + 1:]:
            raise ValueError("a byte has no token: the vocabulary lacks single bytes")

    def traced(self, last: list[int]) -> list[int]:
        """The encoding that ``last`` stands for, from its end to its start and turned round."""
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def whole(self, token: int) -> bool:
        """Does merging ever make this token of its own bytes?"""
        if token not in self._whole:
            self._whole[token] = self.merged(self.tokens[token]) == [token]
        return self._whole[token]

    def follows(self, left: int, right: int) -> bool:
        """May ``right`` stand behind ``left``?  Both are merged side by side: if the pieces that touch ever have a
        joint rank below the next merge on either side, BPE would have joined them (leftmost first at equal ranks)."""
        ok = self.pairs.get((left, right))
        if ok is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            ok = self.pairs[left, right] = self.whole(right) and self._apart(self.edge(left, -1), self.edge(right, 0))
        return ok

    def _apart(self, a: list[tuple[bytes, float]], b: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        while True:
            (x, next_a), (y, next_b) = a[i], b[j]
            joint = self.ranks.get(x + y, NEVER)
            if joint < next_a and joint <= next_b:
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class OpenTable:
    """Whole numbers by rows of 64-bit words, looked up for whole arrays: a hash table with open places."""

    FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)

    def __init__(self, width: int, room: int):
        self.slots = 1 << (2 * room).bit_length()
        self.keys, self.values, self.held = np.zeros((self.slots, width), np.uint64), np.full(self.slots, -1, np.int32), 0

    def places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[:, 0] * self.FACTORS[0]
        for k in range(1, keys.shape[1]):
            mixed ^= keys[:, k] * self.FACTORS[k]
        mixed = (mixed ^ mixed >> np.uint64(29)) * self.FACTORS[-1]
        return ((mixed ^ mixed >> np.uint64(32)) & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        at, out, open_ = self.places(keys), np.full(len(keys), -1, np.int32), np.arange(len(keys))
        while len(open_):
            value = self.values[at]
            same, held = value >= 0, self.keys[at]
            for k in range(keys.shape[1]):
                same &= held[:, k] == keys[:, k]
            out[open_[same]] = value[same]
            on = ~same & (value >= 0)
            open_, keys, at = open_[on], keys[on], (at[on] + 1) & self.slots - 1
        return out

    def add(self, keys: np.ndarray, values) -> None:
        """Add keys that the table lacks."""
        if self.held + len(keys) > self.slots // 2:
            self.values[:], self.held = -1, 0
        for key, value, at in zip(keys, values, self.places(keys).tolist()):
            while self.values[at] >= 0:
                at = at + 1 & self.slots - 1
            self.keys[at], self.values[at] = key, value
        self.held += len(keys)


class Together:
    """The prefix program for many brief pieces at once, byte by byte: at each byte the parts that end there are looked
    up for all pieces, the longest first, until one may follow the last token of the prefix before it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        brief = {t: i for t, i in vocabulary.ranks.items() if len(t) <= BRIEF}
        self.longest = max(map(len, brief), default=1)
        self.tokens, self.pairs = OpenTable(4, len(brief)), OpenTable(1, PAIRS_KEPT)
        ends = np.frombuffer(b"".join(t.rjust(BRIEF, b"\0") for t in brief), np.uint64).reshape(len(brief), -1)
        self.tokens.add(np.column_stack([ends, np.array([len(t) for t in brief], np.uint64)]), brief.values())
        # the sizes (as bits) of the tokens of three and more bytes that end like this, by a hash of the last bytes
        self.sizes = {n: np.zeros(1 << 20, np.uint32) for n in (3, 4, 6)}
        for n, table in self.sizes.items():
            fit = np.array([len(t) for t in brief], np.uint32)
            np.bitwise_or.at(table, self.ending(ends[fit >= n, -1], n), np.uint32(1) << fit[fit >= n])
        kept = np.arange(BRIEF) >= BRIEF - np.arange(BRIEF + 1)[:, None]        # the last n bytes of a window
        self.masks = (kept * np.uint8(255)).view(np.uint64)

    @staticmethod
    def ending(words: np.ndarray, n: int) -> np.ndarray:
        """Hash of the last n bytes of each word."""
        return ((words >> np.uint64(64 - 8 * n)) * OpenTable.FACTORS[0] >> np.uint64(44)).astype(np.int64)

    def possible(self, words: np.ndarray) -> np.ndarray:
        """Which sizes, as bits, a token can have that ends the windows with these last words; one and two always."""
        three, four, six = (self.sizes[n][self.ending(words, n)] for n in (3, 4, 6))
        return np.uint32(0b110) | three & np.uint32(0b1000) | four & np.uint32(0b110000) | six & np.uint32(0xFFFFFFC0)

    def allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """May ``right`` follow ``left`` (-1: nothing is before it)?"""
        keys = (left.astype(np.uint64) + np.uint64(1) << np.uint64(32) | right.astype(np.uint64))[:, None]
        known = self.pairs.find(keys)
        if (known < 0).any():
            new = np.unique(keys[known < 0])
            pairs = [(int(k >> np.uint64(32)) - 1, int(k & np.uint64(0xFFFFFFFF))) for k in new]
            ok = [self.vocabulary.whole(b) if a < 0 else self.vocabulary.follows(a, b) for a, b in pairs]
            known[known < 0] = np.array(ok, np.int32)[np.searchsorted(new, keys[known < 0, 0])]
            self.pairs.add(new[:PAIRS_KEPT, None], ok[:PAIRS_KEPT])
        return known == 1

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths): the encodings one behind the other, and how many ids each has."""
        n, sizes = len(pieces), np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(p.ljust(BRIEF, b"\0") for p in pieces), np.uint8).reshape(n, BRIEF)
        data = np.concatenate([np.zeros((n, BRIEF), np.uint8), data], axis=1)
        longest = int(sizes.max(initial=0))
        last, start = np.full((n, longest + 1), -1, np.int32), np.zeros((n, longest + 1), np.int8)
        for end in range(1, longest + 1):
            rows = np.flatnonzero(sizes >= end)
            window = np.ascontiguousarray(data[rows, end:end + BRIEF]).view(np.uint64)
            sizes_here, open_ = self.possible(window[:, -1]), np.ones(len(rows), bool)
            for size in range(min(end, self.longest), 0, -1):
                some = np.flatnonzero(open_ & (sizes_here >> np.uint32(size) & np.uint32(1)).astype(bool))
                token = self.tokens.find(np.column_stack([window[some] & self.masks[size], np.full(len(some), size, np.uint64)]))
                some, token = some[token >= 0], token[token >= 0]
                fits = self.allowed(last[rows[some], end - size], token)
                some, token = some[fits], token[fits]
                last[rows[some], end], start[rows[some], end], open_[some] = token, end - size, False
            if open_.any():
                raise ValueError("a byte has no token: the vocabulary lacks single bytes")
        # from the last entry back to the first
        back, at, all_rows = [], sizes.copy(), np.arange(n)
        while (at > 0).any():
            back.append(np.where(at > 0, last[all_rows, at], -1))
            at = np.where(at > 0, start[all_rows, at], 0)
        table = np.array(back[::-1], np.int32).reshape(len(back), n).T
        return table[table >= 0], (table >= 0).sum(1)


def strung(index: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The stretches ids[start:start + length] of every index, one behind the other."""
    n = length[index]
    return ids[np.repeat(start[index] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Prefixes:
    """The last token of every prefix of one piece; the empty prefix has none (-1)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.last, self.data)

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace bytes start:end.  Entries before the edit stay; those behind it are computed a stretch at a time
        until as many in a row as the longest token equal the old ones, from where the rest must be equal too."""
        old, tail, longest = self.last, self.data[end:], self.vocabulary.longest
        shift = len(new) - (end - start)
        self.data = self.data[:start] + new + tail
        self.last = old[:start + 1]
        at = start + len(new)
        while at < len(self.data):
            at = min(len(self.data), at + 2 * longest)
            self.vocabulary.extend(self.last, self.data[:at])
            if at - longest >= start + len(new) and self.last[at - longest + 1:] == old[at - longest + 1 - shift:at + 1 - shift]:
                self.last += old[at + 1 - shift:]
                return
        self.vocabulary.extend(self.last, self.data)

    def ids(self) -> list[int]:
        """Trace back from the last entry.  A piece that is itself a token is that token."""
        if self.data in self.vocabulary.ranks:
            return [self.vocabulary.ranks[self.data]]
        return self.vocabulary.traced(self.last)


class Memo(dict):
    """Encodings already worked out, by text.  When it holds ``most``, they become the old ones, of which only those
    still in use come back."""

    def __init__(self, work, most: int = PIECES_KEPT):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.old.get(text)
        if ids is None:
            ids = self.work(text)
        if len(text) <= SHORT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Uneven(Exception):
    """A stretch between two spaces is empty or ends with white space."""


class Tokenizer:
    """Encodes and decodes texts.

    ``cut``: no match of the pattern holds a space that stands behind a
    character which is no white space, nor depends on what is beyond such a
    space.  The text is then cut there first, and the pattern is run once for
    every different stretch that the worker remembers.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, cut: bool = True):
        self.vocabulary, self.pattern, self.cut = Vocabulary(ranks), regex.compile(pattern), cut
        self.pieces, self.stretches, self.together = Memo(self._piece), Memo(self._stretch), Together(self.vocabulary)
        self._forget()

    def _stretch(self, stretch: str) -> tuple[int, ...]:
        if not stretch or stretch[-1].isspace():
            raise Uneven
        return self._matches(" " + stretch)

    def _matches(self, text: str) -> tuple[int, ...]:
        found = self.pattern.findall(text) if len(text) < LONG_TEXT else (m[0] for m in self.pattern.finditer(text))
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, found)))

    def _piece(self, piece: str) -> tuple[int, ...]:
        data, last = piece.encode("utf-8"), [-1]
        if data in self.vocabulary.ranks:
            return (self.vocabulary.ranks[data],)
        self.vocabulary.extend(last, data)
        return tuple(self.vocabulary.traced(last))

    def encode(self, text: str) -> list[int]:
        if not self.cut or " " not in text:
            return list(self._matches(text))
        first, *middle = text.split(" ")
        end = middle.pop()
        try:
            if first[-1:].isspace():
                raise Uneven
            between = list(chain.from_iterable(map(self.stretches.__getitem__, middle)))
        except Uneven:
            return list(self._matches(text))
        return [*self._matches(first), *between, *self._matches(" " + end)]

    def encode_batch(self, texts: pa.Array) -> pa.ListArray:
        """The encodings of many texts.  The last batch's are kept: where a query asks for the ids and for what follows from
        them, Spark has one worker run this twice over each batch."""
        if self.batch is None or not self.batch[0].equals(texts):
            self.batch = None
            self.batch = texts, self._batch(texts.fill_null(""))
        return self.batch[1]

    def _batch(self, texts: pa.Array) -> pa.ListArray:
        """Different stretches between spaces are cut once a batch, and their pieces encoded once, all new ones together,
        and kept by number; a text is then a list of numbers, from which the ids are gathered."""
        if not self.cut:
            ids, ends = self._listed([self._matches(x) for x in texts.to_pylist()])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
        parts, ends = self._parts(texts)
        first, last = ends[:-1], ends[1:] - 1
        several = last > first
        between = np.ones(len(parts), bool)
        between[first] = between[last] = False
        coded = parts.dictionary_encode()
        number, asked = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), bool)
        asked[number[between]] = True
        ids, length = self._stretches(coded.dictionary.filter(pa.array(asked)))
        known = len(length)
        own, own_ends = self._listed([self._matches(x) for x in parts.take(pa.array(first)).to_pylist()]
                                     + [self._matches(" " + x) for x in parts.take(pa.array(last[several])).to_pylist()])
        number = (np.cumsum(asked) - 1)[number]
        number[first] = known + np.arange(len(first))
        number[last[several]] = known + len(first) + np.arange(several.sum())
        starts = np.concatenate([[0], np.cumsum(length), own_ends[1:] + len(ids)])
        encoded = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate([ids, own])))
        every = encoded.take(pa.array(number))
        return pa.ListArray.from_arrays(pa.array(every.offsets.to_numpy()[ends]), every.values)

    @staticmethod
    def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts cut at spaces, and where the parts of each begin and those of the last one end.  Where a space is cut
        that does not stand behind a character which is no white space, the text is cut anew, only at those that do."""
        cuts = pc.split_pattern(texts, " ")
        parts, ends = cuts.flatten(), cuts.offsets.to_numpy()
        empty = pc.equal(parts, "").to_numpy(zero_copy_only=False)
        loose = empty | pc.utf8_is_space(pc.utf8_slice_codeunits(parts, -1)).to_numpy(zero_copy_only=False)
        loose[ends[:-1]] &= ~empty[ends[:-1]]
        loose[ends[1:] - 1] = False
        if not loose.any():
            return parts, ends
        uneven = np.zeros(len(texts), bool)
        uneven[np.searchsorted(ends, np.flatnonzero(loose), "right") - 1] = True
        anew = pa.array(map(BEHIND.split, texts.filter(pa.array(uneven)).to_pylist()), pa.list_(texts.type))
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)])] = np.arange(len(texts))
        cuts = pa.concat_arrays([cuts.filter(pa.array(~uneven)).cast(anew.type), anew]).take(pa.array(order))
        return cuts.flatten(), cuts.offsets.to_numpy()

    def _forget(self) -> None:
        self.known, self.start, self.length = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used, self.batch = np.zeros(0, np.int32), np.zeros(0, bool), None

    def _make_room(self) -> None:
        """When the store of pieces is full, those of the last batch stay, if they leave half of it free."""
        if len(self.known) <= PIECES_KEPT and len(self.ids) <= STORED:
            return
        stay, length = np.flatnonzero(self.used), self.length[self.used]
        if 2 * len(stay) > PIECES_KEPT or 2 * length.sum() > STORED:
            self._forget()
            return
        self.ids = strung(stay, self.start, self.length, self.ids)
        self.known, self.start, self.length = self.known.take(pa.array(stay)), np.cumsum(length) - length, length

    @staticmethod
    def _listed(encodings) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([0, *map(len, encodings)]).astype(np.int64)
        return np.fromiter(chain.from_iterable(encodings), np.int32, int(ends[-1])), ends

    def _stretches(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of different stretches that stand behind a space and do not end with white space."""
        self._make_room()
        self.used = np.zeros(len(self.known), bool)
        size = pc.utf8_length(stretches).to_numpy() + np.int64(1)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // LONG_TEXT)) + 1          # some LONG_TEXT characters at once
        found = [self._some(stretches[a:b], size[a:b]) for a, b in zip([0, *cuts], [*cuts, len(stretches)]) if b > a]
        return (np.concatenate([np.zeros(0, np.int32), *[ids for ids, _ in found]]),
                np.concatenate([np.zeros(0, np.int64), *[length for _, length in found]]))

    def _some(self, stretches: pa.Array, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if size.max() > LONG_TEXT:
            ids, ends = self._listed([self._matches(" " + x) for x in stretches.to_pylist()])
            return ids, np.diff(ends)
        pieces = pa.array(self.pattern.findall(" " + " ".join(stretches.to_pylist())), pa.string()).dictionary_encode()
        place = pc.index_in(pieces.dictionary, value_set=self.known)
        new, at = place.is_null(), place.fill_null(0).to_numpy().astype(np.int64)
        fresh, old = new.to_numpy(zero_copy_only=False), len(self.known)
        at[fresh] = old + np.arange(fresh.sum())
        self._learn(pieces.dictionary.filter(new))
        self.used = np.concatenate([self.used, np.ones(len(self.known) - old, bool)])
        self.used[at] = True
        # pieces leave nothing out, so the first one of a stretch begins with the space before it
        index = pieces.indices.to_numpy()
        ends = np.cumsum(pc.utf8_length(pieces.dictionary).to_numpy()[index], dtype=np.int64)
        first = np.searchsorted(ends, np.cumsum(size) - size, "right")
        index = at[index]
        return strung(index, self.start, self.length, self.ids), np.add.reduceat(self.length[index], first)

    def _learn(self, pieces: pa.Array) -> None:
        """Number new pieces and store their ids."""
        data = pieces.cast(pa.binary())
        whole = pc.index_in(data, value_set=self.vocabulary.by_place)
        token = whole.is_valid().to_numpy(zero_copy_only=False)
        brief = ~token & (pc.binary_length(data).to_numpy() <= BRIEF)
        rest = ~token & ~brief
        some, some_length = self.together.encode(data.filter(pa.array(brief)).to_pylist())
        others, ends = self._listed([self._piece(p) for p in pieces.filter(pa.array(rest)).to_pylist()])
        length = np.ones(len(pieces), np.int64)
        length[brief], length[rest] = some_length, np.diff(ends)
        begin = np.empty(len(pieces), np.int64)
        begin[token] = np.arange(token.sum())
        begin[brief] = token.sum() + np.cumsum(some_length) - some_length
        begin[rest] = token.sum() + len(some) + ends[:-1]
        ids = np.concatenate([self.vocabulary.places[whole.drop_null().to_numpy()], some, others])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, strung(np.arange(len(pieces)), begin, length, ids)])
        self.known = pa.concat_arrays([self.known, pieces])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of many texts: those of all tokens one behind the other, cut where a text ends."""
        ends = np.cumsum([0, *ids.value_lengths().fill_null(0).to_pylist()])
        place = pc.index_in(ids.flatten(), value_set=pa.array(self.vocabulary.places))
        if place.null_count:
            raise ValueError("an id has no token")
        data = self.vocabulary.by_place.take(place)
        cut = data.buffers()[1], data.buffers()[2]
        starts = np.frombuffer(cut[0], np.int32, len(data) + 1)[ends] if len(data) else np.zeros(len(ends), np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(starts), cut[1]])


class EditableText:
    """A text whose encoding follows appends and edits: pieces before the change and pieces behind it, once the
    pattern's cuts fall in with the old ones, are kept."""

    def __init__(self, tokenizer: Tokenizer, text: str = ""):
        self.tokenizer, self.text = tokenizer, text
        self.pieces = [(m.start(), m.end(), Prefixes(tokenizer.vocabulary, m[0].encode())) for m in tokenizer.pattern.finditer(text)]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        shift, old = len(new) - (end - start), self.pieces
        self.text = self.text[:start] + new + self.text[end:]
        # the pattern looks one character ahead of a piece, so a piece that ends right before the change may change too
        keep = sum(1 for _, e, _ in old if e < start)
        keep = max(0, keep - 1)
        self.pieces = old[:keep]
        at, later = self.pieces[-1][1] if keep else 0, {s + shift: k for k, (s, _, _) in enumerate(old) if s >= end and k >= keep}
        hint = old[keep] if keep < len(old) else None
        for m in self.tokenizer.pattern.finditer(self.text, at):
            if m.start() > start + len(new) and m.start() in later:
                self.pieces += [(s + shift, e + shift, p) for s, e, p in old[later[m.start()]:]]
                return
            prefixes, data = None, m[0].encode()
            if hint and m.start() == hint[0] and data.startswith(hint[2].data):      # grown by the change: exact append
                prefixes = hint[2]
                prefixes.append(data[len(prefixes.data):])
            self.pieces.append((m.start(), m.end(), prefixes or Prefixes(self.tokenizer.vocabulary, data)))

    def ids(self) -> list[int]:
        return [i for _, _, p in self.pieces for i in p.ids()]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the lines "base64 rank" of a vocabulary file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, data.splitlines()))}


_LOADED: tuple[tuple, Tokenizer] | None = None


def _tokenizer(key: tuple, data) -> Tokenizer:
    """One tokenizer per worker process; another vocabulary or pattern takes its place."""
    global _LOADED
    if _LOADED is None or _LOADED[0] != key:
        _LOADED = (key, Tokenizer(read_ranks(data.value), key[1]))
    return _LOADED[1]


class Coder:
    """Encodes and decodes columns with the vocabulary in ``path``, sent once to each executor (under 2 MB)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            data = f.read()
        if len(data) > 32 << 20:
            raise ValueError(f"{path}: a vocabulary of {len(data)} bytes is too large to broadcast")
        self.data, self.key = spark.sparkContext.broadcast(data), (hash(data), pattern)

    def encode(self, docs: DataFrame, text_col: str = "text", into: str = "ids") -> DataFrame:
        key, data = self.key, self.data

        @F.arrow_udf("array<int>")
        def encoded(texts: pa.Array) -> pa.Array:
            return _tokenizer(key, data).encode_batch(texts)

        return docs.withColumn(into, encoded(whole_text(text_col)))

    def decode(self, frame: DataFrame, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
        key, data = self.key, self.data

        @F.arrow_udf("binary")
        def decoded(ids: pa.Array) -> pa.Array:
            return _tokenizer(key, data).decode_batch(ids)

        return frame.withColumn(into, decoded(F.col(ids_col)))
