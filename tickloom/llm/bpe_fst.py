"""A byte-level BPE tokenizer compiled to deterministic finite-state transducers.

Two transducers run in cascade. The first reads code points and marks where a
pre-token begins; its window is one character back and three ahead. The second
reads bytes and starts anew at every mark. Reading byte ``i`` of a pre-token it
knows the last token of the encoding of every prefix that can still matter, so
a transition is annotated with the change of the token count of the prefix, and
a state with the prefix's last token. States are made when first met and kept
in a dense table, bounded by ``MAX_STATES``.

Why it is exact: the BPE encoding of a prefix ends in the one token ``t`` that
BPE would keep apart from the last token of the encoding before ``t``. Whether
BPE keeps two tokens apart depends on the two alone: undo their merges along
the seam, latest first; at no time may the tokens at the seam have a merge that
comes before the merge undone last.

A text's bytes are cut into chunks of equal length that run in lockstep. The
state map of a chunk with a mark is constant, since the second transducer starts
anew there. That of a chunk without one is kept for the states in which the
chunk can be entered: those in which its left neighbour's map leaves it, and
the start, from which all chunks run at first. Such maps converge within a few
tokens, so two or three turns close them. A parallel prefix scan then composes
the maps of 1, 2, 4, ... chunks (``Transducer.entries``), which gives every
chunk its entry state, and all heads (the bytes before a chunk's first mark) run
at once. A text with no boundary in a megabyte takes as many rounds as the
logarithm of its chunks, not one round a chunk.

``encode`` runs the transducers only where they pay: a pre-token of at most
``SHORT`` bytes is merged once, many in step, and then looked up (see ``Words``).
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np

from tickloom.llm.common import hold

LETTER, NUMBER, SPACE, OTHER, SPECIAL = 1, 2, 3, 0, 4
START, DEAD = 0, 1
CHUNK = 256
#: Rows of the transition table; a row has a number for each byte met so far.
MAX_STATES = 1 << 17
#: Trie nodes with at most so many tokens below tell apart only what their tokens do.
WIDE = 16
#: Bytes run at once; a longer text is entered again where its last piece was left.
BLOCK = 1 << 20
#: Tokens of a pre-token that are read off one by one; the rest is found by doubling.
WALK = 32
#: Turns in which all chunks' maps grow; after them only what the text itself reaches.
TURNS = 8
#: Bytes of a pre-token that is remembered with its ids: its first 16 and its last eight are all of it.
SHORT = 24
#: Pre-tokens remembered at most; then anew. They take about 70 bytes each.
MAX_WORDS = 1 << 20

# The contractions that the pre-tokenizer splits off, without their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
# Unicode white space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


# An open token start in one number, which takes a fifth of the memory of a tuple.
BEFORE_BITS, ZERO = 24, 1 << 15


class TableFull(Exception):
    pass


def _open(node: int, before: int, rel: int) -> int:
    return (node << BEFORE_BITS | before + 1) << 16 | rel + ZERO


@functools.cache
def char_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def byte_symbols() -> dict[str, int]:
    """The printable stand-in that vocabulary files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ends_before(at: np.ndarray, begin: np.ndarray, last: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``at`` and all token ends on the way back from there to ``begin``, found for 1, 2, 4, ... tokens at once."""
    if not len(at):
        return at
    nowhere = len(last)
    jump = np.full(nowhere + 1, nowhere, np.int64)
    size = at - begin + 1
    own = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    back = own - length[last[own]]
    jump[own] = np.where(back >= np.repeat(begin, size), back, nowhere)
    while len(step := jump[at][jump[at] < nowhere]):
        at = np.append(at, step)
        jump = jump[jump]
    return at


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the given ranges, one range after the other."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


class Words:
    """Pre-tokens of at most ``SHORT`` bytes and their ids, as met; lookups compare all bytes."""

    # Odd multipliers of the hash function.
    ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

    def __init__(self, byte_ids: np.ndarray, pair_rank: dict[tuple[int, int], int], made: list[int]):
        """``made``: the token of each merge, by rank."""
        self.byte_ids, self.made = byte_ids, np.array([*made, -1], np.int32)
        self.none = len(made)
        self.pairs = np.array([left << 32 | right for left, right in pair_rank], np.int64)
        order = np.argsort(self.pairs)
        self.pairs, self.pair_rank = np.append(self.pairs[order], -1), np.append(np.fromiter(pair_rank.values(), np.int32, len(pair_rank))[order], self.none).astype(np.int32)
        self.byte_pairs = self._rank(np.repeat(byte_ids, 256), np.tile(byte_ids, 256)).reshape(256, 256)
        self.clear()

    def clear(self) -> None:
        self.known = 0
        #: a word by the upper bits of its key, or the next free place
        self.slots = np.full(1 << 12, -1, np.int32)
        self.key = np.zeros(0, np.uint64)
        self.parts = np.zeros((3, 0), np.uint64)
        self.size, self.count = np.zeros(0, np.int8), np.zeros(0, np.int8)
        self.at = np.zeros(0, np.int64)
        self.used = 0
        self.ids = np.zeros(0, np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs[:-1], pair)
        return np.where(self.pairs[at] == pair, self.pair_rank[at], self.none)

    def merged(self, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and their number; each turn makes the earliest merge of every word.

        ``rows``: a word's bytes, padded.
        """
        none, width = self.none, rows.shape[1]
        inside = np.arange(1, width) < size[:, None]
        rank = np.where(inside, self.byte_pairs[rows[:, :-1], rows[:, 1:]], none)
        rank = np.concatenate([rank, np.full((len(rows), 2), none)], 1).astype(np.int32)  # as wide as ids and one more
        ids = np.concatenate([self.byte_ids[rows], np.zeros((len(rows), 1))], 1).astype(np.int32)
        out, left = np.zeros((len(rows), width), np.int32), size.copy()
        own, columns = np.arange(len(rows)), np.arange(width)
        while len(own):
            at = rank.argmin(1)
            k = np.arange(len(own))
            best = rank[k, at]
            done = best == none
            if done.any():
                out[own[done]] = ids[done, :-1]
                go = ~done
                own, at, best, rank, ids = own[go], at[go], best[go], rank[go], ids[go]
                k = np.arange(len(own))
                if not len(own):
                    break
            left[own] -= 1
            behind = columns > at[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(behind, rank[:, 1:], rank[:, :-1])
            ids[k, at] = self.made[best]
            last = left[own] - 1
            rank[k, at] = np.where(at < last, self._rank(ids[k, at], ids[k, at + 1]), none)
            follows = np.flatnonzero(at > 0)
            before = at[follows] - 1
            rank[follows, before] = self._rank(ids[follows, before], ids[follows, before + 1])
        return out[np.arange(width) < left[:, None]], left

    def find(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where in ``ids`` each word's ids begin, how many they are, and whether the word is there at all; words are learned first."""
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(SHORT, np.uint8)])
        eight = np.ndarray((len(data) + SHORT,), "<u8", padded, strides=(1,))  # the bytes from each place on
        full, small = np.uint64(0xFFFFFFFFFFFFFFFF), size.astype(np.uint64)
        unused = (np.uint64(8) - np.minimum(small, np.uint64(8))) * np.uint64(8)
        parts = [eight[begin + 8] & full >> unused, eight[begin + size] & full << unused]
        parts.append(np.where(size > 16, eight[begin + 16], np.uint64(0)))
        key = (parts[0] ^ small * self.ODD[0]) * self.ODD[1]
        for part in parts[1:]:
            key = (key ^ key >> np.uint64(32) ^ part) * self.ODD[2]
        key = (key ^ key >> np.uint64(29)) * self.ODD[1]
        key ^= key >> np.uint64(32)
        word = self._look(key)
        new = np.flatnonzero(word < 0)
        if len(new):
            unique, first, inverse = np.unique(key[new], return_index=True, return_inverse=True)
            if self.known and self.known + len(unique) > MAX_WORDS:
                self.clear()
                return self.find(data, begin, size)
            word[new] = self.known + inverse
            new = new[first]
            order = np.argsort(size[new], kind="stable")
            ids, count = [], np.empty(len(new), np.int64)
            at = np.empty(len(new), np.int64)
            cuts = [0, *np.searchsorted(size[new][order], (8, 16), side="right").tolist(), len(new)]
            for k, low, high in zip((8, 16, SHORT), cuts, cuts[1:], strict=False):
                some = order[low:high]
                own = new[some]
                if len(own):
                    own_ids, count[some] = self.merged(padded[begin[own][:, None] + np.arange(8, 8 + k)], size[own])
                    ids.append(own_ids)
            at[order] = self.used + np.cumsum(count[order]) - count[order]
            self._learn(unique, [x[new] for x in parts], size[new], at, count, np.concatenate(ids))
        known = (self.size[word] == size) & np.logical_and.reduce([own[word] == x for own, x in zip(self.parts, parts, strict=True)])
        return self.at[word], self.count[word].astype(np.int64), known

    def _look(self, key: np.ndarray) -> np.ndarray:
        """The number of each key's word, or -1."""
        shift = np.uint64(65 - len(self.slots).bit_length())
        slot = (key >> shift).astype(np.int64)
        word = self.slots[slot]
        open_keys = np.flatnonzero(word >= 0)
        open_keys = open_keys[self.key[word[open_keys]] != key[open_keys]]
        while len(open_keys):
            slot[open_keys] = (slot[open_keys] + 1) & len(self.slots) - 1
            word[open_keys] = self.slots[slot[open_keys]]
            open_keys = open_keys[word[open_keys] >= 0]
            open_keys = open_keys[self.key[word[open_keys]] != key[open_keys]]
        return word

    def _learn(self, key: np.ndarray, parts: list[np.ndarray], size: np.ndarray, at: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """Add words with different keys."""
        begin, end = self.known, self.known + len(key)
        if end > len(self.key):
            more = max(end, 2 * len(self.key)) - len(self.key)
            self.key, self.size, self.count, self.at = (np.append(x, np.zeros(more, x.dtype)) for x in (self.key, self.size, self.count, self.at))
            self.parts = np.append(self.parts, np.zeros((3, more), np.uint64), axis=1)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(self.used + len(ids) - len(self.ids), len(self.ids)), np.int32))
        self.key[begin:end], self.parts[:, begin:end], self.size[begin:end] = key, parts, size
        self.at[begin:end], self.count[begin:end] = at, count
        self.ids[self.used : self.used + len(ids)] = ids
        self.known, self.used = end, self.used + len(ids)
        to_place = np.arange(begin, end, dtype=np.int32)
        if 2 * end > len(self.slots):
            self.slots = np.full(1 << (4 * end - 1).bit_length(), -1, np.int32)
            to_place = np.arange(end, dtype=np.int32)
        slot = (self.key[to_place] >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)
        while len(to_place):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = to_place[free]
            left = self.slots[slot] != to_place
            to_place, slot = to_place[left], (slot[left] + 1) & len(self.slots) - 1


class Transducer:
    """The tokenizer of one vocabulary file; ``of`` keeps the last one in a worker process."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE vocabularies without a prefix space are compiled")
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        if spec["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("normalizers and special tokens that take neighbours along are not compiled")
        symbol = byte_symbols()
        special_ids = set(self.special.values())
        size = max(model["vocab"].values(), default=0) + 1 if not special_ids else max(*model["vocab"].values(), *special_ids) + 1
        self.length = np.zeros(size, np.int32)
        self.rank, self.parts = [-1] * size, [(-1, -1)] * size
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner = [False]
        for text, token in model["vocab"].items():
            if token in special_ids:
                continue
            data = bytes(symbol[c] for c in text)
            self.length[token] = len(data)
            node = 0
            for b in data:
                self.inner[node] = True
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token[node] = token
        for text, token in ((k.decode(), v) for k, v in self.special.items()):
            self.length[token] = len(text.encode())
        self._index_subtrees()
        vocab = model["vocab"]
        made = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocab[left + right]
            self.rank[whole] = rank
            self.parts[whole] = (vocab[left], vocab[right])
            self.pair_rank[vocab[left], vocab[right]] = rank
            made.append(whole)
        byte_ids = np.array([self.token[self.child[b]] if b in self.child else -1 for b in range(256)], np.int32)
        self.words = Words(byte_ids, self.pair_rank, made) if (byte_ids >= 0).all() else None
        self.clear()

    @staticmethod
    def of(vocabulary: str) -> Transducer:
        return hold(f"transducer of {vocabulary}", lambda: Transducer(vocabulary))

    def _index_subtrees(self) -> None:
        """Tokens in the order of their bytes, and for each trie node the range of those strictly below it."""
        below: dict[int, list[int]] = {}
        for key, node in self.child.items():
            below.setdefault(key >> 8, []).append((key & 255) << 32 | node)
        self.ordered: list[int] = []
        self.first, self.end = [0] * len(self.token), [0] * len(self.token)
        stack = [(0, False)]
        while stack:
            node, left = stack.pop()
            if left:
                self.end[node] = len(self.ordered)
                continue
            if self.token[node] >= 0:
                self.ordered.append(self.token[node])
            self.first[node] = len(self.ordered)
            stack.append((node, True))
            stack.extend((x & 0xFFFFFFFF, False) for x in sorted(below.get(node, ()), reverse=True))
        self.place = [0] * len(self.length)
        for place, token in enumerate(self.ordered):
            self.place[token] = place

    def clear(self) -> None:
        self.column = np.full(256, -1, np.int32)  # of each byte that has been met
        self.met: list[int] = []
        # next state << 8 | change of the count + 128; 0: not made yet. Rows take memory when they are first written
        self.table = np.zeros((MAX_STATES, 128), np.int32)
        self.last = np.zeros(MAX_STATES, np.int32)
        self.states: list[tuple] = [(_open(0, -1, 0),), ()]
        self.ids = {key: state for state, key in enumerate(self.states)}
        self.table[DEAD] = DEAD << 8 | 128
        self.alike: dict[tuple, int] = {}
        self.allowed: dict[int, tuple] = {}  # by node and stand-in
        self.alias: dict[int, int] = {}

    def keeps_apart(self, left: int, right: int) -> bool:
        """Does BPE leave the two tokens apart when one follows the other?"""
        before = len(self.pair_rank) + 1
        while True:
            across = self.pair_rank.get((left, right))
            if across is not None and across < before:
                return False
            if self.rank[left] > self.rank[right]:
                before = self.rank[left]
                left = self.parts[left][1]
            elif self.rank[right] >= 0:  # equal merges go from left to right
                before = self.rank[right] + 1
                right = self.parts[right][0]
            else:
                return True

    def _stand_in(self, node: int, before: int, above: tuple | None) -> int:
        """A token that allows the same tokens below the node as ``before`` does, or -2 if none is allowed.

        ``above``: what ``before`` allows below the node's parent, where that is known.
        """
        known = self.alias.get(node << BEFORE_BITS | before)
        if known is None:
            first, end = self.first[node], self.end[node]
            if above is None and end - first > WIDE:
                known = before
            else:
                if above is None:
                    allowed = tuple(t for t in self.ordered[first:end] if self.keeps_apart(before, t))
                else:
                    allowed = tuple(t for t in above if first <= self.place[t] < end)
                known = self.alike.setdefault((node, allowed), before) if allowed else -2
                self.allowed[node << BEFORE_BITS | known] = allowed
            self.alias[node << BEFORE_BITS | before] = known
        return known

    def _step(self, state: int, byte: int) -> None:
        """Make one transition. A state is the list of open token starts: trie node, last token before, its count."""
        open_starts, token, count = [], -1, 0
        for start in self.states[state]:
            node, before, rel = start >> BEFORE_BITS + 16, (start >> 16 & (1 << BEFORE_BITS) - 1) - 1, (start & 0xFFFF) - ZERO
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            whole = self.token[to]
            above = self.allowed.get(node << BEFORE_BITS | before) if before >= 0 else None
            if token < 0 and whole >= 0 and (before < 0 or (whole in above if above is not None else self.keeps_apart(before, whole))):
                token, count = whole, rel + 1
            if self.inner[to]:
                if before >= 0:
                    before = self._stand_in(to, before, above)
                if before >= -1:
                    open_starts.append((to, before, rel))
        new = self._state((*(_open(node, before, rel - count) for node, before, rel in open_starts), _open(0, token, 0)))
        self.table[state, self.column[byte]] = new << 8 | count + 128

    def _state(self, key: tuple) -> int:
        """The number of a state, which is made if need be. Its last open start follows the prefix's last token."""
        new = self.ids.get(key)
        if new is None:
            new = len(self.states)
            if new >= MAX_STATES:
                raise TableFull
            self.ids[key] = new
            self.states.append(key)
            self.last[new] = (key[-1] >> 16 & (1 << BEFORE_BITS) - 1) - 1
        return new

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """The column of every byte; bytes met for the first time get one."""
        for byte in np.flatnonzero(np.bincount(data, minlength=256) * (self.column < 0)).tolist():
            if len(self.met) == self.table.shape[1]:
                self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
                self.table[DEAD] = DEAD << 8 | 128
            self.column[byte] = len(self.met)
            self.met.append(byte)
        return self.column[data]

    def _advance(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        width = self.table.shape[1]
        at = state * width + column
        out = self.table.reshape(-1)[at]
        if len(out) and not out.min():
            for pair in np.unique(at[out == 0]).tolist():
                self._step(pair // width, self.met[pair % width])
            out = self.table.reshape(-1)[at]
        return out

    def entries(self, rows: np.ndarray, has_mark: np.ndarray, exits: np.ndarray, entry: int) -> np.ndarray:
        """The state in which each chunk is entered; ``rows`` has a column for each chunk, ``exits`` counts where there is a mark.

        Points (chunk, state) are the maps' arguments, kept in order; ``jump``
        leads from each to the one 2^k chunks on. ``reached`` has the points that
        the text passes in the first 2^k chunks of every run of chunks without a mark.
        """
        found = np.append(entry, exits[:-1]).astype(np.int32)
        free = np.flatnonzero(~has_mark)
        if not len(free):
            return found
        first = free[(free == 0) | has_mark[free - 1]]
        begin = first << 32 | found[first].astype(np.int64)
        points, leave = np.zeros(0, np.int64), np.zeros(0, np.int32)
        new = np.union1d(begin, free << 32 | START)
        turn = 0
        while True:
            chunk = new >> 32
            state, columns = (new & 0xFFFFFFFF).astype(np.int32), rows[:, chunk]
            for j in range(CHUNK):
                state = self._advance(state, columns[j]) >> 8
            points, leave = np.append(points, new), np.append(leave, state)
            order = np.argsort(points)
            points, leave = points[order], leave[order]
            following = ((points >> 32) + 1) << 32 | leave
            goes_on = np.append(~has_mark, False)[following >> 32]
            at = np.minimum(np.searchsorted(points, following), len(points) - 1)
            made = points[at] == following
            nowhere = len(points)
            jump = np.append(np.where(goes_on & made, at, nowhere), nowhere)
            reached = np.searchsorted(points, begin)
            while len(step := jump[reached][jump[reached] < nowhere]):
                reached = np.append(reached, step)
                jump = jump[jump]
            if len(reached) == len(free):
                found[points[reached] >> 32] = points[reached] & 0xFFFFFFFF
                behind = (points[reached] >> 32) + 1
                inside = behind < len(found)
                found[behind[inside]] = leave[reached][inside]
                return found
            turn += 1
            asked = np.arange(len(points)) if turn < TURNS else reached
            asked = asked[(goes_on & ~made)[asked]]
            new = np.unique(following[asked])

    def run(self, data: np.ndarray, mark: np.ndarray, states: bool, entry: int = START) -> tuple[np.ndarray, np.ndarray | None, int]:
        """Per byte: the change of the token count and, if asked for, the state; and the state behind whole chunks.

        ``mark``: 1 start anew, 2 skip from here. ``entry``: the state before the first byte.
        """
        n = len(data)
        lanes = max(1, -(-n // CHUNK))
        padded = np.zeros(lanes * CHUNK, np.uint8)
        padded[:n] = self._columns(data)
        marks = np.full(lanes * CHUNK, 0, np.uint8)
        marks[:n] = mark
        marks[n:] = 2
        by_lane = marks.reshape(lanes, CHUNK)
        has_mark = by_lane.any(1)
        head = np.where(has_mark, (by_lane != 0).argmax(1), CHUNK)
        rows, kept, dead = (np.ascontiguousarray(x.reshape(lanes, CHUNK).T) for x in (padded, marks == 0, marks == 2))
        change = np.full((CHUNK, lanes), 128, np.uint8)
        seen = np.full((CHUNK, lanes), DEAD, np.int32) if states else None
        state = np.full(lanes, DEAD, np.int32)
        for j in range(CHUNK):
            state *= kept[j]
            state += dead[j]
            out = self._advance(state, rows[j])
            change[j] = out & 255
            np.right_shift(out, 8, out=state)
            if states:
                seen[j] = state
        leave = state[-1]
        # all heads at once, long ones first, each from the state in which its chunk is entered
        state = self.entries(rows, has_mark, state, entry)
        now = np.argsort(-head, kind="stable")
        now = now[head[now] > 0]
        state, lengths = state[now], head[now]
        for j in range(int(lengths[0]) if len(now) else 0):
            k = int(np.searchsorted(-lengths, -j, side="left"))  # those with length > j
            out = self._advance(state[:k], rows[j, now[:k]])
            change[j, now[:k]] = out & 255
            state[:k] = out >> 8
            if states:
                seen[j, now[:k]] = state[:k]
        if not has_mark[-1]:
            leave = state[now == lanes - 1][0]
        counts = change.T.reshape(-1)[:n].astype(np.int16) - 128
        return counts, None if seen is None else seen.T.reshape(-1)[:n], int(leave)

    def _marked(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Bytes, marks, the offset of each text, and special tokens as (start, end, id)."""
        joined = b"".join(texts)
        offsets = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(joined, np.uint8)
        n = len(data)
        section = np.zeros(n + 1, bool)
        section[offsets] = True
        specials = []
        for content, token in self.special.items():
            at = joined.find(content)
            while at >= 0:
                if not section[at + 1 : at + len(content)].any():  # not across two texts
                    specials.append((at, at + len(content), token))
                    at = joined.find(content, at + len(content))
                else:
                    at = joined.find(content, at + 1)
        for begin, end, _ in specials:
            section[begin] = section[end] = True
        if joined.isascii():
            lead, cp = np.arange(n), data
        else:
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            cp = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = char_classes()[cp]
        first = section[lead]
        starts = np.ones(len(cp), bool)
        if len(cp) > 1:
            before, here = kind[:-1], kind[1:]
            ends = np.append(first[2:], True)  # the section ends behind this character
            follows = np.append(kind[2:], SPACE)
            split_space = (before == SPACE) & ~ends & (follows != SPACE)
            starts[1:] = first[1:] | np.where(here == SPACE, (before != SPACE) | split_space, np.where(before == SPACE, cp[:-1] != 32, here != before))
        for i in np.flatnonzero((cp == 39) & starts).tolist():
            room = 1
            while room < 3 and i + room < len(cp) and not first[i + room]:
                room += 1
            tail = "".join(map(chr, cp[i + 1 : i + room].tolist()))
            hit = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
            if hit:
                starts[i + 1 : i + 1 + len(hit)] = False
                if i + 1 + len(hit) < len(cp):
                    starts[i + 1 + len(hit)] = True
        mark = np.zeros(n, np.uint8)
        mark[lead[starts]] = 1
        for begin, end, _ in specials:
            mark[begin:end] = 0
            mark[begin] = 2
            if end < n:
                mark[end] = 1
        return data, mark, offsets, specials

    def blocks(self, texts: list[bytes]):
        """Lists of about BLOCK bytes; one longer text stands alone."""
        block, size = [], 0
        for text in texts:
            if block and size + len(text) > BLOCK:
                yield block
                block, size = [], 0
            block.append(text)
            size += len(text)
        if block:
            yield block

    def _run_safely(self, data: np.ndarray, mark: np.ndarray, states: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Changes of the count and last tokens, in pieces of at most BLOCK bytes.

        A piece is entered in the state in which the one before it was left. If
        the table has no room left it starts anew, and a piece that has no room in
        a new table is halved.
        """
        counts, last = np.empty(len(data), np.int16), np.empty(len(data), np.int32) if states else None
        here, at, size, anew = self.states[START], 0, BLOCK, -1
        while at < len(data):
            to = min(at + size, len(data))
            try:
                counts[at:to], seen, leave = self.run(data[at:to], mark[at:to], states, self._state(here))
            except TableFull:
                if anew == at:
                    if to - at <= CHUNK:
                        raise
                    size = max((to - at) // 2 // CHUNK, 1) * CHUNK
                self.clear()
                anew = at
                continue
            if states:
                last[at:to] = self.last[seen]
            here, at, size = self.states[leave], to, min(2 * size, BLOCK)
        return counts, last

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text (valid UTF-8)."""
        out = []
        for block in self.blocks(texts):
            data, mark, offsets, specials = self._marked(block)
            counts, _ = self._run_safely(data, mark, False)
            total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            one = total[offsets[1:]] - total[offsets[:-1]]
            for begin, _, _ in specials:
                one[np.searchsorted(offsets, begin, side="right") - 1] += 1
            out.append(one)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of the texts, one after the other, and the number of each text's."""
        all_ids, all_counts = [], []
        for block in self.blocks(texts):
            data, mark, offsets, specials = self._marked(block)
            begin = np.flatnonzero(mark)
            size = np.diff(begin, append=len(data))
            count, source = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
            plain = mark[begin] == 1
            short = plain & (size <= SHORT) if self.words else np.zeros(len(begin), bool)
            if short.any():
                source[short], count[short], known = self.words.find(data, begin[short], size[short])
                short[np.flatnonzero(short)[~known]] = False
            long = plain & ~short
            known_ids = self.words.ids[: self.words.used] if self.words else np.zeros(0, np.int32)
            found = [known_ids]
            if long.any():
                at = ranges(begin[long], size[long])
                ids, count[long] = self._encode_marked(data[at], mark[at])
                source[long] = np.cumsum(count[long]) - count[long] + len(known_ids)
                found.append(ids)
            if specials:
                special = np.searchsorted(begin, [b for b, _, _ in specials])
                count[special] = 1
                source[special] = np.arange(len(specials)) + sum(map(len, found))
                found.append(np.array([token for *_, token in specials], np.int32))
            all_ids.append((np.concatenate(found) if len(found) > 1 else known_ids)[ranges(source, count)])
            total = np.append(0, np.cumsum(count))[np.searchsorted(begin, offsets)]
            all_counts.append(np.diff(total))
        if not all_ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(all_ids), np.concatenate(all_counts)

    def _encode_marked(self, data: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pre-tokens by the transducer, and the number of each one's."""
        counts, last = self._run_safely(data, mark, True)
        begin = first = np.flatnonzero(mark)
        end = np.append(begin[1:], len(data))
        total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids = np.empty(int(total[-1]), np.int32)
        at = end - 1  # walk back from the end of each pre-token
        for _ in range(WALK):
            ids[total[at + 1] - 1] = last[at]
            at = at - self.length[last[at]]
            more = at >= begin
            at, begin = at[more], begin[more]
        at = ends_before(at, begin, last, self.length)
        ids[total[at + 1] - 1] = last[at]
        return ids, total[end] - total[first]
