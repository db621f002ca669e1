"""Byte-pair encoding by a table of last tokens, one per prefix.

Every prefix of a word has one encoding, so it has one last token: the only token that
ends there and may follow the last token of the prefix before it. Two tokens may stand
side by side when no merge across their border comes before the merges that made them;
undoing those merges, latest first, shows it without encoding anything. The table gives
the token count of every prefix, and the ids by walking it backwards.

Words of a batch are handled together: tokens are matched from all positions at once
along a trie, and the table is filled for all words one position at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

NONE = -1
#: Longer words (in bytes) are walked by themselves, so that a batch's table stays small.
LONG = 1 << 13
#: Answers remembered for such words.
MEMO_PAIRS = 1 << 20
MEMO_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """A fixed map from non-negative 63-bit keys to numbers, probed for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.keys = np.full(1 << self.bits, NONE, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        todo = np.arange(len(keys))
        slots = self._slots(np.asarray(keys, np.int64))
        while len(todo):
            free = self.keys[slots[todo]] == NONE
            first = np.zeros(len(todo), bool)
            first[np.unique(slots[todo], return_index=True)[1]] = True
            now = todo[free & first]
            self.keys[slots[now]], self.values[slots[now]] = keys[now], values[now]
            todo = todo[~(free & first)]
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        todo = np.flatnonzero((found != keys) & (found != NONE))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (found != NONE)]
        return out


class PrefixTable:
    """``atoms``: token of each single symbol. ``merges``: ``(left, right, token, rank)``,
    lower ranks first, ties leftmost first. ``strings``: bytes of each token. ``ended``:
    tokens that only stand at the end of a word."""

    def __init__(self, strings: Sequence[bytes | None], atoms: Iterable[int], merges: Sequence[tuple[int, int, int, int]], ended: Iterable[int] = ()):
        n = len(strings)
        self.strings = strings
        self.length = np.array([len(s) if s is not None else 0 for s in strings], np.int64)
        self.left, self.right = np.full(n, NONE, np.int64), np.full(n, NONE, np.int64)
        self.rank = np.full(n, NONE, np.int64)
        made = np.array(merges, np.int64).reshape(-1, 4)
        self.pairs = Lookup(made[:, 0] << 20 | made[:, 1], made[:, 3])
        usable = np.zeros(n, bool)
        usable[list(atoms)] = True
        # Shorter tokens first: a merge only uses tokens shorter than its own.
        sizes = self.length[made[:, 2]]
        for size in np.unique(sizes):
            rows = made[sizes == size]
            rows = rows[usable[rows[:, 0]] & usable[rows[:, 1]]]
            rows = rows[self._may_meet(rows[:, 0], rows[:, 1], 2 * rows[:, 3])]
            self.left[rows[:, 2]], self.right[rows[:, 2]], self.rank[rows[:, 2]] = rows[:, 0], rows[:, 1], rows[:, 3]
            usable[rows[:, 2]] = True
        self.usable = usable
        ended = set(ended)
        self._build_trie([(t, strings[t]) for t in np.flatnonzero(usable).tolist() if t not in ended], [(t, strings[t]) for t in ended if usable[t]])
        self._memo_keys = np.full(1 << MEMO_BITS, NONE, np.int64)
        self._memo_ok = np.zeros(1 << MEMO_BITS, bool)
        self._pairs_met: dict[int, bool] = {}
        ranks = dict(zip((made[:, 0] << 20 | made[:, 1]).tolist(), made[:, 3].tolist()))
        self._plain = ranks, self.rank.tolist(), self.left.tolist(), self.right.tolist()

    def _build_trie(self, inner: list, final: list) -> None:
        children: dict[int, int] = {}
        count = 1
        ends = []
        for token, text in [*inner, *final]:
            node = 0
            for byte in text:
                key = node << 8 | byte
                nxt = children.get(key)
                if nxt is None:
                    nxt = children[key] = count
                    count += 1
                node = nxt
            ends.append(node)
        self.child = Lookup(np.fromiter(children.keys(), np.int64, len(children)), np.fromiter(children.values(), np.int64, len(children)))
        self.inner_at, self.final_at = np.full(count, NONE, np.int64), np.full(count, NONE, np.int64)
        self.inner_at[ends[: len(inner)]] = [t for t, _ in inner]
        self.final_at[ends[len(inner) :]] = [t for t, _ in final]
        self.ends_words = bool(final)
        self._inner, self._final = {s: t for t, s in inner}, {s: t for t, s in final}
        # Length of the longest token with these two last bytes.
        self._reach: dict[bytes, int] = {}
        for text in [*self._inner, *self._final]:
            self._reach[text[-2:]] = max(self._reach.get(text[-2:], 1), len(text))

    def _may_meet(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether each ``a, b`` stay apart when all merges up to ``limit`` are done.

        Merges run in order of rank, so undoing the later of the two last merges goes
        back in time; a border merge ranked before the merge undone would have come
        first. At equal rank the left one comes first."""
        ok = np.ones(len(a), bool)
        rows = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << 62, np.int64) if limit is None else limit.copy()
        while len(rows):
            rank = self.pairs(a << 20 | b)
            apart = (rank == NONE) | (2 * rank >= limit)
            ok[rows[~apart]] = False
            undo_left = self.rank[a] > self.rank[b]
            last = np.where(undo_left, self.rank[a], self.rank[b])
            keep = apart & (last != NONE)
            rows, a, b, undo_left, last = rows[keep], a[keep], b[keep], undo_left[keep], last[keep]
            limit = np.where(undo_left, 2 * last, 2 * last + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return ok

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``b`` may stand after ``a``; answers are kept in a table of fixed size."""
        keys = a << 20 | b
        slots = ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        out = self._memo_ok[slots]
        new = np.flatnonzero(self._memo_keys[slots] != keys)
        if len(new):
            out[new] = self._may_meet(a[new], b[new])
            self._memo_keys[slots[new]], self._memo_ok[slots[new]] = keys[new], out[new]
        return out

    def _follows(self, a: int, b: int) -> bool:
        """``may_follow`` of one pair, without arrays."""
        key = a << 20 | b
        found = self._pairs_met.get(key)
        if found is None:
            if len(self._pairs_met) >= MEMO_PAIRS:
                self._pairs_met.clear()
            found = self._pairs_met[key] = self._meet_once(a, b)
        return found

    def _meet_once(self, a: int, b: int) -> bool:
        rank_of, rank, left, right = self._plain
        limit = 1 << 62
        while True:
            border = rank_of.get(a << 20 | b)
            if border is not None and 2 * border < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = 2 * rank[a], right[a]
            elif rank[b] != NONE:
                limit, b = 2 * rank[b] + 1, left[b]
            else:
                return True

    def fill(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``starts, sizes, last, count``: word ``i`` owns the slots ``starts[i]`` to
        ``starts[i] + sizes[i]``, one per prefix, the last holding its whole encoding."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(words) else np.zeros(0, np.int64)
        total = int((sizes + 1).sum())
        text = np.frombuffer(b"\0".join([*words, b""]), np.uint8).astype(np.int64)
        last, count = np.full(total, NONE, np.int64), np.zeros(total, np.int64)
        end_of = np.repeat(starts + sizes, sizes + 1)
        begin_of = np.repeat(starts, sizes + 1)
        at = np.flatnonzero(np.arange(total) < end_of)
        node = np.zeros(len(at), np.int64)
        begins, ends, tokens = [], [], []
        depth = 0
        while len(at):
            node = self.child(node << 8 | text[at + depth])
            depth += 1
            keep = node != NONE
            at, node = at[keep], node[keep]
            stop = at + depth
            final = stop == end_of[at]
            token = np.where(final, self.final_at[node], self.inner_at[node]) if self.ends_words else self.inner_at[node]
            hit = token != NONE
            begins.append(at[hit])
            ends.append(stop[hit])
            tokens.append(token[hit])
            keep = ~final
            at, node = at[keep], node[keep]
        if not begins:
            return starts, sizes, last, count
        begin, end, token = np.concatenate(begins), np.concatenate(ends), np.concatenate(tokens)
        step = end - begin_of[begin]
        # Small numbers sort by counting.
        order = np.argsort(step.astype(np.uint16) if step.max() < 1 << 16 else step, kind="stable")
        begin, end, token = begin[order], end[order], token[order]
        bounds = np.searchsorted(step[order], np.arange(1, int(step.max()) + 2))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            b, e, t = begin[lo:hi], end[lo:hi], token[lo:hi]
            before = last[b]
            known = before != NONE
            ok = b == begin_of[b]
            ok[known] = self.may_follow(before[known], t[known])
            last[e[ok]] = t[ok]
            count[e[ok]] = count[b[ok]] + 1
        return starts, sizes, last, count

    def _fill_one(self, word: bytes, every_end: bool = False) -> tuple[list[int], list[int], list[int]]:
        """The same table for one word, position by position: ``last, count`` and, for
        ``every_end``, the count of each prefix taken as a word of its own."""
        n = len(word)
        last, count, ended = [NONE] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            reach = self._reach.get(word[max(0, end - 2) : end], 1)
            for table, wanted in ((self._final, self.ends_words and (every_end or end == n)), (self._inner, not self.ends_words or end < n)):
                if not wanted:
                    continue
                for begin in range(max(0, end - reach), end):
                    if begin and last[begin] == NONE:
                        continue
                    token = table.get(word[begin:end])
                    if token is not None and (not begin or self._follows(last[begin], token)):
                        if table is self._final:
                            ended[end] = count[begin] + 1
                        if table is self._inner or end == n:
                            last[end], count[end] = token, count[begin] + 1
                        break
        return last, count, ended if self.ends_words else count

    def prefix_counts(self, word: bytes) -> list[int]:
        """Tokens of every prefix of ``word``, each taken as a word of its own."""
        return self._fill_one(word, every_end=True)[2]

    def counts(self, words: Sequence[bytes]) -> list[int]:
        out = [0] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        starts, sizes, _, count = self.fill([words[i] for i in short])
        for i, c in zip(short, count[starts + sizes].tolist()):
            out[i] = c
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._fill_one(w)[1][-1]
        return out

    def encode_flat(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``ids, bounds``: word ``i`` has the ids from ``bounds[i]`` to ``bounds[i + 1]``,
        recovered from its end."""
        sizes = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero(sizes <= LONG)
        starts, lengths, last, count = self.fill([words[i] for i in short.tolist()])
        many = np.zeros(len(words), np.int64)
        many[short] = count[starts + lengths]
        long = {}
        for i in np.flatnonzero(sizes > LONG).tolist():
            tokens, _, _ = self._fill_one(words[i])
            at, back = len(words[i]), []
            while at:
                back.append(tokens[at])
                at -= len(self.strings[tokens[at]])
            long[i] = back[::-1]
            many[i] = len(back)
        bounds = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
        ids = np.zeros(int(bounds[-1]), np.int64)
        put = bounds[1:][short].copy()
        at = starts + lengths
        rows = np.flatnonzero(lengths > 0)
        while len(rows):
            token = last[at[rows]]
            put[rows] -= 1
            ids[put[rows]] = token
            at[rows] -= self.length[token]
            rows = rows[at[rows] > starts[rows]]
        for i, found in long.items():
            ids[bounds[i] : bounds[i + 1]] = found
        return ids, bounds

    def encode(self, words: Sequence[bytes]) -> list[list[int]]:
        """Ids of every word."""
        ids, bounds = self.encode_flat(words)
        flat, at = ids.tolist(), bounds.tolist()
        return [flat[a:b] for a, b in zip(at, at[1:])]
