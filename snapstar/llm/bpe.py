"""Byte-level BPE encoding and decoding.

The merge ranks are compiled into a finite-state transducer over bytes.  Its
nondeterministic form guesses where a token ends: a hypothesis is (tokens since
the last commitment, prefix of the token being read), and a token may follow
another only if the merges of the two tokens' bytes give exactly those two.  A
sequence of tokens is the encoding of its bytes if and only if every
neighbouring pair passes that test, so each prefix of the input has one
finished hypothesis at most.  The transducer is determinised lazily: a state is
the set of live hypotheses, and the longest common prefix of their tokens is
emitted as soon as it is common.  No token is longer than the longest in the
vocabulary, so no more than that many bytes are ever open.

Pieces of up to ``TOGETHER`` bytes go through it many at a time, byte by byte in
step: the states that their prefixes reach are made as arrays, each distinct prefix
once, and tokens are read back from the end.  What a run has made is dropped with it;
only longer pieces, one at a time, use the stored table.

Decoding feeds tokens to an incremental UTF-8 state machine.

Rows: null text counts as empty (no ids); repeated rows give repeated results;
an empty table gives an empty result; other columns of the input are ignored.
Ill-formed UTF-8 in decoded ids is replaced by U+FFFD in text and kept as it is
in bytes.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from contextlib import contextmanager
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow

#: Entries and characters of a word memo, entries of the transducer's table and of the
#: pairs of tokens that were compared.  What is full starts anew: all only save repeated
#: work.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 8_000_000
TABLE_ENTRIES = 100_000
PAIR_ENTRIES = 600_000
#: Bytes of a piece that goes through the transducer beside others, pieces that do so
#: at a time, and chunks and characters that are looked up at a time.
TOGETHER, PIECES_AT_ONCE, CHUNKS_AT_ONCE, CHARS_AT_ONCE = 256, 32_768, 200_000, 1_000_000
#: Ids that the stream decoder takes at a time.
STREAMED = 65_536


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _IntMap:
    """Non-negative integers to small ones, whole arrays at a time (linear probing)."""

    def __init__(self, entries: int, dtype):
        self.bits = max(4, (2 * entries).bit_length())
        self.keys, self.values, self.used = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, dtype), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys``: distinct and new."""
        slot, self.used = self._slots(keys), self.used + len(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for unknown keys."""
        slot = self._slots(keys)
        there = self.keys[slot]
        while len(other := np.flatnonzero((there != keys) & (there >= 0))):
            slot[other] = (slot[other] + 1) & (len(self.keys) - 1)
            there[other] = self.keys[slot[other]]
        return np.where(there == keys, self.values[slot], -1)


class MergeTransducer:
    """Bytes to token ids, one byte at a time, by lazily built states."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.max_lookahead = max(map(len, ranks), default=0)
        # A trie: node << 8 | byte to node; token_at: the id that ends there, or -1.
        self.trie: dict[int, int] = {}
        self.token_at = [-1]
        for token, i in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if (node := self.trie.get(key, 0)) == 0:
                    node = self.trie[key] = len(self.token_at)
                    self.token_at.append(-1)
            self.token_at[node] = i
        self._side: dict[bytes, tuple | None] = {}
        self._pair: dict[int, bool] = {}
        self._tokens_at = np.array(self.token_at, np.int64)
        self._trie = _IntMap(len(self.trie), np.int32)
        self._trie.add(np.fromiter(self.trie, np.int64, len(self.trie)), np.fromiter(self.trie.values(), np.int32, len(self.trie)))
        self._pairs = _IntMap(PAIR_ENTRIES, np.int8)
        self._clear()

    def _clear(self) -> None:
        # A state: (last committed token or -1, ((open tokens, node of the trie), ...)).
        start = (-1, (((), 0),))
        self.states = [start]
        self.number = {start: 0}
        self.table: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _sides(self, token: bytes):
        """How the merges of ``token`` alone replace its last and its first part
        in turn: ((part, rank of the merge that takes it), ...) for each side;
        None if they do not end in the token."""
        if token in self._side:
            return self._side[token]
        parts, ranks, left, right = [token[i:i + 1] for i in range(len(token))], self.ranks, [], []
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
            rank = ranks.get(parts[best] + parts[best + 1])
            if rank is None:
                break
            if best == 0:
                left.append((parts[0], rank))
            if best == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        end = (token, 1 << 60)
        found = self._side[token] = ((*right, end), (*left, end)) if len(parts) == 1 else None
        return found

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether no merge crosses from ``a`` into ``b``: the parts that meet
        there are followed in the order of merging; of equal ranks the leftmost
        merge comes first.  A token that its own bytes do not merge to never
        follows anything."""
        sides = self._sides(self.bytes_of[b])
        if a < 0 or sides is None:
            return sides is not None
        rights, lefts, ranks = self._sides(self.bytes_of[a])[0], sides[1], self.ranks
        i = j = 0
        ok = True
        while ok:
            (r, taken_r), (l, taken_l) = rights[i], lefts[j]
            cross = ranks.get(r + l)
            if cross is not None and cross < taken_r and cross <= taken_l:
                ok = False
            elif taken_r <= taken_l:
                if i == len(rights) - 1:
                    break
                i += 1
            else:
                j += 1
        return ok

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_may_follow`` for whole arrays."""
        keys = (a + 1) << 32 | b
        ok = self._pairs.get(keys)
        if (ok < 0).any():
            new = np.unique(keys[ok < 0])
            found = np.fromiter((self._may_follow((k >> 32) - 1, k & 0xFFFFFFFF) for k in new.tolist()), np.int8, len(new))
            ok[ok < 0] = found[np.searchsorted(new, keys[ok < 0])]
            if self._pairs.used + len(new) > PAIR_ENTRIES:
                self._pairs = _IntMap(PAIR_ENTRIES, np.int8)
            self._pairs.add(new[:PAIR_ENTRIES], found[:PAIR_ENTRIES])
        return ok == 1

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, hyps = self.states[state]
        new, done = [], None
        trie, token_at, known = self.trie, self.token_at, self._pair
        for hyp in hyps:
            open_, node = hyp
            if (grown := trie.get(node << 8 | byte)) is None:
                continue
            new.append((open_, grown))
            if done is None and (t := token_at[grown]) >= 0:
                a = open_[-1] if open_ else last
                if (ok := known.get(a << 32 | t)) is None:
                    if len(known) > TABLE_ENTRIES:
                        known.clear()
                    ok = known[a << 32 | t] = self._may_follow(a, t)
                if ok:
                    done = (*open_, t)
        if done is None:
            raise ValueError("the vocabulary lacks single bytes")
        new.append((done, 0))
        common = 0
        if new[0][0]:  # the oldest hypothesis is open for longest
            shortest = min([len(o) for o, _ in new])
            while common < shortest and len({o[common] for o, _ in new}) == 1:
                common += 1
        out = done[:common]
        if out:
            last, new = out[-1], [(o[common:], p) for o, p in new]
        to = (last, tuple(new))
        if (n := self.number.get(to)) is None:
            n = self.number[to] = len(self.states)
            self.states.append(to)
        self.table[state << 8 | byte] = found = (n, out)
        return found

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-split piece.  A piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if len(self.table) > TABLE_ENTRIES:
            self._clear()
        state, ids, find = 0, [], self.table.get
        for byte in piece:
            state, out = find(state << 8 | byte) or self._step(state, byte)
            if out:
                ids += out
        ids += next((o for o, p in self.states[state][1] if not p), ())
        return tuple(ids)

    def encode_sorted(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many pieces, sorted and not empty, and how many each has.

        All pieces are read in step.  At each byte, the pieces that came from one state
        by one byte are in one state again.  A hypothesis is (state where its token
        begins, last token before that, node of the trie); of a state are kept the
        token that ends there and the state where that begins."""
        n = len(pieces)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.fromiter(map(len, pieces), np.int64, n)
        at, ends = np.cumsum(length) - length, np.zeros(n, np.int64)
        active, state = np.arange(n), np.zeros(n, np.int64)
        count = np.ones(1, np.int64)  # hypotheses of each state
        begins, last, node = np.zeros(1, np.int64), np.full(1, -1, np.int64), np.zeros(1, np.int64)
        first, tokens, back = 0, [np.full(1, -1, np.int64)], [np.zeros(1, np.int64)]  # first: number of this byte's first state
        for depth in range(int(length.max(initial=0)) + 1):
            over = length[active] == depth
            ends[active[over]] = first + state[over]
            active, state = active[~over], state[~over]
            if not len(active):
                break
            byte = data[at[active] + depth].astype(np.int64)
            new = np.r_[True, (state[1:] != state[:-1]) | (byte[1:] != byte[:-1])]
            parent, byte = state[new], byte[new]
            state, first, m = np.cumsum(new) - 1, first + len(count), len(parent)
            many = count[parent]
            owner = np.repeat(np.arange(m), many)
            source = np.arange(len(owner)) + np.repeat((np.cumsum(count) - count)[parent] - (np.cumsum(many) - many), many)
            grown = self._trie.get(node[source] << 8 | byte[owner])
            live = np.flatnonzero(grown >= 0)
            owner, source, grown = owner[live], source[live], grown[live].astype(np.int64)
            begins, last = begins[source], last[source]
            token = self._tokens_at[grown]
            ended = np.flatnonzero(token >= 0)
            ended = ended[self._follow(last[ended], token[ended])]
            ended = ended[np.r_[True, owner[ended][1:] != owner[ended][:-1]]] if len(ended) else ended
            if len(ended) != m:
                raise ValueError("the vocabulary lacks single bytes")
            tokens.append(token[ended])
            back.append(begins[ended])
            # One hypothesis more for each state: a token begins here.
            kept = np.bincount(owner, minlength=m)
            old, fresh = np.arange(len(owner)) + owner, np.cumsum(kept) + np.arange(m)
            count = kept + 1
            parts = ((begins, first + np.arange(m)), (last, tokens[-1]), (grown, np.zeros(m, np.int64)))
            begins, last, node = (np.empty(len(owner) + m, np.int64) for _ in parts)
            for to, (was, more) in zip((begins, last, node), parts):
                to[old], to[fresh] = was, more
        tokens, back = np.concatenate(tokens), np.concatenate(back)
        # From the last token to the first.
        which, found, open_ = [], [], np.arange(n)
        state = ends
        while len(open_):
            which.append(open_)
            found.append(tokens[state])
            state = back[state]
            open_, state = open_[state > 0], state[state > 0]
        size = np.bincount(np.concatenate(which), minlength=n) if which else np.zeros(0, np.int64)
        to = np.cumsum(size)
        ids = np.empty(int(size.sum()), "<u4")
        for k, (pieces_, t) in enumerate(zip(which, found), 1):
            ids[to[pieces_] - k] = t
        return ids, size

    def encode_all(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many pre-split pieces in a row, and how many each has."""
        raw = [p.encode("utf-8") for p in pieces]
        alone = np.fromiter(map(self.ranks.get, raw, repeat(-1)), np.int64, len(raw))
        rest = np.flatnonzero(alone < 0).tolist()
        rest.sort(key=raw.__getitem__)
        short, flat, size, of = [k for k in rest if len(raw[k]) <= TOGETHER], [], [], []
        for at in range(0, len(short), PIECES_AT_ONCE):
            of.append(short[at:at + PIECES_AT_ONCE])
            for to, found in zip((flat, size), self.encode_sorted([raw[k] for k in of[-1]])):
                to.append(found)
        for k in rest:
            if len(raw[k]) > TOGETHER:
                of.append([k])
                flat.append(np.array(self.encode(raw[k]), "<u4"))
                size.append(np.array([len(flat[-1])]))
        whole = np.flatnonzero(alone >= 0)
        flat, size, of = (np.concatenate(x) for x in ((*flat, alone[whole].astype("<u4")), (*size, np.ones_like(whole)), (*of, whole)))
        order = np.argsort(of)
        return runs(flat, (np.cumsum(size) - size)[order], size[order]), size[order]


def runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pieces of ``flat`` in a row."""
    to = np.cumsum(size)
    return flat[np.arange(to[-1] if len(to) else 0) + np.repeat(start - to + size, size)]


class _Numbers(dict):
    """The number of each string, by first look-up; new ones are listed in ``memo``."""

    def __init__(self, memo: _Memo, lead: str):
        self.memo, self.lead = memo, lead

    def __missing__(self, key: str) -> int:
        self.memo.new.append(self.lead + key)
        n = self[key] = self.memo.next
        self.memo.next = n + 1
        return n


class _Memo:
    """Strings and their ids.  ``spaced`` has strings without the one space they begin
    with."""

    def __init__(self, encode_all):
        self.encode_all = encode_all
        self.plain, self.spaced = _Numbers(self, ""), _Numbers(self, " ")
        self.clear()

    def clear(self) -> None:
        self.plain.clear()
        self.spaced.clear()
        self.new: list[str] = []
        self.next = self.chars = 0
        self.flat, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings of these numbers in a row, and how many each has.  A
        full memo is emptied behind it, so numbers hold until then."""
        if self.new:
            new, self.new = self.new, []
            self.chars += sum(map(len, new))
            flat, size = self.encode_all(new)
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
        size = self.size[numbers]
        found = runs(self.flat, (np.cumsum(self.size) - self.size)[numbers], size), size
        if self.next > MEMO_ENTRIES or self.chars > MEMO_CHARS:
            self.clear()
        return found


class Codec:
    """Encoder and decoder of whole texts for one rank file and pattern."""

    #: Every match starts anew where white space follows other characters, so
    #: texts are cut there and each chunk is split by the pattern on its own.
    CHUNK = regex.compile(r"\s*\S+|\s+")

    def __init__(self, path: str, pattern: str):
        self.fst = MergeTransducer(load_ranks(path))
        self.findall = regex.compile(pattern).findall
        # Of matches of the pattern, and of chunks (a run of white space and what follows).
        self.pieces, self.chunks = _Memo(self.fst.encode_all), _Memo(self._split)
        size = max(self.fst.bytes_of) + 1
        self.token_bytes = [self.fst.bytes_of.get(i, b"") for i in range(size)]
        self.whole = np.array([utf8_run(0, t)[0] == 0 for t in self.token_bytes])

    def rest(self) -> None:
        """Give most memory back between two tasks, when other queries may need it.
        A task fills its memos anew from its own texts; the transducer's table and
        pairs, which take longer to make, stay."""
        self.pieces.clear()
        self.chunks.clear()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        todo, size = [], 0
        for k, text in enumerate(texts):
            for numbers, chunks in self._cut(text or ""):
                for at in range(0, len(chunks), CHUNKS_AT_ONCE):
                    part = chunks[at:at + CHUNKS_AT_ONCE]
                    todo.append((k, np.fromiter(map(numbers.__getitem__, part), np.int64, len(part))))
                    size += len(part)
                    if size >= CHUNKS_AT_ONCE:
                        self._look_up(todo, out)
                        todo, size = [], 0
        self._look_up(todo, out)
        return [b"".join(x) for x in out]

    def _cut(self, text: str):
        """The chunks of ``text`` in order, and the numbers that they are looked up in."""
        first, *rest = text.split(" ")
        if "" in rest or any(map(str.isspace, rest)):
            return [(self.chunks.plain, self.CHUNK.findall(text))]
        # Single spaces between words: each part with its space is a chunk.
        return [(self.chunks.plain, [first] if first else []), (self.chunks.spaced, rest)]

    def _look_up(self, todo: list[tuple[int, np.ndarray]], out: list[list[bytes]]) -> None:
        if todo:
            ids, size = self.chunks.ids(np.concatenate([numbers for _, numbers in todo]))
            ends = np.cumsum(size)[np.cumsum([len(numbers) for _, numbers in todo]) - 1].tolist()
            for (k, _), a, b in zip(todo, [0, *ends], ends):
                out[k].append(ids[a:b].tobytes())

    def _split(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks in a row, and how many each has, by their matches."""
        found = [*map(self.findall, chunks)]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        numbers = np.fromiter(map(self.pieces.plain.__getitem__, chain.from_iterable(found)), np.int64, ends[-1])
        ids, size = self.pieces.ids(numbers)
        return ids, np.diff(np.r_[0, np.cumsum(size)][np.r_[0, ends]])

    def decode_bytes(self, ids: np.ndarray) -> tuple[bytes, bool]:
        """The bytes of ``ids`` and whether the state machine accepts them."""
        odd = np.flatnonzero(~self.whole[ids])
        state, at = 0, -2
        ok = True
        for k in odd.tolist():
            if k != at + 1 and state:  # a whole token cannot end an open character
                ok = False
                break
            state, good = utf8_run(state, self.token_bytes[int(ids[k])])
            at = k
            if not good:
                ok = False
                break
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())), ok and state == 0

    def decode(self, ids: np.ndarray) -> str:
        raw, ok = self.decode_bytes(ids)
        return raw.decode("utf-8") if ok else raw.decode("utf-8", "replace")


def _utf8_table() -> list[list[int]]:
    """Next state by state and byte.  0: between characters; 1, 2, 3: so many
    plain continuation bytes to come; 4 to 7: the next byte is in a narrower
    range (after E0, ED, F0, F4); 8: ill-formed."""
    t = [[8] * 256 for _ in range(9)]
    t[0][:0x80] = [0] * 0x80
    t[0][0xC2:0xE0] = [1] * 0x1E
    t[0][0xE0:0xF0] = [2] * 0x10
    t[0][0xF0:0xF5] = [3] * 5
    t[0][0xE0], t[0][0xED], t[0][0xF0], t[0][0xF4] = 4, 5, 6, 7
    for state, low, high, to in ((1, 0x80, 0xC0, 0), (2, 0x80, 0xC0, 1), (3, 0x80, 0xC0, 2),
                                 (4, 0xA0, 0xC0, 1), (5, 0x80, 0xA0, 1), (6, 0x90, 0xC0, 2), (7, 0x80, 0x90, 2)):
        t[state][low:high] = [to] * (high - low)
    return t


_UTF8 = _utf8_table()


def utf8_run(state: int, data: bytes) -> tuple[int, bool]:
    for b in data:
        state = _UTF8[state][b]
        if state == 8:
            return 8, False
    return state, True


class StreamDecoder:
    """Token by token to text: what is complete comes out, the rest waits."""

    def __init__(self, codec: Codec):
        self.codec, self.state, self.open = codec, 0, b""

    def feed(self, token: int) -> str:
        """The text that ``token`` completes.  An ill-formed byte becomes U+FFFD."""
        out, start = [], 0
        data = self.open + self.codec.token_bytes[token]
        state = i = 0
        while i < len(data):
            state = _UTF8[state][data[i]]
            i += 1
            if state == 0:
                out.append(data[start:i].decode("utf-8"))
                start = i
            elif state == 8:
                i = max(start + 1, i - 1)  # the byte that did not fit may start a character
                out.append("�")
                start, state = i, 0
        self.state, self.open = state, data[start:]
        return "".join(out)

    def feed_ids(self, ids: np.ndarray) -> bytes:
        """The text, in UTF-8, that many tokens complete.  Tokens that are whole
        characters leave the machine between characters; only the others, and what
        follows them while a character is open, pass through it byte by byte."""
        out, at = [], 0
        for k in [*np.flatnonzero(~self.codec.whole[ids]).tolist(), len(ids)]:
            if self.open and at < k:
                out.append(self.feed(int(ids[at])).encode())
                at += 1
            out.append(b"".join(map(self.codec.token_bytes.__getitem__, ids[at:k].tolist())))
            if k < len(ids):
                out.append(self.feed(int(ids[k])).encode())
            at = k + 1
        return b"".join(out)

    def finish(self) -> str:
        rest, self.open, self.state = self.open, b"", 0
        return "�" if rest else ""


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


@contextmanager
def working(c: Codec):
    """Memos and states are many small objects without cycles; walking them again
    and again for cycles takes a fifth of the time.  The worker serves other
    queries too, so what was set before is set again and the memos go."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield c
    finally:
        c.rest()
        if was:
            gc.enable()


def encode_batches(batches, path: str, pattern: str):
    with working(codec(path, pattern)) as c:
        yield from _encoded(batches, c)


def _groups(batches):
    """Row numbers and texts, so many characters at a time: a batch may hold very long texts."""
    for b in batches:
        ids, texts, size = b.column(0), [], 0
        for k, t in enumerate(b.column(1), 1):
            texts.append(t.as_py())
            size += len(texts[-1] or "")
            if size > CHARS_AT_ONCE or k == b.num_rows:
                yield ids.slice(k - len(texts), len(texts)), texts
                texts, size = [], 0


def _encoded(batches, c: Codec):
    for doc_ids, texts in _groups(batches):
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in c.encode_many(texts)]
        lengths = np.cumsum([0, *map(len, ids)])
        flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [doc_ids, pa.LargeListArray.from_arrays(pa.array(lengths, pa.int64()), flat).cast(pa.list_(pa.int32()))], ["doc_id", "ids"])


def decode_batches(batches, path: str, pattern: str):
    c = codec(path, pattern)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([c.decode(np.array(i or [], np.int64)) for i in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])


def decoded_digest(c: Codec, ids: np.ndarray) -> str:
    """SHA-256 of what the stream decoder gives for ``ids``, fed in pieces."""
    decoder, sha = StreamDecoder(c), hashlib.sha256()
    for at in range(0, len(ids), STREAMED):
        sha.update(decoder.feed_ids(ids[at:at + STREAMED]))
    sha.update(decoder.finish().encode())
    return sha.hexdigest()


def digest_batches(batches, path: str, pattern: str):
    with working(codec(path, pattern)) as c:
        yield from _digests(batches, c)


def _digests(batches, c: Codec):
    for doc_ids, texts in _groups(batches):
        n, sha, back = [], [], []
        for ids in c.encode_many(texts):
            n.append(len(ids) // 4)
            sha.append(hashlib.sha256(ids).hexdigest())
            back.append(decoded_digest(c, np.frombuffer(ids, "<u4")))
        yield pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row's whole ``text``."""
    return map_arrow(_input(docs), "snapstar.llm.bpe:encode_batches", "doc_id long, ids array<int>", path=path, pattern=pattern)


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row's ``ids`` (null: empty)."""
    return map_arrow(ids.select("doc_id", "ids"), "snapstar.llm.bpe:decode_batches", "doc_id long, text string", path=path, pattern=pattern)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode each whole text; digests of the ids and of the bytes
    that the ids decode to, so that neither crosses to the JVM."""
    return map_arrow(_input(docs), "snapstar.llm.bpe:digest_batches",
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path=path, pattern=pattern)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
