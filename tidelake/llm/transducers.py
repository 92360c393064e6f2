"""Byte-level BPE as two deterministic transducers, run on whole blocks of text with numpy.

The first splits text into the pieces that BPE works on. It has nine states, so a chunk of
text *is* a map from entry state to exit state; the maps of all chunks of a block are
computed side by side and composed by a parallel prefix scan, which gives every chunk its
entry state without reading the text in order.

The second runs inside a piece. After each byte it knows the last token of the BPE result
of the piece so far, because that result is the one for a shorter prefix plus one token,
and the token that ends here is the only one that BPE keeps apart from its predecessor.
Which earlier positions can still matter is bounded by the longest suffix that begins a
token, so (that suffix, the last tokens at its positions, their counts relative to now) is
a finite state. A transition is annotated with the change of the token count. Transitions
are compiled when first met, with the vocabulary's own library as judge of token pairs, and
kept in one hash table of flat arrays for the life of a worker.

Counts are made from all bytes; ids are looked up by piece, as equal pieces have equal ids.
"""

from __future__ import annotations

import json
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import tokenizers

# Byte order of the vocabulary's alphabet (fixed values): printable bytes stand for
# themselves, the others follow from code point 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Character classes of the splitter; plus FIRST for the first character of a segment.
LETTER, TAIL1, TAIL2, DIGIT, OTHER, QUOTE, SPACE, BLANK, FIRST = range(9)
# States: what the last character belongs to.
_IN_LETTERS, _IN_DIGITS, _IN_OTHER, _AT_QUOTE, _AT_SPACE, _AT_BLANK, _MID_TAIL, _END_TAIL, _START = range(9)
STATES, SYMBOLS = 9, 16
STEPS = 128          # characters of a chunk
SETTLE = 16          # last characters of a chunk, which nearly always decide its map alone
LANE = 256           # bytes of a lane of the second transducer
LONG_PIECE = 4096    # longer pieces are walked one by one
BLOCK = 1 << 20      # bytes handled at once
GROUP = 4 << 20      # bytes among which equal pieces are encoded once


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state (times SYMBOLS) and "a piece begins here" at state * SYMBOLS + symbol.

    TAIL1 are letters that end a contraction at once ('s, 't, 'm, 'd), TAIL2 those that do
    with the letter that follows them ('re, 've, 'll). Whether the last blank of a run
    begins a piece depends on the next character, and is added by the caller.
    """
    nxt = np.zeros((STATES, SYMBOLS), np.uint8)
    cut = np.zeros((STATES, SYMBOLS), bool)
    for symbol in range(SYMBOLS):
        kind = symbol & 7
        for q in range(STATES):
            state = _START if symbol >= 8 else q
            joins = False
            if kind in (LETTER, TAIL1, TAIL2):
                to = _IN_LETTERS
                joins = state in (_IN_LETTERS, _AT_SPACE)
                if state == _AT_QUOTE and kind == TAIL1:
                    to, joins = _END_TAIL, True
                elif state == _AT_QUOTE and kind == TAIL2:
                    to, joins = _MID_TAIL, True
                elif state == _MID_TAIL:
                    to, joins = _END_TAIL, True
            elif kind == DIGIT:
                to, joins = _IN_DIGITS, state in (_IN_DIGITS, _AT_SPACE)
            elif kind in (OTHER, QUOTE):
                joins = state in (_IN_OTHER, _AT_QUOTE, _AT_SPACE)
                to = _AT_QUOTE if kind == QUOTE and not joins else _IN_OTHER
            else:
                to = _AT_SPACE if kind == SPACE else _AT_BLANK
                joins = state in (_AT_SPACE, _AT_BLANK)
            nxt[q, symbol], cut[q, symbol] = to * SYMBOLS, not joins
    return nxt.ravel(), cut.ravel()


class Transducers:
    """The two compiled transducers of one vocabulary file (a byte-level BPE ``.json``).

    ``max_states`` bounds the tables of the second one (about 0.7 KB a state); beyond it
    they are emptied and compiled anew, which changes time but no result.
    """

    def __init__(self, path: str, max_states: int = 300_000):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        library = tokenizers.Tokenizer.from_file(path)
        self._bpe, self._split = library.model, library.pre_tokenizer
        rest = (b for b in range(256) if b not in set(_PRINTABLE))
        letters = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._letters = [letters[b] for b in range(256)]
        back = {c: b for b, c in letters.items()}
        self.specials = {t["content"].encode(): t["id"] for t in model["added_tokens"]}
        self._ids = {
            bytes(back[c] for c in text): i
            for text, i in model["model"]["vocab"].items()
            if i not in self.specials.values()
        }
        self._bytes = {i: b for b, i in self._ids.items()}
        # what a longer token can begin with; "" always can
        self._prefixes = {b[:k] for b in self._ids for k in range(len(b))}
        self._next_split, self._cut = _splitter()
        self._class = np.full(0x110000, 255, np.uint8)
        self.max_states = max_states
        self._clear()

    # ------------------------------------------------------------ compiling

    def _clear(self) -> None:
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._seen: dict[tuple, tuple] = {}
        self._pairs: dict[int, bool] = {}
        self._table(1 << 16)
        self._count = 0
        self.last = np.zeros(1024, np.int32)
        self.width = np.zeros(1024, np.int32)
        self._number((b"", ((-1, 0),)))

    def _table(self, size: int) -> None:
        """Empty transition table: keys (state * 256 + byte), next states, count changes."""
        self._bits = np.uint32(33 - size.bit_length())
        self._keys = np.full(size, -1, np.int32)
        self._to = np.zeros(size, np.int32)
        self._change = np.zeros(size, np.int8)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Places of int32 ``key`` in the table, or of the free slot where each belongs."""
        at = (key.view(np.uint32) * np.uint32(2654435761)) >> self._bits
        got = self._keys[at]
        open_ = np.flatnonzero((got != key) & (got >= 0))
        while len(open_):
            at[open_] = (at[open_] + np.uint32(1)) & np.uint32(len(self._keys) - 1)
            got = self._keys[at[open_]]
            open_ = open_[(got != key[open_]) & (got >= 0)]
        return at

    def _store(self, key: int, to: int, change: int) -> None:
        if self._count * 2 >= len(self._keys):
            kept = np.flatnonzero(self._keys >= 0)
            old = self._keys[kept], self._to[kept], self._change[kept]
            self._table(len(self._keys) * 2)
            self._count = 0
            for k, t, c in zip(*(x.tolist() for x in old)):
                self._store(k, t, c)
        mask = len(self._keys) - 1
        at = ((key * 2654435761) & 0xFFFFFFFF) >> int(self._bits)
        while self._keys[at] >= 0:
            at = (at + 1) & mask
        self._keys[at], self._to[at], self._change[at] = key, to, change
        self._count += 1

    def _number(self, state: tuple) -> int:
        n = self._numbers.get(state)
        if n is None:
            n = self._numbers[state] = len(self._states)
            self._states.append(state)
            if n == len(self.last):
                self.last = np.concatenate([self.last, np.zeros_like(self.last)])
                self.width = np.concatenate([self.width, np.zeros_like(self.width)])
            last = state[1][-1][0]
            self.last[n], self.width[n] = last, len(self._bytes.get(last, b""))
        return n

    def _stand_apart(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are when they meet (left -1: alone)."""
        key = (left + 1) << 32 | right
        known = self._pairs.get(key)
        if known is None:
            text = self._bytes.get(left, b"") + self._bytes[right]
            got = [t.id for t in self._bpe.tokenize("".join(self._letters[b] for b in text))]
            known = self._pairs[key] = got == ([right] if left < 0 else [left, right])
        return known

    def _compile(self, number: int, byte: int) -> None:
        suffix, tail = self._states[number]
        grown = suffix + bytes((byte,))
        for size in range(len(grown), 0, -1):
            token = self._ids.get(grown[len(grown) - size:])
            if token is not None:
                before, count = tail[len(tail) - size]
                if self._stand_apart(before, token):
                    break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        change = count + 1
        kept = grown
        while kept not in self._prefixes:
            kept = kept[1:]
        # a place from which no token can reach beyond this byte plays no further part
        share = self._seen.setdefault
        moved = tuple(
            share(entry := (seen[0], seen[1] - change), entry) if seen and kept[k:] in self._prefixes else None
            for k, seen in enumerate(tail[len(tail) - len(kept):] if kept else ())
        )
        now = (token, 0)
        to = self._number((kept, moved + (share(now, now),)))
        self._store(number << 8 | byte, to, change)

    # ------------------------------------------------------------ first transducer

    def _classes(self, points: np.ndarray) -> np.ndarray:
        """Character classes; unknown characters are put to the library's own splitter."""
        out = self._class[points]
        if (out == 255).any():
            for point in np.unique(points[out == 255]).tolist():
                c = chr(point)
                if c == " ":
                    kind = SPACE
                elif c == "'":
                    kind = QUOTE
                elif c in "stmd":
                    kind = TAIL1
                elif len(self._split.pre_tokenize_str("a" + c)) == 1:
                    kind = LETTER
                elif len(self._split.pre_tokenize_str("1" + c)) == 1:
                    kind = DIGIT
                elif len(self._split.pre_tokenize_str("!" + c)) == 1:
                    kind = OTHER
                else:
                    kind = BLANK
                self._class[point] = kind
            out = self._class[points]
        return out

    def _maps(self, table: np.ndarray) -> np.ndarray:
        """Exit by entry state of every chunk, a column of ``table``; all chunks at once."""
        maps = np.tile(np.arange(STATES, dtype=np.uint8)[:, None] * np.uint8(SYMBOLS), (1, table.shape[1]))
        for row in table:
            maps = self._next_split[maps + row]
        return maps

    def piece_starts(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mask of the bytes of ``data`` (UTF-8) at which a piece begins; ``first`` marks the
        bytes that begin a segment, across which nothing is joined."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        head = data[lead].astype(np.int32)
        points = head
        wide = np.flatnonzero(head >= 0xC0)
        if len(wide):
            at, h = lead[wide], head[wide]
            padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
            b1, b2, b3 = (padded[at + k] & 0x3F for k in (1, 2, 3))
            points = head.copy()
            points[wide] = np.where(
                h < 0xE0, (h & 0x1F) << 6 | b1,
                np.where(h < 0xF0, (h & 0x0F) << 12 | b1 << 6 | b2,
                         (h & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        kind = self._classes(points)
        begins = first[lead]
        after = np.append(points[1:], 0)
        after[np.append(begins[1:], True)] = -1
        pair = ((points == ord("r")) | (points == ord("v"))) & (after == ord("e"))
        pair |= (points == ord("l")) & (after == ord("l"))
        symbol = np.where(pair, np.uint8(TAIL2), kind)
        symbol[begins] |= 8
        n = len(symbol)
        lanes = -(-n // STEPS)
        table = np.zeros(lanes * STEPS, np.uint8)
        table[:n] = symbol
        table = np.ascontiguousarray(table.reshape(lanes, STEPS).T)

        # a chunk whose last characters lead to one state from all others is a constant map
        maps = self._maps(table[-SETTLE:])
        open_ = np.flatnonzero((maps != maps[0]).any(axis=0))
        maps[:, open_] = self._maps(table[:, open_])
        shift = 1
        while shift < lanes:    # inclusive scan: map of all chunks up to and with this one
            open_ = open_[(maps[:, open_] != maps[0, open_]).any(axis=0) & (open_ >= shift)]
            if not len(open_):
                break
            maps[:, open_] = np.take_along_axis(maps[:, open_], maps[:, open_ - shift] // np.intp(SYMBOLS), axis=0)
            shift *= 2
        state = np.append(np.uint8(_START * SYMBOLS), maps[_START, :-1])
        for row in table:       # becomes the state before and the symbol
            row += state
            state = self._next_split[row]
        cut = self._cut[table.T.reshape(-1)[:n]]
        blank = (kind == SPACE) | (kind == BLANK)
        solid_next = np.append(~blank[1:] & ~begins[1:], False)
        cut = cut | (blank & solid_next)
        out = np.zeros(len(data), bool)
        out[lead[cut]] = True
        return out

    # ------------------------------------------------------------ second transducer

    def walk(self, data: np.ndarray, starts: np.ndarray, states: bool = False):
        """Change of the token count at each byte and, if asked for, the state after it.
        With states, a lane is one piece: few and different ones are walked then."""
        delta = np.zeros(len(data), np.int8)
        after = np.zeros(len(data), np.int32) if states else None
        begin = np.flatnonzero(starts)
        if not len(begin):
            return delta, after
        size = np.diff(np.append(begin, len(data)))
        for k in np.flatnonzero(size > LONG_PIECE).tolist():
            self._walk_one(data, begin[k], begin[k] + size[k], delta, after)
        if states:
            wanted = np.arange(len(begin))
        else:
            wanted = np.unique(np.searchsorted(begin, np.arange(0, len(data), LANE)))
            wanted = np.union1d(wanted[wanted < len(begin)], np.flatnonzero(size > LONG_PIECE))
            wanted = np.union1d(wanted, np.flatnonzero(size > LONG_PIECE) + 1)
            wanted = wanted[wanted < len(begin)]
        lane = begin[wanted]
        length = np.diff(np.append(lane, len(data)))
        short = size[wanted] <= LONG_PIECE
        lane, length = lane[short], length[short]
        order = np.argsort(-length, kind="stable")
        lane, length = lane[order], length[order]
        running = np.searchsorted(-length, -np.arange(1, length.max(initial=0) + 1), side="right")
        state = np.zeros(len(lane), np.int32)
        for j, active in enumerate(running.tolist()):
            at = lane[:active] + j
            state = np.where(starts[at], np.int32(0), state[:active])
            key = state << np.int32(8) | data[at]
            place = self._find(key)
            new = self._keys[place] < 0
            if new.any():
                if len(self._states) > self.max_states:
                    raise TableFull
                for k in np.unique(key[new]).tolist():
                    self._compile(k >> 8, k & 255)
                place = self._find(key)
            delta[at] = self._change[place]
            state = self._to[place]
            if states:
                after[at] = state
        return delta, after

    def _walk_one(self, data, begin, end, delta, after) -> None:
        state = 0
        for at, byte in enumerate(data[begin:end].tolist(), begin):
            key = np.array([state << 8 | byte], np.int32)
            place = self._find(key)[0]
            if self._keys[place] < 0:
                if len(self._states) > self.max_states:
                    raise TableFull
                self._compile(state, byte)
                place = self._find(key)[0]
            delta[at], state = self._change[place], int(self._to[place])
            if after is not None:
                after[at] = state

    def _run(self, data: np.ndarray, starts: np.ndarray, states: bool):
        """:meth:`walk`, with emptied tables if they have become too large."""
        try:
            return self.walk(data, starts, states)
        except TableFull:
            self._clear()
            limit, self.max_states = self.max_states, len(data)
            try:
                return self.walk(data, starts, states)
            finally:
                self.max_states = limit

    # ------------------------------------------------------------ texts

    def _blocks(self, data: np.ndarray, offsets: np.ndarray):
        """Ranges of at most about BLOCK bytes, cut between texts or, inside a long one,
        before a space that follows another character than white space. No token and no
        look-ahead of the splitter reaches across such a place."""
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            to = min(at + BLOCK, end)
            if to < end:
                k = int(np.searchsorted(offsets, to, side="right")) - 1
                if offsets[k] > at:
                    to = int(offsets[k])
                else:
                    limit = int(offsets[k + 1])
                    while to < limit:
                        part = data[to - 1:min(to + BLOCK, limit)]
                        hit = np.flatnonzero((part[1:] == 32) & (part[:-1] > 32) & (part[:-1] < 127))
                        if len(hit):
                            to += int(hit[0])
                            break
                        to = min(to + BLOCK, limit)
            yield at, to
            at = to

    def _prepared(self, data: np.ndarray, offsets: np.ndarray):
        """Blocks as (first byte, bytes, segment marks, {place: special id}). Bytes of special
        tokens are in no segment: they are taken out, and ``places`` maps bytes back."""
        for at, to in self._blocks(data, offsets):
            block = data[at:to]
            first = np.zeros(len(block), bool)
            first[0] = True
            inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)] - at
            first[inner] = True
            specials: dict[int, int] = {}
            raw = block.tobytes()
            keep = None
            for text, number in self.specials.items():
                hit = raw.find(text)
                while hit >= 0:
                    if not first[hit + 1:hit + len(text)].any():
                        keep = np.ones(len(block), bool) if keep is None else keep
                        keep[hit:hit + len(text)] = False
                        specials[hit] = number
                        if hit + len(text) < len(block):
                            first[hit + len(text)] = True
                    hit = raw.find(text, hit + len(text))
            yield at, block, first, keep, specials

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; text i is ``data[offsets[i]:offsets[i + 1]]``."""
        total = np.zeros(len(offsets) - 1, np.int64)
        for at, block, first, keep, specials in self._prepared(data, offsets):
            used, marks = (block, first) if keep is None else (block[keep], first[keep])
            change = np.zeros(len(block), np.int64)
            if len(used):
                got, _ = self._run(used, self.piece_starts(used, marks), False)
                if keep is None:
                    change[:] = got
                else:
                    change[keep] = got
            for hit in specials:
                change[hit] = 1
            upto = np.concatenate([[0], np.cumsum(change)])
            cut = np.clip(offsets - at, 0, len(block))
            total += upto[cut[1:]] - upto[cut[:-1]]
        return total

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Token ids of all texts in one array, and the first index of each text (plus the end).

        Equal pieces have equal ids, so the different ones among some GROUP bytes are walked."""
        ids, owners = [], np.zeros(len(offsets), np.int64)
        parts, places, marked, held = [], [], {}, 0
        for at, block, first, keep, specials in self._prepared(data, offsets):
            used, marks = (block, first) if keep is None else (block[keep], first[keep])
            if len(used):
                begin = np.flatnonzero(self.piece_starts(used, marks))
                parts.append((used, np.diff(np.append(begin, len(used)))))
                places.append(at + (begin if keep is None else np.flatnonzero(keep)[begin]))
            marked |= {at + hit: number for hit, number in specials.items()}
            held += len(block)
            to = at + len(block)
            if held < GROUP and to < offsets[-1]:
                continue
            token, first_id, which = self._piece_ids(parts)
            place = np.concatenate([*places, np.zeros(0, np.int64)])
            if marked:      # a special token is a piece of one token
                which = np.append(which, len(first_id) - 1 + np.arange(len(marked)))
                first_id = np.append(first_id, len(token) + 1 + np.arange(len(marked)))
                token = np.append(token, np.array([*marked.values()], np.int32))
                place = np.append(place, np.array([*marked], np.int64))
                order = np.argsort(place)
                which, place = which[order], place[order]
            size = np.diff(first_id)[which]
            upto = np.concatenate([[0], np.cumsum(size)])
            ids.append(token[np.repeat(first_id[which] - upto[:-1], size) + np.arange(upto[-1])])
            owners += upto[np.searchsorted(place, offsets)]
            parts, places, marked, held = [], [], {}, 0
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), owners

    def _piece_ids(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        """Ids of the different pieces, the first index of each (plus the end), and which of
        them each piece of ``parts`` (bytes, sizes of pieces) is."""
        if not parts:
            return np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)
        ends = np.cumsum(np.concatenate([[0], *(sizes for _, sizes in parts)]))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [
            None, pa.py_buffer(ends), pa.py_buffer(np.concatenate([used for used, _ in parts]))
        ]).dictionary_encode()
        _, bounds, text = pieces.dictionary.buffers()
        bounds = np.frombuffer(bounds, np.int64)[:len(pieces.dictionary) + 1]
        text = np.frombuffer(text, np.uint8)[:bounds[-1]]
        starts = np.zeros(len(text), bool)
        starts[bounds[:-1]] = True
        _, after = self._run(text, starts, True)
        found = np.full(len(text), -1, np.int32)
        begin, end = bounds[:-1], bounds[1:] - 1
        while len(end):     # from the end of every piece, token by token
            state = after[end]
            found[end] = self.last[state]
            end = end - self.width[state]
            more = end >= begin
            begin, end = begin[more], end[more]
        there = found >= 0
        first_id = np.concatenate([[0], np.cumsum(there)])[bounds]
        return found[there], first_id, pieces.indices.to_numpy(zero_copy_only=False)


class TableFull(Exception):
    """The second transducer's tables have reached their bound."""


_LOADED: OrderedDict[str, Transducers] = OrderedDict()


def transducers(path: str) -> Transducers:
    """This worker's transducers of a vocabulary file; compiled transitions are kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = Transducers(path)
        while len(_LOADED) > 2:
            _LOADED.popitem(last=False)
    return _LOADED[path]
