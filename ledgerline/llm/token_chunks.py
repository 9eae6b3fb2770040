"""Ids of whole texts from a tokenizer that never sees the same piece of text twice.

The given tokenizers never let a token span a single space or line feed between
two characters that aren't white space, so a text's ids are those of its chunks
between them.  A worker remembers the ids of the chunks it has met and looks all
chunks of a batch up at once, by their bytes.  New ones are encoded together,
several hundred to a call, and cut apart again at a mark that the tokenizer leaves.
Texts with other white space at a chunk's edge are encoded whole.
"""

from __future__ import annotations

import ctypes
import os
import re
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.common import bounded

#: Chunks that a table holds at most: 60 MB with their ids, if they have three each.
TABLE_CHUNKS = 900_000
#: Bytes of texts whose chunks are looked up at once, if they aren't one text: arrays made of them take many times as much.
AT_ONCE = 512 << 10
#: Texts that one call of the tokenizer encodes, and the longest chunk that shares a call.
JOINED, LONGEST = 500, 200
#: Letters whose lower case and composed form are single letters: those of ASCII and U+00C0 to U+00FF; and a word of
#: them with one of the commonest signs behind it.  None of these begins a contraction or is white space.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", ",.;:!?"
_WORD = re.compile(f"([{_LETTERS}]+)([{_SIGNS}]?)").fullmatch


def pack(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _cut_apart(texts: list[str], join: Callable, encode: Callable, cut: Callable, alone: Callable) -> list[bytes]:
    """The ids of each text, from calls that encode many: ``join`` makes one text of a group, ``cut`` says where
    each one's ids begin and end; where that doesn't fit, a text holds the mark itself and each is encoded alone."""
    if any(len(t) > LONGEST for t in texts):  # these share no call
        made = iter(_cut_apart([t for t in texts if len(t) <= LONGEST], join, encode, cut, alone))
        return [next(made) if len(t) <= LONGEST else alone(t) for t in texts]
    out: list[bytes] = []
    groups = [texts[i:i + JOINED] for i in range(0, len(texts), JOINED)]
    for group, found in zip(groups, encode([join(g) for g in groups])):
        ids = np.asarray(found, "<u4")
        starts, ends = cut(ids)
        if len(starts) != len(group):
            out += map(alone, group)
            continue
        data = ids.tobytes()
        out += [data[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
    return out


_U8 = np.uint64
#: The bytes of the first and of the second word of a key that a chunk of each length fills.
_MASKS = [np.array([(1 << 8 * min(max(n - skip, 0), 8)) - 1 for n in range(16)], _U8) for skip in (0, 8)]


class ChunkTable:
    """Chunks of up to 15 bytes, each a number, found by their bytes and length: a table that is probed for many at once."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.n, self.used = 0, 0
        self.slots = np.zeros(1 << 12, np.int32)  # a chunk's number and one (0: free)
        self.keys = np.zeros((1 << 10, 2), _U8)  # by number: a chunk's bytes and length
        self.first, self.size = (np.zeros(1 << 10, np.int32) for _ in range(2))  # size -1: can't stand alone
        self.ids = np.zeros(1 << 12, "<u4")

    def _places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * _U8(0x9E3779B97F4A7C15)
        h ^= high * _U8(0xC2B2AE3D27D4EB4F)
        h ^= h >> _U8(32)
        h *= _U8(0x165667B19E3779F9)
        h >>= _U8(64 - (len(self.slots).bit_length() - 1))
        return h.view(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The chunks' numbers; -1 for those that aren't there."""
        place = self._places(low, high)
        out = self.slots[place]
        out -= 1
        # free places are the answer; another chunk's: try the next one
        todo = np.flatnonzero(self._others(out, low, high))
        place = place[todo]
        while len(todo):
            place += 1
            place &= len(self.slots) - 1
            found = self.slots[place]
            found -= 1
            out[todo] = found
            on = np.flatnonzero(self._others(found, low[todo], high[todo]))
            todo, place = todo[on], place[on]
        return out

    def _others(self, found: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of the chunks found are other ones than those looked for."""
        keys = self.keys[found]  # that of any chunk for none
        return ((keys[:, 0] != low) | (keys[:, 1] != high)) & (found >= 0)

    def _insert(self, numbers: np.ndarray) -> None:
        place = self._places(self.keys[numbers, 0], self.keys[numbers, 1])
        while len(place):
            spots, at = np.unique(place, return_index=True)  # one chunk for each place
            free = self.slots[spots] == 0
            spots, at = spots[free], at[free]
            self.slots[spots] = numbers[at] + 1
            left = np.ones(len(place), bool)
            left[at] = False
            numbers = numbers[left]
            place = (place[left] + 1) & (len(self.slots) - 1)

    def number(self, found: list[bytes | None]) -> np.ndarray:
        """New numbers for chunks of these ids."""
        sizes = np.array([-1 if x is None else len(x) // 4 for x in found], np.int32)
        data = np.frombuffer(b"".join(x or b"" for x in found), "<u4")
        numbers = np.arange(self.n, self.n + len(found), dtype=np.int32)
        self.first, self.size, self.keys = (_room(x, self.n + len(found)) for x in (self.first, self.size, self.keys))
        self.ids = _room(self.ids, self.used + len(data))
        kept = np.maximum(sizes, 0)
        self.first[self.n:self.n + len(found)] = self.used + np.cumsum(kept) - kept
        self.size[self.n:self.n + len(found)] = sizes
        self.ids[self.used:self.used + len(data)] = data
        self.n, self.used = self.n + len(found), self.used + len(data)
        return numbers

    def add(self, low: np.ndarray, high: np.ndarray, found: list[bytes | None]) -> np.ndarray:
        """Put in distinct chunks that aren't there; their numbers."""
        numbers = self.number(found)
        self.keys[numbers, 0], self.keys[numbers, 1] = low, high
        if 2 * self.n > len(self.slots):
            held = self.slots[self.slots != 0] - 1
            self.slots = np.zeros(1 << (4 * self.n - 1).bit_length(), np.int32)
            self._insert(held)
        self._insert(numbers)
        return numbers


def _room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    out = np.zeros((max(n, 3 * len(x) // 2), *x.shape[1:]), x.dtype)
    out[:len(x)] = x
    return out


class Encoder:
    """What the tokenizers have in common.

    ``lead``: a text is encoded as if a space came before it.  ``exact``: ``bytes`` has
    each token's bytes, and a text that its tokens don't spell has no ids (None).
    ``folds``: A-Z are encoded as a-z.
    """

    lead, exact, folds = True, False, False
    bytes: list[bytes]

    def __init__(self):
        self.table = ChunkTable(TABLE_CHUNKS)
        self.long: dict[bytes, int] = {}  # numbers of longer chunks

    # to be given: the ids of a whole text, and of chunks (those after a line feed begin with it)
    def whole(self, text: str) -> bytes:
        raise NotImplementedError

    def found(self, chunks: list[str]) -> list[bytes | None]:
        """The ids of distinct new chunks; None for those that can't stand alone."""
        raise NotImplementedError

    def text(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, memoryview(ids).cast("I")))

    def _numbers(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The chunks' numbers in the table, new ones learnt; ``data`` has eight bytes and more behind the last one."""
        table = self.table
        if table.n > table.most or table.used > 8 * table.most:
            table.clear()
            self.long.clear()
        at_byte = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        low, high, short = at_byte[starts], at_byte[starts + 8], np.minimum(sizes, 15)
        low &= _MASKS[0][short]
        high &= _MASKS[1][short]
        high |= short.astype(_U8) << _U8(56)
        out = table.find(low, high)
        whole = memoryview(data)
        chunk = lambda i: bytes(whole[starts[i]:starts[i] + sizes[i]])
        # longer ones are looked up one by one
        long = np.flatnonzero(sizes > 15).tolist()
        names = list(map(chunk, long))
        new_long = list({x for x in names if x not in self.long})
        # of each new chunk, one occurrence
        missing = np.flatnonzero((out < 0) & (sizes <= 15))
        order = missing[np.lexsort((high[missing], low[missing]))]
        fresh = np.append(True, (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])) if len(order) else []
        new = order[np.flatnonzero(fresh)]
        if len(new) or new_long:
            found = self.found([x.decode() for x in [*map(chunk, new.tolist()), *new_long]])
            if len(new):
                numbers = table.add(low[new], high[new], found[:len(new)])
                out[order] = numbers[np.cumsum(fresh) - 1]
            if new_long:
                self.long.update(zip(new_long, table.number(found[len(new):]).tolist()))
        if long:
            out[long] = [self.long[x] for x in names]
            for x in new_long:
                if len(x) > 4 * LONGEST:  # hardly met again
                    del self.long[x]
        return out

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(ids of all texts in a row, how many each has, the texts that aren't spelt and so have none); null is empty."""
        given = pc.fill_null(texts.cast(pa.string()), "")
        rows = pc.ascii_lower(given) if self.folds else given
        rows = pc.replace_substring(rows, "\n", " \n")
        if not self.lead:  # the first chunk follows a line feed, too, whose id is dropped
            rows = pc.binary_join_element_wise("\n", rows, "")
        bounds = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset:rows.offset + len(rows) + 1].astype(np.int64)
        data = np.zeros(bounds[-1] - bounds[0] + 24, np.uint8)
        if bounds[-1] > bounds[0]:
            data[:-24] = np.frombuffer(rows.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
        bounds -= bounds[0]
        spaces = np.flatnonzero(data[:-24] == 32)
        starts, ends = np.sort(np.concatenate([bounds[:-1], spaces + 1])), np.sort(np.concatenate([spaces, bounds[1:]]))
        # a row's first chunk: a chunk for each row and each space before
        first = np.arange(len(bounds)) + np.searchsorted(spaces, bounds)
        numbers = self._numbers(data, starts, ends - starts)
        table = self.table
        n = table.size[numbers]
        odd = n < 0
        np.maximum(n, 0, out=n)
        after = np.zeros(len(n) + 1, np.int32)  # a batch's ids fit 32 bits
        np.cumsum(n, out=after[1:])
        at = np.arange(after[-1], dtype=np.int32)
        at += np.repeat(table.first[numbers] - after[:-1], n)
        ids, ends = table.ids[at], after[first].astype(np.int64)
        del at
        counts = np.diff(ends)
        strange: list[int] = []
        empty = pc.equal(pc.binary_length(given), 0).to_numpy(zero_copy_only=False)
        if odd.any() or not self.lead or empty.any():
            # texts that have to be encoded whole, ids to drop, and the empty text, which is no chunk but a text
            again = set(np.flatnonzero(np.add.reduceat(odd, first[:-1])).tolist()) if odd.any() else set()
            parts = []
            for i in range(len(given)):
                part = ids[ends[i]:ends[i + 1]]
                if empty[i]:
                    part = part[:0]
                elif i in again:
                    text = given[i].as_py()
                    made = self.whole(text)
                    if self.exact and self.text(made) != (" " * self.lead + text).encode():
                        strange.append(i)
                        made = b""
                    part = np.frombuffer(made, "<u4")
                elif not self.lead:
                    part = part[1:]
                parts.append(part)
            ids, counts = np.concatenate([np.zeros(0, "<u4"), *parts]), np.array([len(p) for p in parts], np.int64)
        return ids, counts, strange

    def encode(self, texts: list[str] | pa.Array) -> list[bytes | None]:
        """The ids of each text; None where an exact encoder's tokens don't spell it, space in front included."""
        given = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        out: list[bytes | None] = []
        for batch in bounded([pa.RecordBatch.from_arrays([given], names=["text"])], 0, AT_ONCE):
            ids, counts, strange = self.flat(batch.column(0))
            data, ends, at = ids.tobytes(), (4 * np.cumsum(counts)).tolist(), len(out)
            out += [data[a:b] for a, b in zip([0, *ends], ends)]
            for i in strange:
                out[at + i] = None
        return out

    @staticmethod
    def _sort_out(chunks: list[str]) -> tuple[list[int], list[int]]:
        """Which chunks can stand alone: those after a space, and those after a line feed."""
        rest, first = [], []
        for i, c in enumerate(chunks):
            after_feed = c[:1] == "\n"
            if len(c) > after_feed and not c[after_feed].isspace() and not c[-1].isspace():
                (first if after_feed else rest).append(i)
        return rest, first


class _Tokenizers(Encoder):
    """A file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        # Spark has given the cores to tasks; a worker's threads would each keep memory of their own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(str(path))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.names[i] = token

    def _flags(self, of: Callable[[str], bool]) -> np.ndarray:
        return np.array([of(t) for t in self.names])

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the bytes in a byte-level vocabulary: printable ones for themselves, then 256 and up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


_BYTE = _byte_letters()
_LETTER = [c for c, _ in sorted(_BYTE.items(), key=lambda x: x[1])]


class ByteLevel(_Tokenizers):
    """Byte-level BPE that splits at single spaces and keeps them (GPT-2's pattern)."""

    def __init__(self, path: str, lead: bool = False, exact: bool = False):
        super().__init__(path)
        self.lead, self.exact = lead, exact
        spaced = self._flags(lambda t: t.startswith("Ġ"))
        (feed,) = self._ids("\n")
        self.feed = pack([feed])
        self.bytes = [bytes(map(_BYTE.__getitem__, t)) if all(c in _BYTE for c in t) else t.encode() for t in self.names] if exact else []

        def at_space(ids):
            starts = np.flatnonzero(spaced[ids])
            return starts, np.append(starts[1:], len(ids))

        def at_feed(ids):
            feeds = np.flatnonzero(ids == feed)
            return np.append(0, feeds + 1), np.append(feeds, len(ids))

        self.at_space, self.at_feed = at_space, at_feed

    def whole(self, text: str) -> bytes:
        return pack(self._ids(" " * self.lead + text))

    def found(self, chunks: list[str]) -> list[bytes | None]:
        out: list[bytes | None] = [None] * len(chunks)
        rest, first = self._sort_out(chunks)
        for which, join, cut, front, skip in ((rest, lambda g: " " + " ".join(g), self.at_space, " ", 0),
                                              (first, "\n".join, self.at_feed, "", 1)):
            alone = lambda c: pack(self._ids(front + c))  # noqa: E731,B023
            bodies = [chunks[i][skip:] for i in which]
            for i, c, ids in zip(which, bodies, _cut_apart(bodies, join, self._batch, cut, alone)):
                if not self.exact or self.text(ids) == (front + c).encode():
                    out[i] = self.feed + ids if skip else ids
        return out


class WordEnds(_Tokenizers):
    """BPE of lower-cased words with word ends, white space dropped."""

    folds, MARK = True, "\x01"
    _TO_LETTERS = str.maketrans({chr(c): "".join(_LETTER[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)})

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(path)
        # lower-cased words of plain letters stay as they are until the model, but for the letters of their bytes
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        (mark,) = self._ids(self.MARK)
        self.signs = {sign: pack(self._ids(sign)) for sign in _SIGNS}
        last = self._flags(lambda t: t.endswith("</w>"))

        def at_mark(ids):
            marks = np.flatnonzero(ids == mark)
            return np.append(0, marks + 1), np.append(marks, len(ids))

        def at_end(ids):
            ends = np.flatnonzero(last[ids]) + 1
            return np.append(0, ends[:-1]), ends

        self.at_mark, self.at_end = at_mark, at_end

    def _model_batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _model_alone(self, word: str) -> bytes:
        return pack(self._model_batch([word])[0])

    def whole(self, text: str) -> bytes:
        return pack(self._ids(text))

    def found(self, chunks: list[str]) -> list[bytes | None]:
        # white space leaves no token, so every chunk can stand alone, a line feed in front or not
        out: list[bytes | None] = [b""] * len(chunks)
        words: list[str] = []
        places: list[int] = []
        signs: list[str] = []
        other: list[int] = []
        for i, c in enumerate(chunks):
            if c.isalpha() and c.isascii() and len(c) <= LONGEST:
                words.append(c.lower())
                signs.append("")
            elif (m := _WORD(c.strip("\n"))) and len(c) <= LONGEST:
                words.append(m[1].lower().translate(self._TO_LETTERS))
                signs.append(m[2])
            else:
                other.append(i)
                continue
            places.append(i)
        made = _cut_apart(words, " ".join, self._model_batch, self.at_end, self._model_alone)
        for i, sign, ids in zip(places, signs, made):
            out[i] = ids + self.signs[sign] if sign else ids
        rest = [chunks[i] for i in other]
        for i, ids in zip(other, _cut_apart(rest, f" {self.MARK} ".join, self._batch, self.at_mark, self.whole)):
            out[i] = ids
        return out


class Pieces(Encoder):
    """A sentencepiece BPE model with byte fallback whose pieces have a space in front only, and no line feed."""

    lead, exact = True, True  # the model puts a space before the text

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=str(path))
        names = [m.id_to_piece(i) for i in range(m.vocab_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if m.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        if any(b" " in b.lstrip(b" ") or (b"\n" in b and len(b) > 1) for b in self.bytes):
            raise ValueError("the model has pieces that span a space or a line feed")
        spaced = np.array([b.startswith(b" ") for b in self.bytes])
        feed = self.bytes.index(b"\n")

        def at_space(ids):
            starts = np.flatnonzero(spaced[ids])
            return starts, np.append(starts[1:], len(ids))

        def at_feed(ids):  # behind the space and the line feed in front
            feeds = np.flatnonzero(ids == feed)
            return feeds + 1, np.append(feeds[1:], len(ids))

        self.feed, self.at_space, self.at_feed = pack([feed]), at_space, at_feed

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []

    def whole(self, text: str) -> bytes:
        return pack(self.model.encode(text))

    def found(self, chunks: list[str]) -> list[bytes | None]:
        out: list[bytes | None] = [None] * len(chunks)
        rest, first = self._sort_out(chunks)
        # the model changes some texts (U+2581 becomes a space): such chunks are left to the whole text
        names = [chunks[i] for i in rest]
        for i, c, ids in zip(rest, names, _cut_apart(names, " ".join, self._batch, self.at_space, self.whole)):
            out[i] = ids if self.text(ids) == b" " + c.encode() else None
        names = [chunks[i][1:] for i in first]
        alone = lambda c: pack(self.model.encode("\n" + c))[8:]
        for i, c, ids in zip(first, names, _cut_apart(names, lambda g: "\n" + "\n".join(g), self._batch, self.at_feed, alone)):
            out[i] = self.feed + ids if self.text(ids) == c.encode() else None
        return out


def give_back() -> None:
    """Hand freed memory back to the system at a task's end: workers live on and wait."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def kept(kind: type, path: str | None, vocabulary: str, **options):
    """The Python worker's encoder of that file, kept between its tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
    module = sys.modules.setdefault("_ledgerline_chunks", types.ModuleType("_ledgerline_chunks"))
    key = (kind.__name__, str(path), *sorted(options.items()))
    if key not in module.__dict__.setdefault("made", {}):
        module.made[key] = kind(path, **options)
    return module.made[key]
