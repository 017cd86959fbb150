"""Exact token ids of whole texts, with a bounded cache of the ids of text units.

Texts are cut where the tokenizer's own splitting always cuts, every unit is encoded by the tokenizers
library once, and the ids of a text are its units' ids in order. The cuts are:

* ``words`` (tokenizers that drop white space): before blanks, tabs and line ends. Unicode composition and the
  split pattern never reach across them.
* ``blanks`` (byte-level pattern with a leading blank): runs without white space with one blank before them,
  white space up to the last character before such a run, and other single white-space characters.
* both: before the marks that end a unit, after a Latin letter.

Cuts are found in the UTF-8 bytes of many texts at once; Arrow numbers their different units, and only those
are looked up or learnt one by one.
"""

from __future__ import annotations

import os
import re
import struct
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import release

# Unicode white space as the tokenizers' patterns know it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WIDE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if re.fullmatch(f"[{SPACE}]", c)]
# Punctuation that both patterns separate from a letter before it (no apostrophe: contractions).
MARKS = '.,;:!?*$%#&"()[]{}<>/=+-_|~^@'
# Latin letters in UTF-8: of ASCII, and U+00C0 to U+00FF without the signs at D7 and F7 (lead byte C3).
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Units in each of the cache's two generations, the longest unit kept (bytes), bytes of text cut at a time, and units
#: that the model reads at a time.
CACHED, KEPT, PORTION, LEARNT = 200_000, 64, 2_000_000, 4_000

#: Packers of up to 64 ids, by their number.
PACK = [struct.Struct(f"<{n}I").pack for n in range(65)]


def flags(values) -> np.ndarray:
    """Whether a byte is one of ``values``."""
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


BLANK, MARK, WIDE_LEAD = flags(b"\t\n\v\f\r "), flags(MARKS.encode()), flags({c[0] for c in WIDE})
LETTER, AFTER_C3 = flags(x for x in range(128) if chr(x).isalpha()), flags(set(range(0x80, 0xC0)) - {0x97, 0xB7})


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids; much cheaper than an array object for the few ids of a word."""
    return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}I", *ids)


def portions(batch: pa.RecordBatch, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``text`` holds up to ``limit`` bytes, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo, done = 0, 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, done + (limit or PORTION), side="right")))
        yield batch.slice(lo, hi - lo)
        lo, done = hi, int(ends[hi - 1])


def white(data: np.ndarray) -> np.ndarray:
    """Bytes of white-space characters, of any width."""
    out, lead = BLANK[data], np.flatnonzero(WIDE_LEAD[data])
    for size in (2, 3):
        codes = [int.from_bytes(c) for c in WIDE if len(c) == size]
        at = lead[lead + size <= len(data)]
        found = at[np.isin(sum(data[at + k].astype(np.int64) << 8 * (size - 1 - k) for k in range(size)), codes)]
        for k in range(size):
            out[found + k] = True
    return out


def cuts(data: np.ndarray, starts: np.ndarray, words: bool) -> np.ndarray:
    """Where units start in the bytes of texts that start at ``starts`` (and end there)."""
    first = np.zeros(len(data), bool)
    first[starts[:-1][np.diff(starts) > 0]] = True
    space = BLANK[data] if words else white(data)
    after = np.concatenate([[False], space[:-1]])
    cut = first | space & ~after
    if not words:
        begin = np.flatnonzero(after & ~space & ~first)
        last = begin - 1  # the white-space character before a word
        wide = np.flatnonzero(data[last] >= 0x80)
        last[wide] -= np.where(data[last[wide] - 1] == 0xC2, 1, 2)
        cut[last] = True
        cut[begin[data[last] != 0x20]] = True
    at, mark = np.flatnonzero(cut), MARK[data]
    ends = np.append(at[1:], len(data))
    tail = np.flatnonzero(mark[ends - 1])
    other = np.flatnonzero(~mark)
    place = np.searchsorted(other, ends[tail]) - 1  # the last byte of the unit that is no mark
    tail, place = tail[place >= 0], place[place >= 0]
    apart = other[place] + 1
    apart = apart[apart > at[tail]]
    before = data[apart - 1]
    cut[apart[LETTER[before] | AFTER_C3[before] & (data[np.maximum(apart - 2, 0)] == 0xC3)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of whole texts as ``tokenizer.encode(text, add_special_tokens=False)`` gives them. With ``special_text`` the
    string of a special token in a text is ordinary text instead of that token."""

    def __init__(self, path: str, units: str, special_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # units are encoded as ordinary text; a text with a special token's string goes to the library whole
        self.tokenizer.encode_special_tokens = True
        self.special = [] if special_text else [a.content for a in self.tokenizer.get_added_tokens_decoder().values() if a.special]
        self.path, self.plain = path, None
        self.words = units == "words"
        # bytes of a line end, a blank and Latin letters as the byte-level step writes them
        bare = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        table = ["\ufffe"] * 256  # undefined
        for c in map(chr, range(256)):
            if c in "\n " or LATIN.fullmatch(c.encode()):
                for byte, x in zip(c.encode(), bare.pre_tokenize_str(c)[0][0], strict=True):
                    table[byte] = x
        self.letters = "".join(table)
        # the same model behind a plain split at line ends, for units that are one piece each; a line end is a piece too
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Split(table[ord("\n")], "isolated")
        self.line_end, = self.pieces.encode(table[ord("\n")]).ids
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian unsigned 32-bit) of units that the young generation lacks. With ``words`` the white space
        before a unit is dropped, and Latin units are in lower case, as the tokenizer itself lowers them."""
        out, core, simple, rest, young, old, words = {}, {}, {}, {}, self.young, self.old, self.words
        for u in units:
            ids = old.get(u)
            if ids is None:
                x = u.strip() if words else u
                bare = x[1:] if x[:1] == b" " else x
                if bare.isalpha() or LATIN.fullmatch(bare):
                    if words:
                        x = x.lower() if x.isascii() else x.decode().lower().encode()
                    into = simple
                else:
                    into = rest
                if words:  # most units have one blank before them
                    ids = young.get(b" " + x) or old.get(b" " + x)
                if ids is None:
                    core[u] = x
                    into[x] = None
                    continue
            out[u] = ids
        fresh = {}
        # Latin letters (words: lower case) are one piece that normalizers leave as it is: the model alone does
        new = list(simple)
        for lo in range(0, len(new), LEARNT):
            part = new[lo:lo + LEARNT]
            e = self.pieces.encode_batch_fast([charmap_decode(b"\n".join(part), "strict", self.letters)[0]], add_special_tokens=False)[0]
            ids = np.array([*e.ids, self.line_end], "<u4")
            a, held = 0, ids.tobytes()
            for x, b in zip(part, (np.flatnonzero(ids == self.line_end) * 4).tolist(), strict=True):
                fresh[x] = held[a:b]
                a = b + 4
        new = list(rest)
        for lo in range(0, len(new), 4096):
            part = new[lo:lo + 4096]
            for x, e in zip(part, self.tokenizer.encode_batch_fast([x.decode() for x in part], add_special_tokens=False)):
                fresh[x] = packed(e.ids)
        for u, x in core.items():
            out[u] = fresh[x]
        if len(young) + len(out) + len(fresh) * words > CACHED:
            self.old, self.young = young, {}
            release()
        self.young.update((u, x) for u, x in out.items() if len(u) <= KEPT)
        if words:
            self.young.update((b" " + x, ids) for x, ids in fresh.items() if len(x) < KEPT)
        return out

    def _encode(self, texts: pa.Array) -> list[bytes]:
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if not len(texts) or starts[0] == starts[-1]:
            return [b""] * len(texts)
        data, starts = np.frombuffer(texts.buffers()[2], np.uint8)[starts[0]:starts[-1]], starts - starts[0]
        at = cuts(data, starts, self.words)
        buffers = [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)]
        units = pa.Array.from_buffers(pa.large_binary(), len(at), buffers).dictionary_encode()
        keys = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, keys))
        missing = [u for u, x in zip(keys, ids) if x is None]
        if missing:
            learnt = self._learn(missing)
            ids = [learnt[u] if x is None else x for u, x in zip(keys, ids)]
        each = pa.array(ids, pa.large_binary()).take(units.indices)
        ends = np.frombuffer(each.buffers()[1], np.int64)[np.searchsorted(at, starts)].tolist()
        joined = memoryview(each.buffers()[2] or b"")
        return [bytes(joined[a:b]) for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of every text (null: empty); unknown units of all texts are learnt together."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()).fill_null("")
        whole = {k for x in self.special for k in np.flatnonzero(pc.match_substring(texts, x)).tolist()}
        if not whole:
            return self._encode(texts)
        if self.plain is None:  # few texts need it, and it takes memory
            from tokenizers import Tokenizer
            self.plain = Tokenizer.from_file(self.path)
        rest = iter(self._encode(texts.take(pa.array([k for k in range(len(texts)) if k not in whole], pa.int64()))))
        return [packed(self.plain.encode(texts[k].as_py(), add_special_tokens=False).ids) if k in whole else next(rest) for k in range(len(texts))]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@lru_cache(maxsize=4)
def encoder(path: str, units: str) -> Encoder:
    """One encoder a worker process; its cache lives on from task to task."""
    return Encoder(path, units)
