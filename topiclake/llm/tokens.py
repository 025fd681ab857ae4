"""Exact, memoised token ids with the ``tokenizers`` library.

Running the library over whole texts spends nearly all its time on words it has seen
before. Both vocabularies split a text into pieces that are encoded independently of
their neighbours, so a text's ids are the concatenation of its pieces' ids:

* ``word`` kind (lower-cased words, white space dropped): pieces end at white space;
* ``byte`` kind (byte-level, a space belongs to the word behind it): pieces are
  `` ?non-space-run`` and runs of white space.

Each worker process keeps two bounded memos (piece -> ids, and sub-piece -> ids for
pieces over a plain alphabet, where the library's pre-token pattern can be applied
directly). New plain sub-pieces are merged by a second public BPE core (``tiktoken``)
built from the same vocabulary file, which merges several times faster; every worker
compares its first sub-pieces with the ``tokenizers`` library and the tests compare whole
texts. Any other piece goes through ``tokenizers`` itself. Memory is bounded: a full memo
is emptied.
"""

from __future__ import annotations

import ctypes
import json
import os
import re

import numpy as np

MEMO_PIECES = 350_000
MEMO_PARTS = 350_000

# Plain alphabet: printable ASCII and Latin letters up to U+024F. There, letters, digits
# and the library's normaliser (composition, lower case) agree with Python's.
_PLAIN = re.compile("[!-~À-ɏ]+")
_PLAIN_SPACE = re.compile(" ?[!-~À-ɏ]+")
_WORD_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:\W|_)+")
_BYTE_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+")
_WORD_PIECE = re.compile("[^ \t\n\r]+")
_S = "\t-\r \x85\xa0  -     　"
_BYTE_PIECE = re.compile(f" ?[^{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


_LINES = r"[^\n]+|\n"
_CHECKED = 2000  # sub-pieces that each worker compares with the library


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself where it is
    printable, else the next unused character from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _merge_core(path: str, word: bool):
    """A merge core over the file's vocabulary, the character it takes for the end-of-word
    mark, and what its ranks exceed the ids by.

    Ids of these files follow the merge order (checked here), so they serve as ranks. The
    end-of-word mark becomes a private character, strange to the vocabulary, whose bytes
    merge before all else.
    """
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, byte = model["vocab"], _byte_of_char()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(order, order[1:])):
        raise ValueError("ids of this vocabulary don't follow its merge order")
    plain, ended = {}, {}
    for token, i in vocab.items():
        last = word and token.endswith("</w>")
        chars = token[:-4] if last else token
        if all(c in byte for c in chars) and not chars.startswith("<|"):
            (ended if last else plain)[bytes(byte[c] for c in chars)] = i
    if not word:
        return tiktoken.Encoding("pieces", pat_str=_LINES, mergeable_ranks=plain, special_tokens={}), "", 0
    end = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c.encode()[:2] not in plain)
    mark = end.encode()
    ranks = {mark[:2]: 0, mark: 1}
    ranks |= {b: i + 2 for b, i in plain.items()} | {b + mark: i + 2 for b, i in ended.items()}
    return tiktoken.Encoding("pieces", pat_str=_LINES, mergeable_ranks=ranks, special_tokens={}), end, 2


class Encoder:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (both vocabularies have
    fewer than 65,536 ids)."""

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True  # their strings in a text are ordinary text
        if self._tok.get_vocab_size() > 1 << 16:
            raise ValueError("this encoder holds ids in 16 bits")
        word = kind == "word"
        self._piece = _WORD_PIECE if word else _BYTE_PIECE
        self._plain = _PLAIN if word else _PLAIN_SPACE
        self._part = _WORD_PART if word else _BYTE_PART
        self._lower = word
        self._core, end, self._shift = _merge_core(path, word)
        self._sep = end + "\n"
        self._line_end = self._core.encode_ordinary("\n")[0]
        self._checked = 0
        self._pieces: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self._tok.encode(text, add_special_tokens=False).ids

    def _learn_parts(self, parts: list[str]) -> None:
        ids = np.array(self._core.encode_ordinary(self._sep.join([*parts, ""])))
        cuts = np.flatnonzero(ids == self._line_end)
        if len(cuts) != len(parts):
            raise ValueError("line end met inside a piece")
        ids = (ids - self._shift).astype("<u2")
        start = 0
        for p, end in zip(parts, cuts.tolist()):
            self._parts[p] = ids[start:end].tobytes()
            start = end + 1
        if self._checked < _CHECKED:
            self._checked += len(parts)
            for p in parts[:_CHECKED]:
                if np.array(self._ids(p), dtype="<u2").tobytes() != self._parts[p]:
                    raise ValueError(f"merge core and tokenizers library differ on {p!r}")

    def _learn(self, pieces: set[str]) -> None:
        if len(self._pieces) + len(pieces) > MEMO_PIECES:
            self._pieces.clear()
        if len(self._parts) > MEMO_PARTS:
            self._parts.clear()
        split, odd, new = {}, [], {}
        for p in pieces:
            if self._plain.fullmatch(p):
                parts = split[p] = self._part.findall(p.lower() if self._lower else p)
                for x in parts:
                    if x not in self._parts:
                        new[x] = None
            else:
                odd.append(p)
        todo = list(new)
        for i in range(0, len(todo), 2000):
            self._learn_parts(todo[i:i + 2000])
        get = self._parts.__getitem__
        for p, parts in split.items():
            self._pieces[p] = b"".join(map(get, parts))
        for p in odd:
            self._pieces[p] = np.array(self._ids(p), dtype="<u2").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        find = self._piece.findall
        out = []
        for text in texts:
            pieces = find(text) if text else []
            try:
                out.append(b"".join(map(self._pieces.__getitem__, pieces)))
            except KeyError:
                known = self._pieces
                self._learn({p for p in pieces if p not in known})
                try:
                    out.append(b"".join(map(self._pieces.__getitem__, pieces)))
                except KeyError:  # the memo was emptied meanwhile
                    self._learn(set(pieces))
                    out.append(b"".join(map(self._pieces.__getitem__, pieces)))
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """One encoder, with its memos, per worker process and vocabulary."""
    key = (path, kind)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, kind)
    return _ENCODERS[key]


def release() -> None:
    """Drop this worker's encoder and its memos; tasks of other operators call it first, so
    that one operator's memory at a time is held by a worker that serves many. Freed pages go
    back to the system where the C library can do so."""
    _ENCODERS.clear()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
