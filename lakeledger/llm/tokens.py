"""Encoding of whole texts with the tokenizers library, through a memo.

Byte-pair encoding never crosses the cuts of the tokenizer's own
pre-tokenizer.  So a text may be cut at places where that cuts in any case,
each distinct piece encoded once by the library, and the ids joined.  A piece
that a worker has seen costs a dict lookup.  The memo is bounded: it holds two
generations of at most ``GENERATION`` pieces, and a piece of over ``MAX_CHARS``
characters is encoded each time and not kept.

``byte``: pre-tokenizers of the byte-level kind keep white space and join one
space to the word after it.  Cuts: a space or newline that has no white space
on either side.
``word``: pre-tokenizers that drop white space.  Cuts: spaces and newlines.

A new piece is cut before a run of marks at its end, where both kinds cut, and
the two parts are looked up by themselves, so a word is encoded once with and
without marks.  Texts of the word kind within Latin-1 are lower-cased first,
as the normaliser does.  A part that is one Latin word goes to the library's
model directly, as normaliser and pre-tokenizer would leave it (of the
byte-level kind several in one call, told apart by the tokens that begin with
the space); any other goes through the whole tokenizer.

Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np

from lakeledger.llm.common import process_cache

GENERATION = 500_000
MAX_CHARS = 64
AT_ONCE = 16  # words in one call of a byte-level model
_MARKS = ".,;:!?#$%&*"
_LATIN_END = "\u0250"
_LATIN_1 = "\u00ff"

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


class _Odd(Exception):
    """A piece that ends in white space or is long: its text goes another way."""


class _Numbers(dict):
    """piece -> its number in the memo; ``lead`` stands before each piece."""

    def __init__(self, memo: _Memo, lead: str, strict: bool):
        super().__init__()
        self.memo, self.lead, self.strict, self.old = memo, lead, strict, {}

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece)
        if n is None:
            if len(piece) > MAX_CHARS or self.strict and (not piece or piece != piece.strip()):
                raise _Odd
            n = self.memo.add(self, piece)
        self[piece] = n
        return n


def _byte_letters() -> dict[int, str]:
    """Bytes as the letters that byte-level models know them by: printable
    bytes of Latin-1 as themselves, the others from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo:
    """The ids of numbered pieces: ``size`` of them from ``first`` in ``flat``."""

    def __init__(self, tokenizer, kind: str):
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model, _byte_letters()
        self.normal = tokenizer.normalizer.normalize_str if kind == "word" else None
        self.space = self.letters[32]
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        self.starts = np.zeros(max(vocab.values()) + 1, bool)
        self.starts[[i for t, i in vocab.items() if t.startswith(self.space)]] = True
        #: no token has a space behind anything but spaces and no-break spaces, so words cannot merge
        unbroken = self.letters[0xC2] + self.letters[0xA0] + self.space
        self.apart = kind == "byte" and not any(self.space in t.replace(unbroken, "").lstrip(self.space) for t in vocab)
        self.marks = _Numbers(self, "", strict=False)
        self.clear()

    def _start(self) -> None:
        #: new parts and their numbers: words as the model takes them, with and
        #: without a space before them, and others
        self.spaced, self.bare, self.other = ([], []), ([], []), ([], [])
        self.parts = array("q")  # by three: a piece, its word and its marks

    def clear(self) -> None:
        self.count = 0
        self.first = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.marks.clear()
        self._start()

    def add(self, numbers: _Numbers, piece: str) -> int:
        if self.normal is None and piece.isascii() and piece.isalpha():
            kind = self.spaced if self.apart and numbers.lead else self.bare
            kind[0].append(self.space + piece if numbers.lead else piece)
            kind[1].append(self.count)
            self.count += 1
            return self.count - 1
        word = piece.rstrip(_MARKS)
        if word and len(word) < len(piece) and word[-1] < _LATIN_END and word[-1].isalnum():
            n = self.count
            self.count += 1
            self.parts.extend((n, numbers[word], self.marks[piece[len(word):]]))
            return n
        whole = numbers.lead + piece
        if self.normal is not None:
            piece = whole = whole.lower() if whole.isascii() or max(whole) <= _LATIN_1 else self.normal(whole)
        if piece.isalpha() and (piece.isascii() or max(piece) < _LATIN_END):
            kind = self.spaced if self.apart and whole[0] == " " else self.bare
            if not whole.isascii():
                whole = whole.encode().decode("latin-1")
            whole = whole.translate(self.letters)
        else:
            kind = self.other
        kind[0].append(whole)
        kind[1].append(self.count)
        self.count += 1
        return self.count - 1

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize = self.model.tokenize
        flat = np.array([x.id for i in range(0, len(words), AT_ONCE) for x in tokenize("".join(words[i:i + AT_ONCE]))], np.int32)
        return flat, np.diff(np.r_[np.flatnonzero(self.starts[flat]), len(flat)])

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        ends = []
        for w in words:
            ids += [x.id for x in self.model.tokenize(w)]
            ends.append(len(ids))
        return np.array(ids, np.int32), np.diff(np.array(ends), prepend=0)

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int32, int(size.sum())), size

    def learn(self) -> None:
        """Encode what is new."""
        new = self.count - len(self.size)
        if not new:
            return
        self.first, self.size = (np.concatenate([x, np.zeros(new, np.int64)]) for x in (self.first, self.size))
        flats, total = [self.flat], len(self.flat)

        def put(numbers: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
            nonlocal total
            self.first[numbers] = total + np.cumsum(size) - size
            self.size[numbers] = size
            flats.append(flat)
            total += len(flat)

        for (strings, at), encode in ((self.spaced, self._joined), (self.bare, self._single), (self.other, self.ids_of)):
            if strings:
                put(np.array(at), *encode(strings))
        self.flat = np.concatenate(flats)
        if self.parts:
            n, word, marks = np.array(self.parts).reshape(-1, 3).T
            flats, total = [self.flat], len(self.flat)
            put(n, self.look_up(np.c_[word, marks].ravel()), self.size[word] + self.size[marks])
            self.flat = np.concatenate(flats)
        self._start()

    def look_up(self, numbers: np.ndarray) -> np.ndarray:
        first, size = self.first[numbers], self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(first - ends + size, size) + np.arange(total)]

    def keep(self, maps: list[_Numbers]) -> None:
        """Start a generation: what the last one used is kept as the old one."""
        used = [np.fromiter(m.values(), np.int64, len(m)) for m in maps]
        there = np.zeros(self.count, bool)
        for u in used:
            there[u] = True
        numbers, place = np.flatnonzero(there), np.cumsum(there) - 1
        self.flat, self.size = self.look_up(numbers), self.size[numbers]
        self.first = np.cumsum(self.size) - self.size
        self.count = len(numbers)
        for m in maps:
            m.old = {}  # not beside the new ones
        for m, u in zip(maps, used, strict=True):
            m.old = dict(zip(m, place[u].tolist(), strict=True))
            m.clear()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def encode_once(memo: _Memo, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of distinct strings by an emptied memo of the byte-level
    kind: single words behind a space the short way, others whole."""
    memo.clear()
    spaced = _Numbers(memo, " ", strict=False)
    numbers = []
    for s in strings:
        if s[0] == " " and s[1:].isalpha() and len(s) <= MAX_CHARS:
            numbers.append(spaced[s[1:]])
        else:
            memo.other[0].append(s)
            memo.other[1].append(memo.count)
            numbers.append(memo.count)
            memo.count += 1
    memo.learn()
    at = np.array(numbers, np.int64)
    return memo.look_up(at), memo.size[at]


class Encoder:
    def __init__(self, path: str, kind: str, generation: int | None = None):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memo = memo = _Memo(self.tokenizer, kind)
        self.numbers = {"byte": self._byte, "word": self._word}[kind]
        self.kind, self.generation = kind, generation
        self.bare = _Numbers(memo, "", strict=kind == "byte")     # first words of lines
        self.spaced = _Numbers(memo, " ", strict=True)            # words after a space
        self.whole = _Numbers(memo, "", strict=False)             # pieces with their white space

    def _word(self, text: str) -> list[int]:
        if text.isascii() or _latin(text):  # composed already, and lower-cased letter by letter
            text = text.lower()
        return list(map(self.bare.__getitem__, text.replace("\n", " ").split(" ")))

    def _byte(self, text: str) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        bare, spaced = self.bare.__getitem__, self.spaced.__getitem__
        for line in text.split("\n"):
            if out:
                out.append(self.whole["\n"])
            words = iter(line.split(" "))
            out.append(bare(next(words)))
            out.extend(map(spaced, words))
        return out

    def _odd(self, text: str) -> np.ndarray | list[int]:
        pieces = _CUT.sub("\x00", text).split("\x00") if self.kind == "byte" and "\x00" not in text else [text]
        try:
            return [self.whole[p] for p in pieces]
        except _Odd:
            return self.memo.ids_of(pieces if self.kind == "byte" else text.replace("\n", " ").split(" "))[0]

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the n + 1 offsets of the texts); ``end`` is
        appended to each text."""
        rows: list = []
        for text in texts:
            try:
                rows.append(self.numbers(text))
            except _Odd:
                rows.append(self._odd(text))
        self.memo.learn()
        known = [row for row in rows if isinstance(row, list)]
        numbers = np.fromiter(chain.from_iterable(known), np.int64, sum(map(len, known)))
        upto = np.r_[0, np.cumsum(self.memo.size[numbers])]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        listed = np.fromiter((isinstance(row, list) for row in rows), bool, len(rows))
        ends = np.cumsum(sizes[listed])
        sizes[listed] = upto[ends] - upto[ends - sizes[listed]]
        off = np.r_[0, np.cumsum(sizes + (end is not None))]
        flat, here = np.empty(off[-1], np.int32), np.ones(off[-1], bool)
        if end is not None:
            flat[off[1:] - 1], here[off[1:] - 1] = end, False
        for i in np.flatnonzero(~listed).tolist():
            flat[off[i]:off[i] + sizes[i]], here[off[i]:off[i] + sizes[i]] = rows[i], False
        flat[here] = self.memo.look_up(numbers)
        if len(self.bare) + len(self.spaced) + len(self.whole) > (self.generation or GENERATION):
            self.memo.keep([self.bare, self.spaced, self.whole, self.memo.marks])
        return flat, off


def encoder(path: str, kind: str, generation: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file, kept across tasks, with
    ``generation`` pieces in a generation of its memo (by default GENERATION)."""
    cache = process_cache("encoders")
    if (path, kind) not in cache:
        cache[path, kind] = Encoder(path, kind, generation)
    cache[path, kind].generation = generation
    return cache[path, kind]
