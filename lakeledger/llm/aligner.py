"""Two tokenizations of a text aligned by bytes, through a memo of its words.

A is a byte-level tokenizer of the tokenizers library whose pre-tokenizer keeps
white space and joins one space to the word behind it; B is a sentencepiece
model.  Both cut before a space or newline that has no white space on either
side: A's pre-tokenizer always does, B if none of its pieces has a space behind
another character or a newline at all, which is tested once.  So a text is cut
there, each distinct word is encoded once by both libraries, and the groups of
a text are those of its words.  Marks behind a letter are units by themselves:
A's pre-tokenizer cuts there, too, and B if no piece holds a mark behind a
letter.  Texts with other white space, or all texts if B fails the tests, are
encoded whole.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np

from lakeledger.llm import tokens
from lakeledger.llm.common import process_cache

GENERATION = 150_000  # words in the memo; it starts anew beyond that
LONGEST = 64          # characters of a word that the memo keeps
_SPACE = "▁"
_MARKS = ".,;:!?#$%&*"


class _Odd(Exception):
    """A text that is not words with single spaces or newlines between them."""


class _Numbers(dict):
    """word -> the number of its piece; ``lead`` stands before each word."""

    def __init__(self, home: Aligner, lead: str):
        super().__init__()
        self.home, self.lead = home, lead

    def __missing__(self, word: str) -> int:
        if not word or len(word) > LONGEST or word[0].isspace() or word[-1].isspace():
            raise _Odd
        base, home = word.rstrip(_MARKS), self.home
        if not base or not base[-1].isalpha():
            base = word
        home.head.append(home.unit(self.lead + base))
        home.tail.append(home.unit(word[len(base):]) if len(base) < len(word) else -1)
        self[word] = n = len(home.head) - 1
        return n


def _flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(pieces), np.uint8),
            np.cumsum([0, *map(len, pieces)]))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Units:
    """Encoded strings: counts, pairs and the text form of their groups."""

    def __init__(self):
        self.counts = np.zeros((0, 4), np.int64)  # A ids, B ids, groups, links; all 0 if the bytes differ
        self.good = np.zeros(0, bool)
        self.first = np.zeros(0, np.int64)        # of a unit's links in ``pairs``
        self.pairs = np.zeros(0, np.int64)        # A id << 32 | B id
        self.form: list[bytes] = []

    def add(self, counts, good, pairs, form) -> None:
        links = counts[:, 3]
        self.first = np.r_[self.first, len(self.pairs) + np.cumsum(links) - links]
        self.counts, self.good = np.concatenate([self.counts, counts]), np.r_[self.good, good]
        self.pairs = np.r_[self.pairs, pairs]
        self.form += form


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = self._letters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.a_bytes = _flat([bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = _flat([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                              for i, p in enumerate(pieces)])
        self.bare = [self.b.piece_to_id(_SPACE), self.b.piece_to_id("<0x0A>")]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) or "\n" in p
                            or any(x.isalpha() and y in _MARKS for x, y in zip(p, p[1:])) for p in pieces)
        self.memo = tokens._Memo(self.a, "byte")
        names = [b"%d;" % i for i in range(max(len(names), len(pieces)))]
        self.names = _flat(names)
        self._start()

    @staticmethod
    def _letters() -> dict[str, int]:
        """The letters that stand for bytes: printable bytes of Latin-1 stand
        for themselves, the others for the letters from 256 on."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = sorted(set(range(256)) - set(plain))
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def _start(self) -> None:
        self.new: list[str] = []              # units, the last ones not yet encoded
        self.number: dict[str, int] = {}
        self.units = Units()
        self.head = array("q")                # of each piece its first unit,
        self.tail = array("q")                # and its second or -1
        self.spaced, self.lined = _Numbers(self, " "), _Numbers(self, "\n")

    def unit(self, string: str) -> int:
        n = self.number.get(string)
        if n is None:
            self.number[string] = n = len(self.new)
            self.new.append(string)
        return n

    def _b_ids(self, strings: list[str]) -> list[list[int]]:
        """B's ids of strings.  B puts a space before each; where there is none
        it gets a newline between, and the ids of both go again."""
        ids = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in strings], num_threads=1)
        for i, s in enumerate(strings):
            if s[0] != " ":
                if ids[i][:2] != self.bare:
                    raise ValueError("the sentencepiece model joins a space or newline to what follows")
                del ids[i][:2]
        return ids

    def align(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(counts, good, pairs, forms) of strings."""
        n = len(strings)
        a, count_a = tokens.encode_once(self.memo, strings)
        b = self._b_ids(strings)
        want = [s.encode() for s in strings]
        count = [count_a, np.fromiter(map(len, b), np.int64, n)]
        ids = [a.astype(np.int64), np.fromiter((i for x in b for i in x), np.int64, int(count[1].sum()))]
        raw, off = _flat(want)
        good = np.ones(n, bool)
        width = []
        for k, (flat, at) in enumerate((self.a_bytes, self.b_bytes)):
            size = (at[1:] - at[:-1])[ids[k]]
            text = np.repeat(np.arange(n), count[k])
            same = np.bincount(text, size, n) == np.diff(off)
            # bytes of the strings whose lengths agree
            use = same[text]
            got = flat[_ranges(at[:-1][ids[k][use]], size[use])]
            long = np.where(same, np.diff(off), 0)
            there = raw[_ranges(off[:-1][same], long[same])]
            wrong = np.flatnonzero(got != there)
            same[np.searchsorted(np.cumsum(long), wrong, "right")] = False
            good &= same
            width.append(size)
        end, owner, left = [], [], []
        for k in range(2):
            text = np.repeat(np.arange(n), count[k])
            use = good[text]
            ids[k], owner_k, size = ids[k][use], text[use], width[k][use]
            end.append(np.cumsum(size))
            owner.append(owner_k)
            left.append(np.where(good, count[k], 0))
        common = np.intersect1d(end[0], end[1], assume_unique=bool(np.all(width[0]) and np.all(width[1])))
        group = [np.searchsorted(common, e) for e in end]
        size = [np.bincount(g, minlength=len(common)) for g in group]
        text = owner[0][np.cumsum(size[0]) - 1] if len(common) else np.zeros(0, np.int64)
        links = size[0] * size[1]
        first_b = np.cumsum(size[1]) - size[1]
        # every A id meets the B ids of its group
        pairs = np.repeat(ids[0], size[1][group[0]]) << 32 | ids[1][_ranges(first_b[group[0]], size[1][group[0]])]
        counts = np.c_[left[0], left[1], np.bincount(text, minlength=n), np.bincount(text, links, n).astype(np.int64)]
        return counts, good, pairs, self._forms(ids, group, left)

    def _forms(self, ids, group, left) -> list[bytes]:
        """a1,a2|b1;a3|b2,b3; of each string."""
        if not len(ids[0]):
            return [b""] * len(left[0])
        groups = int(group[0][-1]) + 1
        size = [np.bincount(g, minlength=groups) for g in group]
        place = [np.arange(len(ids[0])) + (np.cumsum(size[1]) - size[1])[group[0]],
                 np.arange(len(ids[1])) + np.cumsum(size[0])[group[1]]]
        every, mark = np.zeros((2, len(ids[0]) + len(ids[1])), np.int64)
        for k in range(2):
            every[place[k]] = ids[k]
            last = np.r_[group[k][1:] != group[k][:-1], True]
            mark[place[k]] = np.where(last, b"|;"[k], ord(","))
        flat, at = self.names
        width = (at[1:] - at[:-1])[every]
        out = flat[_ranges(at[:-1][every], width)]
        ends = np.r_[0, np.cumsum(width)]
        out[ends[1:] - 1] = mark
        cut = ends[np.r_[0, np.cumsum(left[0] + left[1])]].tolist()
        data = out.tobytes()
        return [data[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]

    def _words(self, text: str) -> list[int]:
        out: list[int] = []
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if i:
                out.append(self.lined[words[0]])
                del words[0]
            out += map(self.spaced.__getitem__, words)
        return out

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(counts, sha256 of the groups, text of each link, link) of texts;
        links by text.  A text that is empty or whose bytes differ in A or B
        has zeros, '' and no links."""
        if len(self.head) > GENERATION:
            self._start()
        rows: list[list[int] | None] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            try:
                if not self.cuts:
                    raise _Odd
                rows.append(self._words(text) if text else [])
            except _Odd:
                rows.append(None)
                whole.append(i)
        known = len(self.units.good)
        if len(self.new) > known:
            self.units.add(*self.align(self.new[known:]))
        u = self.units
        head, tail = np.array(self.head), np.array(self.tail)
        if whole:
            counts, good, pairs, form = self.align([" " + texts[i] for i in whole])
            odd = Units()
            odd.add(counts, good, pairs, form)
        out, sha, links = np.zeros((len(texts), 4), np.int64), [], []
        k = 0
        for i, row in enumerate(rows):
            if row is None:
                here, at = odd, np.array([k])
                k += 1
            else:
                here, piece = u, np.array(row, np.int64)
                at = np.c_[head[piece], tail[piece]].ravel()
                at = at[at >= 0]
            if not len(at) or not here.good[at].all():
                sha.append("")
                links.append(u.pairs[:0])
                continue
            c = here.counts[at]
            out[i] = c.sum(axis=0)
            form = here.form
            sha.append(hashlib.sha256(b"".join([form[x] for x in at.tolist()])[:-1]).hexdigest())
            links.append(here.pairs[_ranges(here.first[at], c[:, 3])])
        doc = np.repeat(np.arange(len(texts)), out[:, 3])
        return out, sha, doc, np.concatenate(links) if links else u.pairs[:0]


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of two vocabulary files, kept across tasks."""
    cache = process_cache("aligners")
    if (a_path, b_path) not in cache:
        cache[a_path, b_path] = Aligner(a_path, b_path)
    return cache[a_path, b_path]
