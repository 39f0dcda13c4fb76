"""Exact, memoised use of the public tokenizers inside Arrow stages.

``WordMemo`` gives the ids the ``tokenizers`` library gives for a whole text.
It cuts a text only at places where the file's own pre-tokenizer always cuts
(before a blank that a word follows, around a line end, between a letter and
the marks after it), lets the library encode each stretch, and remembers the
ids for the next time a worker meets it.  Texts whose white space is not plain
are encoded whole.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np


class _OddSpace(Exception):
    """White space that is not a single blank or line end between words: such a text is encoded whole."""


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


#: Marks that end a stretch of letters and make one piece among themselves.
_MARKS = ",.%#&$*|;:!?"
_LAST_LATIN = "ɏ"


class _Memo(dict):
    """Ids (little-endian, 32 bits) of ``lead + stretch``, for the stretches met so far.

    Stretches beyond ``limit`` are encoded each time, so memory is bounded.
    With ``strict`` a stretch that is empty or begins with white space is odd;
    it is never kept, so each text that holds one is found.
    """

    def __init__(self, encode, lead: str, limit: int, strict: bool):
        super().__init__()
        self._encode, self._lead, self._limit, self._strict = encode, lead, limit, strict

    def __missing__(self, stretch: str) -> bytes:
        if self._strict and (not stretch or stretch[0].isspace()):
            raise _OddSpace
        body = stretch.rstrip(_MARKS)
        if body and len(body) < len(stretch) and body[-1] <= _LAST_LATIN and body[-1].isalpha():
            ids = self[body] + self._encode(stretch[len(body):])
            if len(self) < self._limit // 2 and len(stretch) <= 64:
                self[stretch] = ids
            return ids
        ids = self._encode(self._lead + stretch)
        if len(self) < self._limit and len(stretch) <= 64:
            self[stretch] = ids
        return ids


class WordMemo:
    """``ids(text)`` as ``uint32`` array, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    The library gives the string of a special token inside a text that token's
    id; with ``plain_specials`` the string is ordinary text
    (``Tokenizer.encode_special_tokens``).
    """

    def __init__(self, path: str, limit: int = 1_000_000, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = plain_specials
        added = self._tok.get_added_tokens_decoder().values()
        # texts with one of these strings are encoded whole
        self._added = [t.content for t in added if not (plain_specials and t.special)]
        self._added_anywhere = any(t.normalized and t.content in self._added for t in added)
        self._normal = self._tok.normalizer
        self._pre = self._tok.pre_tokenizer
        self._tokenize = self._tok.model.tokenize
        self._short: dict[str, bytes] = {}
        # a file that normalises has white space dropped by its pre-tokenizer; otherwise a blank leads a word
        self._drops_space = self._normal is not None
        self._first = _Memo(self._stretch, "", limit if self._drops_space else limit // 8,
                            not self._drops_space)
        self._after_blank = _Memo(self._stretch, " ", limit, True)
        self._line_end = self._stretch("\n")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _stretch(self, stretch: str) -> bytes:
        if len(stretch) <= 4 and (got := self._short.get(stretch)) is not None:
            return got
        plain = self._normal.normalize_str(stretch) if self._drops_space else stretch
        ids = _packed([t.id for piece, _ in self._pre.pre_tokenize_str(plain) for t in self._tokenize(piece)])
        if len(stretch) <= 4 and len(self._short) < 100_000:
            self._short[stretch] = ids
        return ids

    def ids_bytes(self, text: str, led: bool = False) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; with ``led`` those of a blank and the text."""
        if self._added_anywhere or any(t in text for t in self._added):
            return self.whole(" " * led + text).astype("<u4").tobytes()
        if self._drops_space:
            return b"".join(map(self._first.__getitem__, [w for w in text.replace("\n", " ").split(" ") if w]))
        if not text:
            return self.whole(" ").astype("<u4").tobytes() if led else b""
        try:
            lines = []
            for line in text.split("\n"):
                words = line.split(" ")
                first = self._after_blank if led and not lines else self._first
                lines.append(first[words[0]] + b"".join(map(self._after_blank.__getitem__, words[1:])))
            return self._line_end.join(lines)
        except _OddSpace:
            return self.whole(" " * led + text).astype("<u4").tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.ids_bytes(text), dtype="<u4")


class PieceMemo:
    """``ids_bytes(text)``: the ids of ``SentencePieceProcessor.encode(text)``, for BPE piece files.

    Where no piece holds the blank mark behind another character, or a line
    end with anything else, no merge crosses a single blank or a line end, and
    the stretches between them have ids of their own, which are remembered.
    Texts with the mark itself or blanks that are not single, and all texts of other files, are
    encoded whole.
    """

    MARK = "\u2581"

    def __init__(self, path: str, limit: int = 1_000_000):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self._limit = limit
        self.pieces = [self._sp.id_to_piece(i) for i in range(self._sp.get_piece_size())]
        self._led: dict[str, bytes] = {}        # ids of blank + stretch
        self._bare: dict[str, bytes] = {}       # ids of a stretch that begins a later line
        head = self._sp.encode("\n")
        self._cuts = (not any(self.MARK in p.lstrip(self.MARK) for p in self.pieces)
                      and not any("\n" in p for p in self.pieces)
                      and len(head) == 2 and self.pieces[head[0]] == self.MARK and self._sp.is_byte(head[1]))
        self._head, self._line_end = len(head), np.array(head[-1:], dtype="<u4").tobytes()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._sp.encode(text), dtype=np.uint32)

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: its piece with blanks for marks, or the byte it stands for."""
        return [bytes([int(p[3:5], 16)]) if self._sp.is_byte(i) else p.replace(self.MARK, " ").encode()
                for i, p in enumerate(self.pieces)]

    def _of(self, memo: dict[str, bytes], stretch: str, bare: bool) -> bytes:
        if not stretch or stretch[0].isspace():
            raise _OddSpace
        ids = _packed(self._sp.encode("\n" + stretch)[self._head:] if bare else self._sp.encode(stretch))
        if len(memo) < self._limit and len(stretch) <= 64:
            memo[stretch] = ids
        return ids

    def ids_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self._cuts or not text or self.MARK in text:
            return self.whole(text).astype("<u4").tobytes()
        lines, led, bare = [], self._led, self._bare
        try:
            for line in text.split("\n"):
                words = line.split(" ")
                out = []
                if lines:
                    first = words[0]
                    out.append(bare.get(first) or self._of(bare, first, True))
                    del words[0]
                out += [led.get(w) or self._of(led, w, False) for w in words]
                lines.append(b"".join(out))
            return self._line_end.join(lines)
        except _OddSpace:
            return self.whole(text).astype("<u4").tobytes()


_OPEN: dict = {}


def memo_for(path: str, plain_specials: bool = False) -> WordMemo:
    """One memo for each file, reading of special strings, and worker process."""
    key = (path, plain_specials)
    if key not in _OPEN:
        _OPEN[key] = WordMemo(path, plain_specials=plain_specials)
    return _OPEN[key]


def pieces_for(path: str) -> PieceMemo:
    """One memo for each piece file and worker process."""
    if path not in _OPEN:
        _OPEN[path] = PieceMemo(path)
    return _OPEN[path]
