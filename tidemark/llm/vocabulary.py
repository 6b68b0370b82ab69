"""Token ids by a public tokenizer, with a bounded memory of words seen before."""

from __future__ import annotations

import array
import re
import string

CACHE = 1 << 19  # words a worker remembers
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# The byte-level splitter never joins what white space divides, save for one space before a word.
_PIECE = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_UNEVEN = re.compile(f"[ \\n][{_SPACE}]|\\n$")
_MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a shortened word
_LINE = "\n"


def _as_bytes(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library.

    The library splits a text at white space before it merges bytes, so a text's ids are those of
    its pieces, and each distinct piece is encoded once while it is remembered. A text that holds
    the name of an added token goes to the library whole.
    """

    _of: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if token.content]
        self.pieces = self.tokenizer.model.tokenize
        self.line = self._ids(_LINE)
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder of a file."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _ids(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return _as_bytes(found)

    def _word(self, text: str) -> bytes:
        """The ids of letters with or without a space before them: one piece to the library."""
        if text.isascii():
            raw = _SHOWN[32] + text[1:] if text[0] == " " else text
        else:
            raw = text.encode().decode("latin-1").translate(_SHOWN)
        return _as_bytes([token.id for token in self.pieces(raw)])

    def _learn(self, part: str) -> bytes:
        """The ids of what lies between two spaces, from the space, or line end, on.

        The library takes letters apart from the punctuation that follows, so words are remembered
        without it.
        """
        known = self.known
        space, text = ("", part[1:]) if part[:1] == _LINE else (" ", part)
        letters = text.rstrip(_MARKS)
        if letters.isalpha():
            key = letters if space else _LINE + letters
            ids = known.get(key)
            if ids is None:
                ids = self._word(space + letters)
                ids = known[key] = ids if space else self.line + ids
            if len(letters) < len(text):
                marks = text[len(letters) :]
                ids = known[part] = ids + (self.marks.get(marks) or self._mark(marks))
            return ids
        ids = self._ids(space + text) if space + text else b""
        ids = known[part] = ids if space else self.line + ids
        return ids

    def _mark(self, marks: str) -> bytes:
        if len(self.marks) > CACHE // 8:
            self.marks.clear()
        ids = self.marks[marks] = self._ids(marks)
        return ids

    def _piecewise(self, text: str) -> bytes:
        """Any text, piece by piece as the library divides it."""
        pieces, known = _PIECE.findall(text), self.odd
        for piece in pieces:
            if piece not in known:
                known[piece] = self._ids(piece)
        found = b"".join(map(known.__getitem__, pieces))
        if len(known) > CACHE // 8:
            known.clear()
        return found

    def __call__(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers.

        Where no white space follows a space or a line end, pieces are divided by spaces and begin
        with one; a line end is a piece by itself and the next piece then has no space before it.
        """
        if any(name in text for name in self.added):
            return self._ids(text)
        if _UNEVEN.search(text):
            return self._piecewise(text)
        first, *rest = text.replace(_LINE, " \n").split(" ")
        found = list(map(self.known.get, rest))
        if None in found:
            learn, known = self._learn, self.known.get
            found = [known(x) or learn(x) for x in rest]
            if len(self.known) > CACHE:
                self.known.clear()
        return (self._piecewise(first) if first else b"") + b"".join(found)


def _shown() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes for those from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in own]
    return {byte: chr(256 + at) for at, byte in enumerate(others)}


_SHOWN = _shown()
