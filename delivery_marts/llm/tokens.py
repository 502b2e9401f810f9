"""Token ids of whole texts, from a tokenizer file, with the pieces of a text kept in a cache.

Both kinds of tokenizer here cut a text by a pattern before they look anything up, and no token
crosses such a cut: one is before white space that follows other characters, one between letters
and an ASCII punctuation mark. So a text is cut into pieces there, a piece seen before costs one
dictionary lookup, and the ids of a text are those of its pieces in order, exactly as the
tokenizer gives them for the whole text (tests compare the two). A piece of Latin letters goes
straight to the tokenizer's model; any other goes through the whole tokenizer. Strings of added
tokens in a text are those tokens, as the library has it: a text is cut at them first.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Unicode White_Space, what the tokenizers' patterns call white space.
SPACE = "\t-\r \x85\xa0  -     　"
# Letters that stand for themselves in every normal form and have one lower case.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
MARK = r"!-/:-@\[-`{-~"
WORD_END = f"(?![^{SPACE}{MARK}])"

# Where spaces are part of tokens: one space belongs to the word after it, and a single other
# white space stands alone; a longer run stays with what follows it.
WITH_SPACES = re.compile(f" ?[{LETTER}]++{WORD_END}|[\t-\r](?=[^{SPACE}])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WITHOUT_SPACES = re.compile(f"[{LETTER}]++{WORD_END}|[^{SPACE}]+")
LATIN = re.compile(f" ?[{LETTER}]+")

# The cache holds at most this many pieces, none longer than LONGEST; a full cache starts anew.
CACHED = 1 << 20
LONGEST = 48


def _byte_letters() -> dict[int, str]:
    """The character by which byte-level models spell each byte: printable Latin-1 characters
    spell themselves, the others are numbered from 256."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class _Pieces(dict):
    """Bytes of ids by piece; encodes what is missing."""

    def __init__(self, tokenizer: Tokenizer, spaces: bool, dtype: str):
        super().__init__()
        self.tokenizer, self.model, self.spaces, self.dtype = tokenizer, tokenizer.model, spaces, dtype

    def __missing__(self, piece: str) -> bytes:
        if LATIN.fullmatch(piece):
            # What the normaliser (lower case, where there is one) and the byte alphabet make of it.
            spelled = piece if self.spaces else piece.lower()
            spelled = spelled.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [token.id for token in self.model.tokenize(spelled)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        found = np.array(ids, self.dtype).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """``spaces`` says whether white space is part of the tokens or dropped by the tokenizer."""

    def __init__(self, path: str, spaces: bool):
        tokenizer = Tokenizer.from_file(path)
        added = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
        # Longer strings first, where one begins another.
        strings = sorted(added, key=len, reverse=True)
        self._added = re.compile(f"({'|'.join(map(re.escape, strings))})") if strings else None
        self.dtype = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._cut = (WITH_SPACES if spaces else WITHOUT_SPACES).findall
        self._ids = _Pieces(tokenizer, spaces, self.dtype).__getitem__
        self._id_of = {string: np.array([i], self.dtype).tobytes() for string, i in added.items()}

    def _whole(self, text: str) -> bytes:
        """Ids of a text with strings of added tokens in it."""
        parts = self._added.split(text)
        return b"".join(
            self._id_of[part] if place % 2 else b"".join(map(self._ids, self._cut(part)))
            for place, part in enumerate(parts)
        )

    def ids_of(self, texts: Iterable[str | None], end: int | None = None) -> Iterator[np.ndarray]:
        """Ids of each text (NULL is empty), with the end id after them."""
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        for text in texts:
            text = text or ""
            if self._added and self._added.search(text):
                found = self._whole(text)
            else:
                found = b"".join(map(self._ids, self._cut(text)))
            yield np.frombuffer(found + tail, self.dtype)


@lru_cache(maxsize=4)
def encoder(path: str, spaces: bool) -> Encoder:
    """One encoder per Python worker, which Spark reuses for many tasks."""
    return Encoder(path, spaces)
