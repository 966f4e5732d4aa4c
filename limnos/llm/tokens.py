"""Token ids of whole texts by a byte-level BPE of the tokenizers library.

Such a tokenizer splits a text at white space before it merges bytes: a piece is an optional blank with the
characters up to the next white space, or the white space before it. Pieces never influence each other, so each
distinct piece is encoded once by the library and its ids are looked up afterwards. The result is that of encoding
the whole text; the tests compare the two. Texts are cut at blanks first: a part between blanks, with the blank before
it, is made of whole pieces unless white space touches its front, and those texts are cut by a pattern instead. Strings
of special tokens in a text are those tokens, as the library handles them by default.
"""

from __future__ import annotations

import os
import re
from typing import Any

from limnos.llm.shared import remembered

# Unicode's White_Space, which the tokenizer's own splitting goes by.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# Letters and punctuation that the tokenizer keeps in one run each; other pieces take the library's whole way.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")
GENERATION = 400_000  # distinct pieces in one of the two generations that a worker remembers, about 100 MB each
FRONT = re.compile(f"[{WHITE}]|$")
LONGEST_KEPT = 64  # longer pieces are rarely met again

_ENCODERS: dict[tuple[str, int | None], Any] = remembered({})


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stay, the rest follow U+0100."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in stay]
    return {b: b for b in stay} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """The library's tokenizer with a memory of bounded size for the ids of pieces."""

    def __init__(self, path: str, generation: int | None = None) -> None:
        self.generation = generation
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        self.special = {t.content: i.to_bytes(4, "little") for i, t in added.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.pieces = Pieces(self.tokenizer)
        self.after_blank = PartsAfterBlank(self.pieces)

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """For each text its ids and the end id, as little-endian unsigned 32-bit integers; null is an empty text."""
        end = int(end_id).to_bytes(4, "little")
        return [self._whole(text) + end if text else end for text in texts]

    def _whole(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self._ordinary(text)
        return b"".join([self.special[x] if k % 2 else self._ordinary(x) for k, x in enumerate(self.specials.split(text))])

    def _ordinary(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        found = list(map(self.after_blank.__getitem__, rest))
        if None in found:
            ids = b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))
        else:
            ids = b"".join([self.pieces[first], *found] if first else found)
        for memory in (self.pieces, self.after_blank):
            if len(memory) > (self.generation or GENERATION):
                memory.turn()
        return ids


class _Memory(dict[str, Any]):
    """Values found when they are first asked for, in two generations; when the younger is full, the older is forgotten."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict[str, Any] = {}

    def __missing__(self, key: str) -> Any:
        value = self.older[key] if key in self.older else self.find(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()

    def find(self, key: str) -> Any:
        raise NotImplementedError


class Pieces(_Memory):
    """Ids of pieces."""

    def __init__(self, tokenizer: Any) -> None:
        super().__init__()
        self.tokenizer, self.merge = tokenizer, tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.codes = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]

    def find(self, key: str) -> bytes:
        plain = PLAIN.fullmatch(key)
        if plain is None:
            return b"".join([self.codes[i] for i in self.tokenizer.encode(key, add_special_tokens=False).ids])
        if plain[2]:
            return self[plain[1]] + self[plain[2]]
        return self.merged(key.encode().decode("latin-1").translate(self.letters))

    def merged(self, letters: str) -> bytes:
        """Ids of a run that the tokenizer doesn't split before merging, in the vocabulary's letters."""
        return b"".join([self.codes[t.id] for t in self.merge(letters)])


class PartsAfterBlank(_Memory):
    """Ids of parts between blanks with the blank before them; None where white space touches the front."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.pieces = pieces

    def find(self, key: str) -> bytes | None:
        if key.isascii() and key.isalpha():
            return self.pieces.merged("Ġ" + key)
        if FRONT.match(key):
            return None
        plain = PLAIN.fullmatch(key)
        if plain and plain[2]:
            return self[plain[1]] + self.pieces[plain[2]]
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(" " + key)))


def encoder(path: str, generation: int | None = None) -> Encoder:
    """One encoder for each worker process and vocabulary file, which remembers GENERATION pieces or so many as are asked for."""
    if (path, generation) not in _ENCODERS:
        _ENCODERS[path, generation] = Encoder(path, generation)
    return _ENCODERS[path, generation]
