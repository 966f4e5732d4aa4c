"""Numbers of tokens of whole texts by a byte-level BPE, with a shortcut for strings that are one token by themselves.

Before it merges bytes, such a tokenizer cuts a text into pre-tokens, which never influence each other. Most pre-tokens
of a text are in the vocabulary as a whole. ``whole_tokens`` proves once, on the driver, for which strings of the
vocabulary that means one token: those that the library itself encodes to a single id. In the tasks such a pre-token
counts one without being merged; only the rest is merged, by the library's model, and its count is remembered for a
bounded number of pieces. What is broadcast is bounded by the vocabulary.

Texts are cut at blanks first: a part between blanks, with the blank before it, is made of whole pre-tokens unless white
space touches its front, and those texts are cut by the pattern of white-space runs instead. Strings of special tokens in
a text count as one token, as the library handles them by default.

Null text is an empty text, of no bytes and no tokens. Rows of null or repeated ids each have their own result; no rows
give no rows; other columns of the input are left out, so none can clash. Texts of any length are counted whole.
"""

from __future__ import annotations

import json
import os
import re
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from limnos.llm.shared import id_and_text, map_slices
from limnos.llm.tokens import FRONT, GENERATION, LONGEST_KEPT, PIECES, PLAIN, _byte_letters

LIMIT = 1024
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
TOUCHED = 1 << 48  # above any count: white space touches the front of a part


def _library(path: str) -> Any:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def whole_tokens(path: str) -> list[str]:
    """Strings of the vocabulary that the library encodes to one token, in the vocabulary's own letters.

    Strings that are no valid UTF-8 by themselves never stand alone in a text's pre-tokens and are left out.
    """
    tokenizer = _library(path)
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    kind = told["pre_tokenizer"] or {}
    if told["model"]["type"] != "BPE" or told["normalizer"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
        raise ValueError(f"{path} is no plain byte-level BPE")
    byte_of = {chr(letter): byte for byte, letter in _byte_letters().items()}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    out = []
    for letters in sorted(tokenizer.get_vocab()):
        if letters in special or not all(x in byte_of for x in letters):
            continue
        try:
            text = bytes(byte_of[x] for x in letters).decode()
        except UnicodeDecodeError:
            continue
        if len(tokenizer.encode(text, add_special_tokens=False).ids) == 1:
            out.append(letters)
    return out


class TokenCounter:
    """Counts of texts, with a memory of bounded size for parts that had to be looked into."""

    def __init__(self, path: str, whole: list[str]) -> None:
        tokenizer = _library(path)
        added = tokenizer.get_added_tokens_decoder().values()
        self.tokenizer = tokenizer
        self.special = re.compile("|".join(re.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content)))) if added else None
        self.plain_special = not any(t.lstrip or t.rstrip or t.single_word for t in added)
        pieces = _Pieces(tokenizer, frozenset(whole))
        self.pieces, self.after_blank = _Counts(pieces.count), _Counts(pieces.count_after_blank)

    def count(self, text: str) -> int:
        if self.special is not None and self.special.search(text):
            if not self.plain_special:
                return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            between = self.special.split(text)
            return len(between) - 1 + sum(self._count(x) for x in between)
        return self._count(text)

    def _count(self, text: str) -> int:
        first, *rest = text.split(" ")
        n = (self.pieces[first] if first else 0) + sum(map(self.after_blank.__getitem__, rest))
        if n >= TOUCHED:
            n = sum(map(self.pieces.__getitem__, PIECES.findall(text)))
        self.pieces.forget()
        self.after_blank.forget()
        return n


class _Pieces:
    """Counts of pieces that are made of whole pre-tokens."""

    def __init__(self, tokenizer: Any, whole: frozenset[str]) -> None:
        self.whole, self.merge, self.cut = whole, tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = _byte_letters()

    def count(self, piece: str) -> int:
        plain = PLAIN.fullmatch(piece)
        if plain is None:
            return sum(self.pre_token(letters) for letters, _ in self.cut(piece))
        return self.pre_token(self.spelled(plain[1])) + (self.pre_token(plain[2]) if plain[2] else 0)

    def count_after_blank(self, part: str) -> int:
        return TOUCHED if FRONT.match(part) else self.count(" " + part)

    def pre_token(self, letters: str) -> int:
        return 1 if letters in self.whole else len(self.merge(letters))

    def spelled(self, run: str) -> str:
        return run.replace(" ", "Ġ") if run.isascii() else run.encode().decode("latin-1").translate(self.letters)


class _Counts(dict[str, int]):
    """A memory of two generations; the older one is forgotten when the younger is full."""

    def __init__(self, count: Any) -> None:
        super().__init__()
        self.find, self.older = count, {}

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            n = self.find(piece)
        if len(piece) <= LONGEST_KEPT:
            self[piece] = n
        return n

    def forget(self) -> None:
        if len(self) > GENERATION:
            self.older = dict(self)
            self.clear()


_COUNTERS: dict[str, TokenCounter] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes in UTF-8, n_tokens, and whether those are more than ``limit``."""
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if tokenizer_path not in _COUNTERS:
            _COUNTERS[tokenizer_path] = TokenCounter(tokenizer_path, proven.value)
        count = _COUNTERS[tokenizer_path].count
        n = pa.array([0 if t is None else count(t) for t in batch.column(1).to_pylist()], pa.int64())
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_slices(id_and_text(docs, id_column, text_column), work, SCHEMA)
