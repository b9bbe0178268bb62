"""Token ids of whole texts with a public vocabulary, word by word and remembered.

The vocabulary's normaliser and splitter never join across white space, so the ids of a text are the ids of its
words one after the other. Each distinct word goes through the library once per worker; memory is bounded.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

VOCABULARY = "word_bpe_49k.json"
#: Words of one generation. When it is full it becomes the old one, whose words move on only when they come again.
REMEMBERED = 250_000
#: Words longer than this are not remembered.
LONGEST = 64

# Words of these characters only are split and put in lower case here; they have no composed forms to normalise.
_KNOWN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
# The vocabulary's own splitter, for those characters.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
_CONTROLS = re.compile(r"[\x1c-\x1f]").search


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: visible ones as themselves, the others from code point 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


_BYTES = _byte_letters()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # as in the default pipeline: neither cut nor filled up
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.old_words = {}, {}  # str -> ids, four bytes each
        self.plain, self.old_plain = {}, {}
        self.table: list[str | None] | None = None

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, w: str) -> bytes:
        """Ids of one word (no ASCII white space inside), four bytes each."""
        got = self.words.get(w)
        if got is None:
            got = self.old_words.get(w)
            if got is None:
                got = self._word(w)
            if len(w) <= LONGEST:
                if len(self.words) >= REMEMBERED:
                    self.words, self.old_words = {}, self.words
                self.words[w] = got
        return got

    def _word(self, w: str) -> bytes:
        # printable ASCII without a blank is within the known characters
        if not (w.isascii() and w.isprintable()) and not _KNOWN(w) or "<|" in w:
            return self._library(w)
        if w.isalpha():
            return self._piece(w.lower())
        return b"".join([self._piece(x) for x in _PIECES(w.lower())])

    def _piece(self, x: str) -> bytes:
        """Ids of what the vocabulary's splitter takes as one piece."""
        got = self.plain.get(x)
        if got is None:
            got = self.old_plain.get(x)
            if got is None:
                shown = x if x.isascii() else "".join([_BYTES[b] for b in x.encode()])
                got = _packed([t.id for t in self.tokenizer.model.tokenize(shown)])
            if len(x) <= LONGEST:
                if len(self.plain) >= REMEMBERED:
                    self.plain, self.old_plain = {}, self.plain
                self.plain[x] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, four bytes each."""
        words = _split(text)
        found = list(map(self.words.get, words))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = self.word(words[i])
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode gives for this vocabulary: the tokens joined by blanks."""
        if self.table is None:
            size = self.tokenizer.get_vocab_size()
            self.table = [self.tokenizer.id_to_token(i) for i in range(size)]
        table = self.table
        return " ".join([table[i] for i in ids.tolist()])


def _split(text: str) -> list[str]:
    """Words between white space; str.split() takes four control characters more, which are none to the vocabulary."""
    return text.split(" ") if _CONTROLS(text) else text.split()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process, with what it remembers."""
    return WordEncoder(path)
