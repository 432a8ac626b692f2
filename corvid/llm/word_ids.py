"""Ids of a word-end BPE tokenizer file, word by word.

Its normalizer makes every white space a separator and its pattern never joins
what a separator parts, so a text is cut at ASCII white space and each distinct
word encoded once. Words of Latin letters go straight to the merges (the
library's normalizer and pattern cost more than the merges do); a mark
behind a run of letters is a token of its own; all other words go through the
library, and a text with the beginning of a special token is encoded whole.
"""

from __future__ import annotations

from array import array

CACHE_BYTES = 48 << 20
ENTRY_BYTES = 200  # a word, its ids and their place in the dictionary


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordIds:
    LAST_LATIN = "ɏ"  # below U+0300 nothing composes
    MARKS = (b".", b",")

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.merges = self.lib.model.tokenize
        self.letters = byte_letters()
        self.limit = cache_bytes // ENTRY_BYTES
        self.words: dict[bytes, bytes] = {}
        self.marks = {m: self.whole(m.decode()) for m in self.MARKS}

    def whole(self, text: str) -> bytes:
        return array("I", self.lib.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> str:
        """A run of Latin letters in lower case; '' for any other word."""
        low = word.lower() if word.isalpha() and max(word) <= self.LAST_LATIN else ""
        return low if low.isalpha() and max(low) <= self.LAST_LATIN else ""

    def _word(self, raw: bytes) -> bytes:
        """``raw``: a word in ASCII lower case."""
        word = raw.decode()
        low = self._letters(word)
        if low:
            spelt = low.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.merges(spelt)]).tobytes()
        if raw[-1:] in self.marks and self._letters(word[:-1]):
            return self._of(raw[:-1]) + self.marks[raw[-1:]]
        return self.whole(word)

    def _of(self, raw: bytes) -> bytes:
        found = self.words.get(raw)
        return self._word(raw) if found is None else found

    def encode(self, raw: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian 32-bit integers."""
        if b"<|" in raw:
            return self.whole(raw.decode())
        words = raw.lower().split()  # bytes: ASCII only
        known, room = self.words, self.limit - len(self.words)
        new = set(words).difference(known)
        if len(new) <= room:
            for w in new:
                known[w] = self._word(w)
            return b"".join(map(known.__getitem__, words))
        # The cache is full: this text's new words are not kept.
        once = {w: self._word(w) for w in new}
        return b"".join([known[w] if w in known else once[w] for w in words])
