"""Token ids of texts by a public tokenizer, with words tokenized once per worker.

The tokenizer ends tokens at white space and looks at nothing beyond a word, so ids of a text are
the ids of its words, cut at ASCII white space. The files of tokenizers are installed on every
machine; their path is a parameter.
"""

from __future__ import annotations

from array import array

# Words kept per worker; the table is emptied when it is full.
WORDS = 600_000
# A worker keeps a table of up to so many words for its next task, which may be of another kind.
RESTING_WORDS = 100_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(printable))
    return letters


class WordTokenizer:
    """Ids of texts as bytes, unsigned 32 bits each, in the order of bytes of the machine; no special tokens are added."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # The vocabulary's word pattern.
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        # Words of these characters are the same after Unicode normalization; others go the whole way.
        self.plain = regex.compile(r"[!-~¡-įĲ-ʯ]*").fullmatch
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        found = self.parts[part] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not (text.isascii() and text.isprintable() or self.plain(text)) or "<|" in text:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text, known = text.lower(), self.parts
        if text.isalpha():
            return known.get(text) or self._part(text)
        stem, last = text[:-1], text[-1]
        if stem.isalpha() and not last.isalpha():
            return (known.get(stem) or self._part(stem)) + (known.get(last) or self._part(last))
        return b"".join([known.get(x) or self._part(x) for x in self.pieces(text)])

    def ids(self, text: str | None) -> bytes:
        words = (text or "").encode().split()
        known = self.words
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > WORDS:
                known.clear()
                self.parts.clear()
                new = set(words)
            for w in new:
                known[w] = self._word(w)
        return b"".join([known[w] for w in words])

    def rest(self) -> None:
        """At the end of a task: a large table is emptied, so that an idle worker does not hold it."""
        if len(self.words) > RESTING_WORDS:
            self.words.clear()
            self.parts.clear()


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's own tokenizer of a file."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]
