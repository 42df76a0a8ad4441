"""Token ids of a public BPE tokenizer, with a cache of text pieces.

Both tokenizer families of this module cut a text into pre-tokens before any merge, and never across a blank that follows
a non-blank and precedes one.  So the ids of a text are the ids of its pieces between such places, one after the other.
Pieces repeat; their ids come from the tokenizers library once and from a bounded cache afterwards.  A piece that is a
single word goes to the library's merge model directly, any other through the whole tokenizer.
"""

import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

CACHE_PIECES = 600_000
TEXTS_AT_ONCE = 250
LONG_PIECE = 48
TAILS = 4096

# White space and marks other than one blank or one line feed between words; NUL serves as a mark below.
_ODD = re.compile("[\0\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
# A full stop or comma after anything but a letter or digit may belong to a longer run of marks.
_MARKS = re.compile(r"[.,](?<![^\W_][.,])")

# Letters and then marks, none of which is an apostrophe: contractions are pre-tokens too.
_WORD_AND_MARKS = re.compile(r"( ?[^\W\d_]+)([!-&(-/:-@\[-`{-~]{1,12})")

# The alphabet of byte-level models: printable bytes stand for themselves, the others for characters from 256 on, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_ALPHABET = {byte: chr(256 + n) for n, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK = _BYTE_ALPHABET[0x20]


class _Pieces(dict):
    """Ids by piece; a piece that is not there is learned, and kept unless it is long."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self.learn(piece)
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids


class PieceTokenizer:
    """Ids of texts under one tokenizer definition (the JSON text of the tokenizers library).

    As in the library, the string of a special token in a text is that token; with `plain_specials` it is ordinary text.
    `drops_blanks` is true for a tokenizer whose pre-tokens hold no white space at all.
    """

    def __init__(self, definition: str, plain_specials: bool = False, cache_pieces: int | None = None):
        self.cache_pieces = CACHE_PIECES if cache_pieces is None else cache_pieces
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = plain_specials
        self.model = self.tokenizer.model  # the attribute makes a new object at each use
        # A text that may hold one of these, in any case, goes through the library whole.
        self.specials = [] if plain_specials else [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.drops_blanks = self.tokenizer.normalizer is not None
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        self.young = _Pieces(self._learn)
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}  # runs of marks that end a word: few, and short

    def pieces(self, text: str) -> list[str]:
        if _ODD.search(text) or any(pair in text for pair in _PAIRS) or text[:1] in ("", " ", "\n") or text[-1] in " \n":
            return _SAFE_CUT.split(text)
        if self.lowers:
            text = text.encode().lower().decode()  # A-Z only, which no other step of the normaliser sees
        if self.drops_blanks:
            cut = " " + text.replace("\n", " ").replace(" ", "\0 ")
        else:
            cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
        if not _MARKS.search(text):
            cut = cut.replace(".\0", "\0.\0").replace(",\0", "\0,\0")
        return cut.split("\0")

    def _word(self, piece: str) -> str | None:
        """What the model reads of a piece that is one pre-token of letters, in the byte alphabet; None for any other."""
        blank = piece[:1] == " "
        letters = piece[1:] if blank else piece
        if not letters.isalpha() or len(piece) > LONG_PIECE:
            return None
        if not letters.isascii():
            if self.lowers and not (letters == letters.lower() and unicodedata.is_normalized("NFC", letters)):
                return None
            letters = letters.encode().decode("latin-1").translate(_BYTE_ALPHABET)
        elif self.lowers and not letters.islower():
            return None
        return _BLANK + letters if blank and not self.drops_blanks else letters

    def _model_ids(self, word: str) -> bytes:
        return array(self.code, [token.id for token in self.model.tokenize(word)]).tobytes()

    def _tail(self, marks: str) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = np.array(self.tokenizer.encode(marks, add_special_tokens=False).ids, self.kind).tobytes()
            if len(self.tails) < TAILS:
                self.tails[marks] = ids
        return ids

    def _learn(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is not None:
            return ids
        word = self._word(piece)
        if word is not None:
            return self._model_ids(word)
        cut = _WORD_AND_MARKS.fullmatch(piece)
        if cut and (word := self._word(cut[1])) is not None:
            return self._model_ids(word) + self._tail(cut[2])  # letters and marks are pre-tokens of their own
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.kind).tobytes()

    def _holds_special(self, text: str) -> bool:
        lowered = text.lower()
        return any(special in lowered for special in self.specials)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned integers of 16 or 32 bits."""
        encoded: list[np.ndarray] = []
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            encoded += self._encode(texts[start : start + TEXTS_AT_ONCE])
        return encoded

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.young) > self.cache_pieces:
            self.old, self.young = self.young, _Pieces(self._learn)
        get, encoded = self.young.__getitem__, []
        for text in texts:
            if self._holds_special(text):
                encoded.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind))
            else:
                encoded.append(np.frombuffer(b"".join(map(get, self.pieces(text))), self.kind))
        return encoded


@cache
def _loaded(definition: str, plain_specials: bool, cache_pieces: int | None) -> PieceTokenizer:
    return PieceTokenizer(definition, plain_specials, cache_pieces)


class SharedTokenizer:
    """A tokenizer file of the driver, sent to the executors once; its few megabytes do not grow with the data."""

    MAX_BYTES = 64 << 20

    def __init__(self, spark: SparkSession, path: str, plain_specials: bool = False, cache_pieces: int | None = None):
        self.plain_specials, self.cache_pieces = plain_specials, cache_pieces
        with open(path, encoding="utf-8") as file:
            definition = file.read(self.MAX_BYTES + 1)
        if len(definition) > self.MAX_BYTES:
            raise ValueError(f"{path} is too large to send to every executor")
        self.sent = spark.sparkContext.broadcast(definition)

    def get(self) -> PieceTokenizer:
        return _loaded(self.sent.value, self.plain_specials, self.cache_pieces)
