"""Token ids of whole texts with a byte-level tokenizer file.

The byte-level pre-tokenizer cuts a text into words, numbers, punctuation and white space, and
each piece is encoded by itself. Most pieces are frequent, so their ids are kept in tables of
bounded size; the pieces that a batch of texts adds are encoded together. A text is first cut before single spaces between other characters, where every such
pre-tokenizer cuts. A part whose characters leave no doubt about their class is then cut by the
same pattern here; any other part goes to the tokenizer as it is. Words with white space at
either end are in no table, so a look-up that fails also tells where a text must not be cut.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Sequence

import numpy as np

# The letters whose class is the same in every version of Unicode tables that
# matters here, and the published pattern of the byte-level pre-tokenizer over them.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PATTERN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+"
)
_UNSURE = re.compile(rf"[^\x00-\x1B\x20-\x7F{_LETTER}]")
_CUT = re.compile(r"(?<=\S) (?=\S)")
MOST_WORDS, MOST_PIECES = 800_000, 200_000
TOGETHER = 20  # pieces in one call of the model

_loaded: dict[str, "Encoder"] = {}


def _byte_letters() -> str:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return "".join(out)


class Encoder:
    """Encodes texts as little-endian ids of ``width`` bytes."""

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        # Added tokens are found in the text before it is cut; texts with one go whole.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.letters = {b: c for b, c in enumerate(_byte_letters())}
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # A byte that no UTF-8 text has. Where no entry goes on from it, it keeps pieces apart.
        self.border = self.letters[0xFF]
        vocabulary = self.tokenizer.get_vocab()
        self.border_id = vocabulary.get(self.border)
        if sum(self.border in token for token in vocabulary) != 1:
            self.border_id = None

    @classmethod
    def of(cls, file: str) -> "Encoder":
        """The encoder of this process for a file."""
        if file not in _loaded:
            _loaded[file] = cls(file)
        return _loaded[file]

    def whole(self, text: str) -> bytes:
        """Ids of a text, encoded in one piece."""
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _packed(self, ids: Sequence[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of what the pre-tokenizer would not cut any further, for many at a time."""
        out: list[bytes] = []
        for at in range(0, len(pieces), TOGETHER):
            spelled = [piece.encode() for piece in pieces[at : at + TOGETHER]]
            if self.border_id is None:
                for s in spelled:
                    word = s.decode("latin-1").translate(self.letters)
                    out.append(self._packed([t.id for t in self.model.tokenize(word)]))
                continue
            joined = b"\xFF".join([*spelled, b""]).decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.model.tokenize(joined)], self.dtype)
            ends = np.flatnonzero(ids == self.border_id) * self.width
            data, ends = ids.tobytes(), ends.tolist()
            starts = [0, *[end + self.width for end in ends[:-1]]]
            out.extend([data[a:b] for a, b in zip(starts, ends)])
        return out

    def _learn_pieces(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.pieces))
        self.pieces.update(zip(new, self._pieces(new)))

    def _learn_words(self, words: set[str]) -> None:
        """Ids of words behind a space whose characters leave no doubt."""
        plain = [word for word in words if word.isalpha()]
        words = words.difference(plain)
        # Most others are a word and one sign behind it, which is a piece of its own.
        signed = [word for word in words if word[:-1].isalpha() and not word[-1].isspace()]
        cut = {
            word: _PATTERN.findall(" " + word)
            for word in words.difference(signed)
            if word and not word[0].isspace() and not word[-1].isspace()
        }
        stems = [word[:-1] for word in signed]
        plain.extend({stem for stem in stems if stem not in self.words}.difference(plain))
        self.words.update(zip(plain, self._pieces([" " + word for word in plain])))
        self._learn_pieces({piece for found in cut.values() for piece in found})
        self._learn_pieces({word[-1] for word in signed})
        for word, stem in zip(signed, stems):
            self.words[word] = self.words[stem] + self.pieces[word[-1]]
        for word, found in cut.items():
            self.words[word] = b"".join(map(self.pieces.__getitem__, found))

    def _cut(self, text: str) -> bytes:
        """Ids of a text, or a part of one, whose characters leave no doubt."""
        found = _PATTERN.findall(text)
        self._learn_pieces(set(found))
        return b"".join(map(self.pieces.__getitem__, found))

    def _part(self, part: str) -> bytes:
        """Ids of a part of a text that begins and ends where every pre-tokenizer cuts."""
        if part not in self.parts:
            self.parts[part] = self.whole(part) if _UNSURE.search(part) else self._cut(part)
        return self.parts[part]

    def _doubtful(self, text: str) -> bytes:
        first, *rest = _CUT.split(text)
        return self._part(first) + b"".join([self._part(" " + part) for part in rest])

    def one(self, text: str | None) -> bytes:
        return self([text])[0]

    def _encoded(self, texts: Sequence[str | None]) -> list[bytes]:
        out: list[bytes] = []
        open_texts: list[tuple[int, list[str], list[bytes | None]]] = []
        missing: set[str] = set()
        for i, text in enumerate(texts):
            out.append(b"")
            if not text:
                continue
            if self.added and self.added.search(text):
                out[i] = self.whole(text)
            elif _UNSURE.search(text):
                out[i] = self._doubtful(text)
            else:
                words = text.split(" ")
                ids = list(map(self.words.get, words))
                # No space stands before the first word.
                ids[0] = self._cut(words[0])
                if None in ids:
                    open_texts.append((i, words, ids))
                    missing.update([w for w, x in zip(words, ids) if x is None])
                else:
                    out[i] = b"".join(ids)
        self._learn_words(missing)
        for i, words, ids in open_texts:
            ids = [self.words.get(w) if x is None else x for w, x in zip(words, ids)]
            out[i] = self._cut(texts[i]) if None in ids else b"".join(ids)
        return out

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; none for NULL."""
        for table, most in ((self.words, MOST_WORDS), (self.pieces, MOST_PIECES), (self.parts, MOST_PIECES)):
            if len(table) > most:
                table.clear()
        # Nothing here is in a cycle; going through what is held again and again takes long.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collects:
                gc.enable()
