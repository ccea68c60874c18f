"""Token ids of whole texts as little-endian unsigned 32-bit bytes.

A tokenizer that drops white space encodes every stretch between blanks on its
own, so its ids can be kept per stretch. Arrow splits a group of texts and
numbers its distinct stretches; Python sees each of those once, and numpy
gathers the ids of all texts by number. The cache is bounded and lives per
Python worker.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 150_000
MARKS = ".,;:!?%$&*#|<>"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SLICE = 3_000_000
GROUP = 4000
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    def __init__(self, path: str, drops_white_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_white_space = drops_white_space
        # Ids of stretches in two generations: a full one becomes the older, which goes.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters: dict[str, bool] = {}
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        # Only where the tokenizer folds case itself.
        self.folds = self._batch(["A"]) == self._batch(["a"])
        self.model = self._model(vocab)

    def _model(self, vocab: dict[str, int]):
        """The tokenizer's model behind a split at blanks, for words of a to z; the whole tokenizer if the two differ on its own pieces."""
        from tokenizers import Tokenizer, pre_tokenizers

        bare = Tokenizer(self.tokenizer.model)  # shares it
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        known = sorted(w for piece in vocab if (w := piece.removesuffix("</w>")).isascii() and w.isalpha() and w.islower())
        trial = " ".join([*known[::1 + len(known) // 2000], *LETTERS])
        same = [t.encode(trial, add_special_tokens=False).ids for t in (self.tokenizer, bare)]
        return bare if same[0] == same[1] else self.tokenizer

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], tokenizer) -> list[bytes]:
        """Ids of single words of letters: joined by blanks, and cut after each id that ends a word."""
        out = []
        for lo in range(0, len(words), 1000):
            part = words[lo:lo + 1000]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                out += self._batch(part)  # a word that falls into several pre-tokens
                continue
            raw, at = ids.tobytes(), (ends * 4).tolist()
            out += [raw[lo:hi] for lo, hi in zip([0, *at[:-1]], at, strict=True)]
        return out

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of a to z."""
        return self._words(words, self.model)

    def _others(self, chunks: list[str]) -> list[bytes]:
        """Ids of any other stretches: letters and then marks are two pre-tokens."""
        heads = [h if (h := c.rstrip(MARKS)).isalpha() and self._ends_in_letter(h[-1]) else c for c in chunks]
        tails = [c[len(h):] for c, h in zip(chunks, heads, strict=True)]
        need = {*heads, *tails}
        words, other = [w for w in need if w.isalpha()], [w for w in need if not w.isalpha()]
        ids = dict(zip([*words, *other], [*self._words(words, self.tokenizer), *self._batch(other)], strict=True))
        return [ids[h] + ids[t] for h, t in zip(heads, tails, strict=True)]

    def _known(self, chunks: list[str], encode) -> list[bytes]:
        """Ids of distinct stretches, from the cache or else from ``encode``."""
        if len(self.cache) > CACHE:
            self.cache, self.older = {}, self.cache
        found = list(map(self.cache.get, chunks))
        new = [k for k, x in enumerate(found) if x is None]
        again = list(map(self.older.get, [chunks[k] for k in new]))
        missing = [k for k, x in zip(new, again, strict=True) if x is None]
        fresh = iter(encode([chunks[k] for k in missing]))
        for k, x in zip(new, again, strict=True):
            found[k] = self.cache[chunks[k]] = next(fresh) if x is None else x
        return found

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches, joined, and how many each has. Marks behind a word of a to z are looked up on their own."""
        heads = pc.ascii_rtrim(chunks, MARKS)
        letters = pc.and_(pc.ascii_is_alpha(heads), pc.ascii_is_lower(heads))
        heads = pc.if_else(letters, heads, chunks).dictionary_encode()
        marks = pc.ascii_ltrim(chunks.filter(letters), LETTERS).dictionary_encode()
        letters = letters.to_numpy(zero_copy_only=False)
        place = heads.indices.to_numpy()
        plain = np.zeros(len(heads.dictionary), dtype=bool)
        plain[place[letters]] = True
        # Numbered anew: words of a to z, other stretches, marks, nothing.
        number = np.where(plain, np.cumsum(plain), np.cumsum(~plain) + plain.sum()) - 1
        known = [*self._known(heads.dictionary.filter(pa.array(plain)).to_pylist(), self._plain),
                 *self._known(heads.dictionary.filter(pa.array(~plain)).to_pylist(), self._others),
                 *self._known(marks.dictionary.to_pylist(), self._others), b""]
        pairs = np.full((len(chunks), 2), len(known) - 1)
        pairs[:, 0] = number[place]
        pairs[letters, 1] = marks.indices.to_numpy() + len(plain)
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        ids, lengths = _gathered(np.frombuffer(b"".join(known), dtype="<u4"), sizes, pairs.ravel())
        return ids, lengths.reshape(-1, 2).sum(axis=1)

    def _ends_in_letter(self, letter: str) -> bool:
        """Whether the tokenizer's own form of a letter ends in a letter; some end in a combining mark, which joins the marks behind."""
        known = self.letters.get(letter)
        if known is None:
            form = self.tokenizer.normalizer.normalize_str(letter) if self.tokenizer.normalizer else letter
            known = self.letters[letter] = form[-1:].isalpha()
        return known

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """One byte string of ids for each text, in order."""
        if not self.drops_white_space:
            for text in texts:
                yield self._batch([text])[0]
            return
        for lo in range(0, len(texts), GROUP):
            group, held = [], 0
            for text in texts[lo:lo + GROUP]:
                if len(text) > SLICE:  # a long text is worked through in stretches
                    yield from self._flush(group)
                    group, held = [], 0
                    yield b"".join(x for part in slices(text) for x in self._flush([part]))
                    continue
                group.append(text)
                held += len(text)
                if held > SLICE:
                    yield from self._flush(group)
                    group, held = [], 0
            yield from self._flush(group)

    def _flush(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        plain = [(_folded(t) if self.folds else t).replace("\n", " ") for t in texts]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        ids, sizes = self._distinct(coded.dictionary)
        ids, lengths = _gathered(ids, sizes, coded.indices.to_numpy())
        raw, ends = ids.tobytes(), np.cumsum(lengths)
        at = np.concatenate(([0], ends))[split.offsets.to_numpy()] * 4
        return [raw[lo:hi] for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _gathered(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` holds stretches of these sizes; joins the stretches of the given numbers. Also returns their sizes."""
    lengths = sizes[which]
    # Id k of the result lies so far on in ``ids`` as its own stretch does.
    moved = np.repeat((np.cumsum(sizes) - sizes)[which] - np.cumsum(lengths) + lengths, lengths)
    moved += np.arange(len(moved))
    return ids[moved], lengths


def _folded(text: str) -> str:
    """``text`` in lower case if that is a letter-by-letter matter, as the tokenizer folds it."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in stretches of about ``size`` characters, cut only at a blank."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut <= at:
            later = [x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x >= 0]
            if not later:
                break
            cut = min(later)
        yield text[at:cut]
        at = cut
    yield text[at:]


def encoder(path: str, drops_white_space: bool = True) -> Encoder:
    key = (path, drops_white_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def sentence_ends(path: str) -> list[int]:
    """Ids whose piece ends a sentence: a stop, exclamation or question mark at its end."""
    from tokenizers import Tokenizer

    return [i for piece, i in Tokenizer.from_file(path).get_vocab().items()
            if piece.removesuffix("</w>").rstrip("\"')").endswith((".", "!", "?"))]
