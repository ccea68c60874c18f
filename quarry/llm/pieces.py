"""SentencePiece encoding and decoding in numpy batches.

A text becomes a run of words (blanks stand as a mark in front of a word). No
piece of the file spans two words, so distinct words are encoded once and a
text is a join of byte strings. Words of equal length form one matrix and
advance together; the hash of a substring comes from prefix hashes and is
looked up among the sorted hashes of the pieces.

Both segmentations are one recurrence by position with vectorised maxima and
backpointers; they differ in what a step counts:

* ``scores`` (unigram piece files): the piece's score; the greatest sum wins,
  ties to the longest last piece.
* ``ranks`` (piece files of merge ranks, type BPE): 0 if the piece may follow
  the last piece of the best path at its start, else minus infinity. Two pieces
  may stand side by side if merging their characters ends in just these two;
  this is read off by undoing the later of their last merges, step by step, and
  looking for an earlier merge across the border. A path whose neighbours all
  may stand side by side is what merging the whole word gives, and each prefix
  of a word has exactly one, so the maximum over the starts is unique.

Characters without a piece become their UTF-8 byte pieces (or the unknown id).
Decoding joins pieces, bytes and blanks and drops the blank put in front.

Defined results: null or empty text has no ids; the blank mark in a text
decodes as a blank; words beyond ``LONG`` characters take the same recurrence
one by one, and long texts go through in batches of whole words, so that no
result depends on a length; repeated rows are coded each; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import col

MARK = "▁"
WORD = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
LONG = 64
CACHE = 200_000
CELLS = 200_000
BATCH = 300_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
NONE = -np.inf
UNSEEN = -1e12  # a character without a piece; below any sum of scores
NEVER = 2**31 - 1  # rank of no merge


class PieceFile:
    """Pieces of a model file and the two segmentations over them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.unknown = model.unk_id()
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: model.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids))
        hashes = np.array([self._hash(p) for p in self.ids], dtype=np.uint64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        self.score_at = np.append(np.array([self.scores[p] for p in self.ids])[order], NONE)  # place -1 is the last
        self.id_at = np.append(np.array(list(self.ids.values()))[order], -1)
        place = np.arange(len(self.keys), dtype=np.int32)
        slot = (self.keys * SPREAD) >> np.uint64(44)
        self.slots = np.full(1 << 20, -1, dtype=np.int32)
        self.slots[slot] = place
        self.shared_at = place[(self.slots[slot] != place) | (place == 0)]  # pieces without a slot of their own (and one more: never empty)
        self.shared = self.keys[self.shared_at]
        self._rank([p for _, p in sorted(zip(hashes.tolist(), self.ids, strict=True))])
        self.bytes_of = [b""] * n
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        for p, i in self.ids.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        self.caches: dict[str, dict[str, bytes]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _rank(self, pieces: list[str]) -> None:
        """Ranks of merges (0: a character) and the two halves of each piece's last merge, by place; ``pieces`` by place."""
        place = {p: k for k, p in enumerate(pieces)}
        merged = [p for p in pieces if len(p) > 1]
        self.rank_at = np.zeros(len(pieces) + 1, dtype=np.int64)
        order = {score: k for k, score in enumerate(sorted({self.scores[p] for p in merged}, reverse=True), 1)}
        self.rank_at[[place[p] for p in merged]] = [order[self.scores[p]] for p in merged]
        self.rank_at[-1] = NEVER
        self.size_at = np.array([*map(len, pieces), 0])
        self.halves = np.full((len(pieces) + 1, 2), -1)
        self.usable = np.ones(len(pieces) + 1, dtype=bool)
        for p in merged:
            cut = self._last_merge(p)
            if cut:
                self.halves[place[p]] = place[p[:cut]], place[p[cut:]]
            else:  # merging its characters ends elsewhere: never a result
                self.usable[place[p]] = False
        self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(self.longest, BASE, dtype=np.uint64))), dtype=np.uint64)

    def _last_merge(self, piece: str) -> int:
        """Where the last merge of ``piece`` joins its halves; 0 if merging doesn't end in the piece."""
        n = len(piece)
        end, before, last = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        heap = [(-self.scores[piece[k:k + 2]], k, k + 1, k + 2) for k in range(n - 1) if piece[k:k + 2] in self.scores]
        heapq.heapify(heap)
        while heap:
            _, at, middle, stop = heapq.heappop(heap)
            if end[at] != middle or end[middle] != stop:
                continue
            end[at], end[middle], last = stop, 0, middle
            if stop < n:
                before[stop] = at
            for left, right in ((at, stop), (before[at], at)):
                if left >= 0 and right < n and (p := piece[left:end[right]]) in self.scores:
                    heapq.heappush(heap, (-self.scores[p], left, right, end[right]))
        return last if end[0] == n else 0

    @staticmethod
    def _hash(piece: str) -> int:
        total = 0
        for c in piece:
            total = (total * int(BASE) + ord(c) + 1) & (2**64 - 1)
        return total

    def probe(self, h: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
        """Places of substring hashes (of ``size`` characters, if given) among the sorted piece keys, -1 where there is no such piece."""
        out = np.full(len(h), -1, dtype=np.int32)
        at = self.slots[((h * SPREAD) >> np.uint64(44)).view(np.int64)]
        some = np.flatnonzero(at >= 0)
        at = at[some]
        hit = self.keys[at] == h[some]
        other = np.flatnonzero(~hit)  # another piece's slot: few pieces share one
        if len(other):
            found = np.minimum(np.searchsorted(self.shared, h[some[other]]), len(self.shared) - 1)
            same = self.shared[found] == h[some[other]]
            at[other[same]], hit[other[same]] = self.shared_at[found[same]], True
        if size is not None:
            hit &= self.size_at[at] == size[some]
        out[some[hit]] = at[hit]
        return out

    @staticmethod
    def _prefixes(words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), length)
        prefix = np.zeros((len(words), length + 1), dtype=np.uint64)
        for k in range(length):
            prefix[:, k + 1] = prefix[:, k] * BASE + codes[:, k] + np.uint64(1)
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(length, BASE, dtype=np.uint64))), dtype=np.uint64)
        return prefix, power

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two pieces (by place) ends in just these two."""
        out = np.ones(len(left), dtype=bool)
        live, a, b, limit = np.arange(len(left)), left, right, np.full(len(left), NEVER)
        while len(live):
            across = self.rank_at[self.probe(self.keys[a] * self.powers[self.size_at[b]] + self.keys[b], self.size_at[a] + self.size_at[b])]
            out[live[across < limit]] = False
            rank_a, rank_b = self.rank_at[a], self.rank_at[b]
            go = (across >= limit) & ((rank_a > 0) | (rank_b > 0))
            live, a, b, rank_a, rank_b = live[go], a[go], b[go], rank_a[go], rank_b[go]
            undo_left = rank_a > rank_b  # the later merge; at one rank the left one came first
            limit = np.where(undo_left, rank_a, rank_b + 1)
            a, b = np.where(undo_left, self.halves[a, 1], a), np.where(undo_left, b, self.halves[b, 0])
        return out

    def segment(self, prefix: np.ndarray, power: np.ndarray, how: str) -> np.ndarray:
        """(words, length) end of the piece that starts at each position on the best path, 0 where none starts."""
        n, length = len(prefix), prefix.shape[1] - 1
        best = np.full((length + 1, n), NONE)
        best[0] = 0.0
        back = np.zeros((length + 1, n), dtype=np.int32)
        last = np.full((length + 1, n), -1, dtype=np.int32)  # place of the last piece, -1 at the start and for a character without one
        columns = np.ascontiguousarray(prefix.T)
        for end in range(1, length + 1):
            low = max(0, end - self.longest)
            place = self.probe((columns[end] - columns[low:end] * power[end - low:0:-1, None]).ravel()).reshape(end - low, n)
            some = place >= 0
            some[-1] = True  # one character, also without a piece
            start, row = np.nonzero(some)
            place, start = place[start, row], start.astype(np.int32) + np.int32(low)
            before = last[start, row]
            if how == "scores":
                gain = np.where(place >= 0, self.score_at[place], UNSEEN)
            else:
                gain = np.where(self.usable[place], 0.0, NONE)
                both = np.flatnonzero((before >= 0) & (place >= 0))
                gain[both[~self.follows(before[both], place[both])]] = NONE
            total = best[start, row] + gain
            np.maximum.at(best[end], row, total)
            won = np.flatnonzero((total == best[end][row]) & (total > NONE))[::-1]  # at a tie the earliest start, so the longest piece
            back[end][row[won]], last[end][row[won]] = start[won], place[won]
        ends = np.zeros((n, length), dtype=np.int64)
        live, at = np.arange(n), np.full(n, length)
        while len(live):
            start = back[at, live]
            ends[live, start] = at
            live, at = live[start > 0], start[start > 0]
        return ends

    def _pair(self, left: str, right: str) -> bool:
        """``follows`` for two pieces by name, remembered."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            places = self.probe(np.array([self._hash(left), self._hash(right)], dtype=np.uint64))
            known = self.pairs[left, right] = bool(self.follows(places[:1], places[1:])[0])
        return known

    def _long(self, word: str, how: str) -> list[str]:
        """The same recurrence for one long word."""
        n = len(word)
        best, back, last = [0.0] + [NONE] * n, [0] * (n + 1), [""] * (n + 1)
        usable = {p for p in {word[i:j] for i in range(n) for j in range(i + 1, min(n, i + self.longest) + 1)} if p in self.scores
                  and (how == "scores" or self.usable[self.probe(np.array([self._hash(p)], dtype=np.uint64))[0]])}
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                piece = word[start:end]
                if piece not in usable:
                    if end - start > 1 or piece in self.scores:
                        continue
                    piece, gain = "", UNSEEN if how == "scores" else 0.0
                elif how == "scores":
                    gain = self.scores[piece]
                else:
                    gain = 0.0 if not last[start] or self._pair(last[start], piece) else NONE
                if best[start] + gain > best[end]:
                    best[end], back[end], last[end] = best[start] + gain, start, piece
        out, end = [], n
        while end:
            out.append(word[back[end]:end])
            end = back[end]
        return out[::-1]

    def _ids(self, pieces: list[str]) -> bytes:
        out = array("I")
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out.tobytes()

    def words(self, words: list[str], how: str) -> dict[str, bytes]:
        """Ids of distinct words; words of equal length advance together."""
        out: dict[str, bytes] = {}
        groups: dict[int, list[str]] = {}
        for w in words:
            groups.setdefault(len(w), []).append(w)
        for length, group in groups.items():
            if length > LONG:
                out.update((w, self._ids(self._long(w, how))) for w in group)
                continue
            most = max(1, CELLS // length)
            for lo in range(0, len(group), most):
                part = group[lo:lo + most]
                prefix, power = self._prefixes(part, length)
                ends = self.segment(prefix, power, how)
                row, start = np.nonzero(ends)
                stop = ends[row, start]
                ids = self.id_at[self.probe(prefix[row, stop] - prefix[row, start] * power[stop - start])]
                at = (np.searchsorted(row, np.arange(len(part) + 1)) * 4).tolist()
                raw = ids.astype("<u4").tobytes()
                out.update((w, raw[a:b]) for w, a, b in zip(part, at[:-1], at[1:], strict=True))
                for k in np.unique(row[ids < 0]).tolist():  # words with a character that has no piece
                    mine = slice(at[k] // 4, at[k + 1] // 4)
                    out[part[k]] = self._ids([part[k][a:b] for a, b in zip(start[mine].tolist(), stop[mine].tolist(), strict=True)])
        return out

    def encode(self, texts: list[str], how: str) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        for lo in range(0, len(texts), 1000):
            found = [WORD.finditer((MARK + t).replace(" ", MARK)) if t else iter(()) for t in texts[lo:lo + 1000]]
            parts: list[list[bytes]] = [[] for _ in found]
            held: list[tuple[int, list[str]]] = []
            n = 0
            for k, words in enumerate(found):
                while some := [m.group() for m in islice(words, BATCH - n)]:
                    held.append((k, some))
                    n += len(some)
                    if n == BATCH:
                        self._flush(held, parts, how)
                        held, n = [], 0
            self._flush(held, parts, how)
            yield from map(b"".join, parts)

    def _flush(self, held: list[tuple[int, list[str]]], parts: list[list[bytes]], how: str) -> None:
        """Add the ids of stretches of words to their texts."""
        cache = self.caches.setdefault(how, {})
        need = set().union(*(words for _, words in held))
        missing = [w for w in need if w not in cache]
        if len(cache) + len(missing) > CACHE:  # words of this stretch stay, since common words are among them
            kept = {w: cache[w] for w in need if w in cache}
            cache.clear()
            cache.update(kept)
        cache.update(self.words(missing, how))
        for k, words in held:
            parts[k].append(b"".join(map(cache.__getitem__, words)))

    def decode(self, ids: bytes) -> str:
        """The text of an id string."""
        text = b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode(errors="replace")
        return text.removeprefix(" ")


_FILES: dict[str, PieceFile] = {}


def piece_file(path: str) -> PieceFile:
    if path not in _FILES:
        _FILES[path] = PieceFile(path)
    return _FILES[path]


def encode_pieces(text: Column | str, path: str, how: str = "ranks") -> Column:
    """Column function: ids of a text column; ``how`` is ``scores`` (unigram files) or ``ranks`` (BPE files)."""
    if how not in ("scores", "ranks"):
        raise ValueError(how)

    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        rows = ["" if t is None else t for t in texts.to_pylist()]
        return pa.array(list(piece_file(path).encode(rows, how)), pa.binary())

    return encode(text)


def coded_digests(docs: DataFrame, path: str, keep: list[str], text_col: str = "text", how: str = "ranks") -> DataFrame:
    """The columns ``keep`` with n_ids, the ids' crc32 and whether they decode to the text again, in one pass that hands on no ids."""
    digests = ["n_ids", "ids_crc32", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = piece_file(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = ["" if t is None else t for t in part.column(part.num_columns - 1).to_pylist()]
                rows = [(len(ids) // 4, zlib.crc32(ids), file.decode(ids) == t.replace(MARK, " ")) for t, ids in zip(texts, file.encode(texts, how), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, zip(*rows, strict=True))], names=[*keep, *digests])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, t) for c, t in zip(
        digests, (T.LongType(), T.LongType(), T.BooleanType()), strict=True)])
    return docs.select(*[col(c) for c in keep], col(text_col)).mapInArrow(run, schema)


def decode_pieces(ids: Column | str, path: str) -> Column:
    """Column function: text of an id column; null stays null."""
    @F.arrow_udf(T.StringType())
    def decode(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else piece_file(path).decode(x) for x in column.to_pylist()], pa.string())

    return decode(ids)
