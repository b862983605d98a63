r"""SentencePiece encoding and decoding in batches of numpy.

Texts become words (a run of word marks and what follows up to the next mark), since no piece
crosses the start of a word.  Distinct words of equal length in characters are encoded
together: the hashes of all their substrings probe the sorted piece keys, which gives one
table of piece numbers by (word, start, length).  On it run

* for unigram models, Viterbi: the words advance one character at a time together, and a
  vectorised maximum over the pieces that end there stores the backpointers;
* for BPE models, merges: a Viterbi path over the pieces' scores is not what such a model
  means (its scores are merge ranks), so the words merge together, each the neighbours whose
  union ranks best, the leftmost of equals, by a vectorised maximum in each round.

Words over ``LONG_WORD`` characters merge one by one with a heap.  Characters without a piece
become byte pieces, or the unknown piece where the model has none.  Decoding gathers the
pieces' bytes, so encode and decode give the text back (a word mark in the text itself
becomes a space, as in the library).

Edge cases: null and empty texts have no pieces; white space is kept unless the model removes
extra spaces; a model with a character map for normalisation is refused; repeated rows and
null ids are handled row by row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import lean, prepare, table

MARK = "▁"
LONG_WORD = 64
#: Distinct words whose pieces a worker remembers; only a cache.
CACHE_WORDS = 200_000
#: A character that no piece covers costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0

#: Sorted piece keys are found by their first bits.
_BUCKET_BITS = 17

_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class PieceModel:
    """Pieces with scores and kinds, and the settings that encoding needs."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    bpe: bool
    dummy_prefix: bool = True
    one_space: bool = False
    keys: np.ndarray = field(init=False)
    key_ids: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        usable = np.flatnonzero(np.isin(self.kinds, (_NORMAL, _USER)))
        raw = [self.pieces[i].encode() for i in usable]
        buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in raw]).astype(np.int64)
        h = T.range_hash(T.prefix_hash(buf), ends - [len(x) for x in raw], ends)
        order = np.argsort(h)
        self.ranks = self.scores.astype(np.float32)  # merge ranks are small whole numbers
        self.keys, self.key_ids = h[order], usable[order].astype(np.int32)
        self.bucket = np.searchsorted(self.keys >> np.uint64(64 - _BUCKET_BITS), np.arange((1 << _BUCKET_BITS) + 1)).astype(np.int32)
        self.longest = max((len(self.pieces[i]) for i in usable), default=1)
        byte = np.flatnonzero(self.kinds == _BYTE)
        self.byte_ids = byte.astype(np.int32) if len(byte) == 256 else None
        unknown = np.flatnonzero(self.kinds == _UNKNOWN)
        self.unknown = int(unknown[0]) if len(unknown) else 0
        self.by_text = {self.pieces[i]: int(i) for i in usable}
        # bytes of each piece when decoded
        out = [bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else " ⁇ ".encode() if k == _UNKNOWN else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.out_bytes = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.out_start = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)
        self.floor = float(self.scores[usable].min()) - UNKNOWN_PENALTY if len(usable) else -UNKNOWN_PENALTY

    @staticmethod
    def from_file(path: str) -> PieceModel:
        pieces, scores, kinds, bpe, dummy, extra = [], [], [], False, True, True
        with open(path, "rb") as f:
            data = f.read()
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append(f.get(1, b"").decode())
                scores.append(np.frombuffer(f.get(2, b"\0\0\0\0"), dtype="<f4")[0])
                kinds.append(f.get(3, _NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, 1)
                if kind not in (1, 2):
                    raise ValueError("only unigram and BPE models are supported")
                bpe = kind == 2
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2):
                    raise ValueError("models with a character map are not supported")
                dummy, extra = bool(f.get(3, 1)), bool(f.get(4, 1))
        return PieceModel(pieces, np.array(scores, dtype=np.float64), np.array(kinds), bpe, dummy, extra)

    def prepare(self, text: str | None) -> str:
        """The text as it is cut into pieces."""
        if not text:
            return ""
        if self.one_space:
            text = " ".join(x for x in text.split(" ") if x)
            if not text:
                return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, or -1."""
        out = np.full(h.shape, -1, dtype=np.int32)
        bucket = (h >> np.uint64(64 - _BUCKET_BITS)).astype(np.int32)
        flat, at, end = h.ravel(), self.bucket[bucket].ravel(), self.bucket[bucket + 1].ravel()
        left = np.flatnonzero(at < end)
        # keys are sorted, so a bucket is a short run of them
        while len(left):
            place = at[left]
            hit = self.keys[place] == flat[left]
            out.ravel()[left[hit]] = self.key_ids[place[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out

    def _spell(self, chars: str) -> list[int]:
        """Ids of a character that no piece covers."""
        if self.byte_ids is None:
            return [self.unknown]
        return [int(self.byte_ids[b]) for b in chars.encode()]

    # words of one length, given the table of pieces (word, start, length - 1)

    def _merge(self, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, their boundaries) as BPE merges finish."""
        n, size, widest = table.shape
        rank = np.where(table >= 0, self.ranks[table], np.float32(-np.inf))
        rows, cuts = np.arange(n), np.broadcast_to(np.arange(size + 1), (n, size + 1)).copy()
        while len(rows):
            if cuts.shape[1] <= 2:
                yield rows, cuts
                return
            a, width = cuts[:, :-2], cuts[:, 2:] - cuts[:, :-2]
            score = np.where(width <= widest, rank[rows[:, None], a, np.minimum(width, widest) - 1], -np.inf)
            best = np.argmax(score, axis=1)
            more = score[np.arange(len(rows)), best] > -np.inf
            if not more.all():
                yield rows[~more], cuts[~more]
                rows, cuts, best = rows[more], cuts[more], best[more]
            if len(rows):
                gone = best[:, None] + 1
                cuts = np.where(np.arange(cuts.shape[1] - 1) < gone, cuts[:, :-1], cuts[:, 1:])

    def _viterbi(self, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, their boundaries) of the paths of highest score."""
        n, size, widest = table.shape
        weight = np.where(table >= 0, self.scores[table], -np.inf)
        alone = weight[:, :, 0]
        weight[:, :, 0] = np.where(np.isinf(alone), self.floor, alone)
        best, back = np.full((n, size + 1), -np.inf), np.zeros((n, size + 1), dtype=np.int64)
        best[:, 0] = 0
        for j in range(1, size + 1):
            starts = np.arange(max(0, j - widest), j)
            total = best[:, starts] + weight[:, starts, j - starts - 1]
            top = np.argmax(total, axis=1)
            best[:, j] = total[np.arange(n), top]
            back[:, j] = starts[top]
        paths: dict[int, tuple[list[int], list[list[int]]]] = {}
        for r in range(n):
            cut = [size]
            while cut[-1]:
                cut.append(int(back[r, cut[-1]]))
            rows, cuts = paths.setdefault(len(cut), ([], []))
            rows.append(r), cuts.append(cut[::-1])
        for rows, cuts in paths.values():
            yield np.array(rows), np.array(cuts)

    def merge_one(self, word: str) -> list[int]:
        """BPE of one long word with a heap of neighbour pairs."""
        n = len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[float, int, int, int]] = []

        def push(i: int) -> None:
            j = end[i]
            if j < n:
                piece = self.by_text.get(word[i : end[j]]) if end[j] - i <= self.longest else None
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], i, j, end[j]))

        for i in range(n):
            push(i)
        while heap:
            _, i, j, e = heapq.heappop(heap)
            if not alive[i] or end[i] != j or not alive[j] or end[j] != e:
                continue
            end[i], alive[j] = e, False
            if e < n:
                before[e] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        out: list[int] = []
        i = 0
        while i < n:
            piece = self.by_text.get(word[i : end[i]])
            out += self._spell(word[i : end[i]]) if piece is None else [piece]
            i = end[i]
        return out

    def _long(self, word: str) -> list[int]:
        if self.bpe:
            return self.merge_one(word)
        best, back = [0.0], [0]
        for j in range(1, len(word) + 1):
            top, at = -np.inf, j - 1
            for i in range(max(0, j - self.longest), j):
                piece = self.by_text.get(word[i:j])
                score = best[i] + (self.scores[piece] if piece is not None else self.floor if i == j - 1 else -np.inf)
                if score > top:
                    top, at = score, i
            best.append(top), back.append(at)
        cut = [len(word)]
        while cut[-1]:
            cut.append(back[cut[-1]])
        out: list[int] = []
        for i, j in zip(cut[::-1], cut[-2::-1], strict=False):
            piece = self.by_text.get(word[i:j])
            out += self._spell(word[i:j]) if piece is None else [piece]
        return out

    def encode_words(self, buf: np.ndarray, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, first id of each word and the total) of byte ranges."""
        lead = np.flatnonzero(buf & 0xC0 != 0x80)
        places = np.append(lead, len(buf))
        first = np.searchsorted(lead, start)
        chars = np.searchsorted(lead, end) - first
        sizes = np.zeros(len(start), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # words with as many pieces each

        def spelled(word: int, ids: list[int]) -> None:
            found.append((np.array([word]), np.array([ids], dtype=np.int32)))
            sizes[word] = len(ids)

        for size in np.unique(chars):
            mine = np.flatnonzero(chars == size)
            if size > LONG_WORD:
                for i in mine.tolist():
                    spelled(i, self._long(buf[start[i] : end[i]].tobytes().decode()))
                continue
            # a bound on the tables: about 10 MB
            step = max(1, 700_000 // int(size * min(size, self.longest)))
            for part in (mine[k : k + step] for k in range(0, len(mine), step)):
                edge = places[first[part][:, None] + np.arange(size + 1)]
                pieces = np.full((len(part), size, min(size, self.longest)), -1, dtype=np.int32)
                for w in range(1, pieces.shape[2] + 1):
                    pieces[:, : size - w + 1, w - 1] = self.find(T.range_hash(prefix, edge[:, : size - w + 1], edge[:, w:]))
                for rows, cuts in self._merge(pieces) if self.bpe else self._viterbi(pieces):
                    ids = pieces[rows[:, None], cuts[:, :-1], cuts[:, 1:] - cuts[:, :-1] - 1]
                    plain = (ids >= 0).all(axis=1)
                    words = part[rows[plain]]
                    sizes[words] = ids.shape[1]
                    found.append((words, ids[plain]))
                    for k in np.flatnonzero(~plain):
                        r, one = int(rows[k]), []
                        for c, x in enumerate(ids[k].tolist()):
                            one += [x] if x >= 0 else self._spell(buf[edge[r, cuts[k, c]] : edge[r, cuts[k, c + 1]]].tobytes().decode())
                        spelled(int(part[r]), one)
        at = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.zeros(at[-1], dtype=np.int32)
        for words, ids in found:
            flat[at[words][:, None] + np.arange(ids.shape[1])] = ids
        return flat, at

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of one sequence of pieces."""
        return self.decode_many(ids, np.array([0, len(ids)]))[0]

    def decode_many(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The bytes of each sequence ids[first[k]:first[k + 1]]."""
        start, size = self.out_start[ids], self.out_start[ids + 1] - self.out_start[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(start - total[:-1], size) + np.arange(total[-1])
        whole = self.out_bytes[at].tobytes()
        cut = total[first].tolist()
        parts = [whole[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        # the prefix that encoding put there
        return [x[1:] if self.dummy_prefix and x[:1] == b" " else x for x in parts]


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel.from_file(path)


class Encoder:
    """Encodes slices of texts, remembering words."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.hash, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, h: np.ndarray, flat: np.ndarray, first: np.ndarray) -> None:
        both = np.concatenate([self.hash, h])
        order = np.argsort(both, kind="stable")
        self.hash = both[order]
        self.at = np.concatenate([self.at, first[:-1] + len(self.flat)])[order]
        self.size = np.concatenate([self.size, np.diff(first)])[order]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, first id of each text and the total)."""
        ids, sizes = [], []
        for _, _, buf, offsets in T.text_slices(pa.array([self.model.prepare(t) for t in texts], pa.large_string()), T.SLICE_BYTES):
            prefix = T.prefix_hash(buf)
            mark = np.zeros(len(buf) + 3, dtype=bool)
            if len(buf) > 2:
                mark[: len(buf) - 2] = (buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)
            begins = mark[: len(buf)].copy()
            begins[3:] &= ~mark[: len(buf) - 3] if len(buf) > 3 else False
            begins[offsets[:-1][offsets[:-1] < len(buf)]] = True
            start = np.flatnonzero(begins)
            end = np.append(start[1:], len(buf)) if len(start) else start
            h, sample, which = np.unique(T.range_hash(prefix, start, end), return_index=True, return_inverse=True)
            if len(self.hash) > CACHE_WORDS:
                self._clear()
            known = np.searchsorted(self.hash, h)
            have = known < len(self.hash)
            have[have] = self.hash[known[have]] == h[have]
            new = np.flatnonzero(~have)
            if len(new):
                self._learn(h[new], *self.model.encode_words(buf, prefix, start[sample[new]], end[sample[new]]))
            place = np.searchsorted(self.hash, h)[which]
            size = self.size[place]
            total = np.concatenate([[0], np.cumsum(size)])
            ids.append(self.flat[np.repeat(self.at[place] - total[:-1], size) + np.arange(total[-1])])
            sizes.append(np.diff(total[np.searchsorted(start, offsets)]))
        first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), first


def encode_table(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, ids, ids_sha256, round_trip) of every row; ``model`` is the path of a .model file that workers can open.

    ids_sha256 is over the ids as little-endian 32-bit numbers; round_trip: decoding gives the text back.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        encoder = Encoder(pieces)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids, first = encoder.encode(texts)
            digest = [hashlib.sha256(ids[a:e].astype("<i4").tobytes()).hexdigest() for a, e in zip(first[:-1], first[1:], strict=True)]
            plain = lambda t: pieces.prepare(t).replace(MARK, " ").encode()[int(pieces.dummy_prefix) :]
            back = [x == plain(t) for x, t in zip(pieces.decode_many(ids, first), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)), pa.array(digest, pa.string()), pa.array(back, pa.bool_())], list("abcde"))

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), f"`{id_col}` {kind}, n_pieces long, ids array<int>, ids_sha256 string, round_trip boolean")


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_table(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that came this far."""
    import public_tokenizers

    return encode_table(docs, public_tokenizers.path("piece_bpe_32k.model"))
