r"""LM scoring with a weighted backoff automaton over word n-grams.

Learning: documents are dealt into blocks of about ``BLOCK_BYTES`` of text.  Each block sends
the hashes and training counts of its distinct n-grams, packed and sorted, to shards by hash
range; a shard merges what all blocks sent and answers each block with the corpus counts of
exactly the n-grams that it asked about.  So a block holds the part of the automaton that its
own texts can reach, and nothing of the size of the model meets on one machine or the driver;
since an n-gram comes once from each block, a frequent one makes no hot shard.

Automaton: the states are the contexts seen in training.  An n-gram (context, word) is an arc
with weight log10 ((c(context, word) + mu * P_lower(word)) / (c(context) + mu)); a state's
failure arc to the next shorter context weighs log10 (mu / (c(context) + mu)).  At the root,
words have the absolute-discounting probability (c - D) / N, and any word unseen in training
the rest, D * V / N.  Every state's probabilities sum to one.  One left-to-right traversal
carries the state along each text, follows an arc or failure arcs, and adds the weights.

Edge cases: a null or empty text is the end token alone; a null id counts as an empty string
for the split and may repeat; without training documents every token is unseen, with weight 0;
repeated rows are separate documents; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import prepare, saved, table

ORDER, MU = 2, 50.0
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 16 << 20
_BEGIN, _END = (int(x) for x in T.mix64(np.array([11, 12], dtype=np.uint64)))


class Grams:
    """The token sequences of some texts and, for each order, their distinct n-grams."""

    def __init__(self, texts: pa.ChunkedArray, train: np.ndarray, order: int):
        seqs, rows, at = [], [], 0
        for lo, hi, buf, offsets in T.text_slices(texts):
            words = T.runs(T.LOWER[buf], offsets, T.NOT_SPACE)
            n = hi - lo
            # each text is begin, its words, end
            seq = np.full(len(words) + 2 * n, _END, dtype=np.uint64)
            seq[words.first[:-1] + 2 * np.arange(n)] = _BEGIN
            seq[np.arange(len(words)) + 2 * words.row + 1] = words.hash
            seqs.append(seq)
            rows.append(at + np.repeat(np.arange(n), words.per_row() + 2))
            at += n
        self.n_texts = at
        self.seq = np.concatenate(seqs) if seqs else np.zeros(0, np.uint64)
        self.row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.begin = self.seq == np.uint64(_BEGIN)
        self.start: list[np.ndarray] = []  # first place of each n-gram's occurrences
        self.keys: list[np.ndarray] = []  # distinct, ascending
        self.which: list[np.ndarray] = []  # of each occurrence
        self.sample: list[np.ndarray] = []  # an occurrence of each
        self.counts: list[np.ndarray] = []  # in the training texts here
        for m in range(1, order + 1):
            h = T.gram_hash(self.seq, m)
            start = np.flatnonzero(self.row[: len(h)] == self.row[m - 1 :][: len(h)]) if len(h) else np.zeros(0, np.int64)
            if m == 1:
                start = start[~self.begin[start]]
            keys, sample, which = np.unique(h[start], return_index=True, return_inverse=True)
            self.start.append(start), self.keys.append(keys), self.which.append(which), self.sample.append(sample)
            self.counts.append(np.bincount(which[train[self.row[start]]], minlength=len(keys)).astype(np.uint32))


def _shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """First index of each shard's hash range, and the total."""
    edges = np.array([(k << 64) // shards for k in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]])


def _pack(a: np.ndarray) -> bytes:
    """Counts, behind the bytes that each takes: four, or eight where one needs them."""
    width = 8 if len(a) and int(a.max()) >> 32 else 4
    return bytes([width]) + zlib.compress(a.astype(f"<u{width}").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(data)[1:]), dtype=f"<u{data[0]}").astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, in as few bytes each as the largest difference needs."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(steps) > 1 else 1
    body = np.ascontiguousarray(steps[1:].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return bytes([width]) + steps[:1].tobytes() + body


def _unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    body = np.frombuffer(data, dtype=np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), dtype=np.uint8)
    steps[0] = np.frombuffer(data, dtype=np.uint8, count=8, offset=1)
    steps[1:, :width] = body
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


class Automaton:
    """The part of the automaton that some texts reach, from corpus counts of their n-grams."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], total: int, vocabulary: int, discount: float, mu: float):
        self.grams = grams
        c1 = counts[0].astype(np.float64)
        unseen = discount * vocabulary / total if total else 1.0
        #: weight of each arc at the root
        self.root = np.log10(np.where(c1 > 0, c1 - discount, 1.0) / total) if total else np.zeros(len(c1))
        self.root = np.where(c1 > 0, self.root, math.log10(unseen))
        #: by order: is there such an arc; its weight; and the failure weight of its state
        self.arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        end = np.searchsorted(grams.keys[0], T.gram_hash(np.array([_END], dtype=np.uint64), 1)[0]) if len(grams.keys[0]) else 0
        place = np.full(len(grams.seq), -1, dtype=np.int64)  # of a place's n-gram of the order before
        place[grams.start[0]] = grams.which[0]
        # a text begins as often as one ends
        place[grams.begin] = end
        lower = self.root[grams.which[0]] if len(c1) else np.zeros(0)
        by_place = np.zeros(len(grams.seq))
        by_place[grams.start[0]] = lower
        for m in range(2, len(counts) + 1):
            start, which, sample = grams.start[m - 1], grams.which[m - 1], grams.sample[m - 1]
            full = counts[m - 1].astype(np.float64)
            context = counts[m - 2].astype(np.float64)[place[start[sample]]]
            p_lower = 10.0 ** by_place[start[sample] + m - 1]
            weight = np.log10((full + mu * p_lower) / (context + mu))
            fail = np.log10(mu / (context + mu))
            self.arcs.append((full > 0, weight, fail))
            at = start + m - 1
            by_place[at] = np.where(full[which] > 0, weight[which], fail[which] + by_place[at])
            place = np.full(len(grams.seq), -1, dtype=np.int64)
            place[start] = which

    def traverse(self) -> np.ndarray:
        """log10 probability of each text: along every text, the state's arc if it has one, else failure arcs down to one that has."""
        g = self.grams
        weight = np.zeros(len(g.seq))
        weight[g.start[0]] = self.root[g.which[0]] if len(self.root) else 0.0
        for m, (arc, w, fail) in enumerate(self.arcs, start=2):
            which, at = g.which[m - 1], g.start[m - 1] + m - 1
            weight[at] = np.where(arc[which], w[which], fail[which] + weight[at])
        return np.bincount(g.row, weights=weight, minlength=g.n_texts)


def blocked(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, doc_id, text, held_out), dealt by block."""
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    one = docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"), F.col(id_col), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    return one.repartition(blocks, "block")


def lm_scores(docs: DataFrame, order: int = ORDER, mu: float = MU, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    prepare(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")) + 64)).first()[0] or 0
    blocks, shards = max(1, math.ceil(size / block_bytes)), max(1, math.ceil(size / shard_bytes))
    dealt = blocked(docs, blocks, id_col, text_col)

    def ask(t: pa.Table) -> pa.Table:
        g = Grams(t["text"], ~t["held_out"].to_numpy(), order)
        out: dict[str, list] = {"shard": [], "block": [], "n": [], "keys": [], "counts": []}
        for m in range(order):
            cuts = _shard_cuts(g.keys[m], shards)
            for s in range(shards):
                a, b = cuts[s], cuts[s + 1]
                if a < b:
                    for k, v in (("shard", s), ("block", t["block"][0].as_py()), ("n", m + 1), ("keys", _pack_keys(g.keys[m][a:b])), ("counts", _pack(g.counts[m][a:b]))):
                        out[k].append(v)
        return pa.table(out, schema=pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    def merge(t: pa.Table) -> pa.Table:
        out: dict[str, list] = {"block": [], "n": [], "shard": [], "counts": [], "tokens": [], "kinds": [], "once": [], "twice": []}
        number = t["n"].to_numpy()
        for m in np.unique(number):
            rows = np.flatnonzero(number == m)
            parts = [_unpack_keys(t["keys"][int(r)].as_py()) for r in rows]
            keys, which = np.unique(np.concatenate(parts), return_inverse=True)
            own = np.concatenate([_unpack(t["counts"][int(r)].as_py()) for r in rows])
            count = np.zeros(len(keys), dtype=np.int64)
            np.add.at(count, which, own)
            at = 0
            for k, (r, p) in enumerate(zip(rows, parts, strict=True)):
                facts = (int(count.sum()), int((count > 0).sum()), int((count == 1).sum()), int((count == 2).sum())) if k == 0 and m == 1 else (0, 0, 0, 0)
                for name, v in zip(out, (t["block"][int(r)].as_py(), int(m), t["shard"][int(r)].as_py(), _pack(count[which[at : at + len(p)]]), *facts), strict=True):
                    out[name].append(v)
                at += len(p)
        return pa.table(out, schema=pa.schema([("block", pa.int32()), ("n", pa.int32()), ("shard", pa.int32()), ("counts", pa.binary()), *((c, pa.int64()) for c in ("tokens", "kinds", "once", "twice"))]))

    asked = dealt.groupBy("block").applyInArrow(ask, "shard int, block int, n int, keys binary, counts binary")
    answers = saved(asked.repartition(shards, "shard").groupBy("shard").applyInArrow(merge, "block int, n int, shard int, counts binary, tokens long, kinds long, once long, twice long"), "counts")
    facts = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "kinds", "once", "twice"))).first()
    total, vocabulary, once, twice = (int(x) for x in facts)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def score(docs_: pa.Table, got: pa.Table) -> pa.Table:
        held = docs_["held_out"].to_numpy()
        g = Grams(docs_["text"], ~held, order)
        counts = []
        n, shard = got["n"].to_numpy(), got["shard"].to_numpy()
        for m in range(1, order + 1):
            rows = np.flatnonzero(n == m)
            rows = rows[np.argsort(shard[rows])]
            parts = [_unpack(got["counts"][int(r)].as_py()) for r in rows]
            counts.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        c = counts[0][g.which[0]].astype(np.float64)
        row = g.row[g.start[0]]
        tally = lambda w=None: np.bincount(row, weights=w, minlength=g.n_texts)
        base = tally(np.log10((c + 0.5) / (total + 0.5 * (vocabulary + 1))))
        model = Automaton(g, counts, total, vocabulary, discount, mu).traverse()
        ints = lambda a: pa.array(a.astype(np.int64))
        return pa.table([docs_["doc_id"], docs_["held_out"], ints(tally()), ints(tally((c > 0).astype(float))), ints(np.full(g.n_texts, total)), pa.array(base), pa.array(model)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    dealt = dealt.withColumnRenamed(id_col, "doc_id")
    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.select("block", "n", "shard", "counts").groupBy("block")).applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
