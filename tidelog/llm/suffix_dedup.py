r"""Suffix-array dedup of exact byte passages with a logarithmic index family.

A byte is removed if a string of ``length`` bytes (200) that covers it also starts at any
other place of the corpus.  Suffixes matter by their first ``length`` bytes only, so a suffix
array here is a sorted array of 64-bit fingerprints of such prefixes with their places: equal
prefixes are neighbours.  ``IndexFamily`` keeps such arrays as levels; a new batch's array is
merge-scanned against every level for matches, then levels of like size merge, so each entry
is merged about log(n) times.

To keep what moves far below one suffix a byte, places are sampled by content: of the
fingerprints of the ``gram``-byte strings inside a window of ``length`` bytes the least one is
the window's anchor, so equal windows have equal anchors at equal offsets.  Consecutive
windows with one anchor form a segment.

1. Whole copies of a text are found by hash; one of them goes on for all, and each text with
   a copy is removed whole (if it has ``length`` bytes).
2. Each task sends its segments, by hash of the anchor, to shards; a shard's family tells
   which segments occur twice (all their windows repeat) and which share only the anchor.
3. For the latter, one of each different segment sends its bytes to the anchor's shard, where
   all its windows enter a second family and repeated windows are found one by one.  Anchors
   with very many different segments (``HOT`` in one task, or ``CROWD`` in a shard) deal single
   windows to shards by the windows' own fingerprints instead.
4. Each document's found ranges are united, and removed.

A task first settles what it can see alone and sends one of each key, so no key brings more
entries to a shard than there are batches; tables go back to the documents by a broadcast
only if their size was counted to be small, else by a join.

Edge cases: null or empty texts have no bytes; texts under ``length`` bytes lose nothing;
repeated ids and rows count as different places; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import lean, prepare, saved, table
from tidelog.llm.components import small_side

LENGTH, GRAM = 200, 64
#: Different segments of an anchor in one task, and entries in a shard, from which windows are dealt one by one.
HOT, CROWD = 16, 2_000
SHARD_BYTES = 16 << 20
#: Segments that a task holds before it sends a batch, and bytes of segments' texts or windows likewise.
BATCH, BATCH_TEXT = 1_000_000, 8 << 20
#: Ranges broadcast at most, 16 bytes each.
BROADCAST_RANGES = 3_000_000

_ENTRY = np.dtype([("key", "<u8"), ("sub", "<u8"), ("uid", "<i8"), ("at", "<u4"), ("n", "<u2"), ("flag", "u1")])
#: Entry flags: its ranges are known already; it stands for a hot anchor.
_KNOWN, _HOT_FLAG = 1, 2


class IndexFamily:
    """Sorted arrays of (key, entry number), each level over twice the one after it."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0
        self._matched: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Insert a batch; returns which of its keys occur twice in it or in an earlier batch."""
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        hit = np.zeros(len(keys), dtype=bool)
        same = ordered[1:] == ordered[:-1]
        hit[1:] |= same
        hit[:-1] |= same
        number = order + self.n
        old: list[np.ndarray] = []
        for level, owner in self.levels:
            lo = np.searchsorted(level, ordered, "left")
            found = lo < len(level)
            found[found] = level[lo[found]] == ordered[found]
            hit |= found
            back = np.searchsorted(ordered, level, "left")
            seen = back < len(ordered)
            seen[seen] = ordered[back[seen]] == level[seen]
            old.append(owner[seen])
        self._matched += [number[hit], *old]
        self.n += len(keys)
        self.levels.append((ordered, number))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * 2 > len(self.levels[-2][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both = np.concatenate([b, a])
            merged = np.argsort(both, kind="stable")
            self.levels.append((both[merged], np.concatenate([y, x])[merged]))
        out = np.empty(len(keys), dtype=bool)
        out[order] = hit
        return out

    def matched(self) -> np.ndarray:
        """Of all entries in order of arrival: does the key occur more than once."""
        out = np.zeros(self.n, dtype=bool)
        for x in self._matched:
            out[x] = True
        return out


def _window_least(g: np.ndarray, w: int) -> np.ndarray:
    """Least value of each w consecutive ones."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=g.dtype)
    rows = np.concatenate([g, np.full(-len(g) % w, np.iinfo(g.dtype).max, dtype=g.dtype)]).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def segments(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, number of windows, anchor fingerprint, segment fingerprint) of each segment."""
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(buf) < length:
        return empty
    prefix = T.prefix_hash(buf)
    starts = np.arange(len(buf) - gram + 1)
    g = T.range_hash(prefix, starts, starts + gram)
    least = _window_least(g, length - gram + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    new = np.ones(len(least), dtype=bool)
    # of equal values the leftmost is the anchor, so it also moves where a window began with it
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (g[: len(least) - 1] == least[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(least))
    end = np.minimum(end, offsets[row[begin] + 1] - length + 1)
    good = end > begin
    begin, end = begin[good], end[good]
    return row[begin], begin, end - begin, least[begin], T.range_hash(prefix, begin, end - 1 + length)


def _united(uid: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of each text as one."""
    if not len(uid):
        return uid, start, end
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order].astype(np.int64), end[order].astype(np.int64)
    new_uid = np.ones(len(uid), dtype=bool)
    new_uid[1:] = uid[1:] != uid[:-1]
    # a running maximum that restarts with each text
    lift = np.cumsum(new_uid) * (int(end.max()) + 1)
    top = np.maximum.accumulate(end + lift)
    first = np.ones(len(uid), dtype=bool)
    first[1:] = start[1:] + lift[1:] > top[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(uid)) - 1
    return uid[at], start[at], top[last] - lift[at]


class _Out:
    """Rows (shard, kind, data) on their way to the shards."""

    def __init__(self, shards: int):
        self.shards, self.rows = shards, []

    def send(self, kind: int, key: np.ndarray, data: np.ndarray) -> None:
        shard = (T.mix64(key ^ np.uint64(kind * 0x9E37)) % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cut)):
            self.rows.append((int(s), kind, data[order[cut[s] : cut[s + 1]]].tobytes()))

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "data"])


_RANGE = np.dtype([("uid", "<i8"), ("start", "<u4"), ("end", "<u4")])
_NEED = np.dtype([("uid", "<i8"), ("at", "<u4"), ("n", "<u2"), ("mode", "u1"), ("key", "<u8")])
_WINDOW = np.dtype([("key", "<u8"), ("uid", "<i8"), ("at", "<u4"), ("flag", "u1")])
_K_ENTRY, _K_RANGE, _K_NEED, _K_TEXT, _K_WINDOW = range(5)
_MODE_TEXT, _MODE_WINDOW = 0, 1


def _ranges(uid: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    uid, start, end = _united(uid, start, end)
    out = np.zeros(len(uid), dtype=_RANGE)
    out["uid"], out["start"], out["end"] = uid, start, end
    return out


def _settle(e: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What one task sees of its segments: (ranges known by now, hot windows needed, entries to send)."""
    e = e[np.lexsort((e["sub"], e["key"]))]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e["key"][1:] != e["key"][:-1]) | (e["sub"][1:] != e["sub"][:-1])
    group = np.cumsum(new) - 1
    twice = np.bincount(group) > 1
    dup = e[twice[group]]
    known = _ranges(dup["uid"], dup["at"], dup["at"] + dup["n"].astype(np.int64) - 1 + length)
    one = e[new]
    one["flag"] = np.where(twice, _KNOWN, 0)
    _, which, kinds = np.unique(one["key"], return_inverse=True, return_counts=True)
    hot = kinds[which] >= HOT
    need = _needs(one[hot], _MODE_WINDOW)
    lead = np.zeros(len(one), dtype=bool)
    lead[np.unique(which, return_index=True)[1]] = True
    one["flag"] |= np.where(hot, _HOT_FLAG, 0).astype(np.uint8)
    return known, need, one[~hot | lead]


def _needs(e: np.ndarray, mode: int | np.ndarray) -> np.ndarray:
    out = np.zeros(len(e), dtype=_NEED)
    for c in ("uid", "at", "n", "key"):
        out[c] = e[c]
    out["mode"] = mode
    return out


def _first_pass(batches: Iterator[pa.RecordBatch], shards: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        known, need, entries = _settle(np.concatenate(held), length)
        held.clear()
        out = _Out(shards)
        out.send(_K_RANGE, known["uid"].view(np.uint64), known)
        out.send(_K_NEED, need["uid"].view(np.uint64), need)
        out.send(_K_ENTRY, entries["key"], entries)
        return out.batch()

    for b in batches:
        uid = b.column(0).to_numpy()
        for lo, _, buf, offsets in T.text_slices(b.column(1)):
            row, at, n, anchor, whole = segments(buf, offsets, length, gram)
            e = np.zeros(len(at), dtype=_ENTRY)
            e["key"], e["sub"], e["uid"], e["at"], e["n"] = anchor, whole, uid[lo + row], at - offsets[row], n
            held.append(e)
        if sum(map(len, held)) >= BATCH:
            yield flush()
    if held:
        yield flush()


def _blobs(t: pa.Table, kind: int, dtype: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(d, dtype=dtype) for k, d in zip(t["kind"].to_pylist(), t["data"].to_pylist(), strict=True) if k == kind]


_FOUND = pa.schema([("kind", pa.int32()), ("uid", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("mode", pa.int32()), ("key", pa.int64())])
_FOUND_SQL = "kind int, uid long, start long, end long, mode int, key long"


def _found(ranges: list[np.ndarray], needs: list[np.ndarray]) -> pa.Table:
    r = np.concatenate([np.zeros(0, _RANGE), *ranges])
    n = np.concatenate([np.zeros(0, _NEED), *needs])
    r = _ranges(r["uid"], r["start"], r["end"])
    both = lambda a, b, kind: pa.array(np.concatenate([np.asarray(a).astype(kind), np.asarray(b).astype(kind)]))
    return pa.table([both(np.full(len(r), _K_RANGE), np.full(len(n), _K_NEED), np.int32), both(r["uid"], n["uid"], np.int64), both(r["start"], n["at"], np.int64), both(r["end"], n["n"], np.int64), both(np.zeros(len(r)), n["mode"], np.int32), both(np.zeros(len(r)), n["key"].view(np.int64), np.int64)], schema=_FOUND)


def _merge_segments(t: pa.Table, length: int) -> pa.Table:
    """A shard's segments: ranges of those that occur twice, and the needs of those that share an anchor only."""
    ranges, needs = _blobs(t, _K_RANGE, _RANGE), _blobs(t, _K_NEED, _NEED)
    whole, anchors = IndexFamily(), IndexFamily()
    batches = _blobs(t, _K_ENTRY, _ENTRY)
    for e in batches:
        anchors.add(e["key"])
        whole.add(T.mix64(e["key"]) ^ e["sub"])
    if batches:
        e = np.concatenate(batches)
        twice, shared = whole.matched(), anchors.matched()
        dup = e[twice]
        ranges.append(_ranges(dup["uid"], dup["at"], dup["at"] + dup["n"].astype(np.int64) - 1 + length))
        e = e[shared | (e["flag"] & _HOT_FLAG > 0)]
        if len(e):
            e = e[np.lexsort((e["sub"], e["key"]))]
            new = np.ones(len(e), dtype=bool)
            new[1:] = (e["key"][1:] != e["key"][:-1]) | (e["sub"][1:] != e["sub"][:-1])
            _, which, crowd = np.unique(e["key"], return_inverse=True, return_counts=True)
            kinds = np.bincount(which[new], minlength=len(crowd))
            hot = np.bincount(which, weights=(e["flag"] & _HOT_FLAG > 0), minlength=len(crowd)) > 0
            single = hot | (crowd > CROWD)
            take = new & (hot | (kinds > 1))[which] & (e["flag"] & _HOT_FLAG == 0)
            # a segment whose first entry stands for a hot anchor is among that task's needs already
            needs.append(_needs(e[take], np.where(single[which[take]], _MODE_WINDOW, _MODE_TEXT)))
    return _found(ranges, needs)


def _second_pass(batches: Iterator[pa.RecordBatch], shards: int, length: int) -> Iterator[pa.RecordBatch]:
    """Columns uid, text, needs (start, n, mode, key) to texts and windows for the shards."""
    texts: list[tuple[np.ndarray, bytes]] = []
    windows: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        out = _Out(shards)
        if windows:
            w = np.concatenate(windows)
            w = w[np.lexsort((w["at"], w["uid"], w["key"]))]
            fresh = np.ones(len(w), dtype=bool)
            fresh[1:] = (w["key"][1:] != w["key"][:-1]) | (w["uid"][1:] != w["uid"][:-1]) | (w["at"][1:] != w["at"][:-1])
            w = w[fresh]
            new = np.ones(len(w), dtype=bool)
            new[1:] = w["key"][1:] != w["key"][:-1]
            group = np.cumsum(new) - 1
            twice = np.bincount(group) > 1
            dup = w[twice[group]]
            known = _ranges(dup["uid"], dup["at"], dup["at"].astype(np.int64) + length)
            out.send(_K_RANGE, known["uid"].view(np.uint64), known)
            one = w[new]
            one["flag"] = np.where(twice, _KNOWN, 0)
            out.send(_K_WINDOW, one["key"], one)
        for shard in {int(h["key"] % shards) for h, _ in texts}:
            mine = [(h, x) for h, x in texts if int(h["key"] % shards) == shard]
            head = np.array([h for h, _ in mine], dtype=_NEED)
            out.rows.append((shard, _K_TEXT, len(mine).to_bytes(8, "little") + head.tobytes() + b"".join(x for _, x in mine)))
        texts.clear(), windows.clear()
        return out.batch()

    for b in batches:
        uid, needs = b.column(0).to_numpy(), b.column(2).to_pylist()
        for lo, hi, buf, offsets in T.text_slices(b.column(1)):
            prefix = None
            for r in range(lo, hi):
                start = int(offsets[r - lo])
                for x in needs[r]:
                    a, n = start + x["start"], x["n"]
                    if x["mode"] == _MODE_TEXT:
                        head = np.zeros((), dtype=_NEED)
                        head["uid"], head["at"], head["n"], head["key"] = uid[r], x["start"], n, np.uint64(x["key"] & (2**64 - 1))
                        texts.append((head, buf[a : a + n - 1 + length].tobytes()))
                        size += n + length
                    else:
                        prefix = T.prefix_hash(buf) if prefix is None else prefix
                        w = np.zeros(n, dtype=_WINDOW)
                        at = np.arange(a, a + n)
                        w["key"], w["uid"], w["at"] = T.range_hash(prefix, at, at + length), uid[r], at - start
                        windows.append(w)
                        size += 21 * n
            if size >= BATCH_TEXT:
                yield flush()
                size = 0
    if texts or windows:
        yield flush()


def _merge_windows(t: pa.Table, length: int) -> pa.Table:
    """Ranges of the windows that occur at two places of a shard."""
    ranges = _blobs(t, _K_RANGE, _RANGE)
    family, batches = IndexFamily(), []
    for kind, data in zip(t["kind"].to_pylist(), t["data"].to_pylist(), strict=True):
        if kind == _K_WINDOW:
            w = np.frombuffer(data, dtype=_WINDOW)
        elif kind == _K_TEXT:
            count = int.from_bytes(data[:8], "little")
            head = np.frombuffer(data, dtype=_NEED, count=count, offset=8)
            buf = np.frombuffer(data, dtype=np.uint8, offset=8 + count * _NEED.itemsize)
            n = head["n"].astype(np.int64)
            base = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]
            first = np.cumsum(n) - n
            step = np.arange(int(n.sum())) - np.repeat(first, n)
            at = np.repeat(base, n) + step
            w = np.zeros(len(at), dtype=_WINDOW)
            w["key"] = T.range_hash(T.prefix_hash(buf), at, at + length)
            w["uid"], w["at"] = np.repeat(head["uid"], n), np.repeat(head["at"], n) + step
        else:
            continue
        family.add(w["key"])
        batches.append(w)
    if batches:
        dup = np.concatenate(batches)[family.matched()]
        # one place that came twice is no repeat
        dup = dup[np.lexsort((dup["at"], dup["uid"], dup["key"]))]
        same_key = dup["key"][1:] == dup["key"][:-1]
        other = same_key & ((dup["uid"][1:] != dup["uid"][:-1]) | (dup["at"][1:] != dup["at"][:-1]))
        new = np.ones(len(dup), dtype=bool)
        new[1:] = ~same_key
        group = np.cumsum(new) - 1
        real = np.bincount(group[1:], weights=other, minlength=group[-1] + 1 if len(group) else 0) > 0 if len(dup) else np.zeros(0, bool)
        dup = dup[real[group]] if len(dup) else dup
        ranges.append(_ranges(dup["uid"], dup["at"], dup["at"].astype(np.int64) + length))
    return _found(ranges, [])


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(uid, ranges) of each text with repeats, from docs (uid, text) with one row a text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    sent = docs.select("uid", "text").mapInArrow(lean(lambda it: _first_pass(it, shards, length, gram)), "shard int, kind int, data binary")
    found = saved(sent.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda t: _merge_segments(t, length), _FOUND_SQL), "segments")
    needs = found.where(f"kind = {_K_NEED}").groupBy("uid").agg(F.collect_list(F.struct("start", F.col("end").alias("n"), "mode", "key")).alias("needs"))
    needy = docs.join(_by_length(needs, "needs"), "uid").select("uid", "text", "needs")
    windows = needy.mapInArrow(lean(lambda it: _second_pass(it, shards, length)), "shard int, kind int, data binary")
    more = windows.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda t: _merge_windows(t, length), _FOUND_SQL)
    every = found.where(f"kind = {_K_RANGE}").select("uid", "start", "end").unionByName(more.select("uid", "start", "end"))
    return saved(every.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ranges")), "ranges")


def _by_length(df: DataFrame, column: str) -> DataFrame:
    """df marked for broadcast if its arrays are counted to be small."""
    total = df.agg(F.sum(F.size(column) + 2)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_RANGES else df


def dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, ranges) of every row; ranges are the removed byte ranges."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    keyed = rows.withColumns({"_h": F.xxhash64("text"), "_g": F.xxhash64(F.lit(1), "text"), "uid": F.xxhash64("doc_id", "text")})
    long = F.octet_length("text") >= length
    copies = saved(keyed.where(long).groupBy("_h", "_g").agg(F.count("*").alias("n"), F.min("uid").alias("rep")).where("n > 1"), "copies")
    marked = keyed.join(small_side(copies.select("_h", "_g", "rep"), 2_000_000), ["_h", "_g"], "left").select("doc_id", "text", "uid", F.when(long, F.col("rep")).alias("rep"))
    source = marked.where(long & (F.col("rep").isNull() | (F.col("rep") == F.col("uid"))))
    ranges = repeated_ranges(source, length)
    joined = marked.join(_by_length(ranges, "ranges"), "uid", "left").select("doc_id", "text", F.col("rep").isNotNull().alias("copied"), "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            copied = b.column(2).to_pylist()
            for lo, hi, buf, offsets in T.text_slices(b.column(1)):
                removed, spans, digest, kept = [], [], [], []
                for r, got in zip(range(lo, hi), b.column(3).slice(lo, hi - lo).to_pylist(), strict=True):
                    one = buf[offsets[r - lo] : offsets[r - lo + 1]]
                    if copied[r]:
                        runs = [(0, len(one))]
                    elif got:
                        s = np.array([(x["start"], x["end"]) for x in got], dtype=np.int64)
                        _, a, e = _united(np.zeros(len(s), np.int64), s[:, 0], s[:, 1])
                        runs = list(zip(a.tolist(), e.tolist(), strict=True))
                    else:
                        runs = []
                    sha, at = hashlib.sha256(), 0
                    for a, e in runs:
                        sha.update(one[at:a].tobytes())
                        at = e
                    sha.update(one[at:].tobytes())
                    removed.append(sum(e - a for a, e in runs)), spans.append(len(runs)), digest.append(sha.hexdigest())
                    kept.append([{"start": a, "end": e} for a, e in runs])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], list("abcdef"))

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(lean(cut), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, ranges array<struct<start: long, end: long>>")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("ranges")
