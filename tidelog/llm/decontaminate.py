r"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z became a-z.  A window is
``n`` consecutive words of a benchmark item; an item of fewer words is one window.  Training
texts are scanned window by window against the sorted window hashes, every hash hit is
verified word by word, and the words inside verified windows are hit.

The hash set is broadcast in blocks of ``BLOCK_WINDOWS`` windows, so what is sent to the
workers at once has a fixed bound; a benchmark of more windows is scanned block by block and
the results are joined by document.

Edge cases: null or empty texts and items have no words, no hits and no items; null item ids
are left out; items repeated under one id count once; repeated documents are reported row by
row; an empty benchmark leaves every document clean; extra columns are carried only by
``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import lean, prepare, saved, table

WINDOW = 10
#: Windows broadcast at once: at about 100 bytes each, some 50 MB.
BLOCK_WINDOWS = 500_000

_WORD = T.byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class WindowSet:
    """Windows of benchmark items: per window length, sorted hashes, the words behind each, and its items."""

    #: length -> (sorted distinct hashes, [window bytes], [item numbers])
    by_length: dict[int, tuple[np.ndarray, list[bytes], list[tuple[int, ...]]]]
    items: list[str]


def _words(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, T.Runs]:
    low = T.LOWER[text]
    return low, T.runs(low, offsets, _WORD)


def window_sets(rows: list[tuple[str, str | None]], n: int = WINDOW, block: int = BLOCK_WINDOWS) -> Iterator[WindowSet]:
    """The windows of (item id, text) rows, in blocks of about ``block`` windows (a single item stays whole)."""
    found: dict[tuple[int, int, bytes], set[int]] = {}
    names: list[str] = []

    def pack() -> WindowSet:
        out = {}
        for length in sorted({k[0] for k in found}):
            keys = sorted(k[1:] for k in found if k[0] == length)
            out[length] = (np.array([h for h, _ in keys], dtype=np.uint64), [w for _, w in keys], [tuple(sorted(found[(length, *k)])) for k in keys])
        return WindowSet(out, names)

    for item, text in rows:
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        low, words = _words(raw, np.array([0, len(raw)]))
        if not len(words):
            continue
        length = min(n, len(words))
        names.append(item)
        bytes_ = low.tobytes()
        parts = [bytes_[a:b] for a, b in zip(words.start, words.end, strict=True)]
        for i, h in zip(*T.grams(words, length), strict=True):
            found.setdefault((length, int(h), b" ".join(parts[i : i + length])), set()).add(len(names) - 1)
        if len(found) >= block:
            yield pack()
            found, names = {}, []
    yield pack()


def scan(text: np.ndarray, offsets: np.ndarray, windows: WindowSet) -> tuple[T.Runs, np.ndarray, list[set[int]]]:
    """(words, hit flag of each word, item numbers of each row)."""
    low, words = _words(text, offsets)
    hit = np.zeros(len(words), dtype=bool)
    items: list[set[int]] = [set() for _ in range(len(offsets) - 1)]
    whole = None
    for length, (hashes, texts, owners) in windows.by_length.items():
        first, h = T.grams(words, length)
        at = np.searchsorted(hashes, h, "left")
        inside = np.minimum(at, len(hashes) - 1)
        likely = np.flatnonzero(hashes[inside] == h)
        if not len(likely):
            continue
        whole = low.tobytes() if whole is None else whole
        good = []
        for i, k, x in zip(first[likely].tolist(), at[likely].tolist(), h[likely], strict=True):
            own = b" ".join(whole[a:b] for a, b in zip(words.start[i : i + length].tolist(), words.end[i : i + length].tolist(), strict=True))
            while k < len(hashes) and hashes[k] == x:
                if texts[k] == own:
                    good.append(i)
                    items[words.row[i]].update(owners[k])
                    break
                k += 1
        if good:
            hit |= T.cover(np.array(good), length, len(words))
    return words, hit, items


def _benchmark_rows(benchmark: DataFrame) -> Iterator[tuple[str, str | None]]:
    """Items one by one on the driver, in a fixed order; never the whole table at once."""
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for r in rows.toLocalIterator():
        yield r[0], r[1]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spans(words: T.Runs, hit: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Maximal runs of hit words of each row as byte ranges of its text."""
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    joined = np.zeros(len(hit) + 1, dtype=bool)
    joined[1:-1] = hit[1:] & hit[:-1] & (words.row[1:] == words.row[:-1])
    firsts, lasts = np.flatnonzero(hit & ~joined[:-1]), np.flatnonzero(hit & ~joined[1:])
    for r, a, b in zip(words.row[firsts].tolist(), words.start[firsts].tolist(), words.end[lasts].tolist(), strict=True):
        out[r].append({"start": a - int(offsets[r]), "end": b - int(offsets[r])})
    return out


def hits(docs: DataFrame, windows: WindowSet, id_col: str = "doc_id", text_col: str = "text", before: bool = False) -> DataFrame:
    """(id, n_words, n_hit, items, spans) and the columns named _c...; spans are byte ranges of hit words.

    ``before``: docs has ``items`` and ``spans`` of earlier blocks of windows, which the new ones join.
    """
    sent = docs.sparkSession.sparkContext.broadcast(windows)
    old = ["items", "spans"] if before else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win = sent.value
        for b in batches:
            for lo, hi, buf, offsets in T.text_slices(b.column(1)):
                n = hi - lo
                words, hit, items = scan(buf, offsets, win)
                found = [{win.items[k] for k in x} for x in items]
                if before:
                    for r, (its, sps) in enumerate(zip(b.column(2).slice(lo, n).to_pylist(), b.column(3).slice(lo, n).to_pylist(), strict=True)):
                        found[r].update(its)
                        for s in sps:
                            a, e = np.searchsorted(words.start, [s["start"] + offsets[r], s["end"] + offsets[r]])
                            hit[a:e] = True
                rest = [b.column(i).slice(lo, n) for i in range(2 + len(old), b.num_columns)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n), pa.array(words.per_row().astype(np.int64)), pa.array(T.row_sums(words.row[hit], n)), pa.array([sorted(x) for x in found], pa.list_(pa.string())), pa.array(_spans(words, hit, offsets), _SPANS), *rest], [str(i) for i in range(5 + len(rest))])

    rest = [c for c in docs.columns if c.startswith("_c")]
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string"), *old, *rest).mapInArrow(lean(run), f"`{id_col}` {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>{kinds}")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row of docs.

    With more blocks of windows than one, each block is a scan whose result is saved in the
    shared folder with the text, so that a worker holds one block at a time.
    """
    prepare(docs.sparkSession)
    blocks = window_sets(_benchmark_rows(benchmark), n, block)
    now, done = next(blocks), docs.select("doc_id", "text")
    before = False
    for after in blocks:
        kept = hits(done.withColumn("_c0", F.col("text")), now, before=before)
        done, before, now = saved(kept.select("doc_id", F.col("_c0").alias("text"), "items", "spans"), "windows"), True, after
    return hits(done, now, before=before)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Words as numbered list elements; each item's windows as strings, found in the documents' windows of the same length.
ORACLE = r"""
with dw as (select rowid_ as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
            from (select *, row_number() over () as rowid_ from documents)),
bw as (select distinct cast(item_id as varchar) as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
       from benchmark where text is not null and item_id is not null),
bn as (select item, w, least(10, len(w)) as n from bw where len(w) > 0),
win as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as t from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from bn)),
lens as (select distinct n from win),
dpos as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as t from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, lens)),
m as (select r, dpos.n, i, item from dpos join win on dpos.n = win.n and dpos.t = win.t),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from m) group by r),
it as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from m group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hit using (r) left join it using (r)
"""


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    names = docs.columns
    flagged = docs.select("doc_id", "text", *(F.col(c).alias(f"_c{i}") for i, c in enumerate(names)))
    for w in window_sets(_benchmark_rows(table(spark, sf_dir, "benchmark"))):
        flagged = hits(flagged.select(F.col(f"_c{names.index('doc_id')}").alias("doc_id"), F.col(f"_c{names.index('text')}").alias("text"), *(f"_c{i}" for i in range(len(names)))), w).where("n_hit = 0")
    return flagged.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
