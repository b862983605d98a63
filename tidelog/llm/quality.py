r"""Quality rules: hashed n-gram log-likelihood ratio between two multinomials.

Features of a text are its word and punctuation runs (``[0-9A-Za-z\x80-]+`` and other ASCII
signs) and their pairs, hashed into ``buckets``.  Two smoothed multinomials are counted in one
scan: the raw corpus (every document) and the trusted target (documents whose label is good).
A text's score is the mean over its features of log p_target - log p_raw, so long and short
texts compare.  Every document is kept or rejected by one fixed threshold, fitted on the
labelled sample; nothing is drawn at random.

``LABEL_BOUND`` bounds the labelled sample (the rows with the smallest id hashes); the
corpus counts cover all documents, and every document is scored.

Edge cases: a null or empty text has no words and is rejected by the base rule; null or
repeated document ids are scored row by row; a null label or an id without a document is
ignored; with no good labels all weights are 0 and only the base rule rejects; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import lean, prepare, table

#: Rows of labels used at most, and the number of hash buckets.
LABEL_BOUND, BUCKETS = 20_000, 1 << 14
#: Add-alpha smoothing of both multinomials.
ALPHA = 0.5
#: Of the trusted sample, the share that the threshold may reject.
MISS = 0.001
MIN_WORDS = 50

_SIGN_WORD = np.full(256, 2, dtype=np.uint8)
_SIGN_WORD[T.SPACE] = 0
_SIGN_WORD[:32] = 0
_SIGN_WORD[T.byte_set((48, 57), (65, 90), (97, 122), (128, 255))] = 1
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))


def _features(buf: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of every text."""
    tokens = T.class_runs(buf, offsets, _SIGN_WORD, prefix)
    first, pair = T.grams(tokens, 2)
    single = T.gram_hash(tokens.hash, 1)
    return np.concatenate([tokens.row, tokens.row[first]]), (np.concatenate([single, pair]) % np.uint64(buckets)).astype(np.int64)


def ngram_counts(docs: DataFrame, trusted: np.ndarray, id_col: str, text_col: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over all documents, and over those with trusted ids: one scan, at most ``buckets`` rows from a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            good = np.isin(b.column(0).fill_null(-1).to_numpy(zero_copy_only=False), trusted) & ~np.asarray(b.column(0).is_null())
            for lo, hi, buf, offsets in T.text_slices(b.column(1)):
                row, bucket = _features(buf, offsets, T.prefix_hash(buf), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[lo:hi][row]], minlength=buckets)
        some = np.flatnonzero(raw)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    parts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(lean(count), "bucket int, raw long, target long")
    rows = parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for b, r, t in rows:
        raw[b], target[b] = r, t
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """Weight of each bucket; all 0 where there is no target."""
    if not target.sum():
        return np.zeros(len(raw))
    p = lambda c: np.log(c + alpha) - np.log(c.sum() + alpha * len(c))
    return p(target) - p(raw)


def _measure(batches: Iterator[pa.RecordBatch], weights: np.ndarray, threshold: float, keep_text: bool = False) -> Iterator[pa.RecordBatch]:
    """Columns 0 (id) and 1 (text) of each batch to the rows of ``quality_scores``."""
    for b in batches:
        for lo, hi, buf, offsets in T.text_slices(b.column(1)):
            n, prefix = hi - lo, T.prefix_hash(buf)
            words = T.runs(buf, offsets, T.NOT_SPACE, prefix)
            n_words = words.per_row()
            chars = T.prefix_counts((buf & 0xC0 != 0x80) & T.NOT_SPACE[buf])
            signs = T.prefix_counts(_SYMBOL[buf])
            ln = T.lines(buf, offsets, prefix)
            content = T.prefix_counts(T.NOT_SPACE[buf])
            worded = np.flatnonzero(content[ln.end] > content[ln.start])
            _, again = T.dup_flags(ln.row[worded], ln.hash[worded])
            first, h = T.grams(words, 3)
            twice, _ = T.dup_flags(words.row[first], h)
            repeated = T.row_sums(words.row[T.cover(first[twice], 3, len(words))], n)
            row, bucket = _features(buf, offsets, prefix, len(weights))
            seen = np.bincount(row, minlength=n)
            score = np.bincount(row, weights=weights[bucket], minlength=n) / np.maximum(seen, 1)
            failed = (n_words < MIN_WORDS) | (100 * repeated > 50 * n_words)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, n), pa.array(n_words.astype(np.int64)), pa.array(chars[offsets[1:]] - chars[offsets[:-1]]), pa.array(signs[offsets[1:]] - signs[offsets[:-1]]),
                 pa.array(T.row_sums(ln.row[worded][again], n)), pa.array(repeated), pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold)), *([b.column(1).slice(lo, n)] if keep_text else []), *(b.column(i).slice(lo, n) for i in range(2, b.num_columns))],
                [str(i) for i in range(9 + keep_text + b.num_columns - 2)],
            )


_OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def label_sample(labels: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` distinct labelled ids with their lowest label, by id hash."""
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").cast("int").alias("good"))
    return one.orderBy(F.xxhash64("label_id"), "label_id").limit(bound)


def choose_threshold(score: np.ndarray, good: np.ndarray, miss: float = MISS) -> float:
    """Half way between the bulk of junk and of trusted texts where they part, else what keeps all but ``miss`` of the trusted."""
    if not good.any():
        return -np.inf
    floor = float(np.quantile(score[good], miss))
    if good.all():
        return floor
    top = float(np.quantile(score[~good], 1 - miss))
    return (floor + top) / 2 if top < floor else floor


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, bound: int = LABEL_BOUND) -> tuple[np.ndarray, float]:
    """(weight of each bucket, threshold)."""
    rows = label_sample(labels, bound).collect()
    ids = np.array([r.label_id for r in rows], dtype=np.int64)
    good = np.array([r.good == 1 for r in rows], dtype=bool)
    weights = log_ratio(*ngram_counts(docs, ids[good], id_col, text_col, buckets))
    # the sample has at most ``bound`` ids, which bounds the broadcast
    chosen = docs.sparkSession.createDataFrame([(int(i), bool(g)) for i, g in zip(ids, good, strict=True)], "label_id long, good boolean")
    some = docs.join(F.broadcast(chosen), docs[id_col].cast("long") == chosen.label_id).select("label_id", F.col(text_col).cast("string"), "good")
    scored = some.mapInArrow(lean(lambda it: _measure(it, weights, 0.0)), f"label_id long, {_OUT}, good boolean")
    # the base rule rejects its own, and says nothing of the ratio
    seen = scored.where("not base_failed").groupBy("label_id", "good").agg(F.min("llr").alias("llr")).collect()
    return weights, choose_threshold(np.array([r.llr for r in seen]), np.array([r.good for r in seen], dtype=bool)) if seen else -np.inf


def quality_scores(docs: DataFrame, weights: np.ndarray, threshold: float, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """A row for each document: the base counts, score ``llr``, and ``kept``; the text (as ``_text``) and ``carry`` columns follow."""
    prepare(docs.sparkSession)
    carry = carry or []
    out = docs.select(F.col(id_col), F.col(text_col).cast("string"), *carry)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return out.mapInArrow(lean(lambda it: _measure(it, weights, threshold, keep_text)), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {_OUT}" + ", _text string" * keep_text + (f", {kinds}" if kinds else ""))


def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, *fit(docs, table(spark, sf_dir, "labels")))


def filter_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    names = docs.columns
    weights, threshold = fit(docs, table(spark, sf_dir, "labels"))
    # any name of the input may clash with the measures, so its columns travel under others
    rest = {c: f"_c{i}" for i, c in enumerate(names) if c != "text"}
    renamed = docs.select("doc_id", "text", *(F.col(c).alias(n) for c, n in rest.items()))
    kept = quality_scores(renamed, weights, threshold, carry=list(rest.values()), keep_text=True)
    return kept.where("kept").select(*(F.col(rest.get(c, "_text")).alias(c) for c in names))
