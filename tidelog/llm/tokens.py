r"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

A text over ``chunk_chars`` is cut at multiples of that size.  Every piece is encoded with
``overlap`` characters more on both sides, with offsets, and neighbouring pieces are spliced
where both put a token boundary at a proven stable place: a space or \n behind a character
that is not white space.  The pre-tokenizer's pattern never matches white space behind
anything else, so such a place always ends a pre-token, whatever stands further left or
right, and merges never cross pre-tokens.  Where an overlap holds no such place it is
doubled and the two pieces are encoded again, up to the whole text.

Edge cases: null or empty texts have 0 tokens; special strings inside texts are encoded as
the library does by default; repeated rows are counted row by row; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import lean, prepare, table

CHUNK_CHARS, OVERLAP_CHARS, LIMIT = 32_768, 256, 512


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _stable(text: str, p: int) -> bool:
    return text[p] in " \n" and not text[p - 1].isspace()


class _Piece:
    """Token starts (absolute) of text[lo:hi]."""

    def __init__(self, tok, text: str, lo: int, hi: int):
        self.lo, self.hi = lo, hi
        self.starts = np.array([a for a, _ in tok.encode(text[lo:hi], add_special_tokens=False).offsets], dtype=np.int64) + lo

    def before(self, p: int) -> int:
        return int(np.searchsorted(self.starts, p, "left"))

    def cuts_at(self, p: int) -> bool:
        k = self.before(p)
        return k < len(self.starts) and self.starts[k] == p


def splice_count(tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Number of tokens of a text, from overlapping chunks."""
    n = len(text)
    seams = list(range(chunk, n, chunk))
    width = [overlap] * len(seams)
    edges = lambda k: (0 if k == 0 else max(0, seams[k - 1] - width[k - 1]), n if k == len(seams) else min(n, seams[k] + width[k]))
    pieces: list[_Piece | None] = [None] * (len(seams) + 1)
    cut: list[int | None] = [None] * len(seams)
    while any(c is None for c in cut):
        for k in range(len(pieces)):
            if pieces[k] is None or (pieces[k].lo, pieces[k].hi) != edges(k):
                pieces[k] = _Piece(tok, text, *edges(k))
        for k in range(len(seams)):
            if cut[k] is None:
                left, right = pieces[k], pieces[k + 1]
                # nearest to the seam first; never before the cut on the left, nor at the ragged first place of a piece
                floor = max(right.lo + 1, (cut[k - 1] or 0) + 1 if k else 1)
                places = sorted(range(floor, left.hi), key=lambda p, s=seams[k]: abs(p - s))
                cut[k] = next((p for p in places if _stable(text, p) and left.cuts_at(p) and right.cuts_at(p)), None)
                if cut[k] is None:
                    if right.lo == 0 and left.hi == n:
                        return len(tok.encode(text, add_special_tokens=False).ids)
                    width[k] *= 2
    # a widened seam may pass its neighbour; then the cuts are not in order, and the whole is encoded
    if any(a >= b for a, b in zip(cut, cut[1:], strict=False)):
        return len(tok.encode(text, add_special_tokens=False).ids)
    total, at = 0, 0
    for k, piece in enumerate(pieces):
        end = piece.before(cut[k]) if k < len(cut) else len(piece.starts)
        total += end - (piece.before(at) if k else 0)
        at = cut[k] if k < len(cut) else n
    return total


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``tokenizer`` is the path of a .json file that workers can open."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for b in batches:
            for lo, hi, _, offsets in T.text_slices(b.column(1)):
                texts = [x or "" for x in b.column(1).slice(lo, hi - lo).to_pylist()]
                count = np.zeros(hi - lo, dtype=np.int64)
                short = [i for i, x in enumerate(texts) if len(x) <= chunk]
                for i, e in zip(short, tok.encode_batch_fast([texts[i] for i in short], add_special_tokens=False), strict=True):
                    count[i] = len(e)
                for i, x in enumerate(texts):
                    if len(x) > chunk:
                        count[i] = splice_count(tok, x, chunk, overlap)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(count), pa.array(count > limit)], list("abcd"))

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(lean(run), f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
