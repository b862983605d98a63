r"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct n-word shingles as 64-bit hashes.  Documents with equal sets
form a class and are linked by that alone.

* Sketch: of a set of x hashes the k(x) = x - ceil(p x / 100) + 1 least.  Linked sets (p percent
  or more of their union in common) lack so few of each other's values that they always share
  one of these, so the inverted lists of retained values miss no link.
* Estimate: of the m = least(k(a), k(b)) least values of the union of two sketches, the share in
  both estimates the similarity.  A pair is ruled out where that share is so low that a linked
  pair has it with probability under ``MISS`` (Hoeffding's bound, which also holds for sampling
  without replacement).  A set that has too few retained values in lists with others for any
  partner to pass is ruled out as a whole, before any pair is made.
* Exact Jaccard on the full sets confirms every link.

Nothing emits a list's pairs while its members may be one component.  First each member meets
the member of its list that has least values alone, if they share enough lists.  From then on
only lists that hold members of several components count, and only sets with enough values in
such lists: a group of near copies that is one component, of whatever size, is done with.  A
list is hot while its pairs apart are over ``OPEN`` times its members, and gets ``LEADERS`` fresh
leaders for up to ``TURNS`` turns.  At last every pair that is still apart is met: in lists that
are not hot, by salted blocks, size and position; and sets with enough values in hot lists alone
(passages that many documents share, large groups that are not linked) by a prefix filter over
their full sets, whose shingles are ordered by the number of components that have them, each
pair once and first by each set's rarest one.  Turns and leaders save work only.  What is left
is the work that exactness asks for: sets beside a large group that are linked with none of its
members are compared with those members that position cannot rule out.

Edge cases: a null or empty text has an empty set and links with nothing; texts of fewer
words than a shingle are one shingle; null ids take part in classes but never name a
component unless alone; repeated ids and rows are reported row by row; extra columns, whatever
their names, are ignored by ``near_duplicates`` and kept by the stage, which decides by a
row's id and text (so a null or repeated id loses no other text) and keeps one of equal rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import textnum as T
from tidelog.llm.common import free, lean, prepare, saved, table, tidy
from tidelog.llm.components import components, small_side

#: Probability at most that the estimate rules a linked pair out.
MISS = 1e-9
#: Turns of fresh leaders at most, leaders of a list in each; open pairs for each member of a list from which on it is hot.
TURNS, LEADERS, OPEN = 2, 6, 4
#: Postings of one salted block of a shingle, about, and values of a sketch that one estimate looks at.
BLOCK, LOOKED_AT = 256, 128


def _sets(buf: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes as signed numbers, ascending in each row and distinct; first index of each row)."""
    low = T.LOWER[buf]
    words = T.runs(low, offsets, T.NOT_SPACE)
    first, h = T.grams(words, n)
    row = words.row[first]
    count = words.per_row()
    for k in range(1, n):
        some = np.flatnonzero(count == k)
        if len(some):
            at = words.first[some]
            short = np.zeros(len(some), dtype=np.uint64)
            for j in range(k):
                short += words.hash[at + j] * T._GRAM[j]
            row, h = np.concatenate([row, some]), np.concatenate([h, T.mix64(short + np.uint64(k))])
    h = h.view(np.int64)
    order = np.argsort(h)
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(offsets)))


def _sum_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _lists(h: np.ndarray, first: np.ndarray, percent: int | None) -> pa.ListArray:
    """Each row's values, or with ``percent`` those that its sketch retains."""
    size = np.diff(first)
    if percent is not None:
        most = np.where(size > 0, size - (size * percent + 99) // 100 + 1, 0)
        rank = np.arange(len(h)) - np.repeat(first[:-1], size)
        h, size = h[rank < np.repeat(most, size)], most
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(h))


def _node(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each row's whole set."""
    u = h.view(np.uint64)
    return T.mix64(_sum_by_row(T.mix64(u + np.uint64(1)), first) ^ (_sum_by_row(T.mix64(u ^ np.uint64(0x5851F42D4C957F2D)), first) * np.uint64(3))).view(np.int64)


def _uid() -> Column:
    """The key of a row by its id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("uid")


def sketches(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text", percent: int | None = None, key_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, node, sketch) of every row, and key_col if asked for; without ``percent`` the sketch is the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offsets in T.text_slices(b.column(1)):
                h, first = _sets(buf, offsets, n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)), pa.array(_node(h, first)), _lists(h, first, percent), *(b.column(k).slice(lo, hi - lo) for k in range(2, b.num_columns))], list("abcde")[: 2 + b.num_columns])

    key = [key_col] if key_col else []
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *key).mapInArrow(lean(run), "doc_id long, n_shingles long, node long, sketch array<long>" + "".join(f", {k} long" for k in key))


def _retained(n: str, percent: int) -> str:
    """SQL: values that the sketch of a set of n retains."""
    return f"({n} - (({n}) * {percent} + 99) div 100 + 1)"


def _least_shared(m: str, percent: int) -> str:
    """SQL: of m values of a union, linked sets share so many or more, but with probability ``MISS``: by the binomial tail up to ``LOOKED_AT``, then by Hoeffding's bound."""
    p = percent / 100

    def least(size: int) -> int:
        tail = 0.0
        for k in range(size + 1):
            tail += math.comb(size, k) * p**k * (1 - p) ** (size - k)
            if tail > MISS:
                return k
        return size

    exact = ", ".join(str(least(size)) for size in range(LOOKED_AT + 1))
    return f"case when {m} <= {LOOKED_AT} then element_at(array({exact}), cast({m} as int) + 1) else floor({m} * {p} - {math.sqrt(math.log(1 / MISS) / 2):.4f} * sqrt({m})) end"


def _side(df: DataFrame) -> DataFrame:
    """df written once, and broadcast if it is small."""
    return small_side(saved(df, "side"))


def _enough(n: str, percent: int) -> str:
    """SQL: retained values that a set of n shares with a partner of any size at least."""
    return _least_shared(_retained(f"(({percent} * {n} + 99) div 100)", percent), percent)


def _able(posts: DataFrame, percent: int) -> DataFrame:
    """The postings (node, n, ...) of sets with enough of them for a partner of any size, and ``rare``: retained values that the set has alone."""
    counts = posts.groupBy("node", "n").count().where(f"count >= {_enough('n', percent)}")
    return posts.drop("rare").join(_side(counts.select("node", F.expr(f"{_retained('n', percent)} - count").alias("rare"))), "node")


def _ends(pairs: DataFrame) -> DataFrame:
    return saved(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "nodes")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are linked; estimates come first."""
    pairs = saved(pairs, "pairs")
    known = saved(classes.join(small_side(_ends(pairs)), "node", "left_semi").select("node", "n_shingles", F.slice("sketch", 1, LOOKED_AT).alias("s")), "known")
    one, two = (known.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").withColumn("m", F.least(F.size("sa"), F.size("sb")))
    least = both.withColumn("u", F.expr("slice(sort_array(array_union(sa, sb)), 1, m)"))
    likely = saved(least.where(f"size(array_intersect(array_intersect(u, sa), sb)) >= {_least_shared('m', percent)}").select("a", "b"), "likely")
    out = likely if likely.isEmpty() else _checked(likely, classes, docs, n, percent)
    free(pairs.sparkSession, known, pairs)
    return out


def _full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(node, set) of nodes, each once."""
    reps = classes.join(small_side(nodes), "node").select(F.col("rep_id").alias("_rep"), F.col("node").alias("_node"))
    texts = docs.join(small_side(reps), F.col("doc_id").cast("long").eqNullSafe(F.col("_rep"))).select("doc_id", "text").where("text is not null")
    return saved(sketches(texts, n).select("node", F.col("sketch").alias("set")).join(small_side(nodes), "node", "left_semi").dropDuplicates(["node"]), "sets")


def _checked(likely: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of likely whose full sets are linked."""
    sets = _full_sets(_ends(likely), classes, docs, n)
    one, two = (sets.select(F.col("node").alias(x), F.col("set").alias(f"s{x}")) for x in "ab")
    both = likely.join(one, "a").join(two, "b")
    out = saved(both.where(f"{100 + percent} * size(array_intersect(sa, sb)) >= {percent} * (size(sa) + size(sb))").select("a", "b"), "links")
    free(likely.sparkSession, sets)
    return out


def _open(met: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(value, node, n, at, rare, root, members, hot) of the lists with members of several components, and of sets that may still have links; hot: pairs apart are many."""
    roots = saved(components(found, "a", "b"), "components")
    named = saved(met.join(small_side(roots), "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    several = named.groupBy("value").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("value")
    left = saved(_able(named.join(_side(several), "value", "left_semi"), percent), "left")
    free(met.sparkSession, named)
    counts = left.groupBy("value", "root").count().groupBy("value").agg(F.sum("count").alias("members"), F.sum(F.col("count") * F.col("count")).alias("squares"))
    counts = counts.where("members * members > squares").select("value", "members", F.expr(f"members * members - squares > {2 * OPEN} * members").alias("hot"))
    out = saved(left.join(_side(counts), "value"), "open")
    free(met.sparkSession, left)
    return out


def _crossed(posts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the postings (value, node, n, at, root, members, unseen, before) that are apart and that size and position cannot rule out.

    In any one order of all shingles, linked sets of x <= y shingles have their first common one
    among the first x - ceil(2px / (100 + p)) + 1 of the one and the first k(y) of the other;
    ``unseen`` values of a set, of lists that are not among these, may be common before it.
    Sets that share one of the values ``before`` met there, so a pair meets once.
    """
    index = f"at <= n + unseen - ((2 * {percent} * n + {99 + percent}) div {100 + percent})"
    posts = posts.withColumn("blocks", F.expr(f"cast(ceil(members / {BLOCK}) as int)"))
    side = lambda df, x, block: df.select("value", block.alias("block"), *(F.col(c).alias(f"{c}{x}") for c in ("node", "n", "at", "root", "unseen", "before")))
    one, two = side(posts.where(index), "a", F.expr("pmod(xxhash64(node), blocks)").cast("int")), side(posts, "b", F.explode(F.expr("sequence(0, blocks - 1)")))
    linkable = f"na <= nb and nodea <> nodeb and roota <> rootb and 100 * na >= {percent} * nb and {100 + percent} * (least(na - ata, nb - atb) + least(unseena, unseenb)) >= {percent} * (na + nb) and not arrays_overlap(beforea, beforeb)"
    return one.join(two, ["value", "block"]).where(linkable).select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct()


def _prefixes(open_: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The postings of the sets (node, root) in the prefix filter over full sets, shingles of fewest components first; rank counts a set's postings from 0 on."""
    sets = saved(_full_sets(open_.select("node"), classes, docs, n).join(small_side(open_), "node"), "rooted")
    shingles = sets.select("node", "root", F.size("set").alias("n"), F.explode("set").alias("s"))
    # a shingle of one component joins none that are apart, but comes first in the order
    common = shingles.groupBy("s", "root").agg(F.count("*").alias("c")).groupBy("s").agg(F.count("*").alias("rf"), F.sum("c").alias("df")).where("rf > 1")
    first = shingles.join(_side(common), "s").groupBy("node", "n", "root").agg(F.sort_array(F.collect_list(F.struct("rf", "s", "df"))).alias("xs")).withColumn("own", F.expr("n - size(xs)"))
    probe = _retained("n", percent)
    kept = first.where(f"{probe} > own").withColumn("xs", F.expr(f"slice(xs, 1, cast({probe} - own as int))"))
    at = kept.select("node", "n", "root", "own", F.col("xs.s").alias("all"), F.posexplode("xs").alias("rank", "x"))
    out = saved(at.select(F.col("x.s").alias("value"), "node", "n", F.expr("own + rank").alias("at"), "rank", "root", F.col("x.df").alias("members"), F.lit(0).alias("unseen"), F.expr("slice(all, 1, rank)").alias("before")), "prefixes")
    free(docs.sparkSession, sets)
    return out


def links(docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes, enough of them to join every component."""
    spark = docs.sparkSession
    posts = classes.select("node", F.col("n_shingles").cast("int").alias("n"), F.posexplode("sketch").alias("at", "value"))
    shared = posts.groupBy("value").count().where("count > 1").select("value")
    every = saved(posts.join(_side(shared), "value", "left_semi"), "met")
    met = saved(_able(every, percent), "postings")
    free(spark, every)
    tidy(spark)
    # the member that has least alone is nearest to what a group has in common
    order = F.struct("rare", F.col("node").alias("a"))
    lead = met.groupBy("value").agg(F.min(order).alias("l"), F.count("*").alias("members")).where("members > 1").select("value", "l.a")
    led = met.join(_side(lead), "value").where("node <> a").groupBy("a", F.col("node").alias("b"), "n").count()
    found = _confirmed(led.where(f"4 * count >= {_retained('n', percent)}").select("a", "b"), classes, docs, n, percent)
    for turn in range(TURNS + 1):
        left = _open(met, found, percent)
        many = left.where("hot")
        if turn == TURNS or many.isEmpty():
            break
        # of each of several shares of all sets, drawn anew each turn, the member that has least alone
        share = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(LEADERS))
        best = [F.min(F.when(share == k, F.struct("rare", F.col("node").alias("a"), F.col("root").alias("other")))).alias(f"l{k}") for k in range(LEADERS)]
        fresh = many.groupBy("value").agg(*best).select("value", F.array_compact(F.array(*(f"l{k}" for k in range(LEADERS)))).alias("ls"))
        led = many.join(_side(fresh), "value").select("node", "n", F.explode(F.filter("ls", lambda x: x["other"] != F.col("root"))["a"]).alias("a"))
        shared = led.groupBy("a", "node", "n").count().where(f"2 * count >= {_retained('n', percent)}")
        pairs = shared.select(F.least("node", "a").alias("a"), F.greatest("node", "a").alias("b")).distinct()
        new = _confirmed(pairs, classes, docs, n, percent)
        if new.isEmpty():
            break
        found = found.unionByName(new)
        free(spark, left)
        tidy(spark)
    # a pair apart shares a list that is not hot, or each of the two has enough values in hot ones alone
    hot = saved(many.groupBy("node", "n", "root").agg(F.count("*").cast("int").alias("unseen")), "hot")
    none = F.expr("cast(array() as array<bigint>)")
    plain = left.where("not hot").join(small_side(hot.select("node", "unseen")), "node", "left").fillna(0, ["unseen"]).withColumn("before", none)
    found = found.unionByName(_confirmed(_crossed(plain, percent), classes, docs, n, percent))
    free(spark, left, met)
    tidy(spark)
    hard = saved(hot.where(f"unseen >= {_enough('n', percent)}").select("node", "root"), "hard")
    if hard.isEmpty():
        return found
    posts = _prefixes(hard, classes, docs, n, percent)
    # shingles of few components tell most: what meets there and is linked need not meet elsewhere
    for some in (posts.where("rank = 0"), posts):
        roots = small_side(saved(components(found, "a", "b"), "components").withColumnRenamed("root", "_r"))
        now = some.join(roots, "node", "left").withColumn("root", F.coalesce("_r", "node")).drop("_r")
        found = found.unionByName(_confirmed(_crossed(now, percent), classes, docs, n, percent))
        tidy(spark)
    free(spark, hot, hard, posts)
    return found


def _grouped(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, uid, n_shingles, root, least_id) of every row of docs; root and least_id are null where the set is empty."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = saved(sketches(docs.select("doc_id", "text", _uid()), shingle, percent=percent, key_col="uid"), "sketches")
    classes = saved(rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("rep_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    comp = saved(components(links(docs, classes, shingle, percent), "a", "b"), "components")
    named = comp.join(classes.select("node", "rep_id"), "node").groupBy("root").agg(F.min("rep_id").alias("least_id"))
    linked = comp.join(named, "root").select("node", "root", "least_id")
    ids = classes.select("node", "rep_id").join(linked, "node", "left").select(F.col("node").alias("_n"), F.coalesce("root", "node").alias("root"), F.coalesce("least_id", "rep_id").alias("least_id"))
    return rows.join(ids, (F.col("node") == F.col("_n")) & (F.col("n_shingles") > 0), "left").select("doc_id", "uid", "n_shingles", "root", "least_id")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (columns doc_id and text)."""
    out = _grouped(docs, shingle, percent)
    return out.select("doc_id", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8), with its own columns."""
    found = saved(_grouped(docs, 5, 80).select("doc_id", "uid", "root"), "near")
    # by the row's key, since an id may be null or stand on rows of different groups
    keep = found.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("keep"))
    gone = small_side(saved(found.join(keep, "root").where("uid <> keep.uid").select(F.col("uid").alias("gone")).distinct(), "near-gone"))
    # packed, so that a column of the input may be called what it likes
    rows = docs.select(_uid(), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    left = rows.join(gone, F.col("uid") == F.col("gone"), "left_anti")
    if not found.groupBy("uid").count().where("count > 1").join(gone, F.col("uid") == F.col("gone"), "left_anti").isEmpty():
        left = left.dropDuplicates(["uid"])  # of equal rows one stays
    return left.select("row.*")
