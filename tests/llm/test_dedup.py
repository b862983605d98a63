"""Line, passage and near-duplicate removal against brute force."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidelog.llm import components, line_dedup, near_dup, suffix_dedup
from tidelog.llm import textnum as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        self[self.find(a)] = self.find(b)


def near_brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    g, post = Groups(), defaultdict(list)
    for i, s in enumerate(sets):
        seen = defaultdict(int)
        for x in s:
            for j in post[x]:
                seen[j] += 1
            post[x].append(i)
        for j, c in seen.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                g.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[g.find(i)] = min(least.get(g.find(i), d), d)
    return {d: (len(sets[i]), least[g.find(i)]) for i, (d, _) in enumerate(rows)}


def variants(rng, n, words=80, edits=6):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        yield " ".join(w)


def test_near_dup_on_documents(spark, sf, doc_rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.op4_minhash_near_dedup(spark, sf).collect()}
    assert got == near_brute(doc_rows, 3, 85)


def test_near_dup_large_groups_and_common_passage(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(70))
    texts = [*variants(rng, 120), *variants(rng, 40, 300, 25), *(passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60))) for _ in range(60)), "same text here", "same text here", "Same  TEXT here", None, ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


@pytest.mark.parametrize("open_", [0, 128])
def test_near_dup_without_turns_is_whole(spark, monkeypatch, open_):
    """The last step finds what leaders leave, in lists of a common passage and of a large group, by lists (128) or full sets (0)."""
    monkeypatch.setattr(near_dup, "TURNS", 0)
    monkeypatch.setattr(near_dup, "OPEN", open_)
    monkeypatch.setattr(near_dup, "BLOCK", 20)
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(300))
    texts = list(variants(rng, 80, 100, 9))
    for _ in range(40):
        own = [f"q{rng.randrange(10**6)}" for _ in range(40)]
        texts.append(passage + " " + " ".join(own))
        own[rng.randrange(40)] = "other"
        texts.append(passage + " " + " ".join(own))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


def test_near_dup_of_very_small_sets(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        w = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        texts += [" ".join(w), " ".join(w[:8])]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_brute(rows, 5, 80)


def test_near_dup_odd_and_empty(spark, odd, none):
    out = near_dup.near_duplicates(odd, 5, 80).collect()
    assert len(out) == 11 and near_dup.near_duplicates(none).count() == 0
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id in (1, 2, 5, 6)} == {(1, 1), (2, 2), (5, 5), (6, 5)}
    left = near_dup.dedup_stage(spark, odd, "")
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 9]


def test_near_dedup_stage_with_repeated_and_null_ids(spark):
    one, two, own = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(0, one), (1, one), (1, own), (None, two), (None, two), (2, ""), (2, "")]
    left = near_dup.dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(0, one), (1, own), (None, two), (2, "")], key=str)


def test_near_dup_chains_and_inner_passages(spark):
    """Copies of copies, whose ends are far apart, and pairs that differ in the middle of a passage that all share."""
    rng = random.Random(12)
    texts = []
    for _ in range(3):
        w = [f"w{rng.randrange(4000)}" for _ in range(60)]
        for _ in range(12):
            w[rng.randrange(60)] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    passage = [f"p{k}" for k in range(200)]
    for _ in range(50):
        w = passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 60))]
        texts.append(" ".join(w))
        w[rng.randrange(200)] = "x"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


def test_near_dedup_deletes_what_it_needs_no_longer(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "OPEN", 0)
    line_dedup.prepare(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    kinds = ("postings-", "open-", "rooted-", "prefixes-")
    there = lambda: {x for x in os.listdir(root) if x.startswith(kinds)}
    before = there()
    passage = [f"p{k}" for k in range(60)]
    rows = [(d, " ".join(passage + [f"q{d}x{k}" for k in range(20)])) for d in range(12)]
    rows += [(20, rows[0][1] + " x"), (21, rows[1][1][1:])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)
    assert {x for x in there() - before if any(f.endswith(".parquet") for f in os.listdir(f"{root}/{x}"))} == set()


def test_near_dedup_stage_with_clashing_columns(spark):
    one, own = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    kind = "doc_id long, text string, _gone long, gone long, uid long, row string, root string"
    left = near_dup.dedup_stage(spark, spark.createDataFrame([(0, one, 1, 2, 3, "r", "x"), (1, one, 4, 5, 6, "s", "y"), (2, own, 7, 8, 9, "t", "z")], kind), "")
    assert sorted(map(tuple, left.collect())) == [(0, one, 1, 2, 3, "r", "x"), (2, own, 7, 8, 9, "t", "z")]


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    g = Groups()
    for a, b in edges:
        if a != b:
            g.join(a, b)
    least = defaultdict(lambda: 10**9)
    for x in g:
        least[g.find(x)] = min(least[g.find(x)], x)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: least[g.find(x)] for x in g if any(x in e and e[0] != e[1] for e in edges)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def line_brute(rows):
    occ = defaultdict(list)
    for d, t in rows:
        for n, line in enumerate(t.split("\n") if t is not None else []):
            m = line.strip(" \t\r").lower()
            if len(m) >= line_dedup.MIN_CHARS:
                occ[m].append((d, n))
    keys = list(occ)
    sets = [frozenset(m[i : i + 9] for i in range(max(1, len(m) - 8))) for m in keys]
    g, post = Groups(), defaultdict(list)
    for i, s in enumerate(sets):
        seen = defaultdict(int)
        for x in s:
            for j in post[x]:
                seen[j] += 1
            post[x].append(i)
        for j, c in seen.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                g.join(i, j)
    first = {}
    for i, m in enumerate(keys):
        r = g.find(i)
        first[r] = min(first.get(r, (10**9, 0)), min(occ[m]))
    gone = defaultdict(set)
    for i, m in enumerate(keys):
        for p in occ[m]:
            if p != first[g.find(i)]:
                gone[p[0]].add(p[1])
    return gone


def test_line_dedup_on_documents(spark, sf, doc_rows):
    gone = line_brute(doc_rows)
    for r in line_dedup.op2_line_dedup(spark, sf).collect():
        text = next(t for d, t in doc_rows if d == r.doc_id)
        lines = (text or "").split("\n")
        kept = "\n".join(x for n, x in enumerate(lines) if n not in gone[r.doc_id])
        assert (r.n_removed, r.kept_sha256) == (len(gone[r.doc_id]), hashlib.sha256(kept.encode()).hexdigest())


def test_line_dedup_is_native_and_takes_odd_rows(spark, odd, none):
    out = line_dedup.dedup_lines(odd.select("doc_id", "text"))
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
    assert out.count() == 11 and line_dedup.dedup_lines(none).count() == 0
    stage = line_dedup.line_stage(spark, odd, "")
    assert stage.columns == odd.columns and stage.dtypes == odd.dtypes
    texts = {r.doc_id: r.text for r in stage.collect() if r.doc_id is not None}
    assert texts[1] is None and texts[2] == "" and 5 in texts and 6 not in texts


def removed_here(docs):
    rows = line_dedup.dedup_lines(docs).select("_row.doc_id", "_gone").collect()
    return {r.doc_id: r._gone for r in rows if r._gone}


def test_line_dedup_of_repeated_content(spark):
    rows = list(enumerate(["-" * k for k in range(16, 80, 4)] + ["ha " * k + "ha" for k in (9, 20, 60)] + ["a line of its own that nothing else repeats"]))
    want = {d: len(x) for d, x in line_brute(rows).items()}
    assert len(want) == 17 and removed_here(spark.createDataFrame(rows, "doc_id long, text string")) == want


@pytest.mark.parametrize("turns", [0, 4])
def test_line_dedup_of_many_variants_of_a_line(spark, monkeypatch, turns):
    monkeypatch.setattr(line_dedup, "TURNS", turns, raising=False)
    monkeypatch.setattr(line_dedup, "BLOCK", 50, raising=False)
    rng = random.Random(4)
    base = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(1000)}" for _ in range(60)]
    rows = []
    for d in range(120):
        w = list(base)
        for _ in range(rng.randrange(2, 6)):
            w[rng.randrange(60)] = f"z{rng.randrange(10**5)}"
        rows.append((d, " ".join(w)))
    want = {d: len(x) for d, x in line_brute(rows).items()}
    assert 15 < len(want) and removed_here(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_line_dedup_finds_short_lines(spark):
    """Pairs of lines of three to eight words, edited at an end: recall by brute force."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    rows = []
    for k in range(300):
        one = " ".join(word() for _ in range(3 + k % 6))
        if len(one) >= 20:
            rows += [one, one[: -1 - k % 3] + "z", one + " " + word()[: 1 + k % 3], one[1 + k % 2 :]]
    rows = list(enumerate(rows))
    want = {d: len(x) for d, x in line_brute(rows).items()}
    got = removed_here(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(want) > 300 and set(got) <= set(want) and len(got) >= 0.995 * len(want)


def test_line_dedup_rules_unlike_brief_lines_out_before_the_exact_test(spark, monkeypatch):
    """Lines that share a passage of a few shingles meet in its bands, but are no pairs to compare in full."""
    rng = random.Random(8)
    met, exact = [], line_dedup.confirmed
    monkeypatch.setattr(line_dedup, "confirmed", lambda pairs, *more: met.append(pairs.count()) or exact(pairs, *more))
    rows = [(d, "".join(rng.choice("abcdefghijklmnop") for _ in range(30)) + " shared passage") for d in range(80)]
    rows += [(100, rows[0][1] + "x"), (101, rows[1][1][2:])]
    want = {d: len(x) for d, x in line_brute(rows).items()}
    assert len(want) == 2 and removed_here(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert sum(met) <= 10


def test_line_dedup_rules_out_pairs_not_far_below_the_bound(spark, monkeypatch):
    """Lines of similarity 0.7 share many bands; their bitmaps alone tell them apart, and no linked pair from them."""
    rng = random.Random(9)
    met, exact = [], line_dedup.confirmed
    monkeypatch.setattr(line_dedup, "confirmed", lambda pairs, *more: met.append(pairs.count()) or exact(pairs, *more))
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    base = " ".join(word() for _ in range(66))
    rows = [(d, base + "".join(" " + word() for _ in range(15))) for d in range(60)]
    rows += [(100, rows[0][1] + " x"), (101, rows[1][1][20:])]
    want = {d: len(x) for d, x in line_brute(rows).items()}
    assert len(want) == 2 and removed_here(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert sum(met) <= 60


def test_line_dedup_deletes_what_it_needs_no_longer(spark, odd):
    line_dedup.prepare(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    kinds = ("line-signatures", "line-posts", "line-open", "line-pairs")
    there = lambda: {x for x in os.listdir(root) if x.startswith(kinds)}
    before = there()
    line_dedup.removed_lines(line_dedup._keyed(odd.select("doc_id", "text")))
    assert {x for x in there() - before if any(f.endswith(".parquet") for f in os.listdir(f"{root}/{x}"))} == set()


def passages_brute(texts, k=200):
    enc = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for i, b in enumerate(enc):
        for p in range(len(b) - k + 1):
            seen[b[p : p + k]].append((i, p))
    cover = [np.zeros(len(b), bool) for b in enc]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                cover[i][p : p + k] = True
    out = []
    for b, c in zip(enc, cover, strict=True):
        kept = np.frombuffer(b, np.uint8)[~c].tobytes()
        out.append((len(b), int(c.sum()), int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_dedup(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT", 2)
        monkeypatch.setattr(suffix_dedup, "CROWD", 3)
        monkeypatch.setattr(suffix_dedup, "BATCH", 200)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    blob = lambda n: " ".join(word() for _ in range(n))
    passage, other = blob(120), blob(60)
    texts = [blob(50) + passage[rng.randrange(100) : 300 + rng.randrange(150)] + blob(rng.randrange(60)) for _ in range(25)]
    texts += [passage[:150] + other + passage[100:], other + other, passage, passage, "z" * 1000, "ab" * 300, "ab" * 99, "q" * 199, "q" * 199, None, "", blob(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.dedup(docs).collect()}
    assert [got[k] for k in range(len(texts))] == passages_brute(texts)


def test_suffix_dedup_odd_and_empty(odd, none):
    out = suffix_dedup.dedup(odd).collect()
    assert len(out) == 11 and {r.n_removed == r.n_bytes for r in out if r.doc_id in (5, 6)} == {True}
    assert suffix_dedup.dedup(none).count() == 0


def test_index_family():
    rng = np.random.default_rng(2)
    family, whole = suffix_dedup.IndexFamily(), []
    for _ in range(20):
        keys = rng.integers(0, 4000, rng.integers(1, 400)).astype(np.uint64)
        hit = family.add(keys)
        old = np.concatenate([np.zeros(0, np.uint64), *whole])
        assert (hit == (np.isin(keys, old) | np.array([(keys == k).sum() > 1 for k in keys]))).all()
        whole.append(keys)
    every = np.concatenate(whole)
    _, which, count = np.unique(every, return_inverse=True, return_counts=True)
    assert (family.matched() == (count[which] > 1)).all()
    sizes = [len(x) for x, _ in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


def test_text_primitives():
    for s in ("", "a b", " a  bb\tc\n", "é x"):
        b = np.frombuffer(s.encode(), np.uint8)
        w = T.runs(b, np.array([0, len(b)]), T.NOT_SPACE)
        assert [bytes(b[x:y]).decode() for x, y in zip(w.start, w.end, strict=True)] == s.split()


def test_hashes_are_polynomials_modulo_a_prime():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, T.PRIME, 500, dtype=np.uint64) for _ in range(2))
    a[:3], b[:3] = (0, T.PRIME - 1, T.PRIME - 1), (5, T.PRIME - 1, 1)
    assert [int(x) for x in T.product(a, b)] == [int(x) * int(y) % T.PRIME for x, y in zip(a, b, strict=True)]
    buf = rng.integers(0, 256, 3000).astype(np.uint8)
    buf[:100] = buf[1000:1100] = buf[2500:2600] = 255
    h = T.prefix_hash(buf)
    x, want = 1, [0]
    for c in buf:
        want.append((want[-1] + (int(c) + 1) * x) % T.PRIME)
        x = x * T._STEP % T.PRIME
    assert [int(v) for v in h] == want
    at = np.array([0, 1000, 2500, 1])
    got = T.range_hash(h, at, at + 100)
    assert got[0] == got[1] == got[2] != got[3]


def test_strings_that_collide_modulo_a_power_of_two():
    """The Thue-Morse word and its complement have equal polynomials modulo 2**64 at every odd base."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    b = np.frombuffer((one + two).encode(), np.uint8)
    h = T.range_hash(T.prefix_hash(b), np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] != h[1]


def test_prefix_hash_over_chunks(monkeypatch):
    b = np.random.default_rng(3).integers(0, 256, 5000).astype(np.uint8)
    whole = T.prefix_hash(b)
    monkeypatch.setattr(T, "_CHUNK", 64)
    assert (T.prefix_hash(b) == whole).all()
