"""Quality, decontamination, language model, tokens, pieces, chat and html against brute force, SQL or libraries."""

import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import chat_format, decontaminate, html_extract, lm_score, quality, sentence_pieces, tokens
from tidelog.llm.queries import ORACLES, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = ", ".join(df.columns)
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(map(repr, duck.sql(f"select {cols} from ({ORACLES[name]})").fetchall()))


def base_of(text):
    w, lines, seen, dup = words(text), (text or "").split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_quality(spark, sf, doc_rows, duck):
    got = {r.doc_id: r for r in quality.op1_quality_llr(spark, sf).collect()}
    for d, t in doc_rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_of(t)
        assert not (r.base_failed and r.kept)
    labels = dict(duck.sql("select doc_id, min(quality) from labels group by 1").fetchall())
    rated = [(labels[d], r) for d, r in got.items() if d in labels and not r.base_failed]
    assert all(r.kept == bool(q) for q, r in rated)


def test_quality_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c d"), (3, "a b")], "doc_id long, text string")
    raw, target = quality.ngram_counts(docs, np.array([1]), "doc_id", "text", 64)
    assert (raw.sum(), target.sum()) == (5 + 3 + 3, 5)
    w = quality.log_ratio(raw, target)
    assert np.allclose(w, np.log((target + 0.5) / (5 + 32)) - np.log((raw + 0.5) / (11 + 32)))
    assert not quality.log_ratio(raw, target * 0).any()


def test_quality_odd_and_empty(spark, sf, odd, none):
    out = quality.filter_stage(spark, odd, sf)
    assert out.columns == odd.columns and {r.doc_id for r in out.collect()} <= {5, 6}
    assert quality.filter_stage(spark, none, sf).count() == 0
    w, t = quality.fit(odd, spark.createDataFrame([(None, 1), (99, 1), (5, None)], "doc_id long, quality int"))
    assert not w.any() and t == -math.inf


def contaminated(docs, items, n=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for k, t in items:
        w = find(t)
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(k)
    for d, t in docs:
        w, hit, got = find(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    got |= windows[tuple(w[i : i + m])]
        yield d, len(w), len(hit), sorted(got)


@pytest.mark.parametrize("block", [500_000, 3])
def test_decontamination(spark, block):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(30)] + ["Ünï", "a-b"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [("i10", "w1 w2 w3"), ("i2", "Ünï, W7!"), ("i3", ""), ("i4", None), *((f"j{k}", text(14)) for k in range(8))]
    some = [t for _, t in items if t]
    docs = [(k, text(80) + " " + rng.choice(some).upper() + " " + text(5) if k % 3 else text(60)) for k in range(25)] + [(98, None), (99, "")]
    found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), block=block)
    got = sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect())
    # A-Z alone are lower-cased, so an upper-cased umlaut is another word
    assert got == sorted(contaminated(docs, items))


def test_decontamination_odd(spark, sf, odd, none):
    assert decontaminate.clean_stage(spark, odd, sf).columns == odd.columns
    assert decontaminate.clean_stage(spark, odd, sf).count() == 11 and decontaminate.clean_stage(spark, none, sf).count() == 0
    bench = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contamination(odd, bench).where("n_hit > 0").count() == 0


def test_lm_base_and_split(spark, sf, doc_rows):
    got = {r.doc_id: r for r in lm_score.lm_scores(spark.read.parquet(f"{sf}/documents.parquet"), block_bytes=100_000, shard_bytes=150_000).collect()}
    tok = lambda t: [*words((t or "").translate(LOWER)), "</s>"]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in doc_rows}
    c = Counter(x for d, t in doc_rows if not held[d] for x in tok(t))
    n, v = sum(c.values()), len(c)
    for d, t in doc_rows:
        r, w = got[d], tok(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_is_a_distribution(spark, order):
    """Continuations of a text sum to one: every known word, the end, and one unseen word for the rest."""
    free = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5 != 1]
    train = list(zip(free, ["a b a c", "a b b", "c a b a", "b"], strict=False))
    ask = [k for k in range(1000, 9000) if zlib.crc32(str(k).encode()) % 5 == 1][:5]
    texts = ["a b", "a b a", "a b b", "a b c", "a b zz"]
    docs = spark.createDataFrame(train + list(zip(ask, texts, strict=True)), "doc_id long, text string")
    s = {r.doc_id: r.score for r in lm_score.lm_scores(docs, order=order, mu=2.0).collect()}
    # the end token's own share is score(text) less its prefix, found by brute force below
    p = brute_model([t for _, t in train], order, 2.0)
    for k, t in zip(ask, texts, strict=True):
        assert s[k] == pytest.approx(p(t))


def brute_model(train, order, mu):
    seqs = [["<s>", *t.split(), "</s>"] for t in train]
    count = [Counter(tuple(q[i : i + m]) for q in seqs for i in range(len(q) - m + 1) if m > 1 or q[i] != "<s>") for m in range(1, order + 1)]
    context = [Counter(tuple(q[i : i + m]) for q in seqs for i in range(len(q) - m)) for m in range(1, order + 1)]
    n, v = sum(count[0].values()), len(count[0])
    once, twice = (sum(c == k for c in count[0].values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def prob(w, ctx):
        if not ctx:
            return (count[0][(w,)] - d) / n if count[0][(w,)] else d * v / n
        c, m = context[len(ctx) - 1][ctx], len(ctx)
        lower = prob(w, ctx[1:])
        return (count[m][(*ctx, w)] + mu * lower) / (c + mu) if c else lower

    vocab = [w for (w,) in count[0]]
    for ctx in ((), ("a",), ("b",), ("zz",), ("<s>",)):
        if len(ctx) < order:
            assert sum(prob(w, ctx) for w in [*vocab, "unseen"]) == pytest.approx(1)

    def score(text):
        q = ["<s>", *text.split(), "</s>"]
        return sum(math.log10(prob(q[i], tuple(q[max(0, i - order + 1) : i]))) for i in range(1, len(q)))

    return score


def test_lm_odd_and_empty(odd, none):
    out = {(r.doc_id, r.n_tokens) for r in lm_score.lm_scores(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (None, 3)} <= out and lm_score.lm_scores(none).count() == 0


def test_token_counts(spark, sf, doc_rows):
    tok = tokens._tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    extra = [" " * 3000 + "x" + "\n" * 200 + "<|endoftext|> y" * 100, "日本語" * 900, "a" * 4000, "ab " * 3000, "a b  c" * 300]
    rows = [*doc_rows[:60], *((10_000 + k, t) for k, t in enumerate(extra)), (20_000, None), (20_001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: len(tok.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    for chunk, overlap in ((32_768, 256), (500, 4)):
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk=chunk, overlap=overlap).collect()}
        assert got == {d: (len((t or "").encode()), want[d], want[d] > 512) for d, t in rows}


def test_pieces_equal_the_library(spark, doc_rows):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    texts = [t for _, t in doc_rows[:80]] + [None, "", " ", "   ", "a  b", "\n\n x", "▁", "a▁b", "x" * 700, "ab" * 400 + " é", "<unk> <0x41> </s>", "\x00\x01 👩‍👧", " lead", "trail "]
    texts += ["".join(rng.choice("ab ▁é\n!.1日") for _ in range(rng.randrange(60))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sentence_pieces.encode_table(docs, path).collect():
        assert r.ids == sp.encode(texts[r.doc_id] or "") and r.round_trip and r.n_pieces == len(r.ids)


def test_viterbi_equals_brute_force():
    rng = random.Random(6)
    pieces = sorted({"▁" * rng.randrange(2) + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(40)} | {"▁", "a", "b"})
    scores = np.array([0.0, *(-rng.random() * 9 for _ in pieces)])
    m = sentence_pieces.PieceModel(["<unk>", *pieces], scores, np.array([2] + [1] * len(pieces)), bpe=False)
    by = {p: s for p, s in zip(pieces, scores[1:], strict=True)}

    def best(w):
        top = {0: 0.0}
        for j in range(1, len(w) + 1):
            top[j] = max(top[i] + (by[w[i:j]] if w[i:j] in by else m.floor if j - i == 1 else -math.inf) for i in range(j))
        return top[len(w)]

    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 25))) for _ in range(200)] + ["abc" * 40]
    ids, first = sentence_pieces.Encoder(m).encode(texts)
    for k, t in enumerate(texts):
        got = sum(m.floor if i == 0 else scores[i] for i in ids[first[k] : first[k + 1]])
        assert got == pytest.approx(sum(best(w) for w in re.findall("▁+[^▁]*", m.prepare(t))))


def test_chat_of_unsound_json(spark):
    bad = ['{"tool_call_id":"a","content":"\\ud800"}', '{"tool_call_id":"b","content":NaN}', '{"tool_call_id":"c","content":1e999}', "{" * 5000]
    rows = [(1, k, "tool", t) for k, t in enumerate(bad)] + [(None, None, None, None), (1, 9, "tool", '{"tool_call_id":"\\udfff","content":1}')]
    ev = chat_format.parse_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = chat_format.format_events(chat_format.link(ev), {}).collect()
    kinds = {r.turn: (r.kind, r.canonical) for r in got}
    assert len(got) == 6 and [kinds[k][0] for k in (0, 1, 2, 3, 9)] == ["result", "message", "message", "message", "result"]
    assert "\\ud800" in kinds[0][1] and kinds[9][0] == "result"
    assert chat_format.parse_events(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_links_order_and_validation(spark):
    call = lambda *cs: json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in cs]})
    result = lambda i, c: json.dumps({"tool_call_id": i, "content": c})
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", call(("a", "f", {"x": 1}), ("b", "f", {"x": {"$result": "a"}}), ("c", "g", {}))), (1, 2, "tool", result("b", 2)), (1, 3, "tool", result("a", {"z": 1, "a": "é"})), (1, 4, "tool", result("q", 0)), (1, 5, "tool", result("a", 9)),
            (2, 0, "assistant", call(("p", "f", {"y": {"$result": "r"}}), ("r", "f", {"y": {"$result": "p"}}))), (2, 1, "tool", result("p", 1)), (2, 2, "tool", result("r", 1)), (3, None, None, None), (None, 0, "assistant", "{not json")]
    ev = chat_format.parse_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    schemas = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": ["integer", "object"]}}}}
    out = chat_format.format_events(chat_format.link(ev), schemas).collect()
    by = {(r.conv_id, r.turn, r.call_id): r for r in out}
    assert by[1, 2, "b"].status == "linked" and by[1, 4, "q"].status == "orphan" and by[1, 5, "a"].status == "repeated" and by[1, 1, "c"].status == "unanswered"
    order = [(r.call_id, r.kind) for r in sorted((r for r in out if r.conv_id == 1 and r.status == "linked"), key=lambda r: (r.order_turn, r.level, r.turn, r.part))]
    assert order == [("a", "call"), ("a", "result"), ("b", "call"), ("b", "result")]
    assert by[1, 1, "a"].valid and by[1, 1, "b"].valid and by[1, 1, "c"].valid is False and by[2, 0, "p"].valid is False
    assert by[2, 0, "p"].level is None
    assert by[1, 3, "a"].canonical == '{"call_id":"a","content":{"a":"é","z":1},"conv_id":1,"role":"tool","turn":3}'
    assert len(out) == 14


def test_schema_rules():
    v = chat_format.valid
    assert v(1.0, {"type": "integer"}) and not v(True, {"type": "integer"}) and v([1], {"type": "array", "items": {"minimum": 1}}) and not v([0], {"items": {"minimum": 1}})
    assert not v({"a": 1}, {"properties": {}, "additionalProperties": False}) and v("ab", {"pattern": "^a", "maxLength": 2}) and not v("x", {"enum": ["y"]}) and v(None, {"const": None})


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body class="no-sidebar">
<header>Site</header><nav><ul><li><a href=/x>Menu</a></ul></nav><!-- c --><div class="ad">Buy &amp; go</div><div id="cookie-notice">Cookies</div>
%s<aside>Side</aside><section class="comments"><article>A comment</article></section><form><p>Mail<input></form><footer>&copy; all</footer></body></html>"""


def test_html_marks():
    body = "<h1>Head &lt;1&gt;</h1><p><b>One<br> two\n three<p>F&eacute;e&nbsp;x<ul><li>i<li>j</ul><script>x</script><div hidden>no</div><p>A <i>b</i>c</p>"
    want = "Head <1>\nOne two three\nFée x\ni\nj\nA bc"
    assert html_extract.extract(PAGE % f"<article>{body}</article>", set()) == want
    assert html_extract.extract(PAGE % f"<main>{body}</main>", set()) == want
    assert html_extract.extract(PAGE % f"<div class='c1'>{body}</div>", set()) == want
    assert html_extract.extract("", set()) == "" and html_extract.extract("plain <", set()) == "plain <"


def test_html_template_text(spark):
    rows = [(k, f"http://h/{k}", f"<html><body><div class=x1>Welcome all</div><div class=x2><p>Text {k} of page</p></div><div class=x3>Imprint</div></body></html>") for k in range(9)]
    rows += [(90, None, None), (91, "http://other/1", "<p>only</p>"), (None, "http://h/9", "")]
    out = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == ("Text 3 of page", 14) and out[90] == ("", 0) and out[91] == ("only", 4) and out[None] == ("", 0)
    assert html_extract.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def slots_brute(pages):
    """The article's slot of unmarked pages of one host, by hand: the deepest div path of all pages with 60 percent of their text."""
    total, below = 0, {}
    for blocks in pages:
        for path, text in blocks:
            total += len(text)
            for k in range(1, len(path) + 1):
                below[path[:k]] = below.get(path[:k], 0) + len(text)
    best = max((p for p, c in below.items() if 100 * c >= 60 * total), key=len)
    return ["\n".join(t for p, t in blocks if p[: len(best)] == best) for blocks in pages]


def test_html_template_chooses_the_slot(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    pages, rows = [], []
    for k in range(12):
        blocks = [(("a", "m"), say(2)) for _ in range(rng.randrange(1, 4))] + [(("a", "b", "c"), say(rng.randrange(20, 60))) for _ in range(rng.randrange(2, 6))] + [(("a", "b"), say(3)), (("a", "e"), say(rng.randrange(4)) or "x")]
        pages.append(blocks)
        body = "".join("".join(f"<div class={c}>" for c in p) + f"<p>{t}</p>" + "</div>" * len(p) for p, t in blocks)
        rows.append((k, f"http://h/{k}", f"<html><head><title>t {k}</title></head><body><div class=top>Shop</div>{body}</body></html>"))
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == dict(enumerate(slots_brute(pages)))
    assert all(len(html_extract.extract(h, set())) > len(got[k]) for k, _, h in rows)  # without the template, the other slots stay


def test_html_template_chooses_among_marked_parts(spark):
    rows = [(k, f"http://h/{k}", f"<body><section><article class=teaser>Teaser {k}</article></section><section><article class=full><header><h1>Head {k}</h1></header><div><p>{'long text ' * 20}{k}</p></div></article></section><div class='ad no-print'>buy {k}</div></body>") for k in range(5)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Head {k}\n{'long text ' * 20}{k}" for k in range(5)}
    assert html_extract.extract("<article>a<div class='share has-icons'>b</div><div class=has-sidebar>c</div></article>", set()) == "a\nc"


def test_html_odd_rows(spark):
    long = "<article>" + "<p>some words of a text</p>" * 20_000 + "</article>"
    rows = [(1, "http://a/1", long, 1, 2), (2, "http://a/2", "<p>x</p>", 3, 4), (2, "http://a/2", "<p>x</p>", 3, 4), (3, None, None, 5, 6)]
    got = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, main long, tokens long")).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, 20_000 * len("some words of a text") + 19_999), (2, 1), (2, 1), (3, 0)]


def test_html_pages(spark, sf, duck):
    """Every page of the table: its one article, whose blocks a plain cut by tags gives."""
    import html

    out = {r.page_id: r for r in html_extract.op9_html_extract(spark, sf).collect()}
    pages = duck.sql("select page_id, html from pages").fetchall()
    assert len(out) == len(pages)
    for k, page in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2|h3|ul|li|div|blockquote|table|tr|td)(?:\s[^>]*)?>", re.sub(r"<!--.*?-->", "", body, flags=re.S))
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0][:3] == "<br" else "", b))).strip() for b in blocks]
        assert out[k].text == "\n".join(x for x in lines if x) and out[k].n_chars == len(out[k].text)


def test_pipeline(spark, sf, duck):
    out = corpus_pipeline.run(spark, sf).collect()
    ids = [r.doc_id for r in out]
    all_ids = {d for (d,) in duck.sql("select doc_id from documents").fetchall()}
    assert len(ids) == len(set(ids)) and set(ids) <= all_ids and all(r.round_trip for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "sentence pieces"]
    good = {d for (d,) in duck.sql("select doc_id from labels where quality = 1").fetchall()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, sf).collect()}
    failed = {r.doc_id for r in quality.op1_quality_llr(spark, sf).where(F.col("base_failed")).collect()}
    assert good - failed <= kept


def test_pipeline_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_counts_beyond_32_bits():
    for a in ([], [0, 1, 2**32 - 1], [3, 2**32, 2**45]):
        assert lm_score._unpack(lm_score._pack(np.array(a, dtype=np.int64))).tolist() == a
