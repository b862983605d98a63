r"""HTML extraction by equivalence classes of page tokens on one host.

A page's tokens are its tags with their path and class names, and its text blocks with their
path.  For each (host, token) the occurrence vector over the host's pages is folded into an
order-free fingerprint, so tokens with equal vectors meet by a group-by with partial
aggregation and no host's pages are ever gathered.  Tokens with the same fingerprint form a
class; a class is valid with ``MIN_CLASS`` tokens or more and a support of ``MIN_PAGES`` pages
and half of the host's.  Valid classes nest by their paths into the host's template.  What
is left of a page are its slots: the text below each of the template's tags that is not template
text.  The article is the slot of the deepest tag that holds ``MAIN_PERCENT`` of the host's slot text;
navigation, headers, footers, asides, forms, adverts, notices and reader comments (told by
tag, role, class and id) count for nothing there and are dropped.  Where a page marks its main
part, marks settle how far the article's slot reaches: to the marked parts that it meets,
template text or not, since an article may repeat a line of another page and have a heading
of its own tag.  Pages without the slot, and hosts without a template, rely on marks alone.

Edge cases: null or empty html gives an empty text; a null url or page id is a value like any
other; hosts with few pages have no template and rely on the marks alone; unclosed and
misnested tags are closed as browsers do for paragraphs, items and cells; repeated pages
are extracted row by row; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import lean, prepare, saved, table

MIN_CLASS, MIN_PAGES, MAIN_PERCENT = 2, 3, 60
#: Template tokens broadcast at most (16 bytes each); more are joined by host.
BROADCAST_TOKENS = 2_000_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[a-z0-9]+")
_WHITE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split())
_DROP_TAG = frozenset("nav footer aside form head noscript template button select option datalist svg canvas audio video object dialog menu map".split())
#: Marks of a part that is not the article, as words of class, id or role.
_DROP_MARK = frozenset(
    """ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion promotions banner
    sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent
    gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup
    share sharing social related recommended recommendations comment comments commentlist disqus replies reply respond
    discussion login search searchform widget widgets pagination pager skip hidden copyright contentinfo complementary
    form dialog""".split()
)
_MAIN_MARK = frozenset("article articlebody post entry story content main".split())
#: What opens inside these is closed by a new one of the same kind.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("article section div main body table ul ol dl blockquote aside nav footer header form".split())


class Block:
    """A text block: path, white-space-folded text, and where it stands: in which marked part, if any."""

    __slots__ = ("dropped", "main", "part", "path", "text")

    def __init__(self, path: str, text: str, dropped: bool, main: int, part: str):
        self.path, self.text, self.dropped, self.main, self.part = path, text, dropped, main, part


def _marks(attrs: str) -> tuple[set[str], bool, str]:
    """(words of class, id and role; hidden; class names as they stand)."""
    if not attrs or attrs.isspace():
        return set(), False, ""
    words: set[str] = set()
    hidden, cls = False, ""
    low = attrs.lower()
    for m in _ATTR.finditer(low):
        name, value = m[1], m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop"):
            # has-sidebar, no-ads and the like tell of something else than the part itself
            named = (_NAME.findall(x) for x in value.split())
            words.update(w for ws in named if ws and ws[0] not in ("no", "with", "has") for w in ws)
            if name == "class":
                cls = value
        elif (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
    if re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub(" ", low)):
        hidden = True
    return words, hidden, cls


def parse(page: str) -> tuple[list[str], list[Block]]:
    """(tag tokens in page order, text blocks in page order)."""
    tags: list[str] = []
    blocks: list[Block] = []
    # name, path, dropped, main: 3 main part, 2 article, 1 marked by name, 0 none; path of what marks it
    stack: list[tuple[str, str, bool, int, str]] = [("", "", False, 0, "")]
    parts: list[str] = []
    place = stack[0]

    def text(raw: str) -> None:
        nonlocal place
        if raw:
            if not parts or (len(parts) == 1 and not parts[0].strip()):
                place = stack[-1]
            parts.append(raw)

    def flush() -> None:
        if parts:
            # references first: a no-break space in a text is white space too
            folded = _WHITE.sub(" ", html_lib.unescape("".join(parts))).strip()
            parts.clear()
            if folded:
                blocks.append(Block(place[1], folded, *place[2:]))

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name not in _INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in _INLINE and stack[k][0] not in _INLINE:
                    break
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE:
            flush()
            shut = _CLOSES.get(name) or ({"p"} if name in _SCOPE or name[0] == "h" and name[1:].isdigit() or name in ("pre", "hr") else set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    del stack[k:]
                    break
                if stack[k][0] in _SCOPE and not (name == "tr" and stack[k][0] != "table"):
                    break
        _, above, dropped, main, part = stack[-1]
        before = main
        words, hidden, cls = _marks(m[3] or m[6] or "")
        path = f"{above}/{name}.{cls}" if cls else f"{above}/{name}"
        if name not in _INLINE:
            tags.append(path)
        if name == "main" or "role" in (m[3] or "") and "main" in words:
            main = 3
        elif (name == "article" or "articlebody" in words) and main < 2:
            main = 2
        elif not main and name in ("div", "section", "td") and words & _MAIN_MARK:
            main = 1
        if main != before:
            part = path
        if not dropped and name not in ("html", "body"):
            bad = words & _DROP_MARK
            head = (name == "header" or "header" in words) and not main
            dropped = hidden or name in _DROP_TAG or name in _RAW or head or (bool(bad) and name != "main")
        if name in _RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()
            if end is not None:
                close = page.find(">", at)
                at = n if close < 0 else close + 1
            continue
        if name not in _VOID:
            stack.append((name, path, dropped, main, part))
    flush()
    return tags, blocks


def token_hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _above(path: str) -> Iterator[str]:
    """The path and those of the tags around it."""
    while path:
        yield path
        path = path.rpartition("/")[0]


def extract(page: str, template: set[int], main: int | None = None) -> str:
    """The main text of a page; ``template`` holds the token hashes of its host's template text, ``main`` that of the tag with the article's slot."""
    _, blocks = parse(page)
    kept = [b for b in blocks if not b.dropped]
    slot = []
    if main is not None:
        inside = {p: any(token_hash(q) == main for q in _above(p)) for p in {b.path for b in kept}}
        slot = [b for b in kept if inside[b.path]]
    own = slot or kept
    best = max((b.main for b in own), default=0)
    if best:
        parts = {b.part for b in own if b.main == best}
        own = [b for b in kept if b.part in parts]
    else:
        own = [b for b in own if token_hash(b.path, b.text) not in template]
    return "\n".join(b.text for b in own)


def _host(url_col: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def occurrence_vectors(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(host, token, is_text, depth, n_pages, n_seen, chars, vector): the fingerprint of each token's occurrence vector; chars: of the text below a tag (token 0: of all) that marks do not drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, key, token, kind, depth, seen, chars = [], [], [], [], [], [], []
            for h, k, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                tags, blocks = parse(page or "")
                count = Counter((token_hash(t), False, t.count("/")) for t in tags)
                count.update((token_hash(x.path, x.text), True, x.path.count("/")) for x in blocks)
                count[(0, False, 0)] = 1
                below: Counter[str] = Counter()
                for x in blocks:
                    if not x.dropped:
                        for p in ("", *_above(x.path)):
                            below[p] += len(x.text)
                size = {token_hash(p) if p else 0: c for p, c in below.items()}
                for (t, text, d), c in count.items():
                    host.append(h), key.append(k), token.append(t), kind.append(text), depth.append(d), seen.append(c), chars.append(0 if text else size.get(t, 0))
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(token, pa.int64()), pa.array(kind, pa.bool_()), pa.array(depth, pa.int32()), pa.array(seen, pa.int32()), pa.array(chars, pa.int64())], list("abcdefg"))

    rows = pages.select(_host(url_col).alias("host"), F.xxhash64(id_col, url_col).alias("page"), F.col(html_col).cast("string").alias("html")).mapInArrow(lean(run), "host string, page long, token long, is_text boolean, depth int, seen int, chars long")
    return rows.groupBy("host", "token", "is_text", "depth").agg(F.count("*").alias("n_pages"), F.sum("seen").alias("n_seen"), F.sum("chars").alias("chars"), F.bit_xor(F.xxhash64("page", "seen")).alias("vector"))


def templates(vectors: DataFrame) -> DataFrame:
    """(host, tokens, classes, main): template text of each host, its valid classes from the outside in, and the tag of the article's slot.

    Tokens of half of a host's pages number twice a page's tokens at most, which bounds a host's row.
    """
    hosts = vectors.where("token = 0").select("host", F.col("n_pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    common = vectors.where((F.col("n_pages") >= MIN_PAGES) & (F.col("token") != 0)).join(hosts, "host").where("2 * n_pages >= host_pages")
    holds = F.expr(f"not is_text and chars > 0 and 100 * chars >= {MAIN_PERCENT} * host_chars")
    classes = common.groupBy("host", "vector", "n_pages", "n_seen").agg(F.count("*").alias("size"), F.min("depth").alias("least"), F.collect_list(F.when(F.col("is_text"), F.col("token"))).alias("tokens"), F.max(F.when(holds, F.struct("depth", "chars", "token"))).alias("deepest"))
    valid = classes.where(F.col("size") >= MIN_CLASS)
    return valid.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"), F.array_sort(F.collect_list(F.struct(F.col("least").alias("depth"), "size", "n_pages"))).alias("classes"), F.max("deepest")["token"].alias("main"))


def extract_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages."""
    spark = prepare(pages.sparkSession)
    vectors = saved(occurrence_vectors(pages, html_col, url_col, id_col), "vectors")
    made = saved(templates(vectors), "templates")
    some = made.where("size(tokens) > 0 or main is not null").select("host", "tokens", "main")
    size = some.agg(F.sum(F.size("tokens") + 4)).first()[0] or 0
    hosted = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("html"), _host(url_col).alias("host"))
    joined = hosted.join(F.broadcast(some) if size <= BROADCAST_TOKENS else some, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(page or "", set(t or ()), m) for page, t, m in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(x) for x in texts], dtype=np.int64))], list("abcd"))

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    return joined.select(id_col, url_col, "html", "tokens", "main").mapInArrow(lean(run), f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
