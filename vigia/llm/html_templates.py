"""HTML extraction by equivalence-class template deduction.

Every page is read as tokens: tags, each with its path of open elements, and
pieces of text (what stands between two tags), each with its path.  Tag tokens
that occur equally often on every page of a host have equal occurrence vectors;
they form an equivalence class.  The vectors are never gathered: a token's
vector is summed up in a 128-bit fingerprint (two sums over the host's distinct
pages of a page hash times the count there), so a host of any size needs grouped
sums only, aggregated before the shuffle.  A class of tags is valid if enough
pages have it and its tokens nest.  A piece of text outside articles that
nearly all distinct pages of the host have at the same path belongs to the
template too.  The valid classes are the host's template; what lies between
template tokens are slots.

The template's text is dropped from every page, unless that leaves nothing;
pieces of one class that stand out of the template's order on a page are text of
that page and stay.

A slot keeps the element it lies in.  Slots of menus, headers, footers,
sidebars, notices, adverts, forms and comments (by element, role or class name)
are page furniture; if the template has an article or main element, only slots
in it are content.  The remaining slots are the article: blocks in page order,
character references decoded, white space inside a block one space.

Hosts of too few pages to deduce a template, and pages that miss their host's
template, are read with the element rules alone.

Cases: a null or empty page has the empty text; the text of formulas stays,
drawings, buttons, selections and objects are furniture; pages without any markup are
one block; broken markup never fails, unclosed elements end with their parent;
repeated rows are extracted alike; a null url is a host of its own; a table
without rows gives none; columns with the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re
from bisect import bisect_right
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .common import record_batch, text_slices

# HTML elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
FOREIGN = frozenset(("svg", "math"))
HTML_AGAIN = frozenset("foreignobject desc mtext mi mo mn ms annotation-xml".split())  # HTML within foreign elements
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul
br""".split())
CLOSES_P = BLOCKS - {"br"}
FURNITURE = frozenset("nav header footer aside form head menu dialog".split())
INLINE_FURNITURE = frozenset("svg object select button annotation annotation-xml".split())
CONTENT = frozenset(("article", "main"))
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
FURNITURE_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies disclaimer footer header masthead menu modal nav navbar navigation newsletter notice notification
pagination popup promo promoted recommended related replies reply respond share sharing sidebar skip social sponsor
sponsored subscribe subscription toolbar widget""".split())
#: Words that leave a furniture word's meaning: ``comment-list``, but not ``related-work``.
PLAIN_NAMES = frozenset("""area articles bar block box button buttons container content form inner item items links list outer
posts section signup slot stories thread wrapper""".split())
LAYOUT_NAMES = frozenset("layout wrapper container page grid open enabled".split())
PATH_DEPTH = 64  # elements whose names a path spells out; those below are one hash of theirs

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<bogus>[!?][^>]*(?:>|\Z))|(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)"
                  r"(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|/[^>]*(?:>|\Z))", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Za-z]+")


class Token:
    """A tag or a piece of text, with the path of elements that it lies in."""

    __slots__ = ("kind", "name", "path", "text", "furniture", "content")

    def __init__(self, kind, name, path, text, furniture, content):
        self.kind, self.name, self.path = kind, name, path
        self.text, self.furniture, self.content = text, furniture, content


def _is_furniture(name: str, attributes: str, article: bool = False) -> int:
    """3 for what stands in a line (buttons, drawings), 2 if the element, its role or the first word of a class or id says so, 1
    if another word does (``with-sidebar``: perhaps a wrapper), else 0.  Inside
    an article ids are mostly titles (``related-work``): there an id, or a class
    of a heading or section, must say so in all its words, and a heading's id
    says nothing."""
    if name in INLINE_FURNITURE:
        return 3
    if name in FURNITURE:
        return 1 if name == "form" else 2  # some servers put the whole page, article and all, in a form
    if not attributes or name in ("html", "body", "article", "main"):
        return 0
    by_name = 0
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in FURNITURE_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return 2
        if key in ("class", "id"):
            titles = article and (key == "id" or name in HEADINGS or name == "section")
            if titles and key == "id" and name in HEADINGS:
                continue
            for words in map(_NAME.findall, value.split()):
                if any(w in FURNITURE_NAMES for w in words):
                    if titles and not FURNITURE_NAMES | PLAIN_NAMES >= {*words}:
                        continue
                    by_name = max(by_name, 2 if words[0] in FURNITURE_NAMES and not LAYOUT_NAMES & {*words} else 1)
    return by_name


def tokens(page: str) -> list[Token]:
    """The page's tokens in order.  Raw elements (scripts, styles) are one tag
    token without their content."""
    out: list[Token] = []
    # Name, in furniture, in an article, path; which open element is the nearest drawing, formula or HTML inside one.
    open_: list[tuple[str, int, bool, str, int]] = []
    path = ""
    at, n = 0, len(page)
    named: Counter[str] = Counter()  # open elements by name: no search for what is not open

    def state():
        return open_[-1][1:3] if open_ else (0, False)

    def close_to(k: int):
        nonlocal path
        while len(open_) > k:
            inside = state()
            name, _, _, path, _ = open_.pop()
            named[name] -= 1
            out.append(Token("end", name, path, "", *inside))

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            out.append(Token("text", "", path, page[at:], *state()))
            break
        if m.start() > at:
            out.append(Token("text", "", path, page[at: m.start()], *state()))
        at = max(m.end(), m.start() + 1)
        if m["name"] is None:
            continue
        name, attributes = m["name"].lower(), m["attributes"] or ""
        if m["close"]:
            k = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None) if named[name] else None
            if k is not None:
                close_to(k)
            elif name == "p":
                out.append(Token("end", "p", path, "", *state()))
            continue
        edge = open_[-1][4] if open_ else -1
        if name in BLOCKS and edge >= 0 and open_[edge][0] in FOREIGN:  # HTML ends an open svg or math
            close_to(edge)
        if name in ("select", "button") and named[name]:  # these do not nest
            k = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if k is not None:
                close_to(k)
        if name in CLOSES_P and named["p"]:  # a block ends an open paragraph
            k = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == "p"), None)
            if k is not None and not any(x[0] in CLOSES_P - {"p"} for x in open_[k + 1:]):
                close_to(k)
        if name in ("li", "dt", "dd", "option", "tr", "td", "th"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(name, (name,))
            stop = {"li": ("ul", "ol", "menu"), "tr": ("table", "tbody", "thead", "tfoot"),
                    "td": ("tr",), "th": ("tr",)}.get(name, ("dl", "select"))
            for k in range(len(open_) - 1, -1, -1) if any(named[x] for x in same) else ():
                if open_[k][0] in same:
                    close_to(k)
                    break
                if open_[k][0] in stop:
                    break
        if name in RAW:
            out.append(Token("start", name, path, "", *state()))
            end = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        inside, article = state()
        furniture = max(inside, _is_furniture(name, attributes, article))
        if name in CONTENT and not article and furniture == 1:
            furniture = 0  # a wrapper's class name (``with-sidebar``) says nothing of the article in it
        out.append(Token("start", name, path, "", furniture, article or name in CONTENT))
        if name not in VOID and not attributes.rstrip().endswith("/"):
            edge = len(open_) if name in FOREIGN or name in HTML_AGAIN else open_[-1][4] if open_ else -1
            open_.append((name, furniture, article or name in CONTENT, path, edge))
            named[name] += 1
            path = f"{path}/{name}" if len(open_) <= PATH_DEPTH else _deeper(path, name)
    close_to(0)
    return out


def _deeper(path: str, name: str) -> str:
    """The path of an element below ``PATH_DEPTH``: the spelled-out part and a
    hash of all that follows."""
    spelled = path.partition("/~")[0]
    return f"{spelled}/~{hashlib.sha256(f'{path}/{name}'.encode()).hexdigest()[:16]}"


def _key(t: Token) -> str:
    """What a token is told apart by: its kind, path and name, or its text's hash."""
    name = hashlib.sha256(" ".join(t.text.split()).encode()).hexdigest()[:24] if t.kind == "text" else t.name
    return f"{t.kind[0]}{t.path}/{name}"


# -- templates ----------------------------------------------------------------

_COUNT = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("token", T.StringType()),
    T.StructField("page", T.LongType()), T.StructField("n", T.LongType()), T.StructField("place", T.DoubleType())])


def _count_tokens(schema: T.StructType, html: str, texts: bool):
    """Of each page its distinct tag tokens, with ``texts`` also its pieces of
    text that neither are furniture anyway nor lie in an article, with their
    count and first place."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, html, 1 << 20):
                rows = []
                for host, page, text in zip(part.column("host").to_pylist(), part.column("page").to_pylist(),
                                            part.column(html).to_pylist(), strict=True):
                    found: dict[str, list[int]] = {}
                    for k, t in enumerate(tokens(text or "")):
                        if t.kind != "text" or texts and not t.furniture and not t.content and t.text.strip():
                            found.setdefault(_key(t), []).append(k)
                    size = max(1, max((p[-1] for p in found.values()), default=1))
                    rows += [(host, key, page, len(p), p[0] / size) for key, p in found.items()]
                yield record_batch(schema, [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * len(schema))

    return run


def token_classes(pages: DataFrame, html: str = "html", url: str = "url", texts: bool = False, least_pages: int = 1) -> DataFrame:
    """(host, token, class, pages, share): the equivalence class of every tag
    token of every host, with the share of the host's distinct pages that have
    it; with ``texts`` also of the pieces of text on ``least_pages`` pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(html).alias("page"), F.col(html).alias(html))
    counts = (rows.mapInArrow(_count_tokens(_COUNT, html, texts), _COUNT)
              .groupBy("host", "token", "page").agg(F.max("n").alias("n"), F.max("place").alias("place")))  # copies count once
    big = "decimal(38,0)"
    # Equal vectors have equal sums; different ones almost never, twice over.
    vectors = counts.groupBy("host", "token").agg(
        F.sum(F.xxhash64("page").cast(big) * F.col("n").cast("decimal(9,0)")).alias("a"),
        F.sum(F.xxhash64(F.col("page"), F.lit(7)).cast(big) * F.col("n").cast("decimal(9,0)")).alias("b"),
        F.count(F.lit(1)).alias("pages"), F.avg("place").alias("place"))
    vectors = vectors.filter(~_is_text() | (F.col("pages") >= least_pages))
    hosts = rows.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return (vectors.join(hosts, "host")
            .select("host", "token", F.xxhash64("a", "b").alias("class"), "pages", "place",
                    (F.col("pages") / F.col("host_pages")).alias("share"), "host_pages"))


def _is_text() -> Column:
    return F.col("token").startswith("t")


def templates(pages: DataFrame, html: str = "html", url: str = "url", least_share: float = 0.5, least_pages: int = 3,
              least_tokens: int = 2, text_share: float = 0.9) -> DataFrame:
    """(host, template, classes): the tokens of a host's valid classes in order,
    with their classes.

    Valid: on ``least_share`` of at least ``least_pages`` distinct pages, with at
    least ``least_tokens`` tag tokens; a piece of text on ``text_share`` of them.
    Classes nest by their paths: a class counts if the elements that its tokens
    lie in belong to valid classes too."""
    every = token_classes(pages, html, url, True, math.ceil(least_pages * text_share)).filter(
        F.col("share") >= F.when(_is_text(), text_share).otherwise(least_share))
    found = reliable_checkpoint(every.filter(F.col("host_pages") >= least_pages), "token-classes")  # read twice below
    tags = found.filter(~_is_text())
    sizes = tags.groupBy("host", "class").agg(F.count(F.lit(1)).alias("tokens"))
    valid = tags.join(sizes, ["host", "class"]).filter(F.col("tokens") >= least_tokens).select(tags.columns)
    # A template has as many tokens as pages have paths and repeated pieces, whatever the host's size.
    return (valid.unionByName(found.filter(_is_text())).groupBy("host")
            .agg(F.sort_array(F.collect_list(F.struct("place", "token", "class"))).alias("t"))
            .select("host", F.col("t.token").alias("template"), F.col("t.class").alias("classes")))


def nested(template: list[str]) -> set[str]:
    """Tokens of the classes that nest: both tags of an element, in a parent
    that is in the template itself."""
    keys = {k for k in template if k[0] != "t"}
    out = set()
    for key in sorted(keys, key=len):
        parent = key[1:].rpartition("/")[0]
        if not parent or f"s{parent}" in out:
            other = ("e" if key[0] == "s" else "s") + key[1:]
            if other in keys or key[1:].rpartition("/")[2] in VOID | RAW:
                out.add(key)
    return out


# -- slots --------------------------------------------------------------------

def slots(page: str, template: set[str]) -> list[tuple[list[Token], bool]]:
    """Runs of tokens between template tokens, and whether each lies in an
    article element of the template."""
    out, run, inside = [], [], 0
    for t in tokens(page):
        if t.kind != "text" and _key(t) in template:
            out.append((run, inside > 0))
            run = []
            if t.name in CONTENT and not t.furniture:
                inside += 1 if t.kind == "start" else -1
            run.append(t)
        else:
            run.append(t)
    out.append((run, inside > 0))
    return out


def blocks_of(run: list[Token], pending: list[str], out: list[str], article: bool) -> None:
    """Adds the text blocks of a slot; ``pending`` is the open block."""
    for t in run:
        if t.kind == "text":
            if not t.furniture and (t.content or not article):
                pending.append(html_lib.unescape(t.text))
        elif t.name in BLOCKS or t.furniture in (1, 2):
            _close(pending, out)


def _close(pending: list[str], out: list[str]) -> None:
    if pending:
        text = " ".join("".join(pending).split())
        if text:
            out.append(text)
        pending.clear()


def in_order(ranks: list[int]) -> list[int]:
    """Places of a longest run of the ranks that never falls."""
    ends: list[int] = []  # ranks that end the best run of each length
    last: list[int] = []
    before = []
    for k, rank in enumerate(ranks):
        at = bisect_right(ends, rank)
        before.append(last[at - 1] if at else -1)
        ends[at: at + 1], last[at: at + 1] = [rank], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def drop_texts(found: list[Token], texts: dict[str, tuple[int, int]]) -> None:
    """Empties the pieces outside articles that are the template's: of each class
    those in its order.  What pages say alike inside their articles is theirs."""
    classes: dict[int, list[tuple[int, Token]]] = {}
    for t in found:
        if t.kind == "text" and not t.furniture and not t.content and t.text.strip():
            known = texts.get(_key(t))
            if known is not None:
                classes.setdefault(known[0], []).append((known[1], t))
    for pieces in classes.values():
        for k in in_order([rank for rank, _ in pieces]):
            pieces[k][1].text = ""


def extract_text(page: str | None, template: set[str] | None, texts: dict[str, tuple[int, int]] | None = None) -> str:
    """The article of a page without the template's ``texts`` (class and rank by
    token), unless nothing else is there.  Slots outside the template's article elements
    are furniture; without a template, or without an article in the page, the
    element rules alone decide."""
    if not page:
        return ""
    parts = slots(page, template or set())
    has_slots = any(inside for _, inside in parts)
    has_article = has_slots or any(t.content and t.kind == "text" and not t.furniture for run, _ in parts for t in run)
    if texts:
        drop_texts([t for run, _ in parts for t in run], texts)
    pending: list[str] = []
    out: list[str] = []
    for run, inside in parts:
        if has_slots and not inside and not any(t.content for t in run):
            _close(pending, out)
            continue
        blocks_of(run, pending, out, has_article)
    _close(pending, out)
    if texts and not out:
        return extract_text(page, template)
    return " ".join(out)


def host_of(url: Column) -> Column:
    """The host of a url in lower case; empty without one."""
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def extract(pages: DataFrame, html: str = "html", url: str = "url", keep_html: bool = False, **options) -> DataFrame:
    """The pages with ``text``, the article's text, and ``n_chars``.

    The templates (a few hundred tokens a host) are written first, so that the
    join to the pages by host knows their size: it is a broadcast below Spark's
    bound, else a shuffle whose large hosts adaptive execution splits."""
    pages = pages.drop(*(c for c in ("text", "n_chars", "_template", "_classes", "_host") if c != html))
    known = reliable_checkpoint(templates(pages, html, url, **options), "templates")
    known = known.withColumnRenamed("host", "_host").withColumnsRenamed({"template": "_template", "classes": "_classes"})
    rows = pages.withColumn("_host", host_of(F.col(url))).join(known, "_host", "left").drop("_host")
    kept = [f for f in pages.schema.fields if keep_html or f.name != html]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        seen: dict[tuple, tuple[set[str], dict[str, tuple[int, int]]]] = {}
        for batch in batches:
            for part in text_slices(batch, html, 1 << 20):
                texts = []
                for page, template, classes in zip(part.column(html).to_pylist(), part.column("_template"), part.column("_classes"),
                                                   strict=True):
                    mark = tuple(template.as_py() or []), tuple(classes.as_py() or [])
                    if mark not in seen:
                        if len(seen) > 1000:
                            seen.clear()
                        seen[mark] = nested(list(mark[0])), {
                            t: (c, k) for k, (t, c) in enumerate(zip(*mark, strict=True)) if t[0] == "t"}
                    texts.append(extract_text(page, *seen[mark]))
                yield record_batch(schema, [part.column(f.name) for f in kept] + [texts, [len(t) for t in texts]])

    return rows.mapInArrow(run, schema)
