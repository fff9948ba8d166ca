"""Main-text extraction with a site style tree.

1. Each page is parsed in Arrow batches into elements (path of tags with their
   first class) and text blocks. Per batch the elements of pages of one
   host are merged: a path keeps the number of its instances, of each child
   sequence (its presentation styles), the mean share of each child, and, where it
   holds text, the number of pages with each word. Spark sums these over all
   pages, so a host with a third of the pages is many partial sums, not one group.
2. Importance of an element with children: the entropy of its styles, mixed with
   its children's importance, ``(1 - g**l) * entropy + g**l * sum(share * child)``
   for ``l`` styles. Importance of a text node: one minus the mean entropy of its
   words over the pages, times the squared share of its blocks of four words or more
   that no other page of the host has (headings and labels aside), times (outside <article> and <main>) the share of
   its characters that are no links. Sums per path are native, and so is the recursion: joins
   and aggregates on (host, path), without a group per host. A path is made of tags
   and classes (of ids only where they name layout), not of anchors and slugs.
3. An element is noise if it and all below it lie under ``threshold`` times the
   importance of the host's main text (the path with most characters times importance). Each page is walked again and the blocks below
   noise are left out, as are elements that say what they are (``nav``, ``aside``,
   ``class="comments"``, ...), which alone decide on hosts of one page. Of these, a
   named element that holds the host's text is a wrapper and stays: ``held`` is the
   text below it on all pages, ``needed`` a multiple of what lies beside it. A section named for reader
   comments is one only where the main heading lies in it, whatever its length.

Defined cases: null html gives an empty text; a null url is the host ``''``;
equal page ids are separate pages; unclosed and stray tags are closed as HTML
closes them; an element nested deeper than ``MAX_DEPTH`` shares its ancestor's
path (its text stays); extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import stage

GAMMA = 0.9
MAX_DEPTH = 24

# Element names of HTML and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
#: Elements of formulas and drawings; their text belongs to the text around them.
DRAWN = frozenset("math semantics annotation maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
                  "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
                  "svg circle defs desc ellipse g line lineargradient marker mask path pattern polygon polyline rect stop symbol "
                  "text textpath tspan use".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split()) | DRAWN
FURNITURE = frozenset("head nav footer button select script style textarea title noscript template iframe".split())
#: Furniture unless it holds the page's text, as are forms and elements with a role or a name.
HOLDERS = frozenset("aside dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
NAMED = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert\w*|adbox|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notices|alert|popup|modal|"
    r"newsletter|subscribe|subscription|signup|login|nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side|widgets?|"
    r"footer|foot|masthead|topbar|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|"
    r"pagination|pager|toolbar|skip)(?:$|[-_\s\d])", re.IGNORECASE)
#: A candidate whose name begins so is furniture unless it holds ``SAID`` times the text beside it, one that
#: only mentions such a word (``content has-sidebar``) unless it holds ``MENTIONED`` times that.
#: A form, often one around the whole page, lies between.
SAID, FORM, MENTIONED = 4.0, 1.0, 0.5
#: Names of sections of reader comments. However long, such a section is furniture where the page's main heading
#: (its first h1, else the beginning of its first article, else its first heading) lies outside.
COMMENTS = re.compile(r"^\s*(?:comments?|commentlist|disqus|replies|respond)(?:$|[-_\s\d])", re.IGNORECASE)
READERS = 2 * SAID  # marks them; of the text they must hold they are judged like other named elements
#: Class names that a style compiler makes up; what follows the prefix differs from page to page.
MADE_UP = re.compile(r"^(css|sc|jsx|jss|emotion|styled|svelte|astro|_ngcontent|_)[-_]?[A-Za-z0-9]{4,}$")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
STOPS = frozenset("ul ol dl table select article section div body".split())

#: Headings and labels are the same on many pages without being furniture.
LABEL = re.compile(r"/(?:h[1-6]|th|dt|caption|figcaption|legend|label)(?:\.[^/]*)?$")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
                   r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                   r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
#: Words of ids that name a part of the layout; other ids (anchors, slugs) are no part of a path.
LAYOUT = NAMED.pattern.split("(?:", 2)[2].rsplit(")(?:", 1)[0]
LAYOUT_ID = re.compile(
    rf"(?:(?:{LAYOUT}|header|head|main|content|contents|wrapper|wrap|container|page|body|left|right|center|middle|top|bottom|inner|"
    r"outer|column|col|primary|secondary|article|post|entry|story|text|site|logo)(?:[-_]|\d+|$))+", re.IGNORECASE)


@lru_cache(maxsize=1 << 14)
def multiple_of(class_: str, id_: str) -> float:
    """Of the text beside it, what an element of these names must hold; 0 if they do not name furniture."""
    names = class_, id_
    found = [m for m in map(NAMED.search, names) if m]
    if not found:
        return 0.0
    return READERS if any(map(COMMENTS.match, names)) else SAID if any(m.start() == 0 for m in found) else MENTIONED


@lru_cache(maxsize=1 << 14)
def sign_of(name: str, class_: str, id_: str) -> str:
    """An element's part of a path: its tag and first class, or an id that names layout."""
    mark = class_.split()
    if not mark and LAYOUT_ID.fullmatch(id_):
        mark = [id_]
    return name + ("." + re.sub(r"\d+", "0", MADE_UP.sub(r"\1", mark[0])).replace("/", "_") if mark else "")


class Page:
    """A page's text blocks ``(paths of the elements around it, furniture, text, named, linked)`` and elements.

    ``named`` are the paths of the elements around a block that are furniture unless they hold the page's text,
    with the multiple of the text beside them that they must hold; ``linked`` is the number of characters that are links.
    """

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[tuple[str, ...], bool, str, dict[str, float], int]] = []
        self.children: list[tuple[str, list[str]]] = []  # of each element, in order of closing
        self._text: list[str] = []
        self._linked = 0
        self._paths: tuple[str, ...] = ("",)
        self._open: list[tuple[str, tuple[str, ...], bool, list[str], float]] = [("", ("",), False, [], 0.0)]
        self._parse(source)

    def _flush(self) -> None:
        if self._text:
            text = SPACE.sub(" ", "".join(self._text)).strip()
            linked, self._text, self._linked = min(self._linked, len(text)), [], 0
            if text:
                _, paths, furniture, below, _ = self._open[self._block()]
                below.append("#text")
                named: dict[str, float] = {}
                for o in self._open:
                    if o[4]:
                        named[o[1][-1]] = max(o[4], named.get(o[1][-1], 0.0))
                self.blocks.append((paths, furniture or any(o[2] for o in self._open), text, named, linked))

    def _block(self) -> int:
        k = len(self._open) - 1
        while self._open[k][0] in INLINE:
            k -= 1
        return k

    def _close(self, to: int) -> None:
        while len(self._open) > to:
            name, paths, _, below, _ = self._open.pop()
            if name not in INLINE:
                self.children.append((paths[-1], below))

    def _start(self, name: str, attributes: str) -> None:
        inline = name in INLINE
        if not inline:
            self._flush()
            names = [o[0] for o in self._open]
            if name in CLOSED_BY:
                for k in range(len(names) - 1, 0, -1):
                    if names[k] in CLOSED_BY[name]:
                        self._close(k)
                        if name != "tr" or names[k] == "tr":
                            break
                    elif names[k] in STOPS:
                        break
            elif "p" in names[1:]:
                k = len(names) - 1 - names[::-1].index("p")
                if not STOPS.intersection(names[k:]):
                    self._close(k)
        if name in VOID:
            return
        said = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
        furniture = name in FURNITURE
        holds = 0.0  # the multiple of the text beside it that the element must hold, if it is a candidate
        if not furniture and name not in ("body", "html", "main", "article"):
            names = [said.get("class", "").strip(), said.get("id", "").strip()]
            if name == "form":
                holds = FORM
            elif name in HOLDERS or said.get("role", "").lower() in ROLES or (
                    name == "header" and not any(o[0] in ("article", "main") for o in self._open)):
                holds = SAID
            else:
                holds = multiple_of(*names)
        if inline:
            # without a path of its own, an inline element holds no page
            self._open.append((name, self._open[-1][1], furniture or bool(holds), [], 0.0))
            return
        sign = sign_of(name, said.get("class", ""), said.get("id", ""))
        at = self._block()
        paths, below = self._open[at][1], self._open[at][3]
        below.append(sign)
        if len(paths) < MAX_DEPTH:
            paths = (*paths, f"{paths[-1]}/{sign}")
        self._open.append((name, paths, furniture, [], holds))

    def _end(self, name: str) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k][0] == name:
                if name not in INLINE:
                    self._flush()
                    self._close(k)
                else:
                    del self._open[k:]
                return
            if name in INLINE and self._open[k][0] not in INLINE:
                return

    def _parse(self, source: str) -> None:
        at = 0
        while True:
            m = TOKEN.search(source, at)
            text = source[at:m.start() if m else len(source)]
            if text:
                self._text.append(html.unescape(text))
                if any(o[0] == "a" for o in self._open):
                    self._linked += len(self._text[-1].strip())
            if not m:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self._text.append(m[0][9:-3])
                continue
            if m[1] or m[4]:
                self._end(name)
            elif name in RAW:
                if (m[3] or m[6] or "").endswith("/"):
                    continue
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
                if name not in INLINE:
                    self._flush()
            elif name in ("br", "hr"):
                self._flush()
            elif name not in DRAWN or not (m[3] or m[6] or "").endswith("/"):
                self._start(name, m[3] or m[6] or "")
        self._flush()
        self._close(0)


#: A batch's merged elements: kind 0 instances, 1 words (pages with each), 2 styles, 3 share of the parent, 4 text that
#: a candidate for furniture holds and needs, 5 whole blocks (pages with each), 6 characters, those in links, those not of comments.
MERGED = "host string, path string, kind int, features array<string>, counts array<double>"


MAIN_HEADING = [re.compile(r"/h1(?:\.[^/]*)?$"), re.compile(r"/(?:article|main)(?:[./]|$)"), re.compile(r"/h[2-6](?:\.[^/]*)?$")]


def around_heading(page: Page) -> frozenset[str] | None:
    """The candidates around the page's main heading; None where it has none."""
    for kind in MAIN_HEADING:
        for paths, furniture, _, named, _ in page.blocks:
            if not furniture and kind.search(paths[-1]):
                return frozenset(named)
    return None


def named_text(page: Page) -> dict[str, list[float]]:
    """Of each candidate's path: characters below it, and how many it needs to hold the page's text.

    The text beside a candidate is the rest of the page without surer furniture: for comments all of it, for a
    wrapper that only mentions comments not the comments beside it. Comments that the main heading is not in hold nothing.
    """
    found: dict[str, list[float]] = {}
    blocks = [(len(text) - linked, named) for _, furniture, text, named, linked in page.blocks if not furniture]
    heading = around_heading(page)
    for path, times in {p: t for _, named in blocks for p, t in named.items()}.items():
        held = sum(n for n, named in blocks if path in named)
        beside = sum(n for n, named in blocks if path not in named and all(
            t <= times or path.startswith(f"{p}/") for p, t in named.items()))
        if times == READERS:
            times = SAID
            if heading is not None and path not in heading:
                held, beside = 0, max(beside, 1)
        found[path] = [float(held), times * beside]
    return found


def style_of(below: list[str]) -> str:
    return ",".join(f"{k}*{len([*g])}" for k, g in groupby(below))


def merge_pages(pages: Iterator[tuple[str, str]]) -> list[tuple[str, str, int, list[str], list[float]]]:
    merged: dict[tuple[str, str, int], Counter] = defaultdict(Counter)
    for host, source in pages:
        page = Page(source)
        for path, below in page.children:
            merged[host, path, 0][""] += 1
            if below:
                merged[host, path, 2][style_of(below)] += 1
                for child, n in Counter(below).items():
                    merged[host, f"{path}/{child}", 3][""] += n / len(below)
        words: dict[str, set[str]] = defaultdict(set)
        texts: dict[str, set[str]] = defaultdict(set)
        for paths, furniture, text, named, linked in page.blocks:
            words[paths[-1]].update(text.lower().split())
            if text.count(" ") >= 3 and not LABEL.search(paths[-1]):  # table cells and the like recur by chance
                texts[f"{paths[-1]}/#text"].add(blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest())
            merged[host, f"{paths[-1]}/#text", 6]["all"] += len(text)
            merged[host, f"{paths[-1]}/#text", 6]["linked"] += linked
            if not furniture and READERS not in named.values():
                merged[host, f"{paths[-1]}/#text", 6]["main"] += len(text)
        for path, hashes in texts.items():
            merged[host, path, 5].update(hashes)
        for path, (held, needed) in named_text(page).items():
            merged[host, path, 4]["held"] += held
            merged[host, path, 4]["needed"] += needed
        for path, found in words.items():
            merged[host, f"{path}/#text", 0][""] += 1
            merged[host, f"{path}/#text", 1].update(found)
    return [(*key, [*c], [float(n) for n in c.values()]) for key, c in merged.items()]


def site_trees(pages: DataFrame, host: str = "host", source: str = "html", batch_pages: int = 1500) -> DataFrame:
    """One row per ``(host, path)``: instances, styles' and words' sums, share of the parent."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("kind", pa.int32()),
                            ("features", pa.list_(pa.string())), ("counts", pa.list_(pa.float64()))])
        for batch in batches:
            for at in range(0, batch.num_rows, batch_pages):
                part = batch.slice(at, batch_pages)
                rows = merge_pages(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    rows = pages.select(F.col(host), F.col(source)).mapInArrow(merged, MERGED).select(
        "host", "path", "kind", F.explode(F.arrays_zip("features", "counts")).alias("f"))
    node = F.xxhash64("host", "path")
    feature = F.xxhash64("f.features")
    name = F.col("kind") == 0
    sums = rows.select(node.alias("node"), "kind", feature.alias("feature"), F.col("f.counts").alias("n"),
                       F.when(name, F.col("host")).alias("host"), F.when(name, F.col("path")).alias("path")).groupBy(
        "node", "kind", "feature").agg(F.sum("n").alias("n"), F.max("host").alias("host"), F.max("path").alias("path"))
    of = lambda k, x: F.when(F.col("kind") == k, x)
    named = lambda k, name: F.sum(F.when((F.col("kind") == k) & (F.col("feature") == F.xxhash64(F.lit(name))), F.col("n")))
    return sums.groupBy("node").agg(
        F.max("host").alias("host"), F.max("path").alias("path"), F.sum(of(0, F.col("n"))).alias("instances"),
        F.count(of(1, F.lit(1))).alias("words"), F.sum(of(1, F.log("n"))).alias("word_logs"),
        F.count(of(2, F.lit(1))).alias("styles"), F.sum(of(2, F.col("n"))).alias("styled"),
        F.sum(of(2, F.col("n") * F.log("n"))).alias("style_logs"),
        F.sum(of(3, F.col("n"))).alias("share"),
        named(4, "held").alias("held"), named(4, "needed").alias("needed"),
        F.sum(of(5, F.col("n"))).alias("blocks"), F.sum(F.when((F.col("kind") == 5) & (F.col("n") > 1), F.col("n"))).alias("repeated"),
        F.coalesce(named(6, "main"), named(6, "all") * 0).alias("chars"), (named(6, "linked") / named(6, "all")).alias("linked")).where("instances IS NOT NULL").drop("node")


ABOVE = "transform(sequence(1, size(split(path, '/', -1))), i -> concat_ws('/', slice(split(path, '/', -1), 1, i)))"


def importance(tree: DataFrame) -> DataFrame:
    """Each ``(host, path)`` with its composite importance, the largest ``below`` or at it, and that of the host's ``best`` text,
    the one with the most characters times importance.

    The recursion is linear, so a path's importance is the sum of its descendants' own terms, each times the weights
    of the edges on the way down. These travel with each path (``MAX_DEPTH`` at most): joins and aggregates on
    ``(host, path)`` do it, and no host is one group.
    """
    entropy = F.when(F.col("styled") > 1, F.greatest(F.lit(0.0), (
        F.log("styled") - F.col("style_logs") / F.col("styled")) / F.log("styled"))).otherwise(1.0)
    words = F.when(F.col("words") == 0, 0.0).when(F.col("instances") <= 1, 1.0).otherwise(
        1 - F.least(F.lit(1.0), F.col("word_logs") / F.col("words") / F.log("instances")))
    # whole blocks that recur on other pages of the host, and links where no article is
    repeated = F.coalesce(F.col("repeated") / F.col("blocks"), F.lit(0.0))
    linked = F.when(F.col("path").rlike(r"/(?:article|main)(?:[./]|$)"), 0.0).otherwise(F.coalesce("linked", F.lit(0.0)))
    words = words * F.pow(1 - repeated, F.lit(2.0)) * (1 - linked)
    passed = F.pow(F.lit(GAMMA), F.col("styles"))
    leaf = F.col("styled").isNull()
    nodes = stage(tree.select(
        "host", "path", "share", "chars", (F.col("held") >= F.col("needed")).alias("holds"),
        F.when(leaf, words).otherwise((1 - passed) * entropy).alias("own"),
        F.when(~leaf, passed / F.col("styled")).alias("passed")), "style-tree")
    above = nodes.select("host", F.col("path").alias("parent"), "passed")
    edges = nodes.where("path != ''").select(
        "host", "path", "share", F.regexp_replace("path", "/[^/]*$", "").alias("parent")).join(above, ["host", "parent"]).select(
        "host", F.col("path").alias("at"), (F.col("share") * F.col("passed")).alias("weight"))
    chains = nodes.select("host", "path", "own", F.posexplode(F.expr(ABOVE)).alias("depth", "at"))
    ways = chains.join(edges, ["host", "at"], "left").groupBy("host", "path").agg(
        F.max("own").alias("own"), F.array_sort(F.collect_list(F.struct("depth", "at", F.coalesce(
            "weight", F.lit(0.0)).alias("weight")))).alias("way"))
    terms = ways.select("host", F.explode(F.expr(
        "transform(way, (x, i) -> struct(x.at AS path, own * aggregate(slice(way, i + 2, size(way)), "
        "cast(1 AS double), (p, y) -> p * y.weight) AS term))")).alias("t"))
    scored = terms.groupBy("host", "t.path").agg(F.sum("t.term").alias("importance"))
    scored = stage(scored.join(nodes.select("host", "path", "chars", "holds"), ["host", "path"]), "importance")
    below = scored.select("host", "importance", F.explode(F.expr(ABOVE)).alias("path")).groupBy("host", "path").agg(
        F.max("importance").alias("below"))
    best = scored.where("chars IS NOT NULL").groupBy("host").agg(
        F.max_by("importance", F.struct(F.col("importance") * F.col("chars"), "path")).alias("best"))
    return scored.join(below, ["host", "path"]).join(best, "host", "left").fillna(0.0, ["best"])


def marked_paths(pages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``(host, path, noise)`` of ``pages(host, html)``: elements to leave out, and named ones that hold the text (noise is false)."""
    scored = importance(site_trees(pages))
    noise = F.col("below") < threshold * F.col("best")
    return scored.where(noise | F.col("holds")).select("host", "path", noise.alias("noise"))


def main_text(source: str, noise: frozenset[str], kept: frozenset[str] = frozenset()) -> str:
    return " ".join(text for paths, furniture, text, named, _ in Page(source).blocks
                    if not furniture and kept.issuperset(named) and noise.isdisjoint(paths) and f"{paths[-1]}/#text" not in noise)


def extract(pages: DataFrame, threshold: float = 0.5, salts: int = 16, page_id: str = "page_id", url: str = "url",
            source: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages``."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("html"))
    noise = stage(marked_paths(rows, threshold), "noise").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("path", "noise"))).alias("noise"))
    # a host's list is copied to every salt, so that the pages of one host spread where this join shuffles
    noise = noise.select(F.col("host").alias("noise_host"), "noise",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("noise_salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(salts)).cast("int"))
    joined = salted.join(noise, (F.col("host") == F.col("noise_host")) & (F.col("salt") == F.col("noise_salt")), "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: dict[str, tuple[frozenset[str], frozenset[str]]] = {}  # a host's noise, and what is kept
            texts = []
            for body, site, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), range(batch.num_rows)):
                if site not in lists:
                    marks = batch.column(4)[at].as_py() or ()
                    lists[site] = (frozenset(m["path"] for m in marks if m["noise"]),
                                   frozenset(m["path"] for m in marks if not m["noise"]))
                texts.append(main_text(body, *lists[site]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)
    return joined.select("page_id", "url", "html", "host", "noise").mapInArrow(
        extracted, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")
