"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are the styles of their
branches: the tags and classes from the root to a block of text. A node whose blocks
say the same on page after page has a low entropy and is unimportant, one whose
blocks differ is important. An inner node's importance is composed: of the entropy of its
presentation styles, which are the rows of styles that its children form on the pages,
and of the importances of its children. Nodes whose tag or class states a role (menu, footer,
advert, comment, ...) have a given importance of none; an article has it in full and
is never removed. A branch is noise if its node and all nodes below are unimportant; the
largest such branches are removed from every page.

The trees are whole: they have every branch of every page, at every depth, also those with a
given importance and those beside the article of a page.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from siglake.llm.common import filled, unused
from siglake.session import Steps, broadcast_if_small, small_batches, written


@dataclass(frozen=True)
class Settings:
    """least: importance from which a node stays. min_blocks: with fewer blocks of a
    host, a node's entropy says nothing and it stays. damping: what is left of the
    children's importance in a node with one presentation style; its power in a node with several."""

    least: float = 0.2
    min_blocks: int = 12
    damping: float = 0.9


# A child that is text of the node's own.
_TEXT = "#text"
# Styles that a path spells out. In a deeper one, each full stretch of so many, with all before it, is
# written as its hash behind a mark, which no name has: a path has a bounded length at any depth.
_STRETCH = 64
_MARK = "\x1e"
# What a block is to its page, and the most that an element holds: text with a given role, text beside the
# page's article, or main text.
_GIVEN, _BESIDE, _KEPT = 0, 1, 2
# Blocks, and elements, of a row that a page is handed on in, and about those of a batch of rows.
_PART = 1000
_BATCH = 20_000

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = {"script", "style", "textarea", "noscript", "template", "title"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Tags that do not start a block of their own.
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
_NO_TEXT = set(
    "script style noscript template title head nav footer aside form iframe object svg canvas button select option"
    " textarea input dialog menu".split()
)
_NO_TEXT_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar"
    " navigation sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent notice gdpr popup modal"
    " newsletter subscribe signup share sharing social related recommended pagination pager comment comments"
    " commentlist reply replies respond disqus login search toolbar widget complementary contentinfo".split()
)
# Of these, the ones whose articles are teasers, adverts or comments.
_LISTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu footer"
    " sidebar related recommended comment comments commentlist reply replies respond disqus complementary".split()
)
# With one of these before or behind it, a name of _NO_TEXT_NAMES keeps its meaning (site-footer, nav-links).
_AFFIXES = set(
    "site page main global primary secondary local sub top bottom left right mobile desktop container wrapper wrap inner outer"
    " box area block bar section slot unit item items list link links form posts post button buttons title text"
    " wp js bs md".split()
)
# What introduces text of its own; an article's header holds its title.
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "header"}
_HEADS = {"header", "masthead", "banner"}
_MAIN = {"article", "main"}
# A form with one of these inside is wrapped around the page.
_LANDMARKS = _MAIN | {"h1", "nav", "header", "footer"}
# A start of one of these ends an open element of the same kind.
_ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


def blocks(page: str) -> list[tuple[str, str]]:
    """(style path, text) of the blocks without a given role, in order.

    On a page with an article (or ``main``) only blocks inside one. Character
    references are decoded, white space becomes one blank. Unclosed and stray tags are
    tolerated; raw text ends at its own end tag, a head at the first thing that cannot be in one.

    Names state a role as a whole or with a common affix. Neither they nor the tag silence
    what is around a ``main``, a form around the page or an article, a wrapper of an article,
    or an article that is not inside another. An article among comments, teasers or the like
    counts beside the text without a role, if the page has no other. Names do not silence a
    heading.
    """
    return [(path, text) for path, text, _ in marked(page)]


class _Open(NamedTuple):
    """An open element. quiet: numbers of the silencing elements it is in or is; since: how
    many of them were around its article; hushed: no text, as it is inline."""

    tag: str = ""
    quiet: tuple[int, ...] = ()
    main: bool = False
    nested: bool = False
    since: int = 0
    hushed: bool = False
    block: int = 0  # number of the innermost element that is not inline, itself included; 0 is the page


class _Element(NamedTuple):
    path: str
    up: int  # number of the element around it
    level: int
    main: bool
    children: list[str]


class _Block(NamedTuple):
    at: int  # number of its element
    text: str
    main: bool
    held: int


class _Page(NamedTuple):
    """All blocks and elements in order; held: what each element holds, -1 without a block."""

    blocks: list[_Block]
    elements: list[_Element]
    held: list[int]

    def kept(self) -> list[_Block]:
        return [x for x in self.blocks if x.held == _KEPT]


def _child(path: str, level: int, style: str) -> str:
    """The path of a child of the node with this path and level, as ``_below``."""
    if not level:
        return style
    if level % _STRETCH == 0:
        path = _MARK + hashlib.sha256(path.encode()).hexdigest()
    return f"{path}/{style}"


def marked(page: str) -> list[tuple[str, str, bool]]:
    """``blocks`` with a flag of those inside an article."""
    found = _parsed(page)
    return [(found.elements[x.at].path, x.text, x.main) for x in found.kept()]


def styled(page: str) -> list[tuple[str, list[str], bool]]:
    """(style path, styles of the children in order, whether it is or is in an article) of each
    element that holds a block, be it main text or not."""
    found = _parsed(page)
    return [(x.path, x.children, x.main) for x, held in zip(found.elements, found.held) if held >= 0]


def _parsed(page: str) -> _Page:
    """All blocks of a page and all its elements but the inline ones."""
    found: list[tuple[int, str, bool, tuple[int, ...], int]] = []
    elements = [_Element("", -1, 0, False, [])]
    stack: list[_Open] = []
    kinds: list[str] = []  # of the silencing elements: form, wrapper or list
    lifted: set[int] = set()
    parts: list[str] = []

    def close_block() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            last = next((x for x in reversed(stack) if x.tag not in _INLINE), _Open())
            elements[last.block].children.append(_TEXT)
            found.append((last.block, text, bool(stack) and stack[-1].main, last.quiet, last.since))

    at = 0
    while True:
        token = _TOKEN.search(page, at)
        if not (stack and stack[-1].hushed):
            parts.append(page[at : token.start() if token else len(page)])
            if stack and stack[-1].tag == "head" and parts[-1].strip():
                stack.pop()
        if token is None:
            close_block()
            break
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        inline = tag in _INLINE
        if not inline:
            close_block()
        elif tag == "br":
            parts.append(" ")
        if token[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if inline and stack[i].tag not in _INLINE:
                    break
            continue
        if tag in _VOID or token[3].endswith("/") and inline:
            continue
        if tag == "p" or tag in _ENDS:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag not in _INLINE), None)
            if depth is not None and stack[depth].tag in _ENDS[tag]:
                del stack[depth:]
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if stack and stack[-1].tag == "head":  # whose end may be left out
            stack.pop()
        names = sorted({n.lower() for m in _NAMES.finditer(token[3]) for n in (m[1] or m[2] or m[3] or "").split()})
        above = stack[-1] if stack else _Open()
        center = tag == "main" or "main" in names
        article = (center or tag == "article") and not above.nested
        if above.quiet:
            if center and not above.main:
                lifted.update(above.quiet)
            elif article or tag in _LANDMARKS:
                lifted.update(i for i in above.quiet if kinds[i] == "form" or article and kinds[i] == "wrapper")
        roles = set() if tag in ("html", "body") or tag in _HEADINGS else _roles(names, above.main)
        kind = "form" if tag == "form" else "list"
        silent = tag in _NO_TEXT or tag == "header" and not above.main
        if roles and not silent:
            silent, kind = True, "list" if roles & _LISTS else "wrapper"
        quiet = above.quiet
        if silent and not article:
            quiet += (len(kinds),)
            kinds.append(kind)
        block = above.block
        if not inline:
            style = ".".join([tag, *names]).replace("/", "\x1f")  # which no name has
            outer = elements[block]
            outer.children.append(style)
            elements.append(_Element(_child(outer.path, outer.level, style), block, outer.level + 1, above.main or article, []))
            block = len(elements) - 1
        stack.append(
            _Open(
                tag,
                quiet,
                above.main or article,
                above.nested or tag == "article",
                len(above.quiet) if article else above.since,
                inline and (silent or above.hushed),
                block,
            )
        )
    loud = [all(i in lifted for i in quiet) for _, _, _, quiet, _ in found]
    kept = [x[2] and y for x, y in zip(found, loud)]
    if not any(kept):
        kept = [y or main and all(i in lifted for i in quiet[since:]) for (_, _, main, quiet, since), y in zip(found, loud)]
    blocks = [_Block(*x[:3], _KEPT if k else _BESIDE if y else _GIVEN) for x, y, k in zip(found, loud, kept)]
    held = [-1] * len(elements)
    for at, _, _, what in blocks:
        while at >= 0 and held[at] < what:
            held[at] = what
            at = elements[at].up
    return _Page(blocks, elements, held)


def _roles(names: list[str], in_article: bool) -> set[str]:
    """The roles that whole names state; a header inside an article holds its title."""
    found = set()
    for name in names:
        words = {w for w in re.split(r"[-_:]+", name) if w}
        roles = words & _NO_TEXT_NAMES
        if roles and words - roles <= _AFFIXES and not (in_article and roles <= _HEADS):
            found |= roles
    return found


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def importance(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The site style trees: ``host``, ``path``, ``blocks`` and ``importance`` of each node with text.

    The importance is the entropy of the texts of the node's blocks over the highest
    that so many blocks can have; a node inside an article has 1. Blocks with a given role do not
    count; a node with no others has none and an importance of 0. Each distinct page of a
    host counts once, however many copies it has. Copies meet by their hash within each
    task before anything is moved, and blocks are moved as their texts' hashes.
    """
    return _texts(_distinct_pages(pages, html_col, url_col)).select("host", "path", "blocks", "importance")


def _parts(page: _Page) -> Iterator[tuple[list[dict], list[dict], list[dict]]]:
    """The blocks of a page, its elements that hold one, and before them the paths of both, in parts of bounded
    size. Elements alike come once, with their number ``c``; ``at`` and ``up`` are places in the part's paths."""
    alike: dict[tuple, dict] = {}
    for i, (x, held) in enumerate(zip(page.elements, page.held)):
        if held >= 0:
            key = (x.path, x.main, held, *x.children)
            if key not in alike:
                alike[key] = {"at": i, "up": x.up, "children": x.children, "main": x.main, "held": held, "c": 0}
            alike[key]["c"] += 1
    elements = list(alike.values())
    for start in range(0, max(len(elements), len(page.blocks)), _PART):
        places: dict[tuple[str, int], int] = {}

        def place(at: int) -> int:
            x = page.elements[at]
            return places.setdefault((x.path, x.level), len(places)) if at >= 0 else -1

        b = [x._asdict() | {"at": place(x.at)} for x in page.blocks[start : start + _PART]]
        e = [x | {"at": place(x["at"]), "up": place(x["up"])} for x in elements[start : start + _PART]]
        yield [{"path": path, "level": level} for path, level in places], b, e


def _distinct_pages(pages: DataFrame, html_col: str, url_col: str) -> DataFrame:
    """The blocks and elements of each distinct page of a host: ``host``, ``path``, ``level``, ``main``, ``held`` and
    how many are alike, ``c``; of blocks ``text`` (a hash), of elements ``children`` and the path ``up`` of the one around."""
    block = "struct<at:int,text:string,main:boolean,held:int>"
    element = "struct<at:int,up:int,children:array<string>,main:boolean,held:int,c:bigint>"
    kinds = StructType.fromDDL(f"host string, page bigint, part int, p array<struct<path:string,level:int>>, b array<{block}>, e array<{element}>")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        rows, size = [], 0
        for batch in batches:
            for site, page, source in zip(*(column.to_pylist() for column in batch.columns)):
                for part, (p, b, e) in enumerate(_parts(_parsed(source or ""))):
                    rows.append({"host": site, "page": page, "part": part, "p": p, "b": b, "e": e})
                    size += len(b) + len(e)
                    if size >= _BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    each = pages.select(host(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("page"), F.col(html_col).alias("html"))
    hashed = F.transform("b", lambda b: b.withField("text", F.xxhash64(b["text"])))
    once = each.mapInArrow(parsed, kinds).select("host", "page", "part", F.struct("p", hashed.alias("b"), "e").alias("t"))
    once = once.groupBy("host", "page", "part").agg(F.first("t").alias("t")).select("host", "t.*")
    at = lambda place, name: F.get("p", place)[name].alias(name)
    row = lambda x, *more: F.struct(at(x["at"], "path"), at(x["at"], "level"), x["main"].alias("main"), x["held"].alias("held"), *more)
    blocks = F.transform("b", lambda x: row(x, F.lit(1).cast("long").alias("c"), x["text"].alias("text"), F.lit(None).cast("array<string>").alias("children"), F.lit(None).cast("string").alias("up")))
    above = lambda x: F.when(x["up"] >= 0, at(x["up"], "path")).alias("up")
    elements = F.transform("e", lambda x: row(x, x["c"].alias("c"), F.lit(None).cast("long").alias("text"), x["children"].alias("children"), above(x)))
    return once.select("host", F.inline(F.concat(blocks, elements)))


def _entropy(parts: DataFrame, node: list[str], *extra: Column) -> DataFrame:
    """Per ``node`` the number ``n`` of what ``c`` counts, and ``entropy`` over its highest, 1 for a single one."""
    n = F.col("n")
    sums = parts.groupBy(*node).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log2("c")).alias("s"), *extra)
    share = F.when(n > 1, (F.log2(n) - F.col("s") / n) / F.log2(n)).otherwise(F.lit(1.0))
    return sums.withColumn("entropy", share).drop("s")


def _merged(rows: DataFrame, *node: str) -> DataFrame:
    """Per node what of its rows counts, ``c``, which is nothing with a given role; whether one is main text
    inside an article; and what they hold at most."""
    counted = F.when(F.col("held") > _GIVEN, F.col("c")).otherwise(F.lit(0))
    article = F.max(F.col("main") & (F.col("held") == _KEPT))
    return rows.groupBy(*node).agg(F.sum(counted).alias("c"), article.alias("article"), F.max("held").alias("held"))


def _texts(once: DataFrame) -> DataFrame:
    """``importance`` with the level, what the node's blocks are at most and a flag of nodes inside an article."""
    counts = _merged(once.where("text is not null"), "host", "path", "level", "text")
    nodes = _entropy(counts, ["host", "path", "level"], F.max("article").alias("article"), F.max("held").alias("held"))
    share = F.when(F.col("article"), F.lit(1.0)).when(F.col("held") == _GIVEN, F.lit(0.0)).otherwise(F.col("entropy"))
    return nodes.select("host", "path", F.col("n").alias("blocks"), share.alias("importance"), "level", "held", "article")


def _below(path: Column, level: Column, child: Column) -> Column:
    """``_child`` of columns."""
    full = F.concat(F.lit(_MARK), F.sha2(path, 256))
    return F.when(level == 0, child).otherwise(F.concat(F.when(level % _STRETCH == 0, full).otherwise(path), F.lit("/"), child))


def _composed(nodes: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``total`` of each node: its ``own`` and those of all nodes below it,
    each times the ``part`` of every node from there up to the node.

    ``up`` is the path of the node above, missing at the root. A round doubles the levels that
    totals cover and that nodes reach upwards, so that a tree of any depth takes as many rounds as its
    number of levels has binary digits, and a round's table one row for each node.
    """
    steps = Steps(nodes.sparkSession, "trees")
    levels = nodes.agg(F.max("level")).first()[0] or 0
    at = nodes.select("host", "path", "up", "part", F.col("own").alias("total"))
    for i in range(levels.bit_length()):
        given = at.where(F.col("up").isNotNull()).groupBy("host", F.col("up").alias("path")).agg(F.sum(F.col("part") * F.col("total")).alias("more"))
        further = at.select("host", F.col("path").alias("up"), F.col("up").alias("next"), F.col("part").alias("rest"))
        at = at.join(given, ["host", "path"], "left").join(further, ["host", "up"], "left").select(
            "host",
            "path",
            F.col("next").alias("up"),
            (F.col("part") * F.coalesce("rest", F.lit(1.0))).alias("part"),
            (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
        )
        at = steps.write(at, f"round_{i}")
        if i:
            steps.remove(f"round_{i - 1}")
    return at.select("host", "path", "total")


def composite(once: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Composite importances: ``host``, ``path``, ``importance`` and ``stays`` of every node of the trees,
    with its ``level``, the path ``up`` of the node above and what text it has at most, ``held``.

    ``once`` are the pages of ``_distinct_pages``. A text is a node of its own, ``<path>/#text``, with
    the importance of ``importance``. An inner node with l
    presentation styles has (1 - d) times the entropy of its styles, plus d times the importance of the
    children, averaged in a style and weighted by the styles' shares, with d = damping to
    the power of l. A node with nothing but text has that of its text. An article and all nodes in it
    have 1, a node with nothing but text of a given role has 0. ``stays`` is set for
    what is important or, being text without a given role, too rare to tell.

    As a node has one parent, its share in all nodes above is a product along its path, so
    that the trees are composed by joins, not level by level.
    """
    elements = written(_merged(once.where("children is not null"), "host", "path", "level", "up", "children"))
    plain = F.max(F.exists("children", lambda x: x != _TEXT)).alias("inner")
    several = F.sum((F.col("c") > 0).cast("int")).alias("l")
    styles = _entropy(elements, ["host", "path", "level", "up"], several, F.max("article").alias("article"), F.max("held").alias("held"), plain)
    none = F.col("held") == _GIVEN
    damped = F.when(F.col("article") | none, F.lit(0.0)).when(F.col("inner"), F.pow(F.lit(settings.damping), F.col("l"))).otherwise(F.lit(1.0))
    styles = broadcast_if_small(styles.withColumn("d", damped))
    own = F.when(F.col("article"), F.lit(1.0)).when(none, F.lit(0.0)).otherwise((1 - F.col("d")) * F.col("entropy"))
    rows = styles.select("host", "path", "level", "up", own.alias("own"), F.lit(False).alias("rare"), "held", "article")
    rare = ~none & (F.col("blocks") < settings.min_blocks)
    path = _below(F.col("path"), F.col("level"), F.lit(_TEXT))
    texts = _texts(once).select(
        "host", path.alias("path"), (F.col("level") + 1).alias("level"), F.col("path").alias("up"), F.col("importance").alias("own"), rare.alias("rare"), "held", "article"
    )
    # The children of a node with a given importance have no part in it.
    children = elements.join(styles.where("d > 0").select("host", "path", "n", "d"), ["host", "path"])
    part = F.col("d") * F.col("c") / F.col("n") / F.greatest(F.size("children"), F.lit(1))
    shares = children.select("host", "path", "level", part.alias("part"), F.explode("children").alias("child"))
    shares = shares.groupBy("host", _below(F.col("path"), F.col("level"), F.col("child")).alias("path")).agg(F.sum("part").alias("part"))
    nodes = written(rows.unionByName(texts).join(shares, ["host", "path"], "left").withColumn("part", F.coalesce("part", F.lit(0.0))))
    # Below a node with a given importance all have one, which is nothing but their own.
    rest = nodes.join(_composed(nodes.where(~(F.col("article") | none) | (F.col("part") > 0))), ["host", "path"], "left")
    rest = rest.withColumn("importance", F.coalesce("total", "own"))
    stays = ~none & (F.col("rare") | (F.col("importance") >= settings.least))
    return rest.select("host", "path", "importance", stays.alias("stays"), "level", "up", "held")


def noise(trees: DataFrame) -> DataFrame:
    """(host, path) of the largest branches of ``composite`` that have main text and in which no node stays."""
    trees = written(trees)
    busy = trees.where("stays").groupBy("host", F.col("up").alias("path")).agg(F.count("*").cast("double").alias("own"))
    # Only what may be in such a branch: a node above one that stays is found by what lies between.
    low = trees.where(~F.col("stays") & (F.col("held") > _GIVEN)).join(busy, ["host", "path"], "left")
    low = written(low.withColumn("own", F.coalesce("own", F.lit(0.0))).withColumn("part", F.lit(1.0)))
    whole = low.where(F.col("held") == _KEPT).join(_composed(low).where("total = 0"), ["host", "path"])
    whole = written(whole.select("host", "path", "up"))
    return whole.join(whole.select("host", F.col("path").alias("up")), ["host", "up"], "left_anti").select("host", "path")


def extract(
    pages: DataFrame, settings: Settings = Settings(), html_col: str = "html", url_col: str = "url", name: str = "text"
) -> DataFrame:
    """All rows and columns of ``pages`` and the main text in column ``name``.

    Blocks are joined by line feeds. A missing or empty page has an empty text; pages
    without a host form a site of their own; repeated pages get one text. If every
    block of a page is unimportant, as on a site of copies, all of them stay. A column
    ``name`` is replaced, others pass unread. Pages are moved only if the removed
    nodes are too many to be sent to every task.
    """
    rest = pages.drop(name)
    with small_batches(pages.sparkSession):  # a page's elements can be many times its bytes
        once = written(_distinct_pages(rest, html_col, url_col))
    low = noise(composite(once, settings))
    key, site, removed = (unused(f"_{x}", rest) for x in ("host", "site", "removed"))
    sites = written(low.groupBy(F.col("host").alias(site)).agg(F.collect_set("path").alias(removed)))
    joined = rest.withColumn(key, host(F.col(url_col))).join(sites, F.col(key) == F.col(site), "left")

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, lows in batches:
            yield pd.Series([_joined(x, gone) for x, gone in zip(htmls, lows)], dtype=object)

    return joined.select(*rest.columns, filled(text(F.col(html_col), F.col(removed))).alias(name))


def _joined(page: str | None, gone) -> str:
    found = _parsed(page or "")
    texts = found.kept()
    if gone is not None and len(gone):
        gone = set(gone)
        inside: list[bool] = []  # of each element, whether it is in one of the branches
        for x in found.elements:
            inside.append(x.path in gone or x.up >= 0 and inside[x.up])
        lost = [inside[x.at] or _child(found.elements[x.at].path, found.elements[x.at].level, _TEXT) in gone for x in texts]
        texts = [x for x, low in zip(texts, lost) if x.main or not low] or texts
    return "\n".join(x.text for x in texts)
