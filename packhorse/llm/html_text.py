"""Operator 2: main text of web pages by wrappers inferred per host.

Pages of a host come from few templates. A page's block structure is a union-free
regular expression over tags and text slots. The expressions of a host are aligned
with each other until one is left, its wrapper: what only some have becomes
optional, neighbours of one kind become a repeated group. Every page is then
laid along its host's wrapper: a slot is a place in the wrapper, and its marks and
how pages fill it tell template from main text.
"""

from __future__ import annotations

import html
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.llm.common import bounded_broadcast, by_small_batches, stored, table

# Kinds of elements, and words in class, id and role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br img nobr".split()
)
# An element that opens here closes these where they are open.
CLOSES = {
    **dict.fromkeys("li".split(), {"li"}), **dict.fromkeys("dt dd".split(), {"dt", "dd"}),
    **dict.fromkeys("td th".split(), {"td", "th"}), "tr": {"tr", "td", "th"}, "option": {"option"},
    **dict.fromkeys(
        "p h1 h2 h3 h4 h5 h6 ul ol dl div table section article aside nav header footer main form pre blockquote figure hr address fieldset".split(),
        {"p"},
    ),
}
# Elements beyond which the above does not look.
HOLDS = set("ul ol dl table body article section div main aside nav td th blockquote html".split())
ASIDE_TAGS = set("nav footer aside form button dialog menu head script style noscript template iframe svg math select textarea title object canvas".split())
LAYOUT_WORDS = set(
    "nav navbar navigation topnav sidenav menu menubar mainmenu submenu breadcrumb breadcrumbs header masthead topbar siteheader "
    "pageheader footer foot bottombar sitefooter pagefooter sidebar side aside rail widget widgets notice notices alert announcement "
    "banner form forms search searchbox login signup share sharing social tags toolbar pagination pager copyright legal disclaimer "
    "skip complementary contentinfo dialog more promo promotion".split()
)
STRANGE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle adslot adbox sponsor sponsored cookie cookies consent "
    "gdpr popup modal overlay newsletter subscribe subscription comment comments commentlist discussion reply replies disqus respond "
    "reactions related recommended recommendations teaser hidden".split()
)
# Names that begin with one of these say what a page has, not what an element is.
ABOUT = set("has no with without is js".split())
# Of these words, those that a section of an article may be about.
TOPICS = set(
    "more related legal disclaimer copyright notice notices alert announcement banner form forms search login signup share sharing "
    "social tags menu header footer side promotion advertising advertisement cookie cookies consent gdpr newsletter subscription "
    "discussion reply replies reactions recommended recommendations hidden dialog navigation".split()
)
MAIN_WORDS = set("article articlebody content maincontent post postbody entry story main storybody".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

# Bounds of an expression, so that no page makes it deep or its alignment long.
MOST_LEVELS, MOST_TERMS = 48, 64

# One attribute after the other: a value in quotes may hold any name and sign, one without may hold quotes.
_ATTR = r"""[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[\s/=]++|{_ATTR})*+)>""",
    re.S,
)
_ATTRS = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+""")
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Element:
    """An open block: its key (tag and first words of class and id), whether it is aside, its rank as main text, and the article it is in."""

    tag: str
    key: str
    aside: bool
    rank: int
    level: int
    in_header: bool
    article: int


def _names(attrs: str) -> Iterator[tuple[str, str]]:
    """The names that tell what an element is, each with the attribute that has it."""
    for kind, *values in _ATTRS.findall(attrs):
        kind, value = kind.lower(), "".join(values).lower()
        if kind == "hidden" or (kind == "aria-hidden" and value.strip() == "true"):
            yield kind, "hidden"
        elif kind in ("class", "id", "role", "itemprop"):
            for name in value.split():
                yield kind, name


def _element(tag: str, attrs: str, parent: Element | None, articles: int) -> Element:
    words: list[str] = []
    layout = strange = main = False
    in_main = parent is not None and parent.rank > 0
    if attrs and tag not in ("html", "body"):
        for kind, name in _names(attrs):
            parts = _WORD.findall(name)
            words += parts
            if not parts or parts[0] in ABOUT or "with" in parts:
                continue
            ends = {parts[0], parts[-1]}
            if kind == "id" and (in_main or tag in ("article", "main")):
                # Within the main part an id may name the topic of a heading, a section or an article.
                whole = set(parts) <= LAYOUT_WORDS | STRANGE_WORDS
                if tag in HEADINGS or not whole or (tag == "section" and ends <= TOPICS):
                    continue
            strange = strange or bool(ends & STRANGE_WORDS)
            layout = layout or bool(ends & LAYOUT_WORDS)
            main = main or (bool(MAIN_WORDS & set(parts)) and not ends & (LAYOUT_WORDS | STRANGE_WORDS))
    marked = tag in ("article", "main") or main
    aside = (parent is not None and parent.aside) or tag in ASIDE_TAGS or strange or (layout and not marked)
    aside = aside or (tag == "header" and not in_main)
    rank, article = (parent.rank, parent.article) if parent else (0, 0)
    if not aside:
        own = 3 if tag == "article" or "articlebody" in words else 2 if tag == "main" else 1 if main else 0
        article = articles + 1 if own == 3 > rank else article
        rank = max(rank, own)
    key, level = ".".join([tag, *words[:3]]), parent.level + 1 if parent else 1
    return Element(tag, key, aside, rank, level, tag == "header" or (parent is not None and parent.in_header), article)


@dataclass
class Block:
    """A run of text between block borders: its rank as main text, how much of it is in links, and its article."""

    rank: int
    aside: bool
    heading: bool
    text: str = ""
    linked: int = 0
    article: int = 0


def blocks_of(page: str | None) -> tuple[list[Block], list]:
    """The text blocks of a page in order, and its tree of blocks (key, children); a text slot is "#"."""
    root: list = ["", []]
    stack: list[tuple[Element, list]] = []
    blocks: list[Block] = []
    runs: list[str] = []
    links, linked, at, articles, page = 0, 0, 0, 0, page or ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(runs)).split())
        runs.clear()
        if text:
            top = stack[-1][0] if stack else None
            (stack[-1][1] if stack else root)[1].append("#")
            heading = bool(top and top.tag in HEADINGS)
            aside = bool(top and (top.aside or (top.in_header and not heading)))
            blocks.append(Block(top.rank if top else 0, aside, heading, text, min(linked, len(text)), top.article if top else 0))
        linked = 0

    def close(tags: set[str], limit: set[str]) -> None:
        """Close the outermost open element of `tags` that no element of `limit` holds."""
        found = None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0].tag in tags:
                found = i
            if stack[i][0].tag in limit:
                break
        if found is not None:
            flush()
            del stack[found:]

    while at < len(page):
        token = _TOKEN.search(page, at)
        text = page[at : token.start()] if token else page[at:]
        if text:
            runs.append(text)
            if links:
                linked += len(text)
        if not token:
            break
        at = token.end()
        tag = (token["open"] or token["end"] or "").lower()
        if not tag:
            continue
        if token["open"]:
            if tag in RAW:
                # Only elements of another language may end where they begin.
                if tag not in ("svg", "math") or not token["attrs"].endswith("/"):
                    stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                    at = stop.end() if stop else len(page)
                continue
            if tag in INLINE:
                links += tag == "a"
                if tag == "br":
                    runs.append(" ")
                continue
            flush()
            if tag in CLOSES:
                close(CLOSES[tag], HOLDS - CLOSES[tag])
            if tag in VOID:
                continue
            element = _element(tag, token["attrs"], stack[-1][0] if stack else None, articles)
            articles = max(articles, element.article)
            node = [element.key, []]
            if element.level > MOST_LEVELS:
                # What lies deeper is taken for a part of the last level.
                node = stack[-1][1]
            else:
                (stack[-1][1] if stack else root)[1].append(node)
            stack.append((element, node))
            links = 0
        elif tag in INLINE:
            links -= tag == "a" and links > 0
        else:
            flush()
            close({tag}, {tag})
    flush()
    return blocks, root[1]


# An expression is a list of terms [key, how, children]: how is 1, ? (optional), + (repeated) or * (both);
# a text slot has the key "#" and no children.


def _bounded(terms: list) -> list:
    """`terms`, or if they are more than `MOST_TERMS`, each key once and any number of times.

    Keys lose their words, and in the end their tags, where there are too many of them.
    """
    for shorten in (lambda key: key, lambda key: key.split(".")[0], lambda key: key if key == "#" else "other"):
        if len(terms) <= MOST_TERMS:
            return terms
        merged: dict[str, list] = {}
        for key, _, children in terms:
            short = shorten(key)
            merged[short] = align(merged[short], children) if short in merged else children
        terms = [[key, "*", children] for key, children in merged.items()]
    return terms


def _fold(nodes: list) -> list:
    terms: list = []
    for node in nodes:
        term = ["#", "1", []] if node == "#" else [node[0], "1", _fold(node[1])]
        if terms and terms[-1][0] == term[0]:
            terms[-1] = [term[0], "+", align(terms[-1][2], term[2])]
        else:
            terms.append(term)
    return _bounded(terms)


def _how(*hows: str) -> str:
    optional, many = any(h in "?*" for h in hows), any(h in "+*" for h in hows)
    return "*" if optional and many else "?" if optional else "+" if many else "1"


def align(a: list, b: list) -> list:
    """The union-free expression of what `a` and `b` match.

    Terms with equal keys are matched along the longest common subsequence; the
    others become optional, and neighbours with one key a repeated group.
    """
    if a == b:
        return a
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out: list = []

    def add(term: list) -> None:
        if out and out[-1][0] == term[0]:
            last = out[-1]
            how = "+" if "1" in (last[1], term[1]) or "+" in (last[1], term[1]) else "*"
            out[-1] = [term[0], how, align(last[2], term[2])]
        else:
            out.append(term)

    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            add([a[i][0], _how(a[i][1], b[j][1]), align(a[i][2], b[j][2])])
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            add([a[i][0], _how(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            add([b[j][0], _how(b[j][1], "?"), b[j][2]])
            j += 1
    return _bounded(out)


def expression(page: str | None) -> list:
    return _fold(blocks_of(page)[1])


def as_pattern(terms: list) -> str:
    """An expression as text: (<ul>(<li>#</li>)+</ul>)?"""
    parts = []
    for key, how, children in terms:
        body = "#" if key == "#" else f"<{key}>{as_pattern(children)}</{key.split('.')[0]}>"
        parts.append(body if how == "1" else f"({body}){how}")
    return "".join(parts)


def _fit(key: str, term: str) -> int:
    """How well a key fits a term's key, which `_bounded` may have shortened."""
    return 3 if key == term else 0 if "#" in (key, term) else 2 if term == key.split(".")[0] else term == "other"


def _meet(keys: list[str], terms: list) -> list[int | None]:
    """For each of `keys`, which stand in this order, the place of its term.

    Keys meet terms in order as far as possible, rather the ones every page has. A key
    left over, as in a level that lost its order, takes the term that fits best.
    """
    if keys == [term[0] for term in terms]:
        return list(range(len(keys)))
    fits = {key: [_fit(key, term[0]) for term in terms] for key in set(keys)}
    gains = {key: [2 * fit + (fit > 0 and term[1] in "1+") for fit, term in zip(row, terms, strict=True)] for key, row in fits.items()}
    ahead = [term[1] not in "+*" for term in terms]
    best = [[0] * (len(terms) + 1) for _ in range(len(keys) + 1)]
    for i in range(len(keys) - 1, -1, -1):
        gain, row, below = gains[keys[i]], best[i], best[i + 1]
        for j in range(len(terms) - 1, -1, -1):
            row[j] = max(row[j + 1], below[j])
            if gain[j]:
                row[j] = max(row[j], gain[j] + below[j + ahead[j]])
    out: list[int | None] = []
    j = 0
    for i, key in enumerate(keys):
        gain, row, below = gains[key], best[i], best[i + 1]
        while j < len(terms) and not (gain[j] and row[j] == gain[j] + below[j + ahead[j]]) and row[j] == row[j + 1]:
            j += 1
        if j < len(terms) and gain[j] and row[j] == gain[j] + below[j + ahead[j]]:
            out.append(j)
            j += ahead[j]
        else:
            most = max(fits[key], default=0)
            out.append(fits[key].index(most) if most else None)
    return out


def places(nodes: list, terms: list, path: str = "", optional: bool = False) -> Iterator[tuple[str, bool]]:
    """For each text of a page's tree, in order: its slot in the wrapper, and whether pages may lack it.

    A slot is the path of places of its terms, with the page's own key where the
    wrapper's is shorter, so elements of different names are not judged together.
    """
    runs: list[list] = []
    for node in nodes:
        key = node if node == "#" else node[0]
        if runs and runs[-1][0] == key:
            runs[-1][1].append(node)
        else:
            runs.append([key, [node]])
    for (key, same), place in zip(runs, _meet([key for key, _ in runs], terms), strict=True):
        name, how, children = terms[place] if place is not None else ("", "?", [])
        slot = f"{path}>{'' if place is None else place}{'' if key == name else ':' + key}"
        for node in same:
            if node == "#":
                yield slot, optional or how in "?*"
            else:
                yield from places(node[1], children, slot, optional or how in "?*")


@dataclass(frozen=True)
class Settings:
    """`together` expressions of a host are aligned in one task at a time.

    A text is template if it is the same on `least_pages` different pages and the
    wrapper says that every page has it. Where pages may lack it, `optional_pages`
    are asked for, as pages that copy a passage from each other share its slots too.
    Wrappers are broadcast up to `hosts` and `wrapper_chars`.
    """

    together: int = 64
    least_pages: int = 3
    optional_pages: int = 10
    most_linked: float = 0.5
    hosts: int = 100_000
    wrapper_chars: int = 50_000_000


def host_of(url: str) -> F.Column:
    authority = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.coalesce(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""), F.lit(""))


def infer_wrappers(pages: DataFrame, settings: Settings) -> DataFrame:
    """Per `host`: the `wrapper` as JSON.

    Pages (host, html) are reduced to their expressions where they are read, and
    equal ones merged before they are shuffled. Then groups of at most about
    `together` expressions are aligned, again and again, until each host has one.
    """

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(host, json.dumps(expression(page))) for host, page in zip(batch["host"], batch["html"], strict=True)]
            yield pd.DataFrame(rows, columns=["host", "wrapper"]).drop_duplicates()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        whole: list = []
        for text in sorted(group["wrapper"]):
            # A page without a block says nothing about those of others.
            terms = json.loads(text)
            whole = align(whole, terms) if whole and terms else whole or terms
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    level = stored(pages.mapInPandas(own, "host string, wrapper string").distinct(), "expressions")
    while True:
        most = level.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return level
        parts = math.ceil(most / settings.together)
        dealt = level.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(parts)))
        level = stored(dealt.groupBy("host", "part").applyInPandas(merge, "host string, wrapper string"), "wrappers")


class Places:
    """Lays pages along wrappers, which are read once each."""

    def __init__(self) -> None:
        self.read: dict[str, list] = {}

    def of(self, page: str | None, wrapper: str | None) -> list[tuple[Block, str, bool]]:
        """The blocks of `page` that are not aside, with slot and whether it is optional.

        Nothing is laid along the wrapper if a block is marked as main text: `main_text` takes those.
        """
        blocks, tree = blocks_of(page)
        if all(block.aside or block.rank for block in blocks):
            return [(block, "", False) for block in blocks if not block.aside]
        if wrapper not in self.read:
            if len(self.read) >= 1000:
                self.read.clear()
            self.read[wrapper] = json.loads(wrapper or "[]")
        laid = places(tree, self.read[wrapper])
        return [(block, *place) for block, place in zip(blocks, laid, strict=True) if not block.aside]


_USE = "host string, slot string, page long, optional boolean, chars long, linked long, low long, high long"


def slot_use(pages: DataFrame, settings: Settings) -> DataFrame:
    """Per host and slot of `pages` (host, html, wrapper) without an aside: characters, those in links, whether pages
    may lack it, whether its text is always the same, and on how many different pages it is.

    Copies of a page are one page. Of each batch only the first few pages of a
    slot by their hashes are listed, as no more are asked for.
    """
    most = max(settings.least_pages, settings.optional_pages)

    def use(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        laid = Places()
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            for host, page, wrapper in zip(batch["host"], batch["html"], batch["wrapper"], strict=True):
                own = xxhash.xxh3_64_intdigest(page or "") >> 1
                for block, slot, optional in laid.of(page, wrapper):
                    if not block.rank:
                        name = xxhash.xxh3_64_intdigest(block.text) >> 1
                        held = found.setdefault((host, slot), [set(), optional, 0, 0, name, name])
                        held[0].add(own)
                        held[2:] = held[2] + len(block.text), held[3] + block.linked, min(held[4], name), max(held[5], name)
            rows = []
            for (host, slot), (seen, optional, chars, linked, low, high) in found.items():
                for number, own in enumerate(sorted(seen)[:most]):
                    rows.append((host, slot, own, optional, 0 if number else chars, 0 if number else linked, low, high))
            yield pd.DataFrame(rows, columns=[part.split()[0] for part in _USE.split(", ")])

    def merged() -> list[Column]:
        sums = [F.sum(name).alias(name) for name in ("chars", "linked")]
        return [*sums, F.max("optional").alias("optional"), F.min("low").alias("low"), F.max("high").alias("high")]

    per_page = pages.mapInPandas(use, _USE).groupBy("host", "slot", "page").agg(*merged())
    used = per_page.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n_pages"), *merged())
    return used.withColumn("same", F.col("low") == F.col("high")).drop("low", "high")


def template_slots(use: DataFrame, settings: Settings) -> DataFrame:
    """Per host the slots that hold no main text where no element is marked as such: slots of links, and template."""
    witnesses = F.when(F.col("optional"), settings.optional_pages).otherwise(settings.least_pages)
    template = F.col("same") & (F.col("n_pages") >= witnesses)
    links = F.col("linked") > settings.most_linked * F.col("chars")
    return use.filter(template | links).groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias("slots"))


def main_text(page: str | None, slots: set[str] | None, wrapper: str | None = None, laid: Places | None = None) -> str:
    """The page's main text: what is marked as article, else as main, else as content, else what is in none of the host's template `slots`.

    What a main part holds beside its one article, as a title, belongs to it.
    """
    blocks = (laid or Places()).of(page, wrapper)
    best = max((block.rank for block, _, _ in blocks), default=0)
    if best:
        one = len({block.article for block, _, _ in blocks if block.rank == best}) == 1
        least = 2 if best == 3 and one else best
        chosen = [block for block, _, _ in blocks if block.rank >= least]
    else:
        chosen = [block for block, slot, _ in blocks if not slots or slot not in slots] or [block for block, _, _ in blocks]
    return "\n\n".join(block.text for block in chosen)


def extract(df: DataFrame, settings: Settings | None = None, page: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """`df` with the string `out`: the main text of each page, empty if there is none.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments are left out, everything else of the main part is kept
    whole and in order: blocks joined by an empty line, white space within a
    block as one space, character references decoded. A null page is empty; a
    null url is a host of its own; markup that is cut off ends with the page.
    Repeated rows come out alike, an empty table gives an empty one, a column
    that is already named `out` is replaced, and `_host`, `_wrapper` and `_slots` are reserved.
    """
    settings = settings or Settings()
    hosted = by_small_batches(df).withColumn("_host", host_of(url))
    pages = hosted.select(F.col("_host").alias("host"), F.col(page).alias("html"))
    wrappers = infer_wrappers(pages, settings)
    few = (wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0) <= settings.wrapper_chars

    def shared(hosts: DataFrame) -> DataFrame:
        return bounded_broadcast(hosts, settings.hosts) if few else hosts

    use = slot_use(pages.join(shared(wrappers), "host", "left"), settings)
    judged = wrappers.join(template_slots(use, settings), "host", "left")
    known = shared(stored(judged.withColumnsRenamed({"host": "_host", "wrapper": "_wrapper", "slots": "_slots"}), "slots"))

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        laid = Places()
        for pages, wrappers, slots in batches:
            held = zip(pages, wrappers, slots, strict=True)
            yield pd.Series([main_text(one, None if left is None else set(left), whole, laid) for one, whole, left in held], dtype=object)

    told = hosted.join(known, "_host", "left").withColumn(out, text_of(F.col(page), F.col("_wrapper"), F.col("_slots")))
    return told.select(*df.columns, *([] if out in df.columns else [out]))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op2_html_text": op2_html_text}
ORACLES: dict[str, str] = {}
