"""Main text of web pages: pages of a host vote on where their text stands, and are read again by the winner."""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lakeassay.llm.common import OWN, staged

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)(?:>|\Z|["'][^>]*(?:>|\Z))""", re.S)  # a stray quote ends at >
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noframes", "xmp", "noembed"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text.
APART = set("""nav footer aside form script style noscript iframe template head title svg select option button textarea label
    fieldset dialog menu canvas audio video map noframes xmp noembed annotation annotation-xml""".split())  # a formula is read once
BLOCKS = set("""address article blockquote body br caption center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header
    hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul aside""".split()) - {"br"}
CONTAINERS = set("html body main article section div td center details figure blockquote".split())
#: An opened element ends open ones of these names, within the nearest of the scope.
_ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
#: Words in a class, id or role that mark other things than main text; the second kind not beside one of the third.
BESIDE = set("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer gdpr menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related replies respond share sharing
    sidebar social sponsor sponsored subscribe complementary contentinfo""".split())
#: The same in German, French, Spanish, Italian, Portuguese and Dutch.
BESIDE |= set("""kommentar kommentare werbung anzeige anzeigen fusszeile seitenleiste teilen brotkrumen
    commentaire commentaires publicite partager partage
    comentario comentarios publicidad anuncio anuncios compartir
    commento commenti pubblicita condividi publicidade compartilhar
    reactie reacties advertentie advertenties reclame delen""".split())
#: Of BESIDE, the words that can hardly mean the text, however much of it the element holds.
SURE = BESIDE - set("""banner breadcrumb breadcrumbs complementary contentinfo cookie cookies delen footer menu modal nav navbar navigation notice
    notices pager pagination partage popup promo related share sharing sidebar social sponsor subscribe teilen""".split())
PERHAPS = set("alert header login masthead promotion reply search signup toolbar widget hidden".split())
CONTENT = set("article body content entry main post story text".split())
#: Of BESIDE and PERHAPS, the words that also name layouts after a part of them, and that name readers' or other pages' texts.
LAYOUT = set("""banner breadcrumb breadcrumbs complementary contentinfo footer header hidden login masthead menu nav navbar navigation
    pager pagination search share sharing sidebar social toolbar widget""".split())
#: What follows one of these in a name says what an element has or lacks, not what it is.
HAVING = set("has have having no not with without".split())
#: Words that ids of page parts are made of, besides those above; other ids of sections come from their headings.
FURNITURE = set("""area articles bar block bottom box button buttons col column container form icons inner item items left link links list
    media outer page pages posts primary products right row secondary section site stories top us wrap wrapper""".split())
#: Words of names that say nothing of what an element is, beside those above.
FURNITURE |= set("""block blocks desktop entries field fields fixed google head heading holder inline large lijst lista liste mobile overlay placeholder region
    single site slot small sticky thread threads title toggle tools unit units view""".split())
KNOWN = BESIDE | PERHAPS | CONTENT | LAYOUT | FURNITURE
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Parts that the pages of one host are split into where they are shuffled.
SALTS = 32
#: A container is left for an outer one whose text is this many times what that adds beside the text, and more.
CLEAN = 10
#: Elements deeper than this have the path of their ancestor at this depth.
DEEPEST = 200
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _said(name: str) -> list[str]:
    """The words of a name, without what the element is said to have or lack."""
    words = [w.lower() for w in WORD_PARTS.findall(name)]
    return words[: next((i for i, w in enumerate(words) if w in HAVING), len(words))]


def _beside(words: list[str]) -> set[str]:
    """The words of a name that mark other things than main text, if it is a name for nothing else: `market-share` has none.

    A short word in front may be a prefix that a site gives all its names.
    """
    found = BESIDE.union(PERHAPS).intersection(words)
    if found:
        first = next(i for i, w in enumerate(words) if w in KNOWN or len(w) > 3)
        if not KNOWN.issuperset(words[first:]):
            return set()
    return found


class Page:
    """A page's elements and its blocks of text, without the parts that never hold main text.

    `paths[i]` is element i's generalised path: the tags from the root down, each with its classes, digits
    left out. Blocks are (element, text, characters in links), in page order.

    An element that its names mark as beside the text is kept apart until the page is read, as a layout may be named
    after a part of it (see `_released`).
    """

    def __init__(self, html: str):
        self.tags, self.parents, self.paths = ["#root"], [-1], [""]
        self.blocks: list[tuple[int, str, int]] = []
        self._text: list[tuple[int, str, int]] = []  # the innermost marked element, text, characters in links
        self._runs: list[tuple[int, list[tuple[int, str, int]]]] = []  # blocks with marked text
        self._stack, self._apart, self._marks = [0], [False], [0]
        self._aside: dict[int, int] = defaultdict(int)  # characters left out, by element
        self._outer: dict[int, int] = {}  # each marked element's next marked one outwards
        self._layouts: set[int] = set()  # marked elements whose marks are words of LAYOUT only
        self._sure: set[int] = set()  # marked elements with a word of SURE
        self._signs: list[tuple[int, int]] = []  # elements that say where the text stands, with their innermost marked one
        self._opened: dict[str, int] = defaultdict(int)
        self._holders = [0]  # each element's nearest container, itself included
        self._in_link = 0
        self._read(html)
        self._flush()
        self._free = self._released()
        self.blocks = self._kept(self._free)

    def _read(self, html: str) -> None:
        at, lowered = 0, None
        while True:
            token = TOKEN.search(html, at)
            self._words(html[at : token.start()] if token else html[at:])
            if not token:
                return
            at = token.end()
            if not (tag := (token[2] or "").lower()):
                if token[0].startswith("<![CDATA["):
                    self._words(token[0][9:].removesuffix("]]>"), decode=False)
                continue
            if token[1]:
                self._close(tag)
            else:
                self._open(tag, token[3])
                if tag in RAW and not token[3].endswith("/"):
                    lowered = lowered if lowered is not None else html.lower()
                    end = lowered.find(f"</{tag}", at)
                    at = len(html) if end < 0 else end  # none of these elements holds main text

    def _words(self, text: str, decode: bool = True) -> None:
        if text and self._apart[-1]:
            self._aside[self._stack[-1]] += len(text.strip())
        elif text:
            text = unescape(text) if decode else text
            self._text.append((self._marks[-1], text, len(text) if self._in_link else 0))

    def _flush(self) -> None:
        if self._text:
            element = next(i for i in reversed(self._stack) if self.tags[i] in BLOCKS or i == 0)
            self._runs.append((element, self._text))
        self._text = []

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text.append((self._marks[-1], " ", 0))
            return
        if tag in BLOCKS:
            self._flush()
        if tag in _ENDS_P and self._opened["p"]:
            self._end({"p"}, {"table", "button", "object", "td", "th"} | (CONTAINERS - {"html"}))
        if tag in ENDS and any(self._opened[t] for t in ENDS[tag]):
            self._end(ENDS[tag], SCOPE.get(tag, {"table"}))
        if tag in VOID:
            return
        parent = self._stack[-1]
        classes, named, own_id, hidden = "", "", "", False
        for name, value in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
            name, value = name.lower(), value.strip("\"'")
            if name == "class":
                classes = ".".join(sorted({c for c in re.sub(r"\d+", "", value).lower().split()}))
            hidden = hidden or name == "hidden" or (name == "aria-hidden" and value == "true")
            named += f" {value}" if name in ("class", "role") else ""
            own_id = value if name == "id" else own_id
        self.tags.append(tag)
        self.parents.append(parent)
        step = f">{tag}.{classes}" if classes else f">{tag}"
        self.paths.append(self.paths[parent] + (step if len(self._stack) <= DEEPEST else ""))
        self._opened[tag] += 1
        self._holders.append(len(self.tags) - 1 if tag in CONTAINERS else self._holders[parent])
        self._stack.append(len(self.tags) - 1)
        # The header of the page, not of an article.
        site = tag == "header" and not any(self.tags[i] in ("article", "main") for i in self._stack)
        self._apart.append(self._apart[-1] or hidden or tag in APART or site)
        plain = self._apart[-1] or not (named or own_id or tag in ("article", "main"))
        self._marks.append(self._marks[-1] if plain else self._marked(tag, classes, named, own_id))
        self._in_link += tag == "a"

    def _marked(self, tag: str, classes: str, named: str, own_id: str) -> int:
        """The innermost marked element, after a look at the names of the newest one."""
        new, outer = len(self.tags) - 1, self._marks[-1]
        if own_id and self._trusted(tag, classes, own_id):
            named += f" {own_id}"
        names = [words for name in named.split() if (words := _said(name))] if named else []
        words, marking = set().union(*names), set().union(*map(_beside, names))
        beside = marking & BESIDE or (marking & PERHAPS if not words & CONTENT else set())
        if tag == "p" or tag in HEADINGS:
            beside &= SURE  # a paragraph or heading that is called related or social speaks of that
        whole = any(CONTENT.issuperset(name) for name in names)
        if tag in ("html", "body", "article", "main"):
            if tag == "main" or tag == "article" and not beside:
                self._signs.append((new, outer))
            return outer
        if tag == "header" or not beside:  # of an article
            if whole and tag in CONTAINERS:
                self._signs.append((new, outer))
            return outer
        self._outer[new] = outer
        if beside & SURE:
            self._sure.add(new)
        if beside <= LAYOUT:
            self._layouts.add(new)
            if whole and tag in CONTAINERS:
                self._signs.append((new, new))
        return new

    def _trusted(self, tag: str, classes: str, own_id: str) -> bool:
        """Whether an id is not one made from a heading."""
        if any(self._opened[h] for h in HEADINGS):
            return False
        if tag != "section" and "section" not in classes.split("."):
            return True
        return all(w.lower() in BESIDE | PERHAPS | CONTENT | FURNITURE for w in WORD_PARTS.findall(own_id))

    def _release(self, mark: int, free: set[int]) -> None:
        """Add a marked element and those around it."""
        while mark and mark not in free:
            free.add(mark)
            mark = self._outer[mark]

    def _released(self) -> set[int]:
        """Marked elements that hold the page's text.

        Those that hold more than half of the text of the article or <main> around them, if no word of SURE is among their names.
        Those around <main>. If no article or element named for its content stands outside of marked ones, those
        around the ones that stand in fewest: around an article if all are named after layouts, else if it
        holds more text than is left without it. If nothing is left, the one named after a layout that holds most.
        With an element, those around it are in the set.
        """
        free: set[int] = set()
        if not self._outer:
            return free
        sizes = [0] * len(self.tags)  # characters outside links, for marked elements less those marked within them
        alone: dict[int, int] = defaultdict(int)
        for element, runs in self._runs:
            for mark, text, links in runs:
                plain = 0 if links else len("".join(text.split()))
                sizes[element] += plain
                alone[mark] += plain
        for i in range(len(sizes) - 1, 0, -1):
            sizes[self.parents[i]] += sizes[i]
        if unsure := self._outer.keys() - self._sure:
            article = [0] * len(self.tags)  # the nearest article or <main> around each element, itself included
            for i in range(1, len(self.tags)):
                article[i] = i if self.tags[i] in ("article", "main") else article[self.parents[i]]
            free.update(m for m in unsure if article[m] and 2 * sizes[m] > sizes[article[m]])
        for element, mark in self._signs:
            if self.tags[element] == "main":
                self._release(mark, free)
        around, layout = {0: 0}, {0: True}  # how many marked elements, not free, stand around; whether all are layouts
        for mark, outer in self._outer.items():  # from the outermost inwards
            around[mark] = around[outer] + (mark not in free)
            layout[mark] = layout[outer] and (mark in free or mark in self._layouts)
        left = sum(n for mark, n in alone.items() if not around[mark])
        signs = [(element, mark) for element, mark in self._signs if sizes[element]]
        if all(around[mark] for _, mark in signs):
            fit = []
            for element, mark in signs:
                named = self.tags[element] == "article"
                if layout[mark] and named or (layout[mark] or named) and sizes[element] > left:
                    fit.append(mark)
            fewest = min((around[mark] for mark in fit), default=0)
            for mark in fit:
                if around[mark] == fewest:
                    self._release(mark, free)
        if not any(n for mark, n in alone.items() if not mark or mark in free):
            fit = [(n, -mark) for mark, n in alone.items() if n and layout[mark]]
            if fit:
                self._release(-max(fit)[1], free)
        return free

    def _kept(self, free: set[int]) -> list[tuple[int, str, int]]:
        """The blocks without text of marked elements, but for those in `free`."""
        dropped = {0: False}
        for mark, outer in self._outer.items():  # from the outermost inwards
            dropped[mark] = dropped[outer] or mark not in free
        out = []
        for element, runs in self._runs:
            runs = [run for run in runs if not dropped[run[0]]] if self._outer else runs
            if text := " ".join("".join([text for _, text, _ in runs]).split()):
                out.append((element, text, sum([links for _, _, links in runs])))
        return out

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """End the innermost open elements up to the outermost of `tags` within the nearest of `scope`."""
        found = None
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in tags:
                found = depth
            elif tag in scope:
                break
        if found:
            self._pop(found)

    def _close(self, tag: str) -> None:
        if self._opened[tag]:
            self._pop(next(d for d in range(len(self._stack) - 1, 0, -1) if self.tags[self._stack[d]] == tag))
        elif tag in BLOCKS:
            self._flush()

    def _pop(self, depth: int) -> None:
        closed = [self.tags[i] for i in self._stack[depth:]]
        if not BLOCKS.isdisjoint(closed):
            self._flush()
        for tag in closed:
            self._opened[tag] -= 1
            self._in_link -= tag == "a"
        del self._stack[depth:], self._apart[depth:], self._marks[depth:]

    def best_container(self) -> int:
        """The container whose blocks hold most text outside links; what its inner containers hold counts by half."""
        scores: dict[int, float] = {}
        for element, text, links in self.blocks:
            credit = max(0.0, len(text) - 3.0 * links)
            while (element := self._holders[element]) and credit >= 1:
                scores[element] = scores.get(element, 0.0) + credit
                credit /= 2
                element = self.parents[element]
        worth = {i: s * (2 if self.tags[i] in ("article", "main") else 1) for i, s in scores.items()}
        return max(worth, key=lambda i: (worth[i], -i), default=0)

    def enclosing(self, container: int) -> int:
        """The article around a container, else the <main>, else the container itself."""
        around = [container]
        while around[-1] > 0:
            around.append(self.parents[around[-1]])
        return next((i for tag in ("article", "main") for i in around if i > 0 and self.tags[i] == tag), container)

    def steps(self, container: int) -> list[tuple[int, int, int]]:
        """A container and those around it that add text outside links, with the characters of text outside links and
        of links and parts left out that each adds to the container's. None are beyond an article, <main> or <body>."""
        plain, aside = [0] * len(self.tags), [0] * len(self.tags)
        for element, text, links in self.blocks:
            plain[element] += max(0, len(text) - links)
            aside[element] += min(len(text), links)
        for element, n in self._aside.items():
            aside[element] += n
        for element, runs in self._runs if self._outer else ():
            aside[element] += sum(len(text.strip()) for mark, text, _ in runs if mark and mark not in self._free)
        for i in range(len(plain) - 1, 0, -1):
            plain[self.parents[i]] += plain[i]
            aside[self.parents[i]] += aside[i]
        out, at = [(container, plain[container], 0)], container
        while self.tags[at] not in ("article", "main") and (at := self._holders[self.parents[at]]) and self.tags[at] not in ("html", "body"):
            if plain[at] > plain[out[-1][0]] and self.paths[at] != self.paths[out[-1][0]]:
                out.append((at, plain[at], aside[at] - aside[container]))
        return out

    def _whole(self) -> int:
        """The best container, or the outermost around it that adds text but little beside it."""
        best = self.enclosing(self.best_container())
        return [i for i, plain, aside in self.steps(best) if CLEAN * aside <= plain][-1] if best else 0

    def text(self, path: str | None) -> str:
        """The blocks below elements of the given path, or below the page's own choice if it has none."""
        chosen = {i for i, p in enumerate(self.paths) if i and p == path}
        blocks = self._below(chosen, self._kept(self._free | self._around(chosen))) if chosen else []
        return "\n\n".join(blocks or self._below({self._whole()}))

    def _around(self, chosen: set[int]) -> set[int]:
        """Marked elements that hold one of those chosen, and a marked one chosen alone."""
        found = set(chosen if len(chosen) == 1 else ())
        for i in chosen if self._outer else ():
            while (i := self.parents[i]) > 0 and i not in found:
                found.add(i)
        return found & self._outer.keys()

    def _below(self, chosen: set[int], blocks: list[tuple[int, str, int]] | None = None) -> list[str]:
        inside = [False] * len(self.tags)
        for i, parent in enumerate(self.parents):
            inside[i] = i in chosen or (parent >= 0 and inside[parent])
        return [text for element, text, _ in (self.blocks if blocks is None else blocks) if inside[element]]


_STEP = StructType().add("path", StringType()).add("plain", LongType()).add("aside", LongType())


@F.pandas_udf(StructType().add("path", StringType()).add("chars", LongType()).add("steps", ArrayType(_STEP)))
def _vote(pages: pd.Series) -> pd.DataFrame:
    """The generalised path of each page's best container, the characters below it and its `steps`; null without one."""
    rows = []
    for html in pages:
        page = Page(html or "")
        best = page.enclosing(page.best_container())
        steps = [{"path": page.paths[i], "plain": plain, "aside": aside} for i, plain, aside in page.steps(best)] if best else []
        rows.append((page.paths[best], sum(map(len, page._below({best}))), steps) if best else (None, 0, steps))
    return pd.DataFrame(rows, columns=["path", "chars", "steps"])


@F.pandas_udf(StringType())
def _text(pages: pd.Series, paths: pd.Series) -> pd.Series:
    return pd.Series([Page(html or "").text(path) for html, path in zip(pages, paths)], dtype=object)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The path to read each host's pages at: columns `host`, `path`.

    Most pages decide; ties go to the path with more text, then to the first in order. From there it goes out to the
    outermost container whose text, on all pages where it adds some, is CLEAN times what it adds in links and parts left out.
    Votes are counted before they are shuffled.
    """
    own = F.col("reach") == F.col("path")
    votes = (pages.select(host_of(F.col(f"`{url}`")).alias("host"), _vote(F.col(f"`{html}`")).alias("vote"))
             .where("vote.path is not null").select("host", "vote.path", "vote.chars", F.explode("vote.steps").alias("step"))
             .groupBy("host", "path", F.col("step.path").alias("reach"))
             .agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("step.plain").alias("plain"), F.sum("step.aside").alias("aside"))
             .groupBy("host", "path").agg(
                 F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.col("chars"))).alias("chars"),
                 F.min(F.when(own | (F.col("aside") * CLEAN <= F.col("plain")), F.struct(F.length("reach"), "reach")))["reach"].alias("reach")))
    # min_by over negated numbers: the first in order wins the last tie.
    return votes.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("chars")).alias("chars"), "path", "reach"))["reach"].alias("path"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", column: str = "text",
              broadcast_bytes: int = 16 << 20) -> DataFrame:
    """The pages with their main text, which replaces a column of that name.

    Each page's containers are scored by their text outside links; the pages of a host vote on the generalised path
    of the best one or the article around it, which goes out to containers that add text and little else (`host_paths`), and
    every page is read at the winning path, or at its own best container if it has no such
    element or no text there. Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments are left out by element, class, id and role. A name counts as a whole: all its words must name parts of
    pages, in one of seven languages. It counts for nothing where it says what an element has or lacks, where it is an id
    made from a heading, or where the element holds the page's text or, unless it names comments or adverts, most of its article's. Character references are decoded, white space within
    a block becomes one space, and blocks are joined by an empty line. A null page or one without text gives an
    empty text; pages without a host vote together. Copies vote as often as they occur.

    If the winning paths of all hosts take at most `broadcast_bytes`, every executor gets them and no page is
    shuffled; beyond that, pages are joined to them by host and a salt.
    """
    winners = staged(host_paths(pages, url, html).select(F.col("host").alias(f"{OWN}host"), F.col("path").alias(f"{OWN}path")))
    size = winners.agg(F.sum(F.octet_length(f"{OWN}host") + F.octet_length(f"{OWN}path"))).first()[0] or 0
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() != column.lower()]
    marked = pages.withColumn(f"{OWN}host", host_of(F.col(f"`{url}`")))
    if size <= broadcast_bytes:
        joined = marked.join(F.broadcast(winners), f"{OWN}host", "left")
    else:
        # Pages of one host go to as many tasks as there are salts, with a copy of its path each.
        salted = marked.withColumn(f"{OWN}salt", F.pmod(F.xxhash64(f"`{url}`", f"`{html}`"), F.lit(SALTS)))
        copies = winners.withColumn(f"{OWN}salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(copies, [f"{OWN}host", f"{OWN}salt"], "left")
    return joined.select(*kept, _text(F.col(f"`{html}`"), F.col(f"{OWN}path")).alias(column))
