"""Stored web pages: main content, text, markdown, links, and the link frontier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchloom.functions import web
from watchloom.operators.tables import bounded, numbered, shared_folder, written

#: What holds a page's main content, in order of preference: (tag, class, role).
MAIN = (("main", "", ""), ("article", "", ""), ("", "", "main"), ("", "theme-doc-markdown", ""), ("", "markdown", ""), ("", "content", ""), ("", "doc-content", ""), ("", "DocSearch-content", ""))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PAGE_CAP = 1000
REFERENCE = re.compile(r"&#?\w+;")


class Outline(HTMLParser):
    """Source ranges of the elements that may hold the main content, and of the body; the title and the links of the document."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.html, self.lines = html, [0, *(m.end() for m in re.finditer("\n", html))]  # the parser counts no other line ends
        self.open: list[tuple[str, int, list[int]]] = []
        self.found: dict[int, str] = {}
        self.body = ""
        self.titles: list[list[tuple[str, str]]] = []  # of each title, its text and the source of it
        self.hrefs: list[str] = []
        self.feed(html)
        self.close()
        while self.open:
            self.end(len(html))

    def place(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            return
        a = dict(reversed(attrs))  # of a repeated attribute the first counts
        if tag == "a" and a.get("href"):
            self.hrefs.append(a["href"])
        if tag == "title":
            self.titles.append([])
        names = (a.get("class") or "").split()
        fits = [k for k, (t, c, r) in enumerate(MAIN) if (t and t == tag) or (c and c in names) or (r and r == a.get("role"))]
        self.open.append((tag, self.place() + len(self.get_starttag_text() or ""), fits))

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "title" and self.titles:
            at = self.place()
            end = self.html.find("<", at + 1)
            self.titles[-1].append((data, data if self.html.startswith("<", at) else self.html[at : None if end < 0 else end]))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _, _ in self.open):
            while self.open[-1][0] != tag:
                self.end(self.place())
            self.end(self.place())

    def end(self, at: int) -> None:
        tag, start, fits = self.open.pop()
        inner = self.html[start:at]
        for k in fits:
            if inner.strip():
                self.found[k] = inner if k not in self.found else self.found[k]
        if tag == "body":
            self.body = inner

    def title(self, *, ended: bool = False) -> str:
        """ended: a character reference without its semicolon stays as it is written; a browser decodes some of them."""
        text = "".join(REFERENCE.sub(lambda m: unescape(m[0]), source) if ended else data for data, source in self.titles[0]) if self.titles else ""
        return " ".join(text.split())

    def main(self) -> str:
        return self.found[min(self.found)] if self.found else self.body


#: Elements that stand on lines of their own.
BLOCKS = frozenset("address article aside body caption center dd details div dl dt fieldset figcaption figure footer form header html main nav p section summary table tbody td tfoot th thead tr".split())


class Item(str):
    """A finished list item."""


def tidy(text: str) -> str:
    return re.sub(r"\n[ \n]*\n", "\n\n", text)


class Markdown(HTMLParser):
    """Headings as #, fenced code, bullet and numbered lists, quotes, rules, links, images, emphasis; other tags leave their text."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        #: Open elements: tag, attributes, content so far.
        self.open: list[tuple[str, dict[str, str | None], list[str]]] = [("", {}, [])]
        self.feed(html)
        self.close()
        while len(self.open) > 1:
            self.end()

    def inside(self, *tags: str) -> bool:
        return any(t in tags for t, _, _ in self.open)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(reversed(attrs))
        out = self.open[-1][2]
        if tag == "br":
            out.append("\n" if self.inside("pre") else "  \n")
        elif tag == "hr":
            out.append("\n\n* * *\n\n")
        elif tag == "img":
            if a.get("src"):
                out.append(f"![{a.get('alt') or ''}]({a['src']})")
        elif tag not in VOID:
            if tag in ("p", "li") and self.open[-1][0] == tag:  # an end tag that may be left out
                self.end()
            self.open.append((tag, a, []))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _, _ in self.open[1:]):
            while self.open[-1][0] != tag:
                self.end()
            self.end()

    def handle_data(self, data: str) -> None:
        if not self.inside("script", "style"):
            self.open[-1][2].append(data if self.inside("pre") else re.sub(r"\s+", " ", data))

    def end(self) -> None:
        tag, attrs, parts = self.open.pop()
        text = "".join(parts)
        bare = text.strip()
        outer, _, out = self.open[-1]
        if re.fullmatch("h[1-6]", tag):
            text = f"\n\n{'#' * int(tag[1])} {bare}\n\n" if bare else ""
        elif tag == "pre":
            text = f"\n\n```\n{text.strip(chr(10))}\n```\n\n"
        elif tag == "code" and not self.inside("pre"):
            text = f"`{bare}`" if bare else ""
        elif tag in ("b", "strong"):
            text = f"**{bare}**" if bare else text
        elif tag in ("i", "em"):
            text = f"_{bare}_" if bare else text
        elif tag == "a" and attrs.get("href"):
            text = f"[{bare}]({attrs['href']})"
        elif tag == "blockquote":
            text = "\n\n" + "\n".join("> " + line for line in tidy(bare).split("\n")) + "\n\n"
        elif tag == "li":
            text = Item(tidy(bare)) if outer in ("ul", "ol", "menu") else f"\n- {tidy(bare)}"
        elif tag in ("ul", "ol", "menu"):
            n, lines = int(start) if (start := attrs.get("start") or "").isdigit() else 1, []
            for item in parts:
                if item.strip():
                    mark = f"{n + len(lines)}. " if tag == "ol" else "- "
                    lines.append(mark + item.strip().replace("\n", "\n" + " " * len(mark)))
            text = ("\n" if outer == "li" else "\n\n") + "\n".join(lines) + ("" if outer == "li" else "\n\n")
        elif tag in BLOCKS:
            text = f"\n\n{bare}\n\n" if bare else ""
        out.append(text)

    def text(self) -> str:
        return tidy("".join(self.open[0][2])).strip()


class Text(HTMLParser):
    """All text, that of scripts and styles included."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.feed(html)
        self.close()

    def handle_data(self, data: str) -> None:
        self.out.append(data)

    def text(self) -> str:
        return re.sub(r"\s+", " ", "".join(self.out)).strip()


def read(html: str, url: str, *, ended: bool = False) -> tuple[str, list[str], str]:
    """(title or the URL, distinct normalised links in ascending order, HTML of the main content) of a page, parsed once. ended: see Outline.title."""
    o = Outline(html)
    return o.title(ended=ended) or url, sorted({x for h in o.hrefs if (x := web.resolved(h, url)) is not None}), o.main()


def contents(pages: DataFrame) -> DataFrame:
    """page_id, url, main_html, text, markdown of each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            main = [Outline(h or "").main() for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "main_html": main, "text": [Text(m).text() for m in main], "markdown": [Markdown(m).text() for m in main]})

    bounded(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, main_html string, text string, markdown string")


def outlinks(pages: DataFrame, *, origin: str | None = None, prefix: str | None = None, ended: bool = False) -> DataFrame:
    """page_id, url, title, links of each page as a browser reads them; only links of the origin and below the prefix, if given.

    ended: in titles, only character references that end with a semicolon are decoded.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [read(h or "", u or "", ended=ended) for h, u in zip(b["html"], b["url"], strict=True)]
            kept = [[x for x in found if web.within(x, origin, prefix)] for _, found, _ in got]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "title": [t for t, _, _ in got], "links": kept})

    bounded(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, title string, links array<string>")


def records(pages: DataFrame, fetched_at: str, *, origin: str | None = None, prefix: str | None = None) -> DataFrame:
    """Page records: url, title, fetched_at, slug, markdown, text, links; one a row of pages, each page parsed where it is read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [read(h or "", u or "") for h, u in zip(b["html"], b["url"], strict=True)]
            kept = [[x for x in found if web.within(x, origin, prefix)] for _, found, _ in got]
            yield pd.DataFrame({"url": b["url"], "title": [t for t, _, _ in got], "slug": b["slug"], "markdown": [Markdown(m).text() for *_, m in got], "text": [Text(m).text() for *_, m in got], "links": kept})

    bounded(pages.sparkSession)
    found = pages.select("url", "html", web.slug(F.col("url")).alias("slug")).mapInPandas(run, "url string, title string, slug string, markdown string, text string, links array<string>")
    return found.select("url", "title", F.lit(fetched_at).alias("fetched_at"), "slug", "markdown", "text", "links")


def edges(pages: DataFrame) -> DataFrame:
    """source, target: the normalised links between URLs."""
    return outlinks(pages).select(F.regexp_replace("url", r"#.*", "").alias("source"), F.explode("links").alias("target"))


def frontier(links: DataFrame, seeds: DataFrame, *, cap: int | None = PAGE_CAP, rounds: int | None = None, keep=written) -> DataFrame:  # noqa: ANN001
    """url, depth of what is reached from the seeds (url) over links (source, target), first come first visited, at most cap pages.

    It ends when a round finds no new page, or the cap or the number of rounds is reached; None: no such bound. The cap is the
    crawl's own limit, taken by (depth, url). keep(df) makes a round's state durable and reads it back, so that no round runs twice.
    """
    first = lambda d, n: d if cap is None else d.orderBy("url").limit(n)
    seen = keep(first(seeds.select("url").distinct().withColumn("depth", F.lit(0)), cap))
    for depth in count(1) if rounds is None else range(1, rounds + 1):
        room = None if cap is None else cap - seen.count()
        if room is not None and room <= 0:
            break
        new = links.join(seen.where(F.col("depth") == depth - 1), links["source"] == F.col("url"), "left_semi").select(F.col("target").alias("url")).distinct().join(seen, "url", "left_anti")
        new = keep(first(new.withColumn("depth", F.lit(depth)), room))
        if not new.limit(1).count():
            break
        seen = keep(seen.unionByName(new))
    return seen


def crawl(links: DataFrame, stored: DataFrame, seeds: DataFrame, *, cap: int | None = PAGE_CAP, rounds: int | None = None) -> DataFrame:
    """url, depth, saved of what is visited from the seeds (url) over links (source, target): a page that isn't stored (url) is visited, but not saved.

    Visits go by (depth, URL). The cap is the crawl's own limit and counts saved pages; when it is reached, nothing more is visited.
    It ends when a round finds no new page, or the cap or the number of rounds is reached; None: no such bound. A round adds a folder with
    its own pages to the visited ones, which are never written again.
    """
    spark, top = links.sparkSession, shared_folder(links.sparkSession)
    kind = "url string, saved boolean"
    here = stored.select(F.col("url").alias("_stored")).distinct()
    found, room = seeds.select("url").distinct(), cap
    for depth in count(0):
        new = found.join(here, found["url"] == here["_stored"], "left").select("url", F.col("_stored").isNotNull().alias("saved"))
        new = written(new)
        saved = new.where("saved")
        if room is not None and saved.limit(room).count() == room:
            last = saved.orderBy("url").limit(room).agg(F.max("url")).first()[0]  # `cap` rows at most
            new = new.where(F.col("url") <= F.lit(last)) if room else new.where("false")
        new.write.parquet(f"{top}/depth={depth}")
        new = spark.read.schema(kind).parquet(f"{top}/depth={depth}")
        room = None if room is None else room - new.where("saved").count()
        if room == 0 or depth == rounds or not new.limit(1).count():
            break
        seen = spark.read.schema(kind).parquet(*[f"{top}/depth={k}" for k in range(depth + 1)])
        found = links.join(new.where("saved"), links["source"] == F.col("url"), "left_semi").select(F.col("target").alias("url")).distinct().join(seen, "url", "left_anti")
    return spark.read.schema(f"{kind}, depth int").option("basePath", top).parquet(top).select("url", "depth", "saved")


def first_seen(seen: DataFrame) -> DataFrame:
    """Visit order: by depth, then URL; numbered range by range, as a crawl without a cap has no bound."""
    return numbered(seen, "depth", "url", start=1)
