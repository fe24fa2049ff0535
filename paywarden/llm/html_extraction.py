"""Main text of web pages by consensus of a host's pages.

Each page is read once to score its containers: how much of the page's prose
one holds against what else it holds.  Containers of one path count together,
a path being the tags and classes from the top of the page with numbers
generalised.  Each page votes for its best path; votes are added up by host and
path, so a host with a third of all pages costs one row a path and task.  Then
each page is read again, and the text is taken from the host's winning path
that stands foremost among those the page has, or from its own best.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paywarden.llm import words as w
from paywarden.llm.html_tree import APART, ARTICLE_WORDS, CONTAINERS, LAYOUT_WORDS, STRANGE_WORDS, TEXT_BLOCKS, Page, read_page
from paywarden.sources.tables import stage

#: Paths of a host that pages are held against; pages with none of them decide for themselves.
PATHS = 8
#: Winning paths up to this size are broadcast; larger tables are joined by host.
BROADCAST_BYTES = 16 << 20
#: A block of no text element is prose from so many words on.
_PROSE_WORDS = 8
_PROSE_TAGS = TEXT_BLOCKS | {"article", "main"}
#: Names that not even most of a page's prose speaks against.
_NEVER_MOST = {"nav", "navigation", "menu", "footer"}


class Scored:
    """What of a page may be text of its article, and how well each path holds it."""

    def __init__(self, page: Page):
        self.page = page
        own_size = [0] * len(page.tag)  # characters right in an element
        prose, plain = own_size.copy(), own_size.copy()
        for owner, text, linked in zip(page.owner, page.text, page.linked):
            own_size[owner] += len(text)
            if 2 * linked < len(text):
                plain[owner] += len(text) - linked
                if page.tag[owner] in _PROSE_TAGS or text.count(" ") >= _PROSE_WORDS - 1:
                    prose[owner] += len(text) - linked
        self._weigh(own_size, prose)
        if page.tag and not self.good[0]:
            # Without prose any text that is no link may be the article.
            self._weigh(own_size, plain)

    def _weigh(self, own_size: list[int], prose: list[int]) -> None:
        self.prose = self._summed(prose)
        self.dropped = self._dropped()
        good = [0 if out else x for x, out in zip(prose, self.dropped)]
        self.good = self._summed(good)
        self.waste = self._summed([x - y for x, y in zip(own_size, good)])

    def _summed(self, own: list[int]) -> list[int]:
        """With what lies inside each element."""
        out, parent = own.copy(), self.page.parent
        for e in range(len(out) - 1, 0, -1):
            out[parent[e]] += out[e]
        return out

    def _dropped(self) -> list[bool]:
        page, n = self.page, len(self.page.tag)
        strange = [not x.isdisjoint(STRANGE_WORDS) for x in page.words]
        # A wrapper of the article, or of most of the page, is kept whatever its name.
        article = [tag in ("article", "main") and not odd for tag, odd in zip(page.tag, strange)]
        title = [tag == "h1" for tag in page.tag]
        for e in range(n - 1, 0, -1):
            above = page.parent[e]
            article[above] |= article[e]
            title[above] |= title[e]
        whole = self.prose[0] if n else 0
        inside, out = [False] * n, [False] * n
        for e, (tag, parent) in enumerate(zip(page.tag, page.parent)):
            inside[e] = e > 0 and inside[parent] or tag in ("article", "main")
            if e and out[parent] or tag in APART:
                out[e] = True
            elif tag in ("html", "body", "main") or tag == "article" and not strange[e]:
                continue
            elif strange[e]:
                out[e] = not article[e]
            elif tag in ("header", "form", "fieldset") or not page.words[e].isdisjoint(LAYOUT_WORDS):
                most = tag != "header" and 5 * self.prose[e] > 3 * whole and page.words[e].isdisjoint(_NEVER_MOST)
                out[e] = not (article[e] or title[e] and inside[e] or most)
        return out

    def scores(self) -> dict[bytes, tuple[float, list[int]]]:
        """For each path with prose: its score, and its elements."""
        page = self.page
        groups: dict[bytes, list[int]] = {}
        keys = page.keys()
        for e, (tag, good, waste) in enumerate(zip(page.tag, self.good, self.waste)):
            if good > 0 and (tag in CONTAINERS or "-" in tag) and not self.dropped[e]:
                # Elements that hold more of anything else than of prose are not the article.
                if good >= waste or tag in ("body", "article", "main"):
                    groups.setdefault(keys[e], []).append(e)
        out = {}
        for key, elements in groups.items():
            good, waste = sum(self.good[e] for e in elements), sum(self.waste[e] for e in elements)
            first = elements[0]
            worth = 2 * good / (self.good[0] + good + waste) * _bonus(page.tag[first], page.words[first])
            out[key] = worth, elements
        return out

    def text(self, elements: list[int]) -> str:
        """The blocks inside the elements, but for what is no text of the article."""
        page = self.page
        taken = [False] * len(page.tag)
        for e in elements:
            taken[e] = True
        for e in range(1, len(taken)):
            taken[e] |= taken[page.parent[e]]
        return "\n".join(t for owner, t in zip(page.owner, page.text) if taken[owner] and not self.dropped[owner])


def _bonus(tag: str, words: set[str]) -> float:
    if tag == "article" or "article" in words:
        return 1.5
    if tag == "main" or words & ARTICLE_WORDS:
        return 1.2
    return 0.9 if tag == "body" else 1.0


def _best(scores: dict[bytes, tuple[float, list[int]]]) -> bytes:
    """The path that scores highest; of equal ones that of the later, inner element."""
    return max(scores, key=lambda k: (scores[k][0], scores[k][1][0]))


def _best_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in w.chunks(batches, "html"):
        hosts, keys, points = [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            scores = Scored(read_page(html or "")).scores()
            if scores:
                key = _best(scores)
                hosts.append(host)
                keys.append(key)
                points.append(int(1000 * scores[key][0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(points, pa.int64())], ["host", "path", "points"]
        )


def extract_page(html: str | None, paths: list[bytes] | None = None) -> tuple[str, str | None, bool]:
    """Text of a page, the path it comes from, and whether that is one of ``paths``."""
    page = Scored(read_page(html or ""))
    scores = page.scores()
    if not scores:
        return "", None, False
    key = next((k for k in paths or [] if k in scores), None)
    voted = key is not None
    elements = scores[key if voted else _best(scores)][1]
    return page.text(elements), page.page.path(elements[0]), voted


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in w.chunks(batches, "html"):
        rows = zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())
        texts, paths, voted = zip(*(extract_page(html, own) for html, own in rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(paths, pa.string()), pa.array(voted, pa.bool_())],
            ["id", "url", "text", "path", "voted"],
        )


def _host(url: Column) -> Column:
    """Host name in lower case; null where a URL has none."""
    host = F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.nullif(host, F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths) of pages (host, html): each host's PATHS foremost paths by points, best first."""
    known = pages.where("host is not null").select("host", "html")
    votes = known.mapInArrow(_best_paths, "host string, path binary, points long")
    votes = votes.groupBy("host", "path").agg(F.sum("points").alias("points"))
    rank = Window.partitionBy("host").orderBy(F.desc("points"), "path")
    best = votes.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= PATHS)
    listed = F.array_sort(F.collect_list(F.struct("rank", "path")))
    return best.groupBy("host").agg(F.transform(listed, lambda x: x["path"]).alias("paths"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text``, ``path`` and ``voted``.

    ``text`` is the article without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles, markup and reader comments.  Character
    references are decoded, white space inside a block is one space, blocks are
    joined by a line feed.  Lines breaks inside a block and cells of a table's
    row are white space.  ``path`` names the container it comes from, ``voted``
    tells that the host's pages chose it.

    A page without text, null or empty, has an empty text and no path.  Pages
    with a null or unreadable url vote for none and decide for themselves; so
    do pages that have none of their host's paths.  Rows are taken one by one,
    so repeated rows and null ids give a row each; each repeated row votes.
    Other columns are not read.
    """
    kinds = [pages.schema[c].dataType for c in (id_col, url_col)]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", _host(F.col("url")))
    winners, size = stage(host_paths(rows), "host-paths", {"bytes": F.sum(F.length("host") + 40 * F.size("paths"))})
    small = (size["bytes"] or 0) <= BROADCAST_BYTES
    # Without a broadcast Spark deals out pages by host and splits large hosts.
    rows = rows.join(F.broadcast(winners) if small else winners, "host", "left").select("id", "url", "html", "paths")
    out = rows.mapInArrow(_extract, f"id {kinds[0].simpleString()}, url string, text string, path string, voted boolean")
    return out.select(F.col("id").alias(id_col), F.col("url").cast(kinds[1]).alias(url_col), "text", "path", "voted")
