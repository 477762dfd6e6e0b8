"""Main text of web pages by wrapper inference.

A page is a stream of text blocks, each under a path of block elements (tag, id and classes, words with digits in id and class
are one).
Runs of blocks with one path are a repeated group, so a page is a union-free regular expression over paths.  The wrapper of
a host holds what its different pages (repeated pages count once) say of a path: on how many pages it is (optional, if not
on all), whether it is repeated, whether it is all links, and whether its text is always the same.  Template is

* a path that is never repeated and has the same text on all its pages, at least ``LEAST`` and ``SOME`` of the host's;
* a text that ``MANY`` pages and more than half of the host's have under one path;
* a repeated path of nothing but links on ``MANY`` pages and more than half of the host's.

Tag names, classes and ids are a prior on the rest: a page's article (or main part, where it has no article) is content,
except for parts named as menus, headers, footers, sidebars, notices, adverts, forms or comments; a page without either keeps its
blocks that aren't links.  An article of nothing but template stays (a page that was put up several times).

Scale: a task turns each page into slim rows (host, path hash, text hash, page hash) without text; they are counted with
ordinary aggregates, which no hot host makes large.  A page meets only its host's labels: hashes of template and of link
paths, whose number the shares above bound by a multiple of the blocks of one page.  Pages are extracted one by one.

Defined results: null or empty html gives an empty text; pages with a null url share one wrapper; broken or cut markup is
read as far as it goes (a button, svg or the like that isn't closed, or closed in itself, ends at its tag); repeated rows are extracted each; null ids are carried along; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as C

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(?P<skip>noscript|template|select|svg|iframe|object|button|canvas)\b[^>]*(?<!/)>(?:(?!<(?P=skip)\b|</?(?:article|main|body)\b).)*?</(?P=skip)\s*>"""
    r"""|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)>|<[a-z/!?][^>]*(?:>|\Z)""", re.S | re.I)
ALONE = frozenset("noscript template select svg iframe object button canvas".split())   # here: not closed, or closed in itself
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Elements that stand inside a line, elements without content, and names of parts that aren't the article.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, **{f"h{i}": {"p"} for i in range(1, 7)},
          **{t: {"p"} for t in "div section article aside nav header footer main ul ol table form blockquote pre".split()}}
OUT_TAGS = frozenset("nav header footer aside form head menu dialog".split())
OUT_WORDS = frozenset("ad ads advert adverts advertisement sponsored sponsor promo banner nav navbar navigation menu "
                      "breadcrumb breadcrumbs header footer masthead sidebar aside widget widgets related recommended "
                      "share sharing social cookie cookies consent notice notices alert popup modal newsletter subscribe "
                      "signup login comment comments reply replies respond discussion form search pagination pager "
                      "copyright legal disclaimer toolbar".split())
IN_WORDS = frozenset("article post entry story content main".split())
MODIFIERS = frozenset("no not has have with without is show hide".split())   # has-comments is no comment
WORD = re.compile(r"[a-z]+")
NUMBERED = re.compile(r"[a-z0-9]*[0-9][a-z0-9]*")   # post-123, post-4f0c
LEAST, MANY, SOME = 3, 10, 0.05                      # pages of a host; a share of them


def blocks(page: str) -> list[tuple[str, str, float]]:
    """(path, text, share of the text inside links) of the non-empty blocks of a page, in order."""
    stack: list[tuple[str, str]] = []                # open block elements: (tag, key)
    out, text, linked, link, at = [], [], 0, 0, 0
    path = ""

    def flush():
        nonlocal linked
        if text:
            t = " ".join("".join(text).split())
            if t:
                out.append((path, t, min(linked / len(t), 1.0)))
            text.clear()
        linked = 0

    def say(raw):
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if link:
                linked += len(raw.strip())

    for m in TAG.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ALONE:
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if m.group("close") else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if m.group("close"):
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        else:
            shut = CLOSES.get(tag, ())
            while stack and stack[-1][0] in shut:
                stack.pop()
            if tag not in VOID:
                key = tag
                if m.group("rest"):
                    named = sorted(f"{a[0].lower()}={(a[1] or a[2] or a[3]).lower()}" for a in ATTRIBUTE.findall(m.group("rest")))
                    key = " ".join([tag, *named]).replace("/", "|")
                stack.append((tag, key))
        path = "/".join(k for _, k in stack)
    rest = page[at:]
    cut = rest.rfind("<")
    say(rest[:cut] if cut >= 0 and re.match(r"<[a-zA-Z/!]", rest[cut:]) else rest)
    flush()
    return out


def skeleton(found: list[tuple[str, str, float]]) -> list[list]:
    """Items [path, optional, repeated, text mark, links] of a page; the mark is 0 where texts differ."""
    items: list[list] = []
    for path, text, links in found:
        mark = zlib.crc32(text.encode("utf-8", "replace")) or 1
        if items and items[-1][0] == path:
            items[-1][2], items[-1][3] = 1, 0
            items[-1][4] = min(items[-1][4], links > 0.6)
        else:
            items.append([path, 0, 0, mark, int(links > 0.6)])
            fold_tail(items)
    return items


def fold_tail(items: list[list]) -> None:
    """A group of two to four items that stands twice at the end becomes one repeated group."""
    for p in (2, 3, 4):
        if len(items) >= 2 * p and [i[0] for i in items[-p:]] == [i[0] for i in items[-2 * p:-p]]:
            for x, y in zip(items[-2 * p:-p], items[-p:]):
                x[2], x[3], x[4] = 1, 0, min(x[4], y[4])
            del items[-p:]
            return


def align(wrapper: list[list], other: list[list]) -> list[list]:
    """The smallest union-free expression over both: common items merged, the rest optional."""
    a, b = [i[0] for i in wrapper], [i[0] for i in other]
    if a == b:
        return [[x[0], x[1] | y[1], x[2] | y[2], x[3] if x[3] == y[3] else 0, min(x[4], y[4])] for x, y in zip(wrapper, other)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i] == b[j]:
            x, y = wrapper[i], other[j]
            out.append([x[0], x[1] | y[1], x[2] | y[2], x[3] if x[3] == y[3] else 0, min(x[4], y[4])])
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([wrapper[i][0], 1, *wrapper[i][2:]])
            i += 1
        else:
            out.append([other[j][0], 1, *other[j][2:]])
            j += 1
    folded: list[list] = []
    for x in out:                                    # neighbours with one path are a repeated group
        if folded and folded[-1][0] == x[0]:
            y = folded[-1]
            folded[-1] = [x[0], y[1] & x[1], 1, 0, min(y[4], x[4])]
        else:
            folded.append(x)
    return folded


def part_words(named: list[str], inside: bool) -> set[str]:
    """Words of the classes and ids of an element that can name a part; a header of an article is one of its own."""
    out = set()
    for token in named:
        words = WORD.findall(token.partition("=")[2] if token.startswith(("class=", "id=", "role=")) else token)
        if "layout" not in words:
            own = inside or IN_WORDS & set(words)
            out.update(w for v, w in zip(["", *words], words) if v not in MODIFIERS and not (own and w == "header"))
    return out


def outside(path: str) -> bool:
    """Whether a path names a part that isn't the article (classes of a whole page name none)."""
    inside = False
    for key in path.split("/"):
        tag, *named = key.split(" ")
        if tag in ("html", "body"):
            continue
        if part_words(named, inside) & OUT_WORDS or (tag in OUT_TAGS and not (inside and tag == "header")):
            return True
        inside = inside or tag == "article"
    return False


def holds(path: str) -> int:
    """2 inside an article, 1 inside a main part, else 0."""
    most = 0
    for key in path.split("/"):
        tag, *named = key.split(" ")
        if tag == "article":
            return 2
        if tag == "main" or "role=main" in named or set(WORD.findall(" ".join(named))) & IN_WORDS:
            most = 1
    return most


def name(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) or 1


def path_name(path: str) -> int:
    keys = (key.partition(" ") for key in path.split("/"))
    return name("/".join(f"{tag} {NUMBERED.sub('#', named)}" for tag, _, named in keys))


def facts(found: list[tuple[str, str, float]]) -> list[tuple[int, int, int, int]]:
    """(path, text, blocks, whether all are links) of a page: one for each path and text, and with text 0 each path."""
    out: dict[tuple[int, int], list] = {}
    for path, text, links in found:
        p = path_name(path)
        for key in ((p, name(text)), (p, 0)):
            was = out.setdefault(key, [0, 1])
            was[0] += 1
            was[1] = min(was[1], int(links > 0.6))
    return [(p, t, n, link) for (p, t), (n, link) in out.items()]


def extract(page: str | None, drop: set, linked: set[int], mixed: set[int]) -> str:
    """The text of a page by its host's labels: the best kind of part that the page has."""
    if not page:
        return ""
    found = [(holds(path), path_name(path), path, text, links) for path, text, links in blocks(page) if not outside(path)]
    varies = [x for x in found if not (x[1] in drop or (x[1], name(x[3])) in drop)]
    for some in (varies, found):
        best = max((x[0] for x in some), default=0)
        if best:
            return "\n".join(x[3] for x in some if x[0] == best)
    own: dict[int, bool] = {}                        # paths too rare on the host for a label
    for _, p, _, _, links in varies:
        own[p] = own.get(p, True) and links > 0.6
    return "\n".join(x[3] for x in varies if not (x[1] in linked or (x[1] not in mixed and own[x[1]])))


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, paths, texts, linked, mixed): hashes of a host's template paths and texts, link paths and other frequent paths."""

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for host, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = blocks(text or "")
                which = name(*(x for path, t, _ in found for x in (path, t)))
                rows += [(host, p, t, which, n, link) for p, t, n, link in facts(found)]
                rows.append((host, 0, 0, which, 1, 0))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                             names=["host", "path", "text", "page", "n", "link"])

    rows = pages.select(host_of(url).alias("host"), F.col(page).alias("html")).mapInArrow(
        run, "host string, path long, text long, page long, n long, link long")
    once = rows.groupBy("host", "path", "text", "page").agg(F.max("n").alias("n"), F.min("link").alias("link"))
    texts = once.groupBy("host", "path", "text").agg(F.count("*").alias("on"), F.sum("n").alias("blocks"), F.min("link").alias("link"))
    path = F.col("text") == 0
    texts = C.write_table(texts.where(path | (F.col("on") >= LEAST)), "wrappers")   # pages are read once for all that follows
    # one row per path, with the pages of its most frequent text: the same text on all of them is a constant
    by_path = texts.groupBy("host", "path").agg(
        F.max(F.when(path, F.col("on"))).alias("on"), F.max(F.when(path, F.col("blocks"))).alias("blocks"),
        F.min("link").alias("link"), F.max(F.when(~path, F.col("on"))).alias("same"))
    whole = by_path.where("path = 0").select("host", F.col("on").alias("pages"))
    known = by_path.where("path <> 0").join(whole, "host")
    some = F.col("on") >= SOME * F.col("pages")
    most = (F.col("on") >= MANY) & (2 * F.col("on") > F.col("pages"))
    constant = some & (F.col("on") >= LEAST) & (F.col("same") == F.col("on")) & (F.col("blocks") == F.col("on"))
    listed = most & (F.col("link") == 1) & (F.col("blocks") > F.col("on"))
    often = texts.where(~path & (F.col("on") >= MANY)).join(whole, "host").where(most).groupBy("host").agg(
        F.collect_list(F.struct("path", "text")).alias("texts"))
    return known.where(some).groupBy("host").agg(
        F.collect_list(F.when(constant | listed, F.col("path"))).alias("paths"),
        F.collect_list(F.when(F.col("link") == 1, F.col("path"))).alias("linked"),
        F.collect_list(F.when(F.col("link") == 0, F.col("path"))).alias("mixed")).join(often, "host", "left")


def host_of(url: str):
    """The url's host without scheme, user, port and a leading www or m; empty for a null url."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?(?:www\.|m\.)?([^/:?#]*)", 1),
                      F.lit(""))


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    by_host = wrappers(pages, url, page)
    rows = pages.select(F.col(id_col), F.col(url), F.col(page).alias("html"), host_of(url).alias("host"))
    joined = rows.join(by_host, "host", "left").select(id_col, url, "html", "paths", "texts", "linked", "mixed")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = []
            for h, paths, frequent, linked, mixed in zip(*(b.column(i).to_pylist() for i in range(2, 7))):
                drop = {*(paths or ()), *((x["path"], x["text"]) for x in frequent or ())}
                texts.append(extract(h, drop, set(linked or ()), set(mixed or ())))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url, "text", "n_chars"])

    return joined.mapInArrow(run, f"`{id_col}` {kind}, `{url}` string, text string, n_chars long")
