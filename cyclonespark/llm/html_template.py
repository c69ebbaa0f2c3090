"""HTML extraction: equivalence-class template deduction.

1. Every page is cut into tokens; a tag's role is its name, class or id and the containers
   around it.  A role's occurrence vector over the pages of its host is summed up, page by page,
   in a two-part fingerprint (an aggregate that combines before the shuffle, so a host that holds a
   third of all pages is no single task).
2. Roles of one host with equal vectors form an equivalence class.  An element whose opening and
   closing roles are in one class, or nearly so (pages may break off), is valid and nests in the template;
   texts that all pages of a host share are the template's own.
3. A page is laid on its host's template.  Where the page lost an end tag, so that its elements stand deeper than the
   template has them, the valid elements that should have ended before are ended there.
   Texts inside the article are extracted; without one, all but those of page furniture, the template's own texts and
   its slots (the insides of valid elements) that hold mostly links.

Nulls and edge cases: a null, empty or text-less html gives text '' and 0 characters; a null url is the host '';
a host of one page is its own template; repeated rows are extracted one by one; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import checkpoint, ship

#: share of a host's pages that must hold a role of its template
SUPPORT = 0.5
#: share of its occurrences by which an opening role may differ from its closing one
TOLERANCE = 0.1
#: template texts need so many pages
MIN_PAGES = 3
#: templates of up to so many rows are broadcast to the pages, more are shuffled
BROADCAST_ROWS = 20_000

# FIXED VALUES: element names of the HTML standard
RAW = ("script", "style", "textarea", "title")  # never closed, they run to the page's end
SKIPPED = ("noscript", "template", "iframe", "svg", "object", "canvas")  # left out with all they hold, if they are closed
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html head body article main section div nav header footer aside form ul ol dl table tbody thead tfoot tr figure fieldset details dialog menu blockquote select button".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre hr figcaption address legend caption summary option".split())
FURNITURE = frozenset("head nav header footer aside form button select dialog menu option".split())
MAIN = frozenset("article main".split())
#: words of a class or id that mark page furniture, reader comments among them, or the article
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay popup promo promoted recommended related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())

_HIDDEN = rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
_TOKEN = re.compile(
    rf"{_HIDDEN}|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_SKIP = re.compile(rf"{_HIDDEN}|<(?P<close>/?)(?P<name>{'|'.join(SKIPPED)})(?=[\s/>])(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _number(*parts: str) -> int:
    """63 bits of a role's description."""
    data = "\x00".join(parts).encode("utf-8", "surrogatepass")
    return (zlib.crc32(data) << 31) | (zlib.crc32(data[::-1] + b"\x01") >> 1)


def _shown(source: str) -> Iterator[tuple[int, int]]:
    """Spans of a page outside its skipped elements; those may nest, and one without an end tag skips nothing."""
    inside: dict[str, list[int]] = defaultdict(list)
    gone: list[tuple[int, int]] = []
    for m in _SKIP.finditer(source):
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["close"]:
            if inside[name]:
                gone.append((inside[name].pop(), m.end()))
        elif name == "svg" and m["rest"].endswith("/"):
            gone.append(m.span())
        else:
            inside[name].append(m.start())
    at = 0
    for begin, end in sorted(gone):
        if begin >= at:
            yield at, begin
        at = max(at, end)
    yield at, len(source)


def _matches(source: str) -> Iterator[re.Match | None]:
    """Tokens outside the skipped elements, None for each of those."""
    for i, (begin, end) in enumerate(_shown(source)):
        if i:
            yield None
        yield from _TOKEN.finditer(source, begin, end)


class Page:
    """Tokens of a page: ("open" | "close", name, words of class and id, role) and ("text", string, "", role).

    With ``host``, end tags that the page lost stand where the host's template has them; ``lost`` counts these by name.
    """

    def __init__(self, source: str, host: Template | None = None, lost: dict[str, int] | None = None):
        self.tokens: list[tuple[str, str, frozenset, int]] = []
        around: list[str] = []
        known: dict[tuple, int] = {}

        def role(*parts: str) -> int:
            if parts not in known:
                known[parts] = _number(*parts)
            return known[parts]

        def ended_before(name: str) -> int:
            """How many of the innermost elements the template ends before an element of this name opens."""
            if role("open", name, "/".join(around[-3:])) in host.of:
                return 0
            for n in range(1, len(around)):
                ended, below = around[-n].split("\x01")[0], "/".join(around[:-n][-3:])
                if sum(x.split("\x01")[0] == ended for x in around[-n:]) > lost.get(ended, 0):
                    return 0
                if not host.valid(role("open", ended, below), role("close", ended, below)):
                    return 0
                if role("open", name, below) in host.of:
                    return n
            return 0

        for m in _matches(source):
            if m is None:
                self.tokens.append(("text", " ", frozenset(), 0))
            elif m["text"] is not None:
                if not m["text"].isspace():
                    self.tokens.append(("text", m["text"], frozenset(), 0))
                elif self.tokens:
                    self.tokens.append(("text", " ", frozenset(), 0))
            elif m["name"] is not None:
                name = m["name"].lower()
                if m["close"]:
                    if name in CONTAINERS and any(x.startswith(name + "\x01") for x in around):
                        while not around.pop().startswith(name + "\x01"):
                            pass
                    self.tokens.append(("close", name, frozenset(), role("close", name, "/".join(around[-3:]))))
                else:
                    label = " ".join(next(filter(None, x), "") for x in _LABEL.findall(m["rest"])) if m["rest"] else ""
                    words = frozenset(re.findall(r"[a-z]+", label.lower())) if label else frozenset()
                    if lost and name in CONTAINERS:
                        for _ in range(ended_before(name)):
                            ended = around.pop().split("\x01")[0]
                            lost[ended] -= 1
                            self.tokens.append(("close", ended, frozenset(), role("close", ended, "/".join(around[-3:]))))
                    self.tokens.append(("open", name, words, role("open", name, "/".join(around[-3:]))))
                    if name in CONTAINERS and not m["rest"].endswith("/"):
                        around.append(f"{name}\x01{' '.join(sorted(words))}")
            elif m["raw"] is not None:
                self.tokens.append(("text", " ", frozenset(), 0))


def _furniture(name: str, words: frozenset) -> bool:
    return name in FURNITURE or bool(words & FURNITURE_WORDS)


def _main(name: str, words: frozenset) -> bool:
    return name in MAIN or bool(words & MAIN_WORDS)


def _text_role(text: str) -> int:
    return _number("text", " ".join(text.split()))


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprint parts of the roles of a batch's pages."""
    for batch in batches:
        sums: dict[tuple, list] = defaultdict(lambda: [0, 0, 0, 0])
        for key, url, source in zip(batch["key"], batch["url"], batch["html"], strict=True):
            host = host_of(url)
            counts: dict[int, int] = defaultdict(int)
            inside = 0
            for kind, name, words, role in Page(source or "").tokens:
                if kind == "text":
                    if not inside and name != " ":
                        counts[_text_role(name)] += 1
                    continue
                counts[role] += 1
                if name in CONTAINERS and _main(name, words):
                    inside += 1 if kind == "open" else -1
            counts[0] = 1  # the page itself
            for role, n in counts.items():
                x = hash((int(key), n)) & ((1 << 62) - 1)
                s = sums[host, role]
                s[0] += x >> 31
                s[1] += x & 0x7FFFFFFF
                s[2] += 1
                s[3] += n
        yield pd.DataFrame([(h, r, *s) for (h, r), s in sums.items()], columns=["host", "role", "high", "low", "pages", "total"])


def template(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(host, pages, roles, classes, totals): the roles that enough pages of a host hold, with the class and total of each."""
    rows = pages.select(F.xxhash64(page_id, url).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    part = rows.mapInPandas(_vectors, "host string, role long, high long, low long, pages long, total long")
    # sums of 31-bit parts stay far below a long's range
    whole = part.groupBy("host", "role").agg(*[F.sum(c).alias(c) for c in ("high", "low", "pages", "total")])
    whole = checkpoint(whole.withColumn("class", F.xxhash64("high", "low", "pages")))
    hosts = whole.filter("role = 0").select("host", F.col("pages").alias("host_pages"))
    often = whole.filter("role <> 0").join(hosts, "host").filter(F.col("pages") >= F.greatest(F.lit(1), F.col("host_pages") * SUPPORT))
    return often.groupBy("host").agg(
        F.first("host_pages").alias("host_pages"), F.collect_list(F.struct("role", "class", "total")).alias("t")
    ).select("host", "host_pages", F.col("t.role").alias("roles"), F.col("t.class").alias("classes"), F.col("t.total").alias("totals"))


class Template:
    """A host's template: which elements are valid, and which texts are its own."""

    def __init__(self, pages: int, roles: np.ndarray, classes: np.ndarray, totals: np.ndarray):
        self.pages = pages
        self.of = {int(r): (int(c), int(t)) for r, c, t in zip(roles, classes, totals, strict=True)}

    def valid(self, opening: int, closing: int) -> bool:
        a, b = self.of.get(opening), self.of.get(closing)
        if a is None or b is None:
            return False
        return a[0] == b[0] or abs(a[1] - b[1]) <= TOLERANCE * max(a[1], b[1])

    def own_text(self, text: str) -> bool:
        got = self.of.get(_text_role(text))
        return self.pages >= MIN_PAGES and got is not None and got[1] >= self.pages * (1 - TOLERANCE)


def _lost(tokens: list[tuple[str, str, frozenset, int]]) -> dict[str, int]:
    """End tags that a page lacks, by name; none of a page that breaks off, whose open elements end with it."""
    tags = [(kind, name) for kind, name, _, _ in tokens if kind != "text" and name in CONTAINERS]
    last = next((t[:2] for t in reversed(tokens) if t[0] != "text" or t[1] != " "), None)
    if not tags or last != ("close", tags[0][1]):
        return {}
    missing: dict[str, int] = defaultdict(int)
    for kind, name in tags:
        missing[name] += 1 if kind == "open" else -1
    return {name: n for name, n in missing.items() if n > 0}


def _menus(tokens: list[tuple[str, str, frozenset, int]], pairs: list[tuple[int, int]], shown: np.ndarray, host: Template) -> np.ndarray:
    """Which tokens lie in a slot of the template, the inside of a valid element up to the next valid one, whose varying
    text is mostly links; none, if nothing else is left."""
    slot = np.zeros(len(tokens) + 1, np.int32)
    valid = [(b, e) for b, e in pairs if tokens[b][1] not in ("html", "body") and host.valid(tokens[b][3], tokens[e][3])]
    for n, (begin, end) in enumerate(sorted(valid, key=lambda p: p[0] - p[1]), 1):
        slot[begin:end] = n
    chars = np.zeros((2, len(valid) + 1), np.int64)
    inside = 0
    for i, (kind, name, _, _) in enumerate(tokens):
        if kind == "text":
            if shown[i] and name != " " and not host.own_text(name):
                chars[int(inside > 0), slot[i]] += len(" ".join(name.split()))
        elif name == "a":
            inside = inside + 1 if kind == "open" else max(0, inside - 1)
    mostly = chars[1] > chars[0]
    mostly[0] = False
    return mostly[slot] & bool((chars.sum(axis=0) * ~mostly).any())


def main_text(source: str, host: Template) -> str:
    """The page's article by its host's template; blocks are joined by two line ends."""
    tokens = Page(source).tokens
    if host.of and (lost := _lost(tokens)):
        tokens = Page(source, host, lost).tokens
    # the page's elements, and its known parts: the index of each one's end
    pairs: list[tuple[int, int]] = []
    ends: dict[int, int] = {}
    open_at: dict[str, list[int]] = defaultdict(list)
    for i, (kind, name, _, _) in enumerate(tokens):
        if kind == "open" and name in CONTAINERS:
            open_at[name].append(i)
        elif kind == "close" and open_at.get(name):
            begin = open_at[name].pop()
            pairs.append((begin, i))
            if _main(name, tokens[begin][2]) or _furniture(name, tokens[begin][2]):
                ends[begin] = i
    for name, left in open_at.items():
        for begin in left:  # never closed: up to the page's end, if it is a known part
            if name not in ("html", "body") and (_main(name, tokens[begin][2]) or _furniture(name, tokens[begin][2])):
                ends[begin] = len(tokens)
    # slots: depth of article and of furniture at each token
    article = np.zeros(len(tokens) + 1, np.int32)
    furniture = np.zeros(len(tokens) + 1, np.int32)
    for begin, end in ends.items():
        _, name, words, _ = tokens[begin]
        if _furniture(name, words) and name not in MAIN:
            furniture[begin] += 1
            furniture[end] -= 1
        elif _main(name, words):
            article[begin] += 1
            article[end] -= 1
    article, furniture = np.cumsum(article), np.cumsum(furniture)
    has_article = any(k == "text" and name != " " and article[i] and not furniture[i] for i, (k, name, _, _) in enumerate(tokens))
    menus = np.zeros(len(tokens) + 1, bool)
    if not has_article and host.pages >= MIN_PAGES:
        menus = _menus(tokens, pairs, furniture == 0, host)
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        block = " ".join("".join(run).split())
        if block:
            blocks.append(block)
        run.clear()

    for i, (kind, name, _, _) in enumerate(tokens):
        if kind == "text":
            if furniture[i] or menus[i] or (has_article and not article[i]):
                continue
            if not has_article and name != " " and host.own_text(name):
                continue
            run.append(entities.unescape(name))
        elif name in BLOCKS:
            close()
        elif name in VOID:
            run.append(" ")
    close()
    return "\n\n".join(blocks)


_NONE = Template(0, np.zeros(0), np.zeros(0), np.zeros(0))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Template] = {}
    for batch in batches:
        texts = []
        for url, source, n, roles, classes, totals in zip(batch["url"], batch["html"], batch["host_pages"], batch["roles"], batch["classes"], batch["totals"], strict=True):
            host = host_of(url)
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = _NONE if roles is None else Template(int(n), roles, classes, totals)
            texts.append(main_text(source or "", known[host]))
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": np.asarray([len(t) for t in texts], "int64")})


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    ship(pages.sparkSession)
    found = checkpoint(template(pages, page_id, url, html))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    laid = rows.withColumn("host", host).join(found, "host", "left")
    return laid.select("page_id", "url", "html", "host_pages", "roles", "classes", "totals").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
