"""HTML extraction: article text, with a suffix array per host.

A page is read into blocks, each inside its article (article, main, role=main), inside something that never is text (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts, markup), or neither. What only its class, id or being a
form rejects may be a wrapper of the page: a main inside starts anew, so do the articles under the fewest such elements, and one
that holds WRAP of the page's words is not rejected (comments, consents and lists of related pages always are; articles inside
them count if the page has no other text). Blocks of the last kind and of articles are judged by repetition: the token streams of whole pages are laid end to end for a host, a suffix array ordered by the
first RUN tokens finds substrings of RUN tokens or more that occur on a SHARE of the host's distinct pages, LEAST at least, and
what these cover is removed; the other runs stay. Near copies count as one page, so a page does not turn the text of its copies into boilerplate: pages whose
articles (open blocks where there is none) share NEAR of their distinct runs of GRAM tokens, measured on the smallest hashes of HASHES ranges.

A host's pages are ordered STREAM at a time; a substring's pages are added up over the streams of the host in which LEAST pages
have it, near copies counting once in each.
(A token lies in a repeated substring of RUN tokens or more exactly if it lies in a repeated window of RUN tokens.)

Defined cases: null and empty html give an empty text; unclosed and cut-off markup ends with the page; a page
whose url is null or names no host is compared with no other; equal rows get equal texts; an empty table gives no rows; columns besides page_id, url and html are not looked at.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.sources.storage import stage

RUN = 12            # tokens of the shortest substring that counts
STREAM = 2_048      # pages ordered together
KEPT = 100_000      # pages that a task remembers
WRAP = 0.9          # of a page's words, those of menus, headers and the like left out
SHARE, LEAST = 0.2, 3   # of a host's pages, one for each class of near copies
GRAM, NEAR, HASHES = 4, 0.8, 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z", re.S)
_ATTR = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main",
          "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_NEVER = {"nav", "aside", "footer", "head", "menu", "search", "dialog", "button", "select", "object", "audio", "video", "canvas"}
_SIGNS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                   "alert newsletter subscribe signup popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment "
                   "comments replies disqus related recommended share sharing social widget pagination login search copyright skip".split())
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
_PARTS = {"comment", "comments", "replies", "disqus", "related", "recommended", "cookie", "cookies", "consent", "gdpr"}   # signs of no wrapper
_STATES = {"no", "not", "with", "without", "has", "hide", "is"}   # a class that begins so tells what a page has
ARTICLE, OPEN, NEVER = 2, 1, 0


def _signs(found: dict) -> set[str]:
    names = [re.split(r"[_-]+", n) for n in (found.get("class", "") + " " + found.get("id", "")).split()]
    return {part for n in names if n[0] not in _STATES for part in n}


def _place(name: str, attrs: str, inside: int) -> tuple[int, set[str], str]:
    """Where the content of an element belongs, the signs for which it may be rejected, and main or article if it opens one;
    inside: where the element stands."""
    if inside == NEVER or name in _NEVER:
        return NEVER, set(), ""
    found = {}
    if attrs and not attrs.isspace():
        for key, a, b, c in _ATTR.findall(attrs):
            found[key.lower()] = (a or b or c).lower()
        if re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)) or found.get("aria-hidden") == "true":
            return NEVER, set(), ""
    opened = found.get("role") if found.get("role") in ("main", "article") else name if name in ("article", "main") else ""
    if opened:
        return (NEVER if name == "article" and _signs(found) & {"comment", "comments", "reply"} else ARTICLE), set(), opened
    if name in ("html", "body"):
        return inside, set(), ""
    if name == "header" and inside != ARTICLE or found.get("role") in _ROLES:
        return NEVER, set(), ""
    signs = _signs(found)
    against = signs & (_SIGNS if inside == ARTICLE else _SIGNS | {"header"})
    if name == "form":
        against.add("form")
    return inside, against, ""


def _settle(found: list[tuple[int, str, tuple, int]], against: list[set[str]]) -> list[tuple[int, str]]:
    """Blocks with their places after wrappers are told from rejected elements. found: place, text, the elements around it that
    may be rejected and how many of them stand outside its article."""
    size, total = [0] * len(against), 0
    for where, text, path, _ in found:
        n = 0 if where == NEVER else text.count(" ") + 1
        total += n
        for i in path:
            size[i] += n
    wrapper = {i for i, signs in enumerate(against) if size[i] >= WRAP * total and not signs & _PARTS}
    out = []
    for where, text, path, base in found:
        outside, within = ([i for i in p if i not in wrapper] for p in (path[:base], path[base:]))
        # how little stands against an article: nothing of _PARTS, then few elements
        rank = (any(against[i] & _PARTS for i in outside), len(outside))
        out.append((NEVER if within else where, text, rank))
    least = min((rank for where, _, rank in out if where != NEVER), default=None)
    if least is not None and not least[0]:
        least = min((rank for where, _, rank in out if where == ARTICLE and not rank[0]), default=None)
    return [(NEVER if where == ARTICLE and rank != least else where, text) for where, text, rank in out]


def blocks(page: str) -> list[tuple[int, str]]:
    """(place, text) of each block with text, in page order; character references decoded, white space made single."""
    out: list[tuple[int, str, tuple, int]] = []
    stack: list[tuple[str, tuple]] = []
    against: list[set[str]] = []
    place, text, at = (OPEN, (), 0), [], 0

    def close():
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append((place[0], joined, *place[1:]))
        text.clear()

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in _BLOCK:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close()
                    place = stack[i][1]
                    del stack[i:]
                    break
            continue
        if name == "br":
            text.append(" ")
        if name in _BLOCK:
            close()
            # a paragraph or item that is still open ends before the next block
            while stack and (stack[-1][0] == "p" or name in ("li", "dd", "dt") and stack[-1][0] == name):
                place = stack.pop()[1]
        if name in _RAW:
            # its end may lie far on; without one the rest of the page belongs to it
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _VOID or m[3].endswith("/"):
            continue
        where, path, base = place
        within, signs, opened = _place(name, m[3], where)
        if signs:
            against.append(signs)
            path += (len(against) - 1,)
        elif opened:
            path = () if opened == "main" else path
            base = len(path)
        within = (within, path, base)
        if within != place or name in _BLOCK:
            if within != place:
                close()
            stack.append((name, place))
            place = within
    text.append(page[at:])
    close()
    return _settle(out, against)


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def _pack(found: list[tuple[int, str]]) -> str:
    """Blocks as lines: the place's digit, then the text (which holds no line feed)."""
    return "\n".join(f"{where}{text}" for where, text in found)


def _unpack(body: str) -> list[tuple[int, str]]:
    return [(int(line[0]), line[1:]) for line in body.split("\n")] if body else []


def _tokens(found: list[tuple[int, str]]) -> np.ndarray:
    data = "\n".join(t for _, t in found).encode()
    return bt.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes()


_EMPTY = np.uint32(0xFFFFFFFF)


def _sketch(found: list[tuple[int, str]], tokens: np.ndarray) -> np.ndarray:
    """Of the article's runs of GRAM tokens, or of the open blocks' or the page's, the smallest hash in each of HASHES ranges."""
    place = np.repeat([where for where, _ in found], [t.count(" ") + 1 for _, t in found])
    own = tokens[place == max(where for where, _ in found)]
    grams = np.sort(bt.gram_hashes(own, min(GRAM, len(own))))
    span, first = np.unique(grams >> np.uint64(64 - HASHES.bit_length() + 1), return_index=True)
    out = np.full(HASHES, _EMPTY)
    out[span] = np.minimum(grams[first] & np.uint64(0xFFFFFFFF), _EMPTY - 1)
    return out


def near_copies(sketches: np.ndarray) -> np.ndarray:
    """The class of each page: that of the first page, one for each class, with which it agrees in NEAR of the ranges not
    empty in both."""
    kind = np.zeros(len(sketches), np.int64)
    first = np.empty_like(sketches)
    part = HASHES // 4
    head = np.empty((len(sketches), part), sketches.dtype)
    least = part - int(HASHES * (1 - NEAR))      # equal ones in the first quarter if all others are equal
    n = 0
    for i, sketch in enumerate(sketches):
        near = np.flatnonzero(np.count_nonzero(head[:n] == sketch[:part], axis=1) >= least)
        equal = first[near] == sketch
        void = equal & (sketch == _EMPTY)
        filled = HASHES - np.count_nonzero(void, axis=1)
        near = near[np.count_nonzero(equal & ~void, axis=1) >= NEAR * filled]
        if len(near):
            kind[i] = near[0]
        else:
            kind[i], first[n], head[n] = n, sketch, sketch[:part]
            n += 1
    return kind


def window_order(streams: list[np.ndarray], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of streams laid end to end, ordered by the first `run` tokens: (rank of the window that begins at each
    token, stream of the token, whether the window fits its stream). Ranks double their length until they span the window."""
    if not streams or not sum(map(len, streams)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    owner = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    rank = np.unique(np.concatenate(streams), return_inverse=True)[1].astype(np.int64)
    span = 1
    while span < run:
        step = min(span, run - span)
        other = np.full(len(rank), -1, np.int64)
        if step < len(rank):
            other[:-step] = np.where(owner[:-step] == owner[step:], rank[step:], -1)
        order = np.lexsort((other, rank))
        new = np.ones(len(order), bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (other[order][1:] != other[order][:-1])
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new) - 1
        span += step
    last = np.cumsum([len(s) for s in streams])[owner]
    return rank, owner, np.arange(len(rank)) + run <= last


def _stream_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one stream of pages: host, window (its hash) and pages (classes of near copies that have it, LEAST at least); and a
    row without a window for the number of classes."""
    frame = frame.sort_values("page")
    found = [_unpack(b) for b in frame["body"]]
    streams = [_tokens(f) for f in found]
    kind = near_copies(np.array([_sketch(f, t) for f, t in zip(found, streams)]))
    rank, owner, fits = window_order(streams)
    key = bt.gram_hashes(np.concatenate(streams), RUN)
    place = np.flatnonzero(fits)
    seen = np.unique(rank[place] * len(streams) + kind[owner[place]]) // len(streams)
    ranks, pages = np.unique(seen, return_counts=True)
    ranks, pages = ranks[pages >= LEAST], pages[pages >= LEAST]
    first = np.zeros(len(rank), np.int64)
    first[rank[place][::-1]] = place[::-1]
    return pd.DataFrame({"host": frame["host"].iloc[0], "window": pd.array([None, *key[first[ranks]].view(np.int64)], "Int64"),
                         "pages": np.concatenate([[kind.max() + 1], pages])})


def _bodies(html) -> pa.Array:
    return pa.array([_pack(blocks(h or "")) for h in html.to_pylist()], pa.string())


def _body_batches(batches):
    for batch in batches:
        at = batch.schema.get_field_index
        yield pa.RecordBatch.from_arrays([*(batch.column(at(c)) for c in ("page_id", "url", "host")), _bodies(batch.column(at("html")))],
                                         names=["page_id", "url", "host", "body"])


def _stream_batches(batches):
    """Pages to compare; of equal ones that a task meets among its last KEPT, only the first."""
    seen = {}
    for batch in batches:
        at = batch.schema.get_field_index
        rows = []
        for i, key in enumerate(zip(*(batch.column(at(c)).to_pylist() for c in ("host", "page")))):
            if key not in seen:
                rows.append(i)
                seen[key] = None
                if len(seen) > KEPT:
                    del seen[next(iter(seen))]
        part = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(part.column(at(c)) for c in ("host", "stream", "page")), _bodies(part.column(at("html")))],
                                         names=["host", "stream", "page", "body"])


def _unique_runs(found: list[tuple[int, str]], repeated) -> str:
    """Text of the article's and the undecided blocks without the tokens that a repeated window covers."""
    words = [t.split(" ") for _, t in found]
    hit = np.zeros(sum(map(len, words)) + RUN, bool)
    if repeated is not None and len(repeated):
        for i in np.flatnonzero(np.isin(bt.gram_hashes(_tokens(found), RUN).view(np.int64), repeated)):
            hit[i:i + RUN] = True
    out, at = [], 0
    for (where, text), w in zip(found, words):
        gone = hit[at:at + len(w)]
        at += len(w)
        if where != NEVER and not gone.all():
            out.append(text if not gone.any() else " ".join(x for x, g in zip(w, gone) if not g))
    return "\n".join(out)


def _text_batches(batches):
    for batch in batches:
        body, repeated = (batch.column(batch.schema.get_field_index(c)) for c in ("body", "repeated"))
        texts = [_unique_runs(_unpack(b), r.values.to_numpy() if r.is_valid else None) for b, r in zip(body.to_pylist(), repeated)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")] + [pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of pages."""
    rows = pages.select("page_id", "url", "html", F.nullif(host_of(F.col("url")), F.lit("")).alias("host"))
    asked = rows.where("host is not null and html <> ''").select("host", F.xxhash64("html").alias("page"), "html")
    hosts = asked.select("host", "page").distinct().groupBy("host").agg(F.ceil(F.count("*") / STREAM).alias("streams"))
    streams = asked.join(stage(hosts, "page-hosts"), "host").select("host", F.pmod(F.col("page"), F.col("streams")).alias("stream"), "page", "html")
    # one exchange serves both the copies left over from other tasks and the streams
    streams = streams.mapInArrow(_stream_batches, "host string, stream long, page long, body string").where("body <> ''")
    streams = streams.repartition("host", "stream").dropDuplicates(["host", "stream", "page"])
    windows = streams.groupBy("host", "stream").applyInPandas(_stream_windows, "host string, window long, pages long")
    counts = stage(windows.groupBy("host", "window").agg(F.sum("pages").alias("pages")), "host-windows")
    classes = counts.where("window is null").select("host", F.col("pages").alias("classes"))
    repeated = counts.where("window is not null").join(classes, "host").where(F.col("pages") >= SHARE * F.col("classes"))
    repeated = stage(repeated.groupBy("host").agg(F.sort_array(F.collect_list("window")).alias("repeated")), "repeated-windows")
    read = rows.mapInArrow(_body_batches, rows.select("page_id", "url", "host").schema.add("body", "string"))
    return read.join(repeated, "host", "left").select("page_id", "url", "body", "repeated").mapInArrow(
        _text_batches, read.select("page_id", "url").schema.add("text", "string"))
