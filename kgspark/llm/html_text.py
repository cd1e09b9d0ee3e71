"""Main text of web pages: structure first, then a suffix array per host for what structure leaves open.

A page is read leniently (unclosed tags, comments, raw text of scripts) into blocks of text, each with
its place:

* ``out``  -- markup that is never content: scripts, styles, head, menus, page headers and footers,
  sidebars, forms, notices, adverts and reader comments, by element or by class, id or role;
* ``main`` -- inside the page's article (``article``, ``main`` or their role);
* ``open`` -- neither: content of pages without an article, or templates without telling names.

A class or id counts by its whole name (``sidebar``, ``cookie-banner``, ``site-footer``, but not ``has-sidebar``
or ``related-work``). Such names and forms are weak evidence: an article inside a form is the
page's article; one inside a wrapper with such a class is, if the page has no other and it is longer than the
open text (else it is open); without any article, a form that holds most of the text is open, as are the
wrappers of a page that has no other text. Alerts and notices inside an article belong to it; a header does so
only inside an ``article`` element (its headline), not in the rest of the page's main part. What readers wrote is
out wherever a class or id has a part that says so (``user-comments``, ``commentlist``), an article element too.

A page with an article is its ``main`` blocks, a page without one its ``open`` blocks, both but for
boilerplate, which the host's suffix array finds:

1. Copies of a page on a host (equal articles, or equal open blocks) count as one page. The words of its
   ``open`` and ``out`` blocks, and of those ``main`` blocks that ``LEAST`` articles of the host have word for
   word, are concatenated, a separator of its own after each block. A hot host is dealt to shards by page,
   each of about ``SHARD`` words.
2. Prefix doubling sorts all suffixes of a shard by their first ``RUN`` words (a suffix array to that
   depth); neighbours of equal rank share a run, whose distinct pages are counted and summed over the
   host's shards by hash. Runs on one in ``SHARE`` of the host's distinct pages, and on ``LEAST`` of them, are repeated;
   occurrences in articles do not count.
3. An ``open`` block all of whose words are covered by repeated runs is boilerplate; a block shorter than ``RUN``
   words is one run, and boilerplate only if it is not between two blocks that stay.
4. A ``main`` block all of whose words are covered is boilerplate too: a notice in several articles, which other pages
   have outside theirs. The same article on several pages of a host is content on all of them, so repetition
   within articles alone removes nothing, nor does it where over half of an article's words are in such blocks (near
   copies); a teaser quoted elsewhere is in one article only. Blocks shorter than ``RUN`` words always stay.

A block's text has character references decoded and white space joined; blocks are joined by an empty line.

Defined cases: null or empty html gives an empty text; null urls share one host; repeated rows are
pages of their own only if their ids differ; texts of any length are read whole; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, slices, written

RUN = 8
SHARD = 500_000
#: Boilerplate lies on one in so many of a host's distinct pages, and on so many at least.
SHARE = 4
LEAST = 3
OPENING = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
NAME = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)?\s*")
UNQUOTED = re.compile(r"[^\s>]*")
#: Elements whose text is not parsed, that have no end, that break a block, that are
#: never content, and the words in class, id or role that say so.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search",
         "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
OUT = {"nav", "footer", "aside", "menu", "dialog", "button", "select", "input", "label", "search",
       "head", "object", "canvas", "audio", "video"}
FORMS = {"form", "fieldset"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog",
             "menu", "menubar", "toolbar"}
OUT_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
             "comment", "comments", "disqus", "cookie", "cookies", "consent", "dialog", "footer", "gdpr", "login",
             "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination",
             "popup", "promo", "promotion", "related", "recommended", "replies", "share", "sharing", "sidebar", "signup",
             "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "alert",
             "masthead", "topbar", "sitenav", "sidenav", "reply", "responses"}
#: Words that may stand beside those in a whole name, and those that are content inside an article.
PARTS = {"area", "bar", "block", "bottom", "box", "container", "content", "global", "inner", "item", "items", "left", "links", "list",
         "page", "panel", "placeholder", "primary", "right", "secondary", "section", "site", "slot", "space", "top", "unit", "wrap",
         "wrapper", "zone"}
CALLOUTS = {"alert", "notice", "notices", "notification"}
#: Elements that an element of the same set closes when it opens, up to the next container.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = {"ul", "ol", "dl", "table", "select", "article", "div", "section"}
#: Parts of names of what readers wrote, and parts that deny it (fixed values).
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus"}
DENIALS = {"no", "not", "without", "has", "with", "open", "closed", "count", "link"}
NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Scanner:
    """Marks of a page in order, in time linear in its length: a character is passed once by each of the scans for
    ``<``, for the end of a tag or comment, and for a quote; a search that finds nothing is not begun again."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def find_close(self, name: str, at: int) -> int:
        """Where the name of the next end tag of an element ends that holds raw text, or -1."""
        close = f"</{name}"
        if close not in self.missing:
            m = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(self.page, at)
            if m:
                return m.end()
            self.missing.add(close)
        return -1

    def tag(self, at: int) -> tuple[int, dict[str, str]]:
        """Where a tag ends whose name ends at ``at``, and its attributes. A quote opens a value only after ``=``; one
        that is never closed is part of an unquoted value. A tag that never ends takes the rest of the page."""
        page, found = self.page, {}
        if page.startswith(">", at):
            return at + 1, found
        while at < len(page):
            m = NAME.match(page, at)
            at = m.end()
            if at >= len(page):
                break
            if page[at] == ">":
                if m[1]:
                    found.setdefault(m[1].lower(), "")
                return at + 1, found
            if page[at] != "=":
                if m[1]:
                    found.setdefault(m[1].lower(), "")
                elif m.end() == m.start():
                    at += 1
                continue
            at += 1
            while at < len(page) and page[at].isspace():
                at += 1
            close = self.find(page[at], at + 1) if page[at:at + 1] in ("'", '"') else -1
            if close >= 0:
                value, at = page[at + 1:close], close + 1
            else:
                u = UNQUOTED.match(page, at)
                value, at = u[0], u.end()
            if m[1]:
                found.setdefault(m[1].lower(), value)
        return len(page), found


def _reader_comment(said: list[str]) -> bool:
    """Whether a class or id is about what readers wrote: a part that says so, and none that denies it."""
    return any((w := {p.lower() for p in NAMES.findall(name)}) & COMMENT_WORDS and not w & DENIALS for name in said)


def _excluded(name: str, found: dict[str, str], article: bool, inside_main: bool) -> str:
    """``out`` (no article inside counts), ``form`` or ``named`` (weak evidence), or nothing; ``article``: within an
    article, ``inside_main``: within an article or the page's main part."""
    if name in OUT or name == "header" and not article:
        return "out"
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return "out"
    allowed = CALLOUTS if inside_main else set()
    if set(found.get("role", "").lower().split()) & (OUT_ROLES - allowed):
        return "out"
    said = f"{found.get('class', '')} {found.get('id', '')}".split()
    if inside_main and name not in ("html", "body", "main") and _reader_comment(said):
        return "out"
    if name in ("html", "body", "article", "main"):
        return ""
    for one in said:
        parts = {w.lower() for w in NAMES.findall(one)}
        if parts & (OUT_NAMES - allowed) and parts <= OUT_NAMES | PARTS or _reader_comment([one]):
            return "named"
    return "form" if name in FORMS else ""


def _settled(blocks: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Blocks with only ``main``, ``open`` and ``out`` as places."""
    size = dict.fromkeys(("main", "again", "open", "form", "named", "out"), 0)
    for place, text in blocks:
        size[place] += len(text)
    means = {"again": "out", "form": "out", "named": "out"}
    if not size["main"]:
        if size["again"] > size["open"]:
            means["again"] = "main"
        else:
            means["again"] = "open"
            if size["form"] > size["open"]:
                means["form"] = "open"
            elif not size["open"]:
                means["named"] = "open"
    return [(means.get(place, place), text) for place, text in blocks]


def read_blocks(page: str) -> list[tuple[str, str]]:
    """(place, text) of a page's blocks in order; empty blocks are left out."""
    blocks: list[tuple[str, str]] = []
    stack: list[tuple[str, str, bool]] = []  # element, place of its text, within an article
    count: Counter[str] = Counter()  # open elements by name, so that no search runs for one that is not open
    pieces: list[str] = []
    scanner = Scanner(page)
    place, article, at = "open", False, 0

    def end_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append((place, text))
            pieces.clear()

    def close(first: int) -> None:
        nonlocal place, article
        for name, _, _ in stack[first:]:
            count[name] -= 1
        del stack[first:]
        place, article = (stack[-1][1], stack[-1][2]) if stack else ("open", False)

    def innermost(names: set[str], walls: set[str]) -> int:
        """The last open element of ``names`` above the last of ``walls``, or -1."""
        if any(count[n] for n in names):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    return i
                if stack[i][0] in walls:
                    break
        return -1

    while at < len(page):
        start = scanner.find("<", at)
        if start < 0:
            pieces.append(page[at:])
            break
        if start > at:
            pieces.append(page[at:start])
        if page.startswith("<!--", start):
            end = scanner.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        m = OPENING.match(page, start + 1)
        if m is None:
            end = scanner.find(">", start) if page[start + 1:start + 2] in ("!", "?") else -1
            if end < 0:
                pieces.append("<")
                end = start
            at = end + 1
            continue
        name = m[2].lower()
        at, found = scanner.tag(m.end())
        if m[1]:
            k = innermost({name}, set())
            if k < 0 and name in BLOCK or any(n in BLOCK for n, _, _ in stack[k:] if k >= 0):
                end_block()
            if k >= 0:
                close(k)
            continue
        if name in RAW:
            if name in BLOCK:
                end_block()
            end = scanner.find_close(name, at)
            at = scanner.tag(end)[0] if end >= 0 else len(page)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK:
            end_block()
            k = innermost({"p"}, BLOCK - {"p"})  # a block closes an open paragraph in the same container
            if k >= 0:
                close(k)
            if name in SIBLINGS and (k := innermost(SIBLINGS[name], CONTAINERS)) >= 0:
                close(k)
        if name in VOID or page[at - 2:at] == "/>" and name not in BLOCK:
            continue
        inside, within = place, article or name == "article"
        if place != "out":
            kind = _excluded(name, found, article, place in ("main", "again"))
            if kind == "out":
                inside = "out"
            elif name in ("article", "main") or "main" in found.get("role", "").lower().split():
                inside = "again" if place in ("named", "again") else "main"
            elif kind:
                inside = "named" if place in ("named", "again") else kind
        if inside != place and name not in BLOCK:
            end_block()
        stack.append((name, inside, within))
        count[name] += 1
        place, article = inside, within
    end_block()
    return _settled(blocks)


def run_ranks(tokens: np.ndarray, depth: int = RUN) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` tokens, by prefix doubling (a suffix array to
    that depth); equal rank means an equal run. Past the end counts as smallest."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    n = 1
    while n < depth:
        step = min(n, depth - n)
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:] if step < len(rank) else 0
        key = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
        n += step
    return rank


def occurrences(blocks: list[np.ndarray], pages: np.ndarray, inside: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of a shard, from its suffix array: for each occurrence its block, first word and words,
    the run's hash, the distinct pages of the shard that hold it outside an article (``inside``: blocks of
    articles), and whether it is the first."""
    sizes = np.array([len(b) for b in blocks])
    pad = np.zeros(RUN, np.uint64)  # a run that begins a short block ends in padding
    flat = np.concatenate([x for b in blocks for x in (b, pad)])
    block = np.repeat(np.arange(len(blocks)), sizes + RUN)
    offset = np.arange(len(flat)) - (np.cumsum(sizes + RUN) - sizes - RUN)[block]
    at = np.flatnonzero((offset + RUN <= sizes[block]) | (offset == 0))
    rank = run_ranks(flat)[at]
    order = np.lexsort((at, inside[block[at]], pages[block[at]], rank))
    at, rank = at[order], rank[order]
    page = pages[block[at]]
    new_rank = np.r_[True, rank[1:] != rank[:-1]]
    new_page = new_rank | np.r_[True, page[1:] != page[:-1]]
    run = np.cumsum(new_rank) - 1
    n_pages = np.bincount(run, new_page & ~inside[block[at]]).astype(np.int64)[run]
    hashes = np.zeros(len(at), np.uint64)
    for j in range(RUN):
        hashes = (hashes ^ flat[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    return {"block": block[at], "at": offset[at], "words": np.minimum(RUN, sizes[block[at]] - offset[at]),
            "run": hashes.view(np.int64), "pages": n_pages, "first": new_rank}


def staying(marks: list[np.ndarray]) -> list[bool]:
    """Which of a page's candidate blocks stay, by their words that repeated runs cover: those with
    uncovered words, and covered short ones whose next other blocks on both sides stay."""
    keep = [not m.all() for m in marks]
    firm = [k or len(m) >= RUN for k, m in zip(keep, marks)]
    out, before = [], False
    after = [False] * len(keep)
    for i in range(len(keep) - 2, -1, -1):
        after[i] = keep[i + 1] if firm[i + 1] else after[i + 1]
    for k, f, a in zip(keep, firm, after):
        out.append(k if f else before and a)
        if f:
            before = k
    return out


def extract(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(id_col).alias("page_id"), "url", F.col("html").cast("string").alias("html"),
                        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)).alias("host"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            main, rest, flags, same = [], [], [], []
            for page in batch.column("html").to_pylist():
                blocks = read_blocks(page or "")
                has_main = any(p == "main" for p, _ in blocks)
                main.append([t for p, t in blocks if p == "main"] if has_main else None)
                rest.append([t for p, t in blocks if p != "main"])
                flags.append([p == "open" and not has_main for p, _ in blocks if p != "main"])
                same.append(xxhash.xxh3_128_hexdigest("\n\n".join(t for p, t in blocks if p == ("main" if has_main else "open"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(main, pa.list_(pa.string())),
                 pa.array(rest, pa.list_(pa.string())), pa.array(flags, pa.list_(pa.bool_())),
                 pa.array(same, pa.string())],
                ["page_id", "url", "host", "main", "rest", "candidate", "same"])

    parsed = written(rows.mapInArrow(parse, f"page_id {kind}, url string, host string, main array<string>, rest array<string>, "
                                            "candidate array<boolean>, same string")
                     .withColumn("row", F.monotonically_increasing_id()), "html-blocks")
    words = lambda texts: F.aggregate(texts, F.lit(0).cast("bigint"), lambda n, t: n + F.size(F.split(t, " ")))
    # blocks that several articles of a host have word for word; small tables, so that articles cross no shuffle
    own = (parsed.select("host", "same", "row", F.posexplode("main").alias("at", "t")).where(F.size(F.split("t", " ")) >= RUN)
           .select("host", "same", "row", "at", F.xxhash64("t").alias("text")))
    shared = written(own.select("host", "text", "same").distinct().groupBy("host", "text").count().where(F.col("count") >= LEAST)
                     .drop("count"), "html-shared")
    asked = written(own.join(shared, ["host", "text"]).groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("asked")),
                    "html-asked")  # of one page
    inside = F.transform("asked", lambda i: F.get("main", i))
    picked = written(parsed.select("host", "same", "row", "main", F.size("rest").alias("before")).join(asked, "row")
                     .where(2 * words(inside) <= words(F.col("main"))).select("host", "same", "row", "before", "asked", inside.alias("inside")),
                     "html-picked")
    none = F.array().cast("array<string>")
    # of copies on a host one page takes part: pages with and without an article are never copies
    parts = (parsed.select("host", "same", F.col("main").isNull().alias("bare"), "row", "rest", "candidate")
             .join(picked.select("row", "inside"), "row", "left").withColumn("inside", F.coalesce("inside", none)))
    once = written(parts.where(F.size("rest") + F.size("inside") > 0)
                   .select("host", "same", "bare", "row", (words(F.col("rest")) + words(F.col("inside"))).alias("n"))
                   .groupBy("host", "same", "bare").agg(F.min("row").alias("row"), F.min_by("n", "row").alias("n")), "html-once")
    sizes = once.groupBy("host").agg(  # one row per host
        F.ceil(F.sum("n") / SHARD).cast("int").alias("shards"),
        F.greatest(F.lit(LEAST), F.ceil(F.count("*") / SHARE)).cast("bigint").alias("need"))
    page = F.xxhash64("same", "row")
    places = once.join(sizes, "host").select(
        "host", F.pmod(page, F.col("shards")).cast("int").alias("shard"), "row", page.alias("page"), "shards", "need")
    sharded = parts.select("row", "rest", "candidate", "inside").join(places, "row")
    dealt = sharded.repartition("host", "shard").sortWithinPartitions("host", "shard", "page", "row")

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        place = None

        def done() -> pa.RecordBatch:
            blocks = [np.array([xxhash.xxh3_64_intdigest(w) | 1 for w in t.split()], np.uint64)
                      for r in held for t in r["rest"] + r["inside"]]
            per = [len(r["rest"]) + len(r["inside"]) for r in held]
            inside = np.array([i for r in held for i in [False] * len(r["rest"]) + [True] * len(r["inside"])], bool)
            found = occurrences(blocks, np.repeat([r["page"] for r in held], per), inside)
            row = np.repeat([r["row"] for r in held], per)
            own = np.concatenate([np.arange(n) for n in per])
            asks = np.array([c for r in held for c in r["candidate"] + [True] * len(r["inside"])], bool)
            # a host of one shard is decided here; of others, counts and the blocks that may go leave
            often = found["pages"] >= held[0]["need"]
            keep = asks[found["block"]] & often if held[0]["shards"] == 1 else asks[found["block"]] | found["first"]
            found = {k: v[keep] for k, v in found.items()}
            often = often[keep]
            return pa.RecordBatch.from_pydict({
                "host": pa.array([held[0]["host"]] * len(found["run"]), pa.string()),
                "shard": pa.array(np.full(len(often), held[0]["shard"]), pa.int32()),
                "asks": pa.array(asks[found["block"]]), "often": pa.array(often),
                "row": pa.array(row[found["block"]], pa.int64()), "block": pa.array(own[found["block"]], pa.int32()),
                "at": pa.array(found["at"], pa.int32()), "words": pa.array(found["words"], pa.int32()),
                "run": pa.array(found["run"]), "pages": pa.array(found["pages"]), "first": pa.array(found["first"])})

        for batch in batches:
            for r in batch.to_pylist():
                if (r["host"], r["shard"]) != place:
                    if held:
                        yield done()
                    held, place = [], (r["host"], r["shard"])
                held.append(r)
        if held:
            yield done()

    found = written(dealt.mapInArrow(
        runs, "host string, shard int, asks boolean, often boolean, row bigint, block int, at int, words int, run bigint, pages bigint, first boolean"), "html-runs")
    # a run that is rare in its shard may be on enough pages of the host; it returns by shard, so
    # that no key has more rows than a shard
    first = found.where("first").join(sizes.where("shards > 1").select("host", "need"), "host")
    total = (first.groupBy("host", "run", "need").agg(F.sum("pages").alias("all_pages")).where("all_pages >= need")
             .select("host", "run"))
    back = first.join(total, ["host", "run"]).select("host", "shard", "run")
    span = ["row", F.struct("block", "at", "words").alias("s")]
    covered = found.where("asks and often").select(*span).unionByName(
        found.where("asks and not often").join(back, ["host", "shard", "run"]).select(*span))
    spans = covered.groupBy("row").agg(F.collect_list("s").alias("spans"))  # of one page

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for r in batch.select(["rest", "candidate", "spans"]).to_pylist():
                marks = [np.zeros(len(t.split()), bool) for t in r["rest"]]
                for s in r["spans"] or []:
                    marks[s["block"]][s["at"]:s["at"] + s["words"]] = True
                own = [(t, m) for t, c, m in zip(r["rest"], r["candidate"], marks) if c]
                texts.append("\n\n".join(t for (t, _), stays in zip(own, staying([m for _, m in own])) if stays))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("same"), pa.array(texts, pa.string())], ["host", "same", "text"])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for r in batch.select(["before", "asked", "inside", "spans"]).to_pylist():
                marks = [np.zeros(len(t.split()), bool) for t in r["inside"]]
                for s in r["spans"]:
                    marks[s["block"] - r["before"]][s["at"]:s["at"] + s["words"]] = True
                gone.append([at for at, m in zip(r["asked"], marks) if m.all()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("same"), pa.array(gone, pa.list_(pa.int32()))], ["host", "same", "gone"])

    decided = (parsed.where("main is null").join(once.where("bare").select("row"), "row").join(spans, "row", "left")
               .select("host", "same", "rest", "candidate", "spans")
               .mapInArrow(decide, "host string, same string, text string"))
    opened = (parsed.where("main is null").select("page_id", "url", "host", "same").join(decided, ["host", "same"], "left")
              .select("page_id", "url", F.coalesce("text", F.lit("")).alias("text")))
    judged = written(picked.join(spans, "row").select("host", "same", "before", "asked", "inside", "spans")
                     .mapInArrow(judge, "host string, same string, gone array<int>").where(F.size("gone") > 0), "html-gone")
    stays = F.filter("main", lambda t, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    out = (parsed.where("main is not null").select("page_id", "url", "host", "same", "main").join(judged, ["host", "same"], "left")
           .select("page_id", "url", F.array_join(stays, "\n\n").alias("text")).unionByName(opened))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
