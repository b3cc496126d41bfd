"""Main text of HTML pages by the maximum-scoring subsequence.

A page is read once into a sequence of words and tags. A word scores the share of such words (same
markup around them) that were content on labelled pages, a tag minus the share of such tags outside of
content, times a cost. The best contiguous region is the run of the sequence with the largest sum, found
by one linear scan. Its text comes out, less what stands in menus, headers, footers, sidebars, notices,
adverts, forms and comments inside the region.

Labelled pages are those that name their article in their markup (``article``, ``main``, ``itemprop=articleBody``): words
in it are content, all others are not. Shares are learned on about ``SAMPLE_PAGES`` pages drawn by a hash of
their ids, once with the mark visible and once with it hidden, which serves pages without marks. The cost of
tags is the one of ``COSTS`` with the best F1 over the words of these pages, marks hidden. Markup that the sample
does not hold keeps the shares of ``_prior``.

Character references are decoded, white space inside a block becomes one space, and blocks are joined by a
line feed. A line break element is white space. Null and empty pages, and pages without words, give an empty text.
Broken markup is read as browsers do: raw elements and comments that are not closed reach to the end of the page, end tags
without a start are ignored, and an end tag closes what is still open inside. A container of a boilerplate kind that
holds the article or main heading and over half of the page's words is not boilerplate (a form around the whole page,
a menu that was never closed). Repeated rows are extracted each. An empty table gives no rows.
"""

import html as entities
import re

import pyarrow as pa
from pyspark.sql import functions as F

#: About so many pages are drawn to learn from (a documented bound), and words and tags that a prior share counts for.
SAMPLE_PAGES, STRENGTH = 2_000, 50
#: What a tag outside of content costs, in words.
COSTS, USUAL_COST = (1.0, 2.0, 4.0, 8.0, 16.0), 4.0

# Element names of HTML, and class names that pages use for parts other than the article.
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "title", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "math", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
UNSEEN = {"head", "noscript", "template", "svg", "object", "canvas", "audio", "video", "select", "datalist", "button"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
BLOCKS = {
    "p": "p", "blockquote": "p", "pre": "p", "dd": "p", "figcaption": "p", "h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h",
    "h6": "h", "li": "li", "dt": "li", "td": "td", "th": "td", "caption": "td",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
PARTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead",
    "topbar", "toolbar", "footer", "sidebar", "aside", "related", "recommended", "recommendations", "share", "sharing",
    "social", "comment", "comments", "commentlist", "respond", "disqus", "reply", "replies", "cookie", "cookies", "consent",
    "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "search", "copyright", "disclaimer", "skip",
}
OF_ARTICLE = {"article", "entry", "post", "story", "content"}
#: Elements that end where another of their kind starts.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
}

_MARKUP = re.compile(
    r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)>?|[!?/][^>]*+>?)"""
)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|style)(?![^\s=/])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)


def _kind_of(name, attributes):
    """(part of the page to leave out, hidden, names the article) as an element's markup tells."""
    found = {}
    if attributes.strip():
        for key, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(key.lower(), value.strip("\"'"))
    hidden = name in UNSEEN or "hidden" in found or bool(_NO_DISPLAY.search(found.get("style", "")))
    marks = name == "article" or "articlebody" in found.get("itemprop", "").lower().split()
    if name in ("html", "body", "main"):
        return False, hidden, marks
    names = {w.lower() for w in _NAME_PART.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    parts = names & PARTS
    if names & OF_ARTICLE:
        parts -= {"header"}
    return bool(name in ASIDE or parts or found.get("role", "").lower() in ROLES), hidden, marks


class Page:
    """Words and tags of one page in order.

    ``runs`` holds (first event, words, inside article, inside main, zone, block, in link, block number, raw text) for every
    run of text, ``tags`` (event, name, inside article, inside main, zone).
    """

    def __init__(self, html):
        self.runs, self.tags, self.zones = [], [], []
        self.length = 0
        self._read(html)
        self._settle()

    def _read(self, html):
        size, position, known, unclosed = len(html), 0, {}, set()
        open_, counts = [], {}
        zone, article, main, link, block = -1, 0, 0, 0, 0
        while position < size:
            match = _MARKUP.search(html, position)
            start = match.start() if match else size
            if start > position:
                self._text(html[position:start], article, main, zone, open_, link, block)
            if not match:
                break
            position = match.end()
            if match[1]:
                end = html.find("-->", start + 2)
                position = size if end < 0 else end + 3
                continue
            if not match[3]:
                continue
            name, closing = match[3].lower(), match[2] == "/"
            if name == "br":
                self.runs.append((self.length, 0, article, main, zone, "", link, block, " "))
                continue
            if name not in INLINE:
                block += 1
            if closing:
                self.tags.append((self.length, name, article, main, zone))
                self.length += 1
                if name == "a":
                    link = 0
                if counts.get(name):
                    while True:
                        other, (zone, article, main) = open_.pop()
                        counts[other] -= 1
                        if other == name:
                            break
                continue
            if name in RAW:
                self.tags.append((self.length, name, article, main, zone))
                self.length += 1
                if name not in unclosed:
                    end = re.compile(f"</{name}(?![a-z0-9])[^>]*>?", re.I).search(html, position)
                    if end:
                        position = end.end()
                    elif name in ("title", "textarea"):
                        unclosed.add(name)
                    else:
                        position = size
                continue
            if name == "a":
                link = 1
            # A paragraph ends where any other block starts.
            while open_ and name not in INLINE and (open_[-1][0] == "p" or open_[-1][0] in ENDED_BY.get(name, ())):
                other, (zone, article, main) = open_.pop()
                counts[other] -= 1
            if name not in VOID and name not in INLINE or name == "span" and match[4]:
                key = name, match[4]
                if key not in known:
                    known[key] = _kind_of(name, match[4])
                aside, hidden, marks = known[key]
                if name == "header":
                    aside = aside or not (article or main)
                open_.append((name, (zone, article, main)))
                counts[name] = counts.get(name, 0) + 1
                if marks or name in ("main", "h1"):
                    self._holds_article(zone)
                if aside or hidden:
                    self.zones.append([zone, 0, False, hidden])
                    zone = len(self.zones) - 1
                    if marks:
                        self.zones[zone][2] = True
                article += marks
                main += name == "main"
            self.tags.append((self.length, name, article, main, zone))
            self.length += 1

    def _holds_article(self, zone):
        while zone >= 0 and not self.zones[zone][2]:
            self.zones[zone][2] = True
            zone = self.zones[zone][0]

    def _text(self, text, article, main, zone, open_, link, block):
        n = len(text.split())
        around = next((BLOCKS[name] for name, _ in reversed(open_[-8:]) if name in BLOCKS), "") if n else ""
        if zone >= 0:
            self.zones[zone][1] += n
        self.runs.append((self.length, n, article, main, zone, around, link, block, text))
        self.length += n

    def _settle(self):
        """Which zones are left out, and which mark names the article."""
        for parent, words, _, _ in reversed(self.zones):
            if parent >= 0:
                self.zones[parent][1] += words
        total, self.out = sum(r[1] for r in self.runs), []
        for parent, words, holds, hidden in self.zones:
            own = hidden or not (holds and 2 * words > total)
            self.out.append(own or parent >= 0 and self.out[parent])
        seen = [r for r in self.runs if r[1] and not self.left_out(r[4])]
        self.mark = "article" if any(r[2] for r in seen) else "main" if any(r[3] for r in seen) else None

    def left_out(self, zone):
        return zone >= 0 and self.out[zone]

    def inside(self, entry):
        """Whether a run or tag (its article and main counts at 2 and 3) stands in the marked article."""
        return entry[2] > 0 if self.mark == "article" else entry[3] > 0 if self.mark == "main" else False

    def _where(self, entry, zone, visible):
        mark = ("in" if self.inside(entry) else "out") if visible and self.mark else "none"
        return f"{mark} {'part' if self.left_out(zone) else 'page'}"

    def run_kind(self, run, visible):
        return f"word {self._where(run, run[4], visible)} {run[5] or '-'} {'link' if run[6] else 'plain'}"

    def tag_kind(self, tag, visible):
        name = tag[1] if tag[1] in _TAG_NAMES else "other"
        return f"tag {self._where(tag, tag[4], visible)} {name}"

    def content(self, entry, zone):
        """The label of a run or tag on a page that marks its article."""
        return self.inside(entry) and not self.left_out(zone)

    def region(self, shares, cost, visible=True):
        """(first, last) event of the best contiguous region, last excluded; ties go to the earliest."""
        best, where, total, begin = 0.0, (0, 0), 0.0, 0
        runs, tags = iter(self.runs), iter(self.tags)
        run, tag = next(runs, None), next(tags, None)
        while run or tag:
            if run and (not tag or run[0] <= tag[0]):
                at, end = run[0], run[0] + run[1]
                score = run[1] * _share(shares, self.run_kind(run, visible)) if run[1] else 0.0
                run = next(runs, None)
            else:
                at, end = tag[0], tag[0] + 1
                score = -cost * _share(shares, self.tag_kind(tag, visible))
                tag = next(tags, None)
            if total <= 0.0:
                total, begin = 0.0, at
            total += score
            if total > best:
                best, where = total, (begin, end)
        return where

    def chosen(self, shares, cost, visible=True):
        """The runs of text that come out."""
        first, last = self.region(shares, cost, visible)
        outside = visible and self.mark
        return [
            r for r in self.runs
            if first <= r[0] and r[0] + r[1] <= last and not self.left_out(r[4]) and not (outside and not self.inside(r))
        ]

    def text(self, shares, cost):
        blocks, number = [], None
        for run in self.chosen(shares, cost):
            if run[7] != number:
                blocks.append([])
                number = run[7]
            blocks[-1].append(run[8])
        lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
        return "\n".join(line for line in lines if line)


_TAG_NAMES = INLINE | RAW | VOID | UNSEEN | ASIDE | set(BLOCKS) | {
    "html", "body", "div", "section", "article", "main", "header", "ul", "ol", "dl", "table", "tr", "tbody", "thead", "figure", "center",
}


def _prior(kind):
    """Share of content among words, of other things among tags, for markup that no labelled page has."""
    what, mark, zone, name, *link = kind.split(" ")
    if what == "word":
        if zone == "part" or mark == "out":
            return 0.02
        if mark == "in":
            return 0.95
        if link == ["link"]:
            return 0.7 if name in ("p", "h") else 0.2
        return {"p": 0.95, "h": 0.95, "li": 0.7, "td": 0.7}.get(name, 0.5)
    if zone == "part" or mark == "out":
        return 1.0
    if mark == "in":
        return 0.05
    return 0.1 if name in INLINE or BLOCKS.get(name) in ("p", "h") else 0.3 if name in ("li", "ul", "ol", "td", "tr", "table") else 0.5


def _share(shares, kind):
    share = shares.get(kind)
    if share is None:
        share = shares[kind] = _prior(kind)
    return share


# -- learning


def count_kinds(page, into):
    """Add the words and tags of a marked page to ``into``: kind -> [content, other]."""
    for run in page.runs:
        if run[1]:
            for visible in (True, False):
                into.setdefault(page.run_kind(run, visible), [0, 0])[not page.content(run, run[4])] += run[1]
    for tag in page.tags:
        for visible in (True, False):
            into.setdefault(page.tag_kind(tag, visible), [0, 0])[not page.content(tag, tag[4])] += 1


def shares_of(counts):
    """Share of content (words) or of the rest (tags) of every kind in ``counts``, smoothed by the prior."""
    out = {}
    for kind, (content, other) in counts.items():
        named = content if kind.startswith("word") else other
        out[kind] = (named + STRENGTH * _prior(kind)) / (content + other + STRENGTH)
    return out


def _count_batches(batches):
    counts = {}
    for batch in batches:
        for html in batch.column(0):
            page = Page(html.as_py() or "")
            if page.mark:
                count_kinds(page, counts)
    rows = [(kind, *n) for kind, n in counts.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
        names=["kind", "content", "other"],
    )


def _judge_costs(shares):
    def of_batches(batches):
        hits = {cost: [0, 0, 0] for cost in COSTS}
        for batch in batches:
            for html in batch.column(0):
                page = Page(html.as_py() or "")
                if not page.mark:
                    continue
                wanted = sum(r[1] for r in page.runs if page.content(r, r[4]))
                for cost in COSTS:
                    got = page.chosen(shares, cost, visible=False)
                    right = sum(r[1] for r in got if page.content(r, r[4]))
                    hits[cost][0] += right
                    hits[cost][1] += sum(r[1] for r in got) - right
                    hits[cost][2] += wanted - right
        columns = [pa.array(list(hits))] + [pa.array([h[i] for h in hits.values()], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["cost", "right", "wrong", "missed"])

    return of_batches


def learn(pages, id_col="page_id", html_col="html", sample_pages=SAMPLE_PAGES):
    """(shares, cost) learned on a bounded sample of the pages that mark their article."""
    rate = min(1.0, sample_pages / max(1, pages.count()))
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 40)) < int(rate * (1 << 40))
    sample = pages.filter(drawn).select(html_col)
    rows = sample.mapInArrow(_count_batches, "kind string, content bigint, other bigint")
    rows = rows.groupBy("kind").agg(F.sum("content").alias("content"), F.sum("other").alias("other")).collect()
    shares = shares_of({r.kind: (r.content, r.other) for r in rows})  # a few hundred kinds of markup
    judged = sample.mapInArrow(_judge_costs(shares), "cost double, right bigint, wrong bigint, missed bigint")
    judged = judged.groupBy("cost").agg(*[F.sum(c).alias(c) for c in ("right", "wrong", "missed")]).collect()

    def merit(r):
        f1 = 2 * r.right / max(1, 2 * r.right + r.wrong + r.missed)
        return round(f1, 4), -abs(r.cost - USUAL_COST)

    return shares, max(judged, key=merit).cost if judged else USUAL_COST


def main_text(pages, id_col="page_id", url_col="url", html_col="html", weights=None):
    """(page_id, url, text, n_chars) of every page; ``weights`` are those of ``learn``, learned here by default."""
    shares, cost = weights or learn(pages, id_col, html_col)
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def of_batches(batches):
        known = dict(shares)
        for batch in batches:
            texts = [Page(html.as_py() or "").text(known, cost) for html in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )

    kinds = dict(chosen.dtypes)
    return chosen.mapInArrow(of_batches, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
