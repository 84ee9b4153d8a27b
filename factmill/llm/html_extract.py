"""HTML extraction by nearest-URL page differencing.

Pages of a host are put in the order of their URL paths, and each page is paired with the one
before it (the first with the one after it). The text lines of the two that stand outside articles,
in furniture or not, are aligned by longest common subsequence, and the lines that they share are
the site's template and go. Differencing by itself can't tell a template from an article that two
neighbours share, nor drop furniture that is different on every page, so markup is a safeguard on
both sides: what stands in an article element is safe from differencing, and what is left in menus,
asides, forms and the like goes too.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, bound_batches, broadcast_if_small, cut, in_order, row_key, slices, tidy

#: Pages of one host that are differenced by one task at a time.
RUN_PAGES = 256

#: Elements whose content is characters up to their own end tag, and those whose content is no text of the page.
CHARACTERS = frozenset("script style textarea title iframe xmp noembed noframes".split())
DROPPED = frozenset("noscript template svg math object canvas audio video".split())
#: Furniture elements, and elements that bound a block.
FURNITURE = frozenset("nav footer aside form button select dialog menu head fieldset".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words that make a class or an id furniture when they stand alone, at its head or at its end.
ALONE = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus foot footer header "
    "login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promos promotion recommended related replies respond search "
    "share sharing sidebar signup social sponsor sponsored sponsors subscribe toolbar topbar widget widgets".split()
)
HEAD = frozenset("ad ads advert advertisement breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer menu nav navbar navigation newsletter pagination popup promo related reply share sidebar skip social sponsor sponsored subscribe widget".split())
END = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comments consent cookie cookies disclaimer footer masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo related replies share sharing sidebar signup social sponsor toolbar topbar widget".split())
#: Heads of names that speak of a state, and furniture that an article inside of it doesn't lift.
STATES = frozenset("has no with without is not hide show".split())
FIRM = frozenset("ad ads advert adverts advertisement advertising comment comments disqus promo promos promotion recommended related replies reply respond sponsor sponsored sponsors".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[-_]+")
_LETTER = re.compile(r"[a-zA-Z]")
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_ENDING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in CHARACTERS}

#: How an element stands to the page's text: its own, furniture by a name that an article lifts, and furniture for good.
OWN, NAMED, JUNK = 0, 1, 2


def _named(value: str, in_article: bool) -> int:
    """What the names in a class or an id make of an element; each name is taken whole, by its first and last word."""
    worst = OWN
    for name in value.lower().split():
        words = [w for w in _PARTS.split(name) if w] or [""]
        first, last = words[0], words[-1]
        if len(words) == 1:
            word = first if first in ALONE else ""
        elif first in STATES or (first, last) == ("content", "sidebar"):
            word = ""
        else:
            word = first if first in HEAD else last if last in END or (last == "header" and first in ("site", "page", "main")) else ""
        if word and not (in_article and word == "header"):
            worst = max(worst, JUNK if word in FIRM else NAMED)
    return worst


def _standing(name: str, attributes: dict[str, str], in_article: bool) -> int:
    if name in FURNITURE or name in DROPPED or (name == "header" and not in_article):
        return JUNK
    if not attributes:
        return OWN
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return JUNK
    if name in ("html", "body", "main"):
        return OWN
    if attributes.get("role", "").lower() in _ROLES:
        return JUNK
    return max(_named(attributes.get("class", ""), in_article), _named(attributes.get("id", ""), in_article))


class _Scanner:
    """Cuts a page into characters and tags in one pass; a quote or comment that never ends is looked for once."""

    def __init__(self, source: str):
        self.s, self.missing = source, set()

    def find(self, what: str, at: int) -> int:
        """Where what begins from at on, -1 if nowhere; once it is nowhere, later searches are spared."""
        if what in self.missing:
            return -1
        found = self.s.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def attributes(self, at: int) -> tuple[dict[str, str] | None, bool, int]:
        """(attributes, whether the tag closes itself, the place after the tag); None where the tag never ends."""
        s, out = self.s, {}
        while True:
            m = _ATTRIBUTE.match(s, at)
            if m is None:
                end = self.find(">", at)
                return (None, False, len(s)) if end < 0 else (out, s[at:end].rstrip().endswith("/"), end + 1)
            at, value = m.end(), ""
            if m[2]:
                quote = s[at : at + 1]
                end = self.find(quote, at + 1) if quote in ('"', "'") else -1
                if end >= 0:
                    value, at = s[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(s, at)
                    value, at = bare[0], bare.end()
            out.setdefault(m[1].lower(), value)

    def __iter__(self):
        """("text", characters), ("open", name, attributes, closes itself) and ("close", name)."""
        s, at, n = self.s, 0, len(self.s)
        while at < n:
            tag = s.find("<", at)
            if tag != at:
                yield "text", s[at : tag if tag >= 0 else n], None, False
                if tag < 0:
                    return
            at, after = tag + 1, s[tag + 1 : tag + 2]
            if _LETTER.match(s, at):
                name = _NAME.match(s, at)[0]
                attributes, closed, at = self.attributes(at + len(name))
                if attributes is None:
                    return
                name = name.lower()
                yield "open", name, attributes, closed
                if name in CHARACTERS:
                    end = _ENDING[name].search(s, at)
                    at = end.start() if end else n
            elif after == "/" and _LETTER.match(s, tag + 2):
                name = _NAME.match(s, tag + 2)[0]
                attributes, _, at = self.attributes(tag + 2 + len(name))
                if attributes is None:
                    return
                yield "close", name.lower(), None, False
            elif after in ("!", "?", "/") and after:
                opening, ending = ("!--", "-->") if s.startswith("!--", at) else ("![CDATA[", "]]>") if s.startswith("![CDATA[", at) else ("", ">")
                if opening == "!--" and (s.startswith(">", at + 3) or s.startswith("->", at + 3)):
                    ending = ">"
                end = self.find(ending, at + len(opening))
                at = n if end < 0 else end + len(ending)
            else:
                yield "text", "<", None, False


def text_lines(source: str) -> list[tuple[str, bool, bool]]:
    """The page's blocks of text in order: (line, stands in an article, stands in furniture).

    Character references are decoded, white space becomes single spaces, empty blocks are left out.
    Elements that aren't closed end with the element around them; a tag that never ends takes the
    rest of the page with it, as in browsers. Furniture goes by element, role and whole names in class
    and id; an article inside an element that is furniture by the name of its class or id alone is
    lifted out of it, but for names of adverts, comments and the like (FIRM). The time is linear in
    the length of the page.
    """
    out: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    open_: list[tuple[str, bool, int]] = []  # name, in article, standing
    article, standing = False, OWN

    def flush():
        if parts:
            line = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if line:
                out.append((line, article, standing > OWN))
            parts.clear()

    counts: dict[str, int] = {}  # of open elements, so that a stray end tag costs nothing
    for kind, name, attributes, closed in _Scanner(source):
        if kind == "text":
            parts.append(name)
            continue
        if name in BLOCK:
            flush()
        if kind == "close":
            if counts.get(name):
                while True:
                    last = open_.pop()
                    counts[last[0]] -= 1
                    if last[0] == name:
                        break
                around = open_[-1][1:] if open_ else (False, OWN)
                if around != (article, standing):
                    flush()
                article, standing = around
            continue
        if name in CHARACTERS or name in VOID or closed and name not in BLOCK:
            continue
        if name in _ENDS:
            for gone in _implied(open_, name):
                counts[gone] -= 1
            around = open_[-1][1:] if open_ else (False, OWN)
            if around != (article, standing):
                flush()
            article, standing = around
        own = _standing(name, attributes, article)
        inside = article or name in ("article", "main")
        lifted = OWN if standing == NAMED and name in ("article", "main") else standing
        now = (inside, max(lifted, own))
        if now != (article, standing):
            flush()
        article, standing = now
        open_.append((name, *now))
        counts[name] = counts.get(name, 0) + 1
    flush()
    return out


_ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


def _implied(open_: list, name: str) -> list[str]:
    """The names of elements that a new paragraph, item or cell ends: the one that is open beside it, and inline ones within."""
    for i in range(len(open_) - 1, -1, -1):
        if open_[i][0] in _ENDS[name]:
            gone = [x[0] for x in open_[i:]]
            del open_[i:]
            return gone
        if open_[i][0] in BLOCK or len(open_) - i > 64:
            return []
    return []


def _prefix_lengths(x: list, y: list) -> list[int]:
    """For each i the length of a longest common subsequence of x[:i] and y, by one bit a line."""
    masks: dict = {}
    for i, v in enumerate(x):
        masks[v] = masks.get(v, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for v in y:
        hit = row & masks.get(v, 0)
        row = (row + hit | row - hit) & full
    lengths, n = [0], 0
    for bit in reversed(bin(row + (1 << len(x)))[3:]):
        n += bit == "0"
        lengths.append(n)
    return lengths


def shared_lines(a: list[bytes], b: list[bytes]) -> list[int]:
    """Where a longest common subsequence with b lies in a.

    Equal ends are taken first; the middle is halved until a side has one line, so memory stays in
    proportion to the lines, and the table of all pairs is worked through by bits.
    """
    out: list[int] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, n, j, m = work.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append(n)
        if i == n or j == m:
            continue
        if m - j == 1:
            out += [next(k for k in range(i, n) if a[k] == b[j])] if b[j] in a[i:n] else []
            continue
        x, half = a[i:n], (j + m) // 2
        fore, back = _prefix_lengths(x, b[j:half]), _prefix_lengths(x[::-1], b[half:m][::-1])[::-1]
        at = max(range(len(x) + 1), key=lambda k: fore[k] + back[k])
        if fore[at] + back[at]:
            work += [(i, i + at, j, half), (i + at, n, half, m)]
    return sorted(out)


_URL = re.compile(r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)(?::\d*)?([^?#]*)")


def host_path(url: str) -> tuple[str, str]:
    m = _URL.match(url)
    return (m[1].lower(), m[2].rstrip("/") or "/") if m else ("", url)


def _open_lines(batches):
    """For pairing: a digest of each line outside articles."""
    for batch in batches:
        for part in slices(batch, "html"):
            rows = []
            for key, url, source in zip(part.column("key").to_pylist(), as_text(part.column("url")), as_text(part.column("html"))):
                ds = [xxhash.xxh3_128_digest(t.encode()) for t, article, _ in text_lines(source) if not article]
                rows.append((key, *host_path(url), b"".join(ds)))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.binary(), pa.string(), pa.string(), pa.binary()])], ["key", "host", "path", "lines"])


def _difference(batches):
    """Partitions of (run, g, host, key, lines, own), sorted; yields for each own page the lines that it shares with its pair."""
    before = first = None

    def split(b):
        return [b[i : i + 16] for i in range(0, len(b), 16)]

    def deleted(row, other):
        return (row["key"], shared_lines(split(row["lines"]), split(other["lines"])) if other is not None else [])

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            beside = before is not None and before["run"] == row["run"] and before["g"] + 1 == row["g"] and before["host"] == row["host"]
            if first is not None:  # the first page of a host, which waited for the one after it
                out.append(deleted(first, row if beside else None))
                first = None
            if row["own"]:
                if beside:
                    out.append(deleted(row, before))
                else:
                    first = row
            before = row
        yield _deletions(out)
    if first is not None:
        yield _deletions([deleted(first, None)])


def _deletions(rows):
    rows = [r for r in rows if r[1]]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["key", "gone"])


def template_lines(pages: DataFrame, run_pages: int = RUN_PAGES) -> DataFrame:
    """(key, gone) for rows (key, url, html): for each page the lines outside articles, by number among them, that it shares with the page beside it in URL order."""
    lines = pages.select("key", "url", "html").mapInArrow(tidy(_open_lines), "key binary, host string, path string, lines binary").distinct()
    numbered = in_order(lines, "host", "path", "key").select("host", "key", "lines", F.col("place").alias("g"))
    run = F.floor(F.col("g") / run_pages).cast("bigint")
    # each run of pages is one unit of work and also sees the page before it and the page after it
    homes = F.array(F.struct(run.alias("run"), F.lit(True).alias("own")), F.struct((run - 1).alias("run"), F.lit(False).alias("own")), F.struct((run + 1).alias("run"), F.lit(False).alias("own")))
    at = F.col("g") % run_pages
    dealt = numbered.withColumn("home", F.explode(homes)).where(F.col("home.own") | ((at == 0) & (F.col("home.run") == run - 1)) | ((at == run_pages - 1) & (F.col("home.run") == run + 1)))
    dealt = dealt.select("home.run", "g", "host", "key", "lines", "home.own").repartition("run").sortWithinPartitions("run", "g")
    return dealt.mapInArrow(tidy(_difference), "key binary, gone array<int>")


def _texts(batches):
    for batch in batches:
        for part in slices(batch, "html", 4 << 20):
            texts, shared, named = [], [], []
            for source, gone in zip(as_text(part.column("html")), part.column("gone").to_pylist()):
                gone, number, use, cut_, junk = set(gone or ()), 0, [], 0, 0
                for t, article, furniture in text_lines(source):
                    if not article:
                        number += 1
                        if number - 1 in gone:
                            cut_ += 1
                            continue
                    if furniture:
                        junk += 1
                    else:
                        use.append(t)
                texts.append(" ".join(use))
                shared.append(cut_)
                named.append(junk)
            lengths = [len(t) for t in texts]
            arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(lengths, pa.int64()), pa.array(shared, pa.int32()), pa.array(named, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars", "lines_shared", "lines_furniture"])


def extract(pages: DataFrame, run_pages: int = RUN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, lines_shared (gone by differencing), lines_furniture (gone by markup alone).

    The text is the page's blocks less those outside article and main elements that the page shares
    with the page beside it in its host's URL order, and less what is left in furniture. Blocks are
    joined by one space in page order. A null html counts as empty and gives an empty text; null
    URLs are one host of their own; pages that repeat whole are kept and are not each other's
    template; an empty table gives an empty result; other columns are ignored.
    """
    bound_batches(pages.sparkSession)
    url, source = F.col("url").cast("string"), F.col("html").cast("string")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"), source.alias("html"), row_key(url, source).alias("key"))
    gone = cut(template_lines(pages, run_pages))
    joined = pages.join(broadcast_if_small(gone, 60, "gone"), "key", "left").select("page_id", "url", "html", "gone")
    return joined.mapInArrow(tidy(_texts), "page_id bigint, url string, text string, n_chars bigint, lines_shared int, lines_furniture int")
