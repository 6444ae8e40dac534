"""Main text of web pages: blocks labelled by a minimum cut."""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names by what they mean for text.
RAW = frozenset("script style iframe textarea title noembed noframes xmp".split())
SKIPPED = frozenset("noscript template svg math object select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ASIDE = frozenset("nav footer aside form header menu dialog".split())
PROSE = frozenset("h1 h2 h3 p blockquote pre".split())
LISTED = frozenset("li dt dd td th".split())
# Parts of the names in class, id and role. Names of parts beside the article, of what readers add, names that are also used
# inside it, names that say nothing by themselves, and names of the article.
_STRONG = re.compile(r"ads?|adv|advert\w*|banners?|sponsor\w*|promo(?:s|ted|tion|tions)?|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer\w*|masthead|cookies?|consent|gdpr|newsletters?|subscribe|subscription|signup|login|share|sharing|related|recommend(?:ed|ations?)?|popup|modal|widgets?|pagination|pager|complementary|contentinfo|outbrain|taboola")
_READERS = re.compile(r"comments?|commentlist|commentary|responses?|replies|reactions?|discussion|disqus|respond|feedback")
_WEAK = re.compile(r"header|reply|notices?|alerts?|social|toolbar|copyright|legal|disclaimer|search|skip|tags?|privacy|byline|meta")
_NEUTRAL = re.compile(r"|site|page|global|primary|secondary|main|top|bottom|left|right|center|box|blocks?|container|wrap(?:per)?|area|section|list|items?|links?|bar|inner|outer|buttons?|icons?|posts?|articles?|entry|entries|contents?|form|unit|slot|panel|group|row|col(?:umn)?s?|title|heading|text|body|wp|js|fixed|sticky|mobile|desktop|small|large|user|readers?|thread|\d+")
_GOOD = re.compile(r"(?:^|[\s_-])(?:article\w*|main\w*|content|post|entry|body|story|text)(?:$|[\s_-])")
_PART = re.compile(r"[_-]+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[^\s/>=][^\s/>=]*")
_GAP = re.compile(r"[\s/]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_SPACE = re.compile(r"[\s\x00]+")

#: Open elements that are told apart; deeper ones belong to the last of them.
DEPTH = 400
#: Shares of a page's prose: of its article for FAR, and of an element whose class words then say nothing, as it is no part beside the text;
#: and the words of prose from which on a page has such shares.
MOST, WHOLE, PROSE_WORDS = 0.5, 0.8, 30
#: The classifier: log-odds of content, in whole numbers, by feature of a block.
ARTICLE, OUTSIDE, GOOD, HEADING = 16, -24, 14, 8
#: Instead of OUTSIDE where the article that a page marks holds most of its prose: then prose elsewhere needs more than its length.
FAR = -40
ELEMENT, STRONG, WEAK, HIDDEN = -64, -64, -12, -64
WORDS, MARK, LINKED, FEW = 20, 6, -30, -6
#: What it costs to part two blocks: NEAR for neighbours in page order and TREE for the next block of the same parent, divided
#: by the square of the steps between them in the document's tree (2 for siblings).
NEAR, TREE = 48, 24


@lru_cache(maxsize=4096)
def class_words(words: str) -> tuple[int, bool]:
    """(evidence, whether it is of what a page's author puts beside a text) of class, id and role. A name is strong if each of its parts is
    known and one is strong; one with other parts is only weak: `related-posts` is a part beside the article, `related-work` may be its own."""
    found, loose = set(), False
    for name in words.split():
        parts = _PART.split(name)
        readers, strong = any(map(_READERS.fullmatch, parts)), any(map(_STRONG.fullmatch, parts))
        if readers or strong:
            known = all(_READERS.fullmatch(p) or _STRONG.fullmatch(p) or _WEAK.fullmatch(p) or _NEUTRAL.fullmatch(p) for p in parts)
            found.add("strong" if known else "weak")
            loose |= not readers
        elif any(map(_WEAK.fullmatch, parts)):
            found.add("weak")
            loose = True
    good = "strong" not in found and _GOOD.search(words)
    return GOOD * bool(good) + STRONG * ("strong" in found) + WEAK * ("weak" in found), loose and not any(_READERS.fullmatch(p) for n in words.split() for p in _PART.split(n))


class Block:
    """text; linked: characters of links; name of its element; path: numbers of its ancestors from the root; evidence: what its ancestors say."""

    __slots__ = ("text", "linked", "name", "path", "evidence", "article")

    def __init__(self, text: str, linked: int, name: str, path: tuple[int, ...], evidence: int, article: bool) -> None:
        self.text, self.linked, self.name, self.path, self.evidence, self.article = text, linked, name, path, evidence, article


class Scanner:
    """Tags of a page, each character seen a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page, self.low, self.missing = page, page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), page), set()

    def find(self, what: str, at: int, low: bool = False) -> int:
        """Where a string is from a place on, or -1; a string that was once not found further on is not sought again."""
        if what in self.missing:
            return -1
        found = (self.low if low else self.page).find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def attributes(self, at: int) -> tuple[int, dict[str, str], bool]:
        """What follows a tag's name: the place behind its >, or -1 if the page ends first, its attributes, and whether it closes itself."""
        page, end, own = self.page, len(self.page), {}
        while True:
            gap = _GAP.match(page, at)
            at = gap.end()
            if at >= end:
                return -1, own, False
            if page[at] == ">":
                return at + 1, own, gap[0].endswith("/")
            name = _ATTRIBUTE.match(page, at)
            if not name:  # a stray =
                at += 1
                continue
            at = name.end()
            value = ""
            if (e := _EQUALS.match(page, at)) and e.end() < end:
                at = e.end()
                quote = page[at]
                close = self.find(quote, at + 1) if quote in "\"'" else -1
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                else:
                    m = _BARE.match(page, at)
                    value, at = m[0], m.end()
            own.setdefault(name[0].lower(), value)


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in its order, white space made one space, with what their ancestors say about them.

    An element's class words say nothing if it holds an article, main or body element, or nearly all of the page's prose.
    """
    scan = Scanner(page)
    out: list[Block] = []
    # Open elements: name, number, in a link, in an article, numbers of the ancestors.
    stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("", 0, False, False, (0,))]
    opened: Counter[str] = Counter()
    said: dict[int, int] = {}  # evidence by number of the element
    loose: set[int] = set()  # elements against which only their class words speak
    parts: list[tuple[str, bool]] = []
    number = at = 0
    end = len(page)

    def close() -> None:
        if parts:
            text = _SPACE.sub(" ", "".join(unescape(p) for p, _ in parts)).strip()
            if text:
                linked = sum(len(p) for p, a in parts if a)
                i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCKS), 0)
                out.append(Block(text, linked, stack[i][0], stack[-1][4], 0, stack[-1][3]))
            parts.clear()

    def pop_to(index: int) -> None:
        opened.subtract(s[0] for s in stack[index:])
        del stack[index:]

    while at < end:
        tag = page.find("<", at)
        if tag < 0:
            tag = end
        if tag > at:
            parts.append((page[at:tag], stack[-1][2]))
        if tag == end:
            break
        at = tag + 1
        after = page[at : at + 1]
        if page.startswith("!--", at):
            done = scan.find("-->", at)
            at = done + 3 if done >= 0 else end
            continue
        if page.startswith("![CDATA[", at):
            done = scan.find("]]>", at)
            parts.append((page[at + 8 : done if done >= 0 else end], stack[-1][2]))
            at = done + 3 if done >= 0 else end
            continue
        if after in ("!", "?"):
            done = scan.find(">", at)
            at = done + 1 if done >= 0 else end
            continue
        ending = after == "/"
        m = _NAME.match(page, at + ending)
        if not m:
            parts.append(("<", stack[-1][2]))
            continue
        name = m[0].lower()
        at, own, itself = (m.end() + 1, {}, False) if page.startswith(">", m.end()) else scan.attributes(m.end())
        if at < 0:
            break  # the page ends in a tag
        if ending:
            if name in BLOCKS:
                close()
            if opened[name]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        pop_to(i)
                        break
                    if stack[i][0] in ("article", "body", "td", "table") and name not in ("body", "html", "table", "article", "main"):
                        break
            continue
        if name in RAW or name in SKIPPED:
            done = scan.find(f"</{name}", at, low=True)
            if done >= 0:
                done = scan.find(">", done)
                at = done + 1 if done >= 0 else end
            elif name in RAW:
                at = end
            parts.append((" ", False))
            continue
        if name == "br":
            parts.append((" ", stack[-1][2]))
            continue
        if name in BLOCKS:
            close()
            # A new block ends an open paragraph, a new item the last one.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or name in ("li", "dt", "dd", "td", "th", "tr") and stack[i][0] == name:
                    pop_to(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if name in VOID or itself or len(stack) >= DEPTH:
            continue
        number += 1
        _, _, link, article, path = stack[-1]
        words = " ".join(own[x] for x in ("class", "id", "role") if x in own).lower() if own else ""
        evidence = 0
        if name in ("article", "main", "body", "html") or own.get("role", "").lower() in ("main", "article"):
            if name in ("article", "main") or own.get("role"):
                for n in path:  # what holds an article is no part beside it
                    said.pop(n, None)
                article = True
        else:
            if words:
                evidence, beside = class_words(words)
                if beside:
                    loose.add(number)
            if name in ASIDE and not (name == "header" and article):
                evidence += ELEMENT
                loose.discard(number)
            if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in own.get("style", "").lower().replace(" ", ""):
                evidence += HIDDEN
                loose.discard(number)
        if evidence:
            said[number] = evidence
        stack.append((name, number, link or name == "a", article, (*path, number)))
        opened[name] += 1
    close()
    loose &= said.keys()
    if loose and (total := sum(map(prose, out))) >= PROSE_WORDS:
        held: Counter[int] = Counter()
        for b in out:
            if words := prose(b):
                held.update({n: words for n in b.path if n in loose})
        for n, words in held.items():
            if words >= WHOLE * total:
                del said[n]
    for b in out:
        all_ = [said[n] for n in b.path if n in said]
        b.evidence = min(0, *all_) + max(0, *all_) if all_ else 0
    return out


def prose(b: Block) -> int:
    """Words of a block that is no heap of links and no label."""
    words = b.text.count(" ") + 1
    return words if words >= 4 and 2 * b.linked < len(b.text) else 0


def scores(own: list[Block]) -> list[int]:
    """Log-odds of content of each block from its features; those of an article's blocks only count where a page marks one."""
    marked = any(b.article for b in own)
    inside, every = (sum(prose(b) for b in own if b.evidence > ELEMENT and b.article >= least) for least in (True, False))
    outside = FAR if every >= PROSE_WORDS and inside >= MOST * every else OUTSIDE
    out = []
    for b in own:
        words = b.text.count(" ") + 1
        s = b.evidence + min(2 * WORDS, words) // 2 + FEW * (words < 4 and (b.name not in LISTED or b.linked > 0)) + MARK * (b.text[-1] in ".!?…:;\"»”") + HEADING * (b.name in PROSE)
        s += int(LINKED * min(1.0, b.linked / len(b.text)))
        out.append(s + (ARTICLE if b.article else outside) * marked)
    return out


def edges(own: list[Block]) -> list[tuple[int, int, int]]:
    """(a, b, capacity): neighbours in page order, and the next block of the same parent, tied by how near they are in the tree."""

    def steps(a: tuple[int, ...], b: tuple[int, ...]) -> int:
        same = 0
        for x, y in zip(a, b):
            if x != y:
                break
            same += 1
        return len(a) + len(b) - 2 * same

    out = [(i, i + 1, NEAR // max(1, steps(own[i].path, own[i + 1].path)) ** 2) for i in range(len(own) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(own):
        parent = b.path[-2] if len(b.path) > 1 else 0
        if parent in last and last[parent] < i - 1:
            out.append((last[parent], i, TREE // max(1, steps(own[last[parent]].path, b.path)) ** 2))
        last[parent] = i
    return [e for e in out if e[2]]


def minimum_cut(n: int, terminal: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which of n nodes stay on the source's side of a minimum cut: Dinic's maximum flow. terminal: capacities from the
    source and to the sink; edges: (a, b, capacity) both ways."""
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[int] = []
    source, sink = n, n + 1

    def add(a: int, b: int, forth: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(forth)
        head[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, (s, t) in enumerate(terminal):
        through = min(s, t)  # flows from source to sink at once
        if s > through:
            add(source, i, s - through, 0)
        if t > through:
            add(i, sink, t - through, 0)
    for a, b, c in edges:
        add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if not cap[e])
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[u] < len(head[u]):
                e = head[u][nxt[u]]
                if cap[e] and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(head[u]):
                path.append(head[u][nxt[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                nxt[u] += 1
            else:
                break


def labels(own: list[Block]) -> list[bool]:
    """Which blocks are content: the whole page is one graph, whose minimum cut weighs the classifier against the edges."""
    return minimum_cut(len(own), [(max(0, s), max(0, -s)) for s in scores(own)], edges(own))


def extract(page: str) -> str:
    """The main text of a page: its content blocks, joined by one space."""
    own = blocks(page)
    return " ".join(b.text for b, k in zip(own, labels(own), strict=True) if k)


def _extract(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for at in range(0, frame.num_rows, 200):
            part = frame.slice(at, 200)
            texts = [extract(h or "") for h in part.column("html").to_pylist()]
            yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text (empty if there is none), n_chars (its code points).

    A page's blocks are nodes. A linear classifier of their features (length, marks, share of links, element, what the elements
    and the words of class, id and role around them say) gives their capacities from the source or to the sink; neighbours
    in the page and in its tree are tied by edges; the blocks on the source's side of a minimum cut are the text.

    Null and empty pages have no text. Comments, scripts, styles and markup are no text; character references are decoded;
    a `<` that begins no tag is text; a tag in which the page ends is dropped. Repeated rows and null ids are kept; other
    columns are left out, whatever their names. An empty table gives an empty result. Nothing is shuffled.
    """
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return source.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
