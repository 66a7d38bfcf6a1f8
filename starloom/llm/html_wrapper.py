"""Main text of web pages by wrapper induction.

A page is read as a stream of block tags and text. Streams of pages of one host are
aligned step by step into a wrapper: a union-free regular expression of tags,
text slots, optional parts ``( )?`` and repeated groups ``( )+``. Texts that
differ turn a constant into a slot, tags that differ into a repeated group if a
neighbour has the same form, else into an optional part. Wrappers align with each
other in the same way, so map tasks fold their own pages and only wrappers are
shuffled, merged over salted host keys first: a host with a third of all
pages is no group of pages anywhere.

The wrapper decides once per host which slots are article text: those in the main
region, outside menus, headers, footers, sidebars, notices, adverts, forms and
comments; where no region is marked, slots that vary from page to page and are not
mostly links. Each page is then aligned with its host's wrapper and gives the
texts of these slots in page order.

Null and empty pages give an empty text; pages without a host share the wrapper of
the empty host; broken or cut markup is closed where HTML would close it and tags
beyond ``DEPTH`` levels add no level; repeated rows give one result each; columns
beside id, url and html are ignored.
"""

from __future__ import annotations

import collections
import difflib
import functools
import hashlib
import html as html_lib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, stage
from starloom.llm.url_filter import host_and_path

DEPTH = 60
SALTS = 64
HOSTS_IN_TASK = 2000     # wrappers that a map task holds before it passes them on
LONGEST_PERIOD = 3       # tags of a repeated group side by side
LONGEST_KEY = 120        # longer keys have a hash for the words that mark nothing
TABLE_CELLS = 250_000    # alignment table; longer lists are aligned by matching blocks

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# HTML element classes.
SKIPPED = frozenset("script style title template noscript iframe object svg canvas textarea select "
                    "math audio video map noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main "
                   "menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption "
                   "search button label option".split())
TRANSPARENT = frozenset(("html", "body", "head"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# an element that starts ends an open one of these, up to the nearest stop
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"form"})}

# Tags, roles and class words that mark what is not article text.
OTHER_TAGS = frozenset("nav footer aside form button fieldset dialog menu search label option legend"
                       .split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert "
                        "form menu menubar toolbar status".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion "
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment "
    "comments reply replies discussion respond disqus widget search pagination pager copyright legal "
    "disclaimer toolbar hidden form header".split())
# words written as one, such as "siteheader"
OTHER_STARTS = ("sidebar", "footer", "cookie", "newsletter", "breadcrumb", "advert", "sponsor")
OTHER_ENDS = ("sidebar", "footer", "nav", "menu", "header", "comments", "banner")
ALWAYS_OTHER = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo "
                         "related hidden".split())
# of the words above, those that stand in names of an article's own parts as well
DOUBTFUL = frozenset("related social search legal discussion hidden notice notices respond alert form "
                     "header promotion subscription recommended recommendations copyright disclaimer "
                     "navigation menu banner login signup widget".split())
# whole ids that mark furniture even on sections
OTHER_IDS = frozenset("comment comments reply replies respond disqus".split())
MAIN_WORDS = ("articlebody", "article", "maincontent", "postbody", "entry", "post", "story",
              "content", "main")


def _key(name: str, attributes: str) -> str:
    """Tag with its role, class and id words, digits left out. Words of ids have a ``#``;
    a ``=`` adds names that are one furniture word as a whole."""
    if not attributes.strip("/ \t\r\n"):
        return name
    words, marks = set(), []
    for a, v in _ATTRIBUTE.findall(attributes):
        a, v = a.lower(), v.strip("\"'").lower()
        if a == "id":
            found = [w for w in re.split(r"[^a-z]+", v) if w]
            words.update("#" + w for w in found)
            if len(found) == 1 and found[0] in OTHER_IDS:
                words.add("#=" + found[0])
        elif a in ("class", "itemprop"):
            words.update(w for w in re.split(r"[^a-z]+", v) if w)
            words.update("=" + w for w in v.split() if w in DOUBTFUL)
        elif a == "role" and v:
            marks.append("!" + v)
        elif a == "hidden" or a == "aria-hidden" and v == "true" or a == "style" and re.search(
                r"display\s*:\s*none|visibility\s*:\s*hidden", v):
            words.update(("hidden", "=hidden"))
    key = name + "".join("." + w for w in sorted(words)) + "".join(sorted(marks))
    if len(key) <= LONGEST_KEY:
        return key
    telling = {w for w in words if "=" in w or _telling(w.lstrip("#"))}
    known = {m for m in marks if m[1:] in OTHER_ROLES or m == "!main"}
    rest = "".join(sorted(words - telling) + sorted(set(marks) - known))
    return (name + "".join("." + w for w in sorted(telling))
            + (".~" + hashlib.md5(rest.encode()).hexdigest() if rest else "")
            + "".join(sorted(known)))


def _telling(word: str) -> bool:
    """Whether a word marks the main region or furniture."""
    return (word in OTHER_WORDS or word in MAIN_WORDS or word == "section"
            or word.startswith(OTHER_STARTS) or word.endswith(OTHER_ENDS))


class Item:
    """Part of a wrapper: a tag with its parts, a text (key ``#``) or a group
    (key ``(...)``). ``at`` lists the texts of a page that fall on it."""

    __slots__ = ("key", "opt", "rep", "kids", "const", "size", "links", "at", "keep")

    def __init__(self, key, kids=None, const=None, size=0, links=0, at=None):
        self.key, self.kids, self.const = key, kids or [], const
        self.opt = self.rep = False
        self.size, self.links, self.at, self.keep = size, links, at or [], False

    def pack(self):
        return [self.key, self.opt + 2 * self.rep, self.const, self.size, self.links,
                [k.pack() for k in self.kids]]

    @classmethod
    def unpack(cls, row):
        item = cls(row[0], [cls.unpack(k) for k in row[5]], row[2], row[3], row[4])
        item.opt, item.rep = bool(row[1] & 1), bool(row[1] & 2)
        return item

    def expression(self) -> str:
        """The part as a regular expression over tags and texts."""
        inner = "".join(k.expression() for k in self.kids)
        if self.key == "#":
            body = "#" if self.const is None else json.dumps(self.const, ensure_ascii=False)
        elif self.key[0] == "(":
            body = inner
        else:
            body = f"<{self.key}>{inner}</{self.key.split('.')[0].split('!')[0]}>"
        mark = "*" if self.opt and self.rep else "?" if self.opt else "+" if self.rep else ""
        return f"({body}){mark}" if mark else body


def parse(page: str) -> tuple[list[Item], list[str]]:
    """Block tree of a page and its texts in page order."""
    texts: list[str] = []
    top: list[Item] = []
    stack: list[tuple[str, list[Item]]] = [("", top)]
    opened: dict[str, list[int]] = collections.defaultdict(list)  # places in the stack by tag
    buffer: list[str] = []
    linked = in_link = 0
    lower = None

    def flush():
        nonlocal linked
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            stack[-1][1].append(Item("#", const=text, size=len(text), links=min(linked, len(text)),
                                     at=[len(texts)]))
            texts.append(text)
        linked = 0

    def close(names, stops):
        last = max((opened[n][-1] for n in names if opened[n]), default=0)
        if last and last > max((opened[n][-1] for n in stops if opened[n]), default=0):
            flush()
            while len(stack) > last:
                opened[stack.pop()[0]].pop()
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        start = m.start() if m else end
        if start > at:
            raw = page[at:start]
            buffer.append(html_lib.unescape(raw) if "&" in raw else raw)
            linked += len(raw) if in_link else 0
        if not m:
            break
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name or name in TRANSPARENT:
            continue
        ending = m.group(1) or m.group(4)
        attributes = m.group(3) or m.group(6) or ""
        if name in SKIPPED:
            if not ending and not attributes.endswith("/"):
                lower = lower if lower is not None else page.lower()
                if len(lower) != end:  # some capitals change length
                    lower = "".join(c.lower() if c.isascii() else c for c in page)
                done = lower.find("</" + name, at)
                at = end if done < 0 else done
            continue
        if name == "a":
            in_link = 0 if ending else 1
        elif name == "br":
            buffer.append(" ")
        elif name in BLOCKS:
            if ending:
                if name == "p":
                    close({"p"}, {"div", "article", "section", "td", "li"})
                    flush()
                else:
                    close({name}, ())
                    flush()
                continue
            flush()
            close({"p"}, {"div", "article", "section", "td", "th", "li", "blockquote", "table"})
            if name in CLOSES:
                close(*CLOSES[name])
            if name == "hr":
                continue
            opened[name].append(len(stack))
            if len(stack) > DEPTH:  # open for its end tag only
                stack.append((name, stack[-1][1]))
                continue
            item = Item(_key(name, attributes))
            stack[-1][1].append(item)
            stack.append((name, item.kids))
    flush()
    return top, texts


def generalise(items: list[Item]) -> list[Item]:
    """Parts of a page with neighbours of one form folded into repeated groups."""
    for item in items:
        item.kids = generalise(item.kids)
    return fold(items)


def fold(items: list[Item]) -> list[Item]:
    out: list[Item] = []
    for item in items:  # a+ before longer periods
        if out and out[-1].key == item.key and item.key != "#":
            last = out[-1]
            opt = last.opt and item.opt
            out[-1] = merge(last, item)
            out[-1].rep, out[-1].opt = True, opt
        else:
            out.append(item)
    for period in range(2, LONGEST_PERIOD + 1):
        i = 0
        while i + 2 * period <= len(out):
            keys = [x.key for x in out[i:i + period]]
            n = 1
            while [x.key for x in out[i + n * period:i + (n + 1) * period]] == keys:
                n += 1
            if n > 1 and len(set(keys)) > 1 and not any(k[0] == "(" for k in keys):
                group = None
                for k in range(n):
                    one = Item("(" + " ".join(keys) + ")",
                               out[i + k * period:i + (k + 1) * period])
                    group = one if group is None else merge(group, one)
                group.rep = True
                out[i:i + n * period] = [group]
            i += 1
    return out


def merge(a: Item, b: Item) -> Item:
    """One part for two of the same key."""
    out = Item(a.key, const=a.const if a.const == b.const else None, size=a.size + b.size,
               links=a.links + b.links, at=a.at + b.at)
    out.opt, out.rep = a.opt or b.opt, a.rep or b.rep
    out.kids = align(a.kids, b.kids) if a.kids or b.kids else []
    return out


def _grouped(items: list[Item], other: list[Item]) -> list[Item]:
    """``items`` with the groups of ``other`` formed, so that they can match."""
    for group in other:
        if group.key[0] != "(" or any(x.key == group.key for x in items):
            continue
        keys = [k.key for k in group.kids]
        for i in range(len(items) - len(keys) + 1):
            if [x.key for x in items[i:i + len(keys)]] == keys:
                items = (items[:i] + [Item(group.key, items[i:i + len(keys)])]
                         + items[i + len(keys):])
                break
    return items


def pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence as pairs of places."""
    n, m = len(a), len(b)
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    x, y = a[head:n - tail], b[head:m - tail]
    if len(x) * len(y) > TABLE_CELLS:
        blocks = difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
        middle = [(head + i + k, head + j + k) for i, j, size in blocks for k in range(size)]
    else:
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            row, below = table[i], table[i + 1]
            for j in range(len(y) - 1, -1, -1):
                row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
        middle, i, j = [], 0, 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                middle.append((head + i, head + j))
                i, j = i + 1, j + 1
            elif table[i + 1][j] >= table[i][j + 1]:
                i += 1
            else:
                j += 1
    return ([(k, k) for k in range(head)] + middle
            + [(n - tail + k, m - tail + k) for k in range(tail)])


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """One list of parts that describes both; what only one has is optional."""
    a, b = _grouped(a, b), _grouped(b, a)
    out: list[Item] = []
    i = j = 0
    for p, q in pairs([x.key for x in a], [x.key for x in b]) + [(len(a), len(b))]:
        for item in a[i:p] + b[j:q]:
            item.opt = True
            out.append(item)
        if p < len(a):
            out.append(merge(a[p], b[q]))
        i, j = p + 1, q + 1
    return fold(out)


def decide(wrapper: list[Item], n_pages: int) -> None:
    """Set ``keep`` on the text slots of article text."""
    regions = _regions(wrapper)
    varying = []

    def walk(items, other, inside, header, main):
        for item in items:
            if item.key == "#":
                item.keep = not other and (inside or not regions) and not header
                if item.keep and not regions:
                    varying.append(item)
                continue
            tag, words, roles = _parts(item.key)
            # a title often stands in the main part, just before the article
            here = inside or tag in regions or bool(regions & (words | roles)) or main and tag == "h1"
            drop = other or ((_other_inside(item, n_pages) if inside
                              else _other(item.key, False))
                             and not (tag == "form" and regions and _regions([item])))
            named = _names(item.key)[1] if tag == "section" or "section" in words else words
            head = (header or inside and (tag == "header" or any(w.endswith("header") for w in named))
                    ) and tag not in HEADINGS
            walk(item.kids, drop, here and not drop, head, main or "main" in (tag, *roles) and not drop)
    walk(wrapper, False, False, False, False)
    if not regions:
        plain = [x for x in varying if 2 * x.links <= x.size]
        fixed = [x for x in plain if n_pages > 2 and x.const is not None]
        for item in varying:
            item.keep = any(item is x for x in plain) and not (
                len(fixed) < len(plain) and any(item is x for x in fixed))


def _parts(key: str) -> tuple[str, frozenset, frozenset]:
    """Tag, class and id words, and roles."""
    tag, words, ids, roles, _ = _names(key)
    return tag, words | ids, roles


def _names(key: str) -> tuple[str, frozenset, frozenset, frozenset, frozenset]:
    """Tag, class words, id words, roles, and ``=`` names."""
    if key[0] == "(":
        return "(", frozenset(), frozenset(), frozenset(), frozenset()
    body, *roles = key.split("!")
    tag, *words = body.split(".")
    return (tag, frozenset(w for w in words if w[0] not in "#="),
            frozenset(w[1:] for w in words if w[0] == "#" and w[1] != "="), frozenset(roles),
            frozenset(w for w in words if "=" in w))


def _furniture(words) -> set:
    return {w for w in words if w in OTHER_WORDS or w.startswith(OTHER_STARTS)
            or w.endswith(OTHER_ENDS)}


def _other(key: str, inside: bool) -> bool:
    tag, words, ids, roles, whole = _names(key)
    if tag in ("article", "main", "("):  # their ids are slugs of titles
        sure = words & ALWAYS_OTHER
        return bool(sure - DOUBTFUL or {"=" + w for w in sure} & whole
                    or any(w[0] == "#" for w in whole))
    if tag in OTHER_TAGS or roles & OTHER_ROLES or tag == "header" and not inside:
        return True
    found = _furniture(words | ids)
    return any(not w.endswith("header") for w in found) if inside else bool(found)


def _other_inside(item: Item, n_pages: int) -> bool:
    """``_other`` in the main region, where names can be slugs of the article's own
    headings: a doubtful word counts as a whole class, beside another one, or if the
    part is mostly links or the same on all pages. Ids of headings and sections count
    only if they are whole."""
    if not _other(item.key, True):
        return False
    tag, words, ids, roles, whole = _names(item.key)
    if tag in ("article", "main", "(") or tag in OTHER_TAGS or roles & OTHER_ROLES:
        return True
    by_class = {w for w in _furniture(words) if not w.endswith("header")}
    if by_class - DOUBTFUL or {"=" + w for w in by_class} & whole:
        return True
    if tag in HEADINGS:
        return len(by_class) > 1
    by_id = {w for w in _furniture(ids) if not w.endswith("header")}
    if any(w[0] == "#" for w in whole):
        return True
    if tag != "section" and "section" not in words:
        if by_id - DOUBTFUL:
            return True
        by_class |= by_id
    texts = list(_texts(item))
    return (len(by_class) > 1 or 2 * sum(x.links for x in texts) > sum(x.size for x in texts)
            or n_pages > 2 and not item.opt and all(x.const is not None for x in texts))


def _texts(item: Item):
    if item.key == "#":
        yield item
    for k in item.kids:
        yield from _texts(k)


def _regions(wrapper) -> frozenset:
    """What marks the main region: a tag, or a class word; empty if nothing."""
    seen: set = set()

    def walk(items):
        for item in items:
            if item.key == "#":
                continue
            tag, words, roles = _parts(item.key)
            if tag != "form" and _other(item.key, True) or tag == "header":
                continue  # a form may be a frame around the whole page
            if item.size or _has_text(item):
                seen.update({tag} & {"article", "main"})
                seen.update(words & set(MAIN_WORDS))
                if "main" in roles:
                    seen.add("main")
            walk(item.kids)
    walk(wrapper)
    if "article" in seen:
        return frozenset(("article", "articlebody"))
    for word in ("main", *MAIN_WORDS):
        if word in seen:
            return frozenset((word,))
    return frozenset()


def _has_text(item: Item) -> bool:
    return item.key == "#" or any(map(_has_text, item.kids))


def extract(wrapper: list[Item], page: str) -> str:
    """Texts of the page that fall on kept slots of the wrapper."""
    items, texts = parse(page)
    chosen: list[int] = []
    paths: dict[tuple, bool] = {}

    def walk(slots, parts, path):
        parts = _grouped(parts, slots)
        slots = _grouped(slots, parts)
        matched = pairs([s.key for s in slots], [p.key for p in parts])
        taken = {q: slots[p] for p, q in matched}
        by_key = {s.key: s for s in slots}
        for q, part in enumerate(parts):
            slot = taken.get(q) or by_key.get(part.key)
            if part.key == "#":
                if slot is None and not paths:
                    paths.update(slot_paths(wrapper))
                if slot.keep if slot is not None else paths.get(path):
                    chosen.extend(part.at)
            else:
                walk(slot.kids if slot is not None else [], part.kids,
                     path if part.key[0] == "(" else (*path, part.key))
    walk(wrapper, generalise(items), ())
    return "\n".join(texts[i] for i in sorted(chosen))


def slot_paths(wrapper: list[Item]) -> dict[tuple, bool]:
    """Whether a text stays, by the keys of the tags around it. Groups add no key, so a
    part that stands alone finds the slots of its like in groups, and the other way
    round: aligning and folding move parts in and out of groups, but lose none."""
    found: dict[tuple, bool] = {}

    def walk(items, path):
        for item in items:
            if item.key == "#":
                found[path] = found.get(path, False) or item.keep
            else:
                walk(item.kids, path if item.key[0] == "(" else (*path, item.key))
    walk(wrapper, ())
    return found


def fold_pages(wrapper: list[Item] | None, page: str) -> list[Item]:
    """Wrapper of the pages so far and one more."""
    items = generalise(parse(page)[0])
    _forget(items)
    return items if wrapper is None else align(wrapper, items)


def _forget(items) -> None:
    """Drop page places, and long constants, which cannot be template text."""
    for item in items:
        item.at = []
        if item.const is not None and len(item.const) > 200:
            item.const = None
        _forget(item.kids)


def dump(wrapper: list[Item], n: int) -> str:
    return json.dumps([n, [x.pack() for x in wrapper]], ensure_ascii=False)


def load(text: str) -> tuple[list[Item], int]:
    n, rows = json.loads(text)
    return [Item.unpack(r) for r in rows], n


def _fold_batches(batches):
    import pyarrow as pa
    held: dict[str, tuple[list[Item], int]] = {}

    def flush():
        rows = [(h, dump(w, n)) for h, (w, n) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in rows], pa.string()),
             pa.array([w for _, w in rows], pa.string())], ["host", "wrapper"])
    for batch in small_batches(batches):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrapper, n = held.get(host, (None, 0))
            held[host] = (fold_pages(wrapper, page or ""), n + 1)
            if len(held) >= HOSTS_IN_TASK:
                yield flush()
    if held:
        yield flush()


def _merge_wrappers(pdf):
    import pandas as pd
    wrapper, pages = None, 0
    for text in sorted(pdf["wrapper"]):
        more, n = load(text)
        wrapper, pages = (more if wrapper is None else align(wrapper, more)), pages + n
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [dump(wrapper, pages)]})


@functools.lru_cache(maxsize=512)
def _decided(text: str) -> list[Item]:
    wrapper, n = load(text)
    decide(wrapper, n)
    return wrapper


def _extract_batches(batches):
    import pyarrow as pa
    for batch in small_batches(batches):
        out = [extract(_decided(w), page) if page and w else ""
               for page, w in zip(batch.column("html").to_pylist(),
                                  batch.column("wrapper").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
            ["page_id", "url", "text"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from columns ``host`` and ``html``."""
    folded = pages.select("host", "html").mapInArrow(_fold_batches, "host string, wrapper string")
    salted = folded.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInPandas(_merge_wrappers,
                                                        "host string, wrapper string")
    return some.groupBy("host").applyInPandas(_merge_wrappers, "host string, wrapper string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text``."""
    host, _ = host_and_path(F.col("url"))
    view = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).withColumn("host", host)
    wrappers = stage(induce_wrappers(view), "wrappers")
    id_type = view.schema["page_id"].dataType.simpleString()
    return (view.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
            .mapInArrow(_extract_batches, f"page_id {id_type}, url string, text string"))
