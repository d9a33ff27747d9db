"""Main text of web pages through wrappers: union-free regular expressions inferred per host.

1. A page becomes a stream of structural tags (name and class words) and text; the stream is read as a tree, text
   between two structural tags is one slot, and neighbours that look alike fold into a repeated group, so that
   most pages of a host share one skeleton.
2. Distinct skeletons of a host are aligned one after the other: children that match by tag are merged, those
   that do not become optional groups, folded ones stay repeated.  The result is the host's wrapper, an
   expression of tags, slots, ``?`` and ``+`` without unions.  Buckets of ``FOLD`` skeletons are aligned by
   themselves and their wrappers again, as a reduction tree, so a hot host is no single task.
3. Each slot of a wrapper knows over all pages how much text and linked text it held and whether it ever changed.
   Slots under furniture (navigation, footers, forms, adverts, comments and the like, by tag or class word), slots
   of links outside an article, and slots whose text never changes while others of the page do are template; the
   main region is a skeleton's article or main element, else the smallest container with most of its other text.
   Inside an article a class word alone drops nothing unless the whole name says so ("comment-list", "ad-box"); other
   furniture words ("legal-analysis", "follow-up", "more") drop a slot only if the host's other pages show that it is
   template: the same text on ``TEMPLATE_PAGES`` different pages, or mostly links.
4. Each skeleton is found again in its host's wrapper, which holds it whole, and a page keeps the blocks of its main slots.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from difflib import SequenceMatcher
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, cut, small, table, written
from .urls import host

FOLD = 64
DEPTH = 60           # deeper elements get no node of their own, but for furniture and regions
TEMPLATE_PAGES = 3   # a slot has to be the same on so many different pages to count as template
REGION_SHARE = 0.8

# Structural tags, tags without content of their own, tags left out with their content, furniture.
STRUCTURE = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot
tr td th caption blockquote pre figure figcaption address nav header footer aside form fieldset legend label details
summary dialog menu center hgroup""".split())
BREAKS = frozenset(["br", "hr"])
LEFT_OUT = frozenset("""script style noscript template textarea select option button svg math iframe object canvas
audio video map title""".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe")}  # no tags inside
NEVER_CLOSED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}}
REGIONS = frozenset(["article", "main"])
CONTAINERS = frozenset("#root html body div section center td".split())
FURNITURE_TAGS = frozenset("nav header footer aside form fieldset legend label dialog menu".split())
FURNITURE_WORDS = frozenset("""ad ads adv advert advertisement advertising sponsor sponsored banner promo promotion cookie
cookies consent gdpr notice notices notification alert comment comments reply replies respond disqus discussion share
sharing social follow related recommended recommendations more trending popular breadcrumb breadcrumbs newsletter
subscribe subscription signup signin login register popup modal overlay menu nav navbar navigation topbar toolbar
sidebar side rail footer foot header masthead pagination pager paging widget copyright legal disclaimer skip hidden
search form""".split())

#: Words that name what no article consists of, and words that say nothing of their own beside them.
NAMED = frozenset("""ad ads adv advert advertisement advertising sponsor sponsored cookie cookies consent gdpr notice notices
comment comments disqus newsletter subscribe share sharing related recommended breadcrumb breadcrumbs nav navbar navigation
menu sidebar footer pagination pager form""".split())
NEUTRAL = frozenset("""area bar block box container content group inner item items links list posts section stories thread
widget wrap wrapper""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""",
                  re.S)
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _label(tag: str, attrs: str) -> str:
    """Tag and its class, id and role words without figures."""
    if "=" not in attrs:
        return tag
    words = {w.lower() for m in _ATTR.finditer(attrs) for w in _WORDS.findall(next(g for g in m.groups() if g is not None))}
    return ".".join([tag, *sorted(words)])


class _Node:
    __slots__ = ("label", "kids", "slots")

    def __init__(self, label: str):
        self.label, self.kids, self.slots = label, [], []  # slots: block numbers of each kid's slots


def _folded(kids: list, slots: list) -> tuple[list, list]:
    """Fold neighbouring alike children, alone or as groups of two or three, into repeated ones."""
    for width in (1, 2, 3):
        out, held, i = [], [], 0
        while i < len(kids):
            group = [(k[0], k[2]) for k in kids[i:i + width]]
            j = i + width
            while len(group) == width and [(k[0], k[2]) for k in kids[j:j + width]] == group:
                j += width
            if j > i + width:
                at = slots[i:i + width]
                for k in range(i + width, j):
                    at[(k - i) % width] = [a + b for a, b in zip(at[(k - i) % width], slots[k])]
                out += [(k[0], "+", k[2]) for k in kids[i:i + width]]
                held += at
                i = j
            else:
                out.append(kids[i])
                held.append(slots[i])
                i += 1
        kids, slots = out, held
    return kids, slots


def read(html: str | None) -> tuple[tuple, list[str], list[int], list[list[int]]]:
    """Skeleton, text blocks, linked characters of each block, and the block numbers of each slot of a page."""
    html, blocks, links = html or "", [], []
    stack, buf, linked, in_link = [_Node("#root")], [], 0, 0
    opened, n_open = [], Counter()  # all open elements, and whether they are on the stack or deeper than that

    def flush():
        nonlocal linked
        text = " ".join(unescape("".join(buf)).split())
        buf.clear()
        if text:
            top = stack[-1]
            if not top.kids or top.kids[-1][0] != "#":
                top.kids.append(("#", "", ()))
                top.slots.append([[]])
            top.slots[-1][0].append(len(blocks))
            blocks.append(text)
            links.append(min(linked, len(text)))
        linked = 0

    def close():
        node = stack.pop()
        kids, slots = _folded(node.kids, node.slots)
        stack[-1].kids.append((node.label, "", tuple(kids)))
        stack[-1].slots.append([s for kid in slots for s in kid])

    def end():
        tag, on_stack = opened.pop()
        n_open[tag] -= 1
        if on_stack:
            close()

    def keeps(label):
        """Deeper than DEPTH only furniture and regions get a node, so that they are still told apart."""
        if len(stack) <= DEPTH:
            return True
        tag = label.split(".")[0]
        article = tag in REGIONS
        if not article and not _is_furniture(label, False):
            return False
        above, semantic = [n.label for n in stack], False
        for a in above:
            if _is_furniture(a, semantic):
                return False
            semantic = semantic or a.split(".")[0] in REGIONS
        return _is_furniture(label, semantic) or (article and not semantic)

    at, skipping = 0, None
    while m := _TAG.search(html, at):
        if skipping is None:
            buf.append(html[at:m.start()])
            if in_link:
                linked += m.start() - at
        at, tag = m.end(), (m[2] or "").lower()
        if tag in RAW and not m[1] and not m[3].endswith("/"):
            stop = RAW[tag].search(html, at)  # such an element ends at its literal closing tag, else with the page
            at = stop.end() if stop else len(html)
            continue
        if skipping is not None:
            if m[1] and tag == skipping:
                skipping = None
            continue
        if tag in LEFT_OUT and not m[1]:
            if not m[3].endswith("/"):
                skipping = tag
        elif tag == "a":
            in_link = not m[1]
        elif tag in BREAKS:
            flush()
        elif tag in STRUCTURE:
            flush()
            if m[1]:
                if n_open[tag]:
                    while opened[-1][0] != tag:
                        end()
                    end()
            elif not m[3].endswith("/"):
                ends = NEVER_CLOSED.get(tag, ())
                while opened and (opened[-1][0] == "p" or opened[-1][0] in ends):
                    end()
                label = _label(tag, m[3])
                opened.append((tag, keeps(label)))
                n_open[tag] += 1
                if opened[-1][1]:
                    stack.append(_Node(label))
    if skipping is None:
        buf.append(re.sub(r"<[/a-zA-Z!][^<>]*$", "", html[at:]))  # a tag that the page's end cut off
    flush()
    while len(stack) > 1:
        close()
    kids, slots = _folded(stack[0].kids, stack[0].slots)
    return ("#root", "", tuple(kids)), blocks, links, [s for kid in slots for s in kid]


# A wrapper node is [label, quantifier, children, facts]; only slots ("#") have facts:
# [pages, characters, linked characters, smallest and largest text hash].

def _wrapper(node, facts) -> list:
    label, many, kids = node
    return [label, many, [_wrapper(k, facts) for k in kids], next(facts) if label == "#" else None]


def _optional(node: list) -> list:
    return [node[0], {"": "?", "+": "*"}.get(node[1], node[1]), node[2], node[3]]


def _either(a: str, b: str) -> str:
    many, maybe = "+" in a + b or "*" in a + b, "?" in a + b or "*" in a + b
    return {(True, True): "*", (True, False): "+", (False, True): "?", (False, False): ""}[many, maybe]


def _facts(a, b):
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])] if a else None


def align(a: list, b: list) -> list:
    """The wrapper of what either wrapper fits: matched children merge, the others become optional."""
    kids = []
    same = SequenceMatcher(None, [k[0] for k in a[2]], [k[0] for k in b[2]], autojunk=False)
    for op, i, i2, j, j2 in same.get_opcodes():
        if op == "equal":
            kids += [align(x, y) for x, y in zip(a[2][i:i2], b[2][j:j2])]
        else:
            kids += [_optional(k) for k in a[2][i:i2] + b[2][j:j2]]
    return [a[0], _either(a[1], b[1]), kids, _facts(a[3], b[3])]


def _is_furniture(label: str, in_article: bool) -> bool:
    """Whether an element is furniture by its tag or class words.

    Outside articles one furniture word will do.  Inside one the words must name nothing else than what an article
    does not consist of (``NAMED``, with ``NEUTRAL`` ones); other furniture words only make its slots suspect.
    """
    tag, *words = label.split(".")
    if not in_article:
        return tag in FURNITURE_TAGS or any(w in FURNITURE_WORDS for w in words)
    if tag in FURNITURE_TAGS and tag != "header":  # an article's header holds its title
        return True
    return any(w in NAMED for w in words) and all(w in NAMED or w in NEUTRAL for w in words)


def slots_of_wrapper(wrapper: list) -> tuple[list, list]:
    """Slots of a wrapper in order, as (path, free, semantic, changing, characters), and its containers' paths."""
    slots, regions, containers = [], [], []

    def walk(node, path, furniture, semantic, suspect):
        label = node[0]
        if label == "#":
            n, chars, linked, low, high = node[3]
            prose, changing = linked <= 0.6 * chars, n < TEMPLATE_PAGES or low != high
            free = not furniture and (prose and changing if suspect else semantic or prose)
            slots.append((path, free, semantic, free and (semantic or changing), chars))
            return
        tag = label.split(".")[0]
        furniture = furniture or _is_furniture(label, semantic)
        suspect = suspect or (semantic and any(w in FURNITURE_WORDS for w in label.split(".")[1:]))
        semantic = semantic or (not furniture and tag in REGIONS)
        here = (*path, len(regions))  # a number of its own, so a path is a prefix of its descendants'
        regions.append(here)
        if tag in CONTAINERS:
            containers.append(here)
        for k in node[2]:
            walk(k, here, furniture, semantic, suspect)
    walk(wrapper, (), False, False, False)
    return slots, containers


def main_slots(slots: list, containers: list) -> list[bool]:
    """For each of a page's slots, whether it belongs to the main text."""
    if any(s[1] and s[2] for s in slots):
        return [s[1] and s[2] for s in slots]
    total = sum(s[4] for s in slots if s[3])
    if not total:  # without any text that changes, nothing tells template from text
        slots = [(*s[:3], s[1], s[4]) for s in slots]
        total = sum(s[4] for s in slots if s[3])
    region = ()
    for r in containers:  # the deepest that still holds most of the free text
        if sum(s[4] for s in slots if s[3] and s[0][:len(r)] == r) >= REGION_SHARE * total and len(r) > len(region):
            region = r
    return [s[3] and s[0][:len(region)] == region for s in slots]


def mask(skeleton: list, wrapper: list) -> list[bool]:
    """Which of a skeleton's slots are main, by its place in its wrapper.

    A wrapper holds each of its skeletons whole and in order, and every child that is not optional in it.
    """
    slots, containers = slots_of_wrapper(wrapper)
    each, known = iter(slots), {}

    def marked(node):
        return [node[0], node[1], [marked(k) for k in node[2]], next(each) if node[0] == "#" else None]

    def fits(node, w):
        """Rows of a table: whether the children from ``i`` on fit the wrapper's from ``j`` on; None if they do not."""
        if node[0] != w[0] or (node[1] == "+" and w[1] not in ("+", "*")):
            return None
        if (id(node), id(w)) not in known:
            kids, ws = node[2], w[2]
            rows = [[False] * (len(ws) + 1) for _ in range(len(kids) + 1)]
            rows[-1][-1] = True
            for i in range(len(kids), -1, -1):
                for j in range(len(ws) - 1, -1, -1):
                    rows[i][j] = ((ws[j][1] in ("?", "*") and rows[i][j + 1])
                                  or (i < len(kids) and rows[i + 1][j + 1] and fits(kids[i], ws[j]) is not None))
            known[id(node), id(w)] = rows if rows[0][0] else None
        return known[id(node), id(w)]

    def walk(node, w):
        if node[0] == "#":
            return [w[3]]
        out, rows, j = [], fits(node, w), 0
        for i, x in enumerate(node[2]):
            while not (rows[i + 1][j + 1] and fits(x, w[2][j]) is not None):
                j += 1
            out += walk(x, w[2][j])
            j += 1
        return out
    whole = marked(wrapper)
    return main_slots(walk(skeleton, whole), containers)


def _page(html):
    skeleton, blocks, links, slots = read(html)
    s = json.dumps(skeleton, separators=(",", ":"))
    return s, xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) >> 1, blocks, links, slots


def _facts_of(html):
    s, sk, blocks, links, slots = _page(html)
    facts = [(len(" ".join(blocks[i] for i in at)), sum(links[i] for i in at),
              xxhash.xxh64_intdigest("\n".join(blocks[i] for i in at).encode("utf-8", "surrogatepass")) >> 1)
             for at in slots]
    return s, sk, [f[0] for f in facts], [f[1] for f in facts], [f[2] for f in facts]


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["n", "sk"], ascending=[False, True])
    found = json.loads(pdf["wrapper"].iat[0])
    for w in pdf["wrapper"].iloc[1:]:
        found = align(found, json.loads(w))
    return pd.DataFrame({"host": pdf["host"].iloc[:1], "b": pdf["b"].iloc[:1], "buckets": pdf["buckets"].iloc[:1],
                         "n": [int(pdf["n"].sum())], "sk": pdf["sk"].iloc[:1], "wrapper": [json.dumps(found)]})


def infer(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """``(host, sk, skeleton)`` of all pages and ``(host, wrapper)`` as JSON; pages need a ``host``."""
    read_ = written(append(pages.select("host", F.col(html).cast("string").alias("h")), "h",
                           "skeleton string, sk long, chars array<long>, linked array<long>, hash array<long>",
                           lambda: lambda hs: [list(x) for x in zip(*map(_facts_of, hs))] if hs else [[]] * 5,
                           drop=("h",)), "skeletons")
    kinds = read_.groupBy("host", "sk").agg(F.first("skeleton").alias("skeleton"), F.count(F.lit(1)).alias("n"))
    # Copies of a page are one page here: they say nothing about what changes from page to page.
    pages_ = read_.groupBy("host", "sk", "hash").agg(F.first("chars").alias("chars"), F.first("linked").alias("linked"))
    slot = pages_.select("host", "sk", F.posexplode(F.arrays_zip("chars", "linked", "hash")).alias("slot", "x"))
    facts = (slot.groupBy("host", "sk", "slot").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("x.chars").alias("chars"), F.sum("x.linked").alias("linked"),
        F.min("x.hash").alias("low"), F.max("x.hash").alias("high"))
        .groupBy("host", "sk").agg(F.to_json(F.sort_array(F.collect_list(
            F.struct("slot", "pages", "chars", "linked", "low", "high")))).alias("facts")))
    kinds = cut(kinds.join(facts, ["host", "sk"], "left"))
    n_kinds = kinds.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / FOLD).alias("buckets"))

    def start(skeletons, facts_):
        for s, f in zip(skeletons, facts_):
            each = iter([[x["pages"], x["chars"], x["linked"], x["low"], x["high"]] for x in json.loads(f or "[]")])
            yield json.dumps(_wrapper(json.loads(s), each))
    both = kinds.withColumn("both", F.array("skeleton", "facts"))
    now = append(both.select("host", "sk", "n", "both"), "both", "wrapper string",
                 lambda: lambda v: [list(start(*zip(*v)))] if v else [[]], drop=("both",))
    now = now.join(n_kinds, "host").withColumn("b", F.pmod("sk", "buckets"))
    rounds = n_kinds.agg(F.max("buckets")).first()[0] or 0
    while True:
        now = cut(now.select("host", "b", "buckets", "n", "sk", "wrapper").groupBy("host", "b").applyInPandas(
            _fold, "host string, b long, buckets long, n long, sk long, wrapper string"))
        if rounds <= 1:
            break
        rounds = -(-rounds // FOLD)
        now = now.withColumn("buckets", F.ceil(F.col("buckets") / FOLD)).withColumn("b", F.pmod("b", "buckets"))
    return kinds.select("host", "sk", "skeleton"), now.select("host", "wrapper")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Null and empty pages, and pages without main text, have an empty text; a null url counts as the empty host,
    whose pages share a wrapper; repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    pages = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"),
                         host(F.col(url)).alias("host"))
    kinds, wrappers = infer(pages)
    n = wrappers.count()
    both = (kinds.join(small(wrappers, n, 1000), "host").withColumn("both", F.array("skeleton", "wrapper")))
    masks = cut(append(both.select("host", "sk", "both"), "both", "main array<boolean>", lambda: lambda v: [
        [mask(json.loads(s), json.loads(w)) for s, w in v]], drop=("both",)))

    def slots_of(n_blocks, slots):
        out = [0] * n_blocks
        for i, at in enumerate(slots):
            for b in at:
                out[b] = i
        return out

    def read_page(htmls):
        got = [_page(h) for h in htmls]
        return [[g[1] for g in got], [g[2] for g in got], [slots_of(len(g[2]), g[4]) for g in got]]
    parsed = append(pages, "html", "sk long, blocks array<string>, slots array<int>", lambda: read_page, drop=("html",))
    found = parsed.join(small(masks, masks.count()), ["host", "sk"], "left")
    kept = F.filter("blocks", lambda b, i: F.coalesce(F.get("main", F.get("slots", i)), F.lit(False)))
    return found.select("page_id", "url", F.array_join(kept, "\n").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
