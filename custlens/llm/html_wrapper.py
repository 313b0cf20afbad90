"""HTML main-text extraction with inferred wrappers.

A wrapper is a union-free regular expression over the token stream of a host's
pages, kept in nested form: an element with the sequence of its children, each of
which may be optional or repeated, where texts are slots.  A page's own expression
folds repeated groups; expressions of one host are aligned one after the other, and
mismatches become optional or repeated groups.  What the wrapper and the texts seen
in its slots tell (the article element, or else the part that carries the varying
text; slots whose text never changes) decides which part of a page is main text.

Inside the main text, furniture goes by element or role.  A word in a class or id alone
removes nothing there: its element must hold text that is the same on the host's pages,
or be a container that is mostly links, holds controls, or bears a name of nothing but
such words (``ad-slot``, not ``related-work``) and is small or, for reader comments, last.

Only distinct expressions and sums per slot move between tasks, merged before and
after the shuffle, so a host with a third of all pages costs no task more than its
distinct expressions; wrappers meet pages in a join that Spark can split.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import importable, slices, stage, strings

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template iframe svg object textarea title select annotation "
                "annotation-xml".split())
#: Those that take the rest of the page where their end tag is missing.
TO_THE_END = frozenset(["script", "style"])
#: Elements that hold text only, none of the page's, and end with the next tag.
CHOICES = frozenset(["option", "optgroup"])
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag closes an open element of these kinds, up to a container.
CLOSES = {t: frozenset(["p"]) for t in BLOCK - frozenset("body html td th tr caption".split())} | {
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
HOLDS = frozenset("html body article main section div table ul ol dl td th blockquote nav header "
                  "footer aside form".split())
CHROME_TAGS = frozenset("nav footer aside form button menu dialog".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu "
                         "menubar alertdialog".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay nav navbar "
    "navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget widgets related "
    "recommended comment comments commentlist disqus replies respond share sharing social newsletter "
    "subscribe subscription signup login search pagination pager toolbar copyright teaser".split())
#: Names of reader comments among them, and words that only say where or in what a part stands.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
PLACE_WORDS = frozenset("area bar block bottom box container content div group holder inline inner item items left "
                        "links list main mid middle outer panel reader right section slot thread top unit user "
                        "wrap wrapper".split())
#: Elements that can hold a part of furniture inside the main text, and controls.
CONTAINERS = frozenset("center details div dl figure ins ol section table ul".split())
CONTROLS = frozenset("form input button".split())
#: Share of its text in links from which on a named container is a list of links, and share
#: of the main text up to which one by name alone is small.
LINKED, SMALL = 0.5, 0.25
#: Slots in links and list items weigh this much where the main element is searched.
LIST_WEIGHT = 0.1
#: Elements nested deeper than this leave their texts to the one that holds them.
DEEPEST = 100
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_GAP = re.compile(r"\s+")


class Node:
    """An element of a page: its label, its children, whether it is page furniture by its
    element or role (``chrome``), and what its class and id say (``named``: 0 nothing, 1 a
    word of furniture among others, 2 only such words, 3 these of reader comments)."""

    __slots__ = ("tag", "label", "chrome", "named", "items", "_size")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.label, self.chrome, self.items = tag, tag, tag in CHROME_TAGS, []
        self.named, self._size = 0, None
        if attrs:
            got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
            name = got.get("class") or got.get("id") or ""
            if name:
                self.label = f"{tag}.{re.sub(r'[0-9]+', '0', name.split()[0])[:60] if name.split() else ''}"
            if tag not in ("html", "body", "article", "main"):
                self.named = max((_kind(x) for k in ("class", "id") for x in got.get(k, "").split()), default=0)
                self.chrome |= got.get("role", "").lower() in CHROME_ROLES
            if got.get("role", "").lower() == "main" or got.get("itemprop") == "articleBody":
                self.label, self.tag, self.chrome, self.named = "main", "main", False, 0

    def nodes(self) -> Iterator[Node]:
        return (x for x in self.items if isinstance(x, Node))

    def size(self) -> int:
        """Characters of text outside furniture by element or role."""
        if self._size is None:
            self._size = 0 if self.chrome else sum(
                x.size() if isinstance(x, Node) else len(x.strip()) for x in self.items)
        return self._size


def _kind(name: str) -> int:
    words = {w.lower() for w in _WORD.findall(name)}
    if not words & CHROME_WORDS:
        return 0
    if words <= COMMENT_WORDS | PLACE_WORDS:
        return 3
    return 2 if words <= CHROME_WORDS | PLACE_WORDS else 1


def parse(page: str) -> Node:
    """The page's elements as a tree; texts as undecoded strings."""
    root = Node("#page")
    stack, at, end = [root], 0, len(page)
    flat: dict[str, int] = {}
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            stack[-1].items.append(page[at:])
            break
        if m.start() > at:
            stack[-1].items.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if flat.get(tag):
                flat[tag] -= 1
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag
                          or stack[i].label.partition(".")[0] == tag), 0)
            if depth:
                del stack[depth:]
            continue
        attrs = m[3] if m[2] else m[6]
        if tag in RAW:
            if not (attrs or "").endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if close:
                    at = close.end()
                elif tag in TO_THE_END:
                    at = end
                else:
                    # Without an end tag only the text up to the next tag is its own.
                    at = next((x.start() for x in [_TAG.search(page, at)] if x), end)
            continue
        if tag in CHOICES:
            if not (attrs or "").endswith("/"):
                at = next((x.start() for x in [_TAG.search(page, at)] if x), end)
            continue
        closes = CLOSES.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closes:
                del stack[i:]
                break
            if stack[i].tag in HOLDS:
                break
        node = Node(tag, attrs or "")
        stack[-1].items.append(node)
        if tag not in VOID and not (attrs or "").endswith("/"):
            if len(stack) < DEEPEST:
                stack.append(node)
            else:
                flat[tag] = flat.get(tag, 0) + 1
    return root


# -- expressions ----------------------------------------------------------------
# An expression is [label, children, optional, repeated]; a slot's label is "#", a
# group's starts with "(" and its children are the group's sequence.

def expression(node: Node) -> list:
    items = []
    for x in node.items:
        if isinstance(x, Node):
            items.append(expression(x))
        elif not x.isspace():
            items.append(["#", [], False, False])
    return [node.label, fold(items), False, False]


def merge(a: list, b: list) -> list:
    """One expression for what either of two with the same label stands for."""
    return [a[0], align(a[1], b[1]), a[2] or b[2], a[3] or b[3]]


def align(a: list[list], b: list[list]) -> list[list]:
    """Align two sequences by label; what only one has becomes optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [merge(x, y) for x, y in zip(a, b, strict=True)]
    # Longest common subsequence of labels.
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i, j] = best[i + 1, j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1, j], best[i, j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1, j] >= best[i, j + 1]:
            out.append([a[i][0], a[i][1], True, a[i][3]])
            i += 1
        else:
            out.append([b[j][0], b[j][1], True, b[j][3]])
            j += 1
    return fold(out)


def fold(items: list[list], longest: int = 4) -> list[list]:
    """Resolve squares: equal neighbouring groups of up to ``longest`` items become one
    repeated group."""
    for size in range(1, longest + 1):
        out: list[list] = []
        i = 0
        while i < len(items):
            group = items[i:i + size]
            labels = [x[0] for x in group]
            j = i + size
            while len(group) == size and [x[0] for x in items[j:j + size]] == labels:
                group = [merge(x, y) for x, y in zip(group, items[j:j + size], strict=True)]
                j += size
            if j > i + size:
                if size == 1:
                    out.append([labels[0], group[0][1], group[0][2], True])
                else:
                    out.append(["(" + " ".join(labels) + ")", group, False, True])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


# -- what the wrapper says about a host's pages ---------------------------------

def slots(node: Node, path: str = "", named: bool = False) -> Iterator[tuple[str, str]]:
    """(path of labels, text) of the texts outside page furniture; below elements with a
    name of furniture, paths begin with ``!``."""
    path = f"{path}/{node.label}"
    named |= node.named > 0
    for x in node.items:
        if isinstance(x, Node):
            if not x.chrome:
                yield from slots(x, path, named)
        elif not x.isspace():
            yield "!" + path if named else path, x


def _find(wrapper: list, label: str, path: str = "") -> list[str]:
    """Paths of the topmost elements of a kind."""
    own = path if wrapper[0].startswith("(") else f"{path}/{wrapper[0]}"
    if wrapper[0].partition(".")[0] == label:
        return [own]
    return [p for x in wrapper[1] for p in _find(x, label, own)]


def _repeated(wrapper: list, path: str = "", inside: bool = False) -> set[str]:
    """Paths of the elements that are repeated, themselves or in a group."""
    if wrapper[0].startswith("("):
        return {p for x in wrapper[1] for p in _repeated(x, path, True)}
    own = f"{path}/{wrapper[0]}"
    out = {own} if inside or wrapper[3] else set()
    return out.union(*(_repeated(x, own) for x in wrapper[1]))


def main_paths(wrapper: list, mass: dict[str, float]) -> list[str]:
    """Paths of the elements that hold the main text.  ``mass``: characters of varying
    text by slot path."""
    for label in ("article", "main"):
        got = [p for p in _find(wrapper, label) if any(s == p or s.startswith(p + "/") for s in mass)]
        if got:
            return sorted(set(got))
    # Go down while one child, not one of a row of like ones, carries most varying text.
    mass = {s: n * (LIST_WEIGHT if {x.partition(".")[0] for x in s.split("/")} & {"a", "li"} else 1)
            for s, n in mass.items()}
    path, total, rows = "", sum(mass.values()), _repeated(wrapper)
    while total:
        below: dict[str, float] = {}
        for s, n in mass.items():
            if s.startswith(path + "/"):
                step = path + "/" + s[len(path) + 1:].split("/")[0]
                below[step] = below.get(step, 0) + n
        step = max(below, key=lambda p: (below[p], p), default="")
        if not step or step in rows or below[step] < 0.6 * total or step.rsplit("/", 1)[1].partition(".")[0] in (
                "p", "li", "span", "b", "i", "em", "strong", "a", *HEADINGS):
            break
        if 2 * mass.get(step, 0) > below[step] and path.rsplit("/", 1)[-1] not in ("", "#page", "html") and (
                path.rsplit("/", 1)[-1].partition(".")[0] != "body"):
            # Its text is its own: one of the paragraphs of the element around.
            break
        path, total = step, below[step]
    return [path] if path else []


def describe(wrapper: list, stats: dict[str, tuple[float, int, int, int]]) -> dict:
    """The rule for a host: main paths, and slots whose text never varies.  ``stats``: by
    slot path, characters, pages that differ in other slots, and the least and greatest
    hash of its texts."""
    own = {p: c for p, (c, *_) in stats.items() if p[0] != "!"}
    varying = {p: c for p, c in own.items() if stats[p][2] != stats[p][3]}
    fixed = sorted(p for p, (_, n, lo, hi) in stats.items() if lo == hi and n >= LEAST_PAGES)
    return {"main": main_paths(wrapper, varying or own), "fixed": fixed}


def _is_furniture(node: Node, above: str, fixed: set[str], whole: int, last: bool) -> bool:
    """Whether an element with a name of furniture is it, inside the main text.  ``above``:
    its parent's path; ``whole``: characters of the main element; ``last``: no text of its own follows there."""
    if node.tag in BLOCK or node.tag in CONTAINERS:
        own = {p for p, _ in slots(node, above, True)}
        if own and own <= fixed:
            return True
    if node.tag not in CONTAINERS:
        return False
    size = node.size()

    def linked(x: Node) -> int:
        return x.size() if x.tag == "a" else sum(map(linked, x.nodes()))

    small = size <= SMALL * whole
    return (linked(node) >= LINKED * size > 0 or small and (node.named > 1 or _has(node, CONTROLS))
            or node.named == 3 and last)


def _has(node: Node, tags) -> bool:
    return any(x.tag in tags or _has(x, tags) for x in node.nodes())


def extract(root: Node, rule: dict) -> str | None:
    """Main text by a rule; None where the page has none of its main elements."""
    main, fixed = set(rule["main"]), set(rule["fixed"])
    inside_article = any(p.rsplit("/", 1)[1].partition(".")[0] in ("article", "main") for p in main)
    blocks: list[str] = []
    run: list[str] = []
    found = False

    def flush():
        text = _GAP.sub(" ", htmllib.unescape("".join(run))).strip()
        if text:
            blocks.append(text)
        run.clear()

    def walk(node: Node, path: str, whole: int, last: bool):
        """``whole``: characters of the main element around (0: none, 1: the page)."""
        nonlocal found
        above, path = path, f"{path}/{node.label}"
        if path in main and not whole:
            found, last = True, True
            # The whole page is no main element: names count as outside one.
            whole = 1 if node.tag in ("#page", "html", "body") else 2 + node.size()
        if node.chrome and not _has(node, ("article", "main")):
            return
        if node.named and path not in main and not _has(node, ("article", "main")) and (
                whole < 2 or _is_furniture(node, above, fixed, whole, last)):
            return
        if node.tag == "header" and not (whole and _has(node, HEADINGS)):
            return
        block = node.tag in BLOCK
        if block:
            flush()
        if node.tag == "br" and whole:
            run.append(" ")
        rest = sum(_own(x) for x in node.items) if whole and last else 0
        for x in node.items:
            if whole and last:
                rest -= _own(x)
            if isinstance(x, Node):
                walk(x, path, whole, last and not rest)
            elif whole and (inside_article or path not in fixed):
                run.append(x)
        if block:
            flush()

    walk(root, "", 0, False)
    flush()
    return "\n".join(blocks) if found else None


def _own(x: Node | str) -> int:
    """Characters of a child that are the main element's own, by its name."""
    return (0 if x.named else x.size()) if isinstance(x, Node) else len(x.strip())


#: Pages with different texts from which on a slot counts as fixed.
LEAST_PAGES = 3


def _stats(root: Node, into: dict[str, tuple]) -> None:
    """Add a page to the sums by slot path: characters, the hashes of up to LEAST_PAGES
    pages with different texts (copies count once), and the least and greatest hash of
    the slot's texts."""
    import hashlib
    import zlib
    seen: dict[str, list] = {}
    for path, text in slots(root):
        seen.setdefault(path, []).append(text.strip())
    own = "\x01".join("\x00".join([p, *t]) for p, t in sorted(seen.items()) if p[0] != "!")
    page = int.from_bytes(hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)
    for path, texts in seen.items():
        h = zlib.crc32("\x00".join(texts).encode("utf-8", "surrogatepass"))
        n = sum(map(len, texts))
        old = into.get(path)
        if old:
            pages = old[1] if page in old[1] or len(old[1]) >= LEAST_PAGES else (*old[1], page)
            into[path] = old[0] + n, pages, min(old[2], h), max(old[3], h)
        else:
            into[path] = n, (page,), h, h


def extract_page(page: str, rule: dict | None) -> str:
    """Main text of a page; one that its host's rule doesn't fit, or of which fixed slots
    leave nothing, is read by its own expression."""
    root = parse(page)
    text = extract(root, rule) if rule and rule["main"] else None
    if text is None or not text and rule["fixed"] and extract(root, {**rule, "fixed": []}):
        stats: dict[str, tuple] = {}
        _stats(root, stats)
        own = describe(expression(root), {p: (n, len(ids), lo, hi) for p, (n, ids, lo, hi) in stats.items()})
        text = extract(root, own) if own["main"] else None
    return text or ""


# -- Spark ------------------------------------------------------------------------

def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, expression) without path, and slot sums with it, each once per slice; the
    first of a slot's pages has its characters."""
    for part in slices(batches, "html"):
        facts: dict[str, tuple[set, dict]] = {}
        for host, page in zip(part.column("host").to_pylist(),
                              strings(part.column("html")).to_pylist(), strict=True):
            if page:
                seen, stats = facts.setdefault(host, (set(), {}))
                root = parse(page)
                seen.add(json.dumps(expression(root), separators=(",", ":")))
                _stats(root, stats)
        rows = [(h, None, e, 0, 0, 0, 0) for h, (seen, _) in facts.items() for e in sorted(seen)]
        rows += [(h, p, None, 0 if k else n, x, lo, hi) for h, (_, stats) in facts.items()
                 for p, (n, ids, lo, hi) in stats.items() for k, x in enumerate(ids)]
        if rows:
            host, path, expr, chars, page, least, most = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(expr, pa.string()),
                 pa.array(np.array(chars, float)), *(pa.array(x, pa.int64()) for x in (page, least, most))],
                names=["host", "path", "expression", "chars", "page", "least", "most"])


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host to one wrapper for each run of a host; holds one wrapper."""
    host, wrapper, out = None, None, []

    def batch():
        h, w = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(w, pa.string())],
                                          names=["host", "expression"])

    for part in batches:
        for h, e in zip(part.column("host").to_pylist(), part.column("expression").to_pylist(), strict=True):
            if h != host or wrapper is None:
                if wrapper is not None:
                    out.append((host, json.dumps(wrapper, separators=(",", ":"))))
                host, wrapper = h, json.loads(e)
            else:
                wrapper = merge(wrapper, json.loads(e))
        if out:
            yield batch()
    if wrapper is not None:
        out.append((host, json.dumps(wrapper, separators=(",", ":"))))
        yield batch()


#: Parts in which the expressions of one host are aligned before their wrappers meet.
PARTS = 8


def wrappers(pages: DataFrame) -> DataFrame:
    """host, expression: the wrapper of each host; and its rule for main text."""
    spark = pages.sparkSession
    facts = spark.read.parquet(stage(pages.select("host", "html").mapInArrow(
        _learn, "host string, path string, expression string, chars double, page long, least long, most long"),
        "pages"))
    own = facts.where(F.col("path").isNull()).select("host", "expression").distinct()
    part = F.pmod(F.xxhash64("expression"), F.lit(PARTS))
    schema = "host string, expression string"
    some = own.withColumn("part", part).repartition("host", "part").sortWithinPartitions(
        "host", "part", "expression").select("host", "expression").mapInArrow(_merge_runs, schema)
    whole = some.distinct().repartition("host").sortWithinPartitions("host", "expression").mapInArrow(
        _merge_runs, schema)
    by_page = facts.where(F.col("path").isNotNull()).groupBy("host", "path", "page").agg(
        F.sum("chars").alias("chars"), F.min("least").alias("least"), F.max("most").alias("most"))
    # Below LEAST_PAGES, all pages of a slot are there: the count says whether it gets so far.
    sums = by_page.groupBy("host", "path").agg(
        F.sum("chars").alias("chars"), F.count("page").alias("pages"),
        F.min("least").alias("least"), F.max("most").alias("most"))
    # One entry per slot path: as many as a host's pages have different paths.
    by_host = sums.groupBy("host").agg(F.sort_array(F.collect_list(
        F.struct("path", "chars", "pages", "least", "most"))).alias("slots"))

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for e, s in zip(b.column("expression").to_pylist(), b.column("slots").to_pylist(), strict=True):
                stats = {x["path"]: (x["chars"], x["pages"], x["least"], x["most"]) for x in s or []}
                out.append(json.dumps(describe(json.loads(e), stats)))
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("expression"), pa.array(out, pa.string())],
                names=["host", "expression", "rule"])

    return whole.join(by_host, "host", "left").mapInArrow(
        rules, "host string, expression string, rule string")


def with_host(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty html, and a page without main text, give an empty text.  Pages
    without a host (also null urls) share the wrapper of the empty host.  Null ids stay;
    repeated rows give repeated results.
    """
    importable(pages.sparkSession)
    rows = with_host(pages)
    rules = pages.sparkSession.read.parquet(stage(wrappers(rows).select("host", "rule"), "wrappers"))
    text = F.pandas_udf(_texts, "string")
    joined = rows.join(rules.hint("merge"), "host", "left")
    out = joined.select("page_id", "url", text("html", "rule").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def _texts(html: pd.Series, rule: pd.Series) -> pd.Series:
    known: dict = {None: None}
    out = []
    for page, r in zip(html, rule, strict=True):
        if r not in known:
            known[r] = json.loads(r)
        out.append(extract_page(page, known[r]) if page else "")
    return pd.Series(out, dtype=object)
