"""Main text of HTML pages by wrapper induction.

Pages become small DOM trees: one node per path of block elements, siblings of one label (tag and classes) are one
node. Per host the commonest tree is the reference, and every other tree of the host is aligned with it by simple tree
matching (Yang, 1991). The texts of aligned nodes are counted over all pages of the host, and over all hosts along the
commonest tree of all. A node is constant and belongs to the template if nearly all pages have the same texts there; a
node whose texts vary is a slot that holds content. A text counts once per page, and pages whose smallest text hash is
the same count as one, so that repeats in a page count once, a group of copies once and one of near copies a few times.
Where a host has too few such pages, the other hosts decide; a node in an article or main element that varies on other
hosts is no template either. Elements that are never article text by their tag or
class (menus, footers, adverts, forms, reader comments and the like) are left out of the slots, and in a page with an
article or main element everything outside of it. Names count as whole class tokens, not on html, body, main and
article nor on what is around the first article, and if they would empty a page they do not count on it.

Trees are aligned once per distinct pair, not once per page. Texts are counted as hashes, combined before each
shuffle; no host's pages meet in one task. A page all of whose slots look constant, as on a host that holds copies of
one page only, keeps them. Character references are decoded, white space inside a block is one space, blocks are
joined by a line break.

A tag's name begins with a letter and goes on with letters, digits and ``_ : . -``; any other ``<`` is text, as is a
tag that no ``>`` ends. Pages may be nested to any depth and be of any length; a page is read in one pass.

A null or empty html gives an empty text, a null url an empty host. Null ids stay null; rows that repeat are extracted
one by one. Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import written

#: A node is constant if at least so many pages have it, and texts that fewer than the rest of this share of them have
#: are at most this share of the pages.
LEAST_TEXTS = 8
CONSTANT_SHARE = 0.2
#: Hosts that must tell the same of a node for hosts with fewer pages.
LEAST_HOSTS = 2

#: Text, a tag without angle brackets in its attributes, or the begin of another tag, a comment or a declaration.
_TOKEN = re.compile(
    r"[^<]+|<(/?)([a-zA-Z][\w:.-]*+)(?=[\s/>])(?:([^<>\"']*+(?:\"[^\"<>]*+\"[^<>\"']*+|'[^'<>]*+'[^<>\"']*+)*+)>)?|<!--|<[!?]|<",
    re.ASCII,
)
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)
#: Fixed names of the HTML standard.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe svg".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_CLOSES = {  # a start tag on the left ends an open element on the right
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
_NEVER_TAGS = set("head nav footer aside form button select dialog menu object audio video canvas".split())
#: Names of what is no article text, as whole words of class, id or role; also several of them, or with words of layout.
_NEVER_WORD = (
    r"(?:nav|navbar|navigation|menu|breadcrumbs?|footer|sidebar|side|ads?|advert\w*+|sponsor\w*+|promo\w*+|"
    r"banner|cookies?|consent|notice|popup|modal|comments?|replies|respond|disqus|share|sharing|social|related|"
    r"recommend\w*+|newsletter|subscribe|subscription|login|search|widget|pagination|pager|toolbar|masthead|"
    r"contentinfo|complementary|skip)"
)
_LAYOUT_WORD = r"(?:site|main|top|bottom|area|container|wrapper|wrap|box|block|bar|list|links?|buttons?|posts|section|form)"
_NEVER_NAME = re.compile(
    rf"(?:^|\s)(?:{_LAYOUT_WORD}[_-]+)*{_NEVER_WORD}(?:[_-]+(?:{_NEVER_WORD}|{_LAYOUT_WORD}))*(?:$|\s)", re.I
)
#: Elements that hold the article whatever their names are.
_HOLDERS = {"html", "body", "main", "article"}
#: How surely a block is no article text: not at all, by a name or a form around it, by its tag.
_BY_NAME, _BY_TAG = 1, 2


class Node:
    __slots__ = ("label", "children", "number")

    def __init__(self, label: str):
        self.label, self.children, self.number = label, {}, -1

    def child(self, label: str) -> Node:
        return self.children.setdefault(label, Node(label))


def _label(tag: str, attributes: str) -> tuple[str, int]:
    """Label of a node and whether its tag or its names say that it is no article text (0, _BY_NAME or _BY_TAG)."""
    names = {}
    if "=" in attributes:
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    never = 0
    if tag in _NEVER_TAGS:
        never = _BY_NAME if tag == "form" else _BY_TAG  # some sites wrap whole pages in a form
    elif tag not in _HOLDERS and any(_NEVER_NAME.search(name) for name in names.values()):
        never = _BY_NAME
    classes = ".".join(sorted(re.sub(r"[\d(),]+", "", names.get("class", "")).split()))
    return (f"{tag}.{classes}" if classes else tag), never


class _Ends:
    """Where the tags of a page end: at the first ``>`` outside of quotes.

    A tag whose quotes do not pair, and every tag up to its unpaired quote, ends at the first ``>`` instead. So no
    part of a page is searched for quotes twice, and a page without a further ``>`` is known as such.
    """

    def __init__(self, page: str):
        self._page, self._last, self._unpaired = page, page.rfind(">"), -1

    def after(self, position: int) -> int:
        """Index of the ``>`` that ends the tag or declaration whose attributes begin here; -1 if there is none."""
        page = self._page
        if position > self._last:
            return -1
        at = position
        while at >= self._unpaired:
            at = _UNQUOTED.match(page, at).end()
            if page[at : at + 1] == ">":
                return at
            close = page.find(page[at], at + 1) if at < len(page) else -1
            if close < 0:
                self._unpaired = at + 1
            else:
                at = close + 1
        return page.find(">", position)

    def plain(self, position: int) -> int:
        return -1 if position > self._last else self._page.find(">", position)


def blocks_of(page: str) -> tuple[Node, list[tuple[Node, int, bool, str]]]:
    """The tree of a page and its blocks of text: node, whether it is never article text, whether in an article."""
    root = Node("")
    blocks: list[tuple[Node, int, bool, str]] = []
    # open elements: tag, node (that of the nearest block), never, inside an article
    stack: list[tuple[str, Node, int, bool]] = [("", root, 0, False)]
    held = False  # whether an article or main element has begun
    parts: list[str] = []
    owner = stack[0]
    opened: defaultdict[str, int] = defaultdict(int)  # open elements by tag
    ends = _Ends(page)

    def ended() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((owner[1], owner[2], owner[3], text))

    def close(at: int) -> None:
        breaks = False
        for element in stack[at:]:
            opened[element[0]] -= 1
            breaks = breaks or element[0] not in _INLINE
        if breaks:
            ended()
        del stack[at:]

    position, size = 0, len(page)
    while position < size:
        match = _TOKEN.match(page, position)
        token, slash, tag, attributes = match.group(0, 1, 2, 3)
        position = match.end()
        if token == "<!--":
            end = page.find("-->", position)
            position = size if end < 0 else end + 3
            continue
        if attributes is None:
            end = -1
            if tag:
                end = ends.after(position)
            elif token in ("<!", "<?"):
                end = ends.plain(position)
            if end < 0:  # text, or a tag without an end, which is text as well
                if not parts or owner[1:3] != stack[-1][1:3]:
                    ended()
                    owner = stack[-1]
                parts.append(token)
                continue
            attributes, position = page[position:end], end + 1
        if tag:
            tag = tag.lower()
            if slash:
                if opened[tag]:
                    for at in range(len(stack) - 1, 0, -1):
                        if stack[at][0] == tag:
                            close(at)
                            break
                continue
            if tag in _RAW:
                end = re.compile(f"</{tag}[\\s/>]", re.I).search(page, position)
                position = size if end is None else page.find(">", end.start()) + 1 or size
                continue
            if tag in _VOID:
                if tag not in _INLINE:
                    ended()
                parts.append(" ")
                continue
            if tag not in _INLINE:
                ended()
                closes, scopes = _CLOSES.get(tag, ()), _SCOPES.get(tag, ())
                if opened["p"] or any(opened[t] for t in closes):
                    for at in range(len(stack) - 1, 0, -1):
                        open_tag = stack[at][0]
                        if open_tag in scopes:
                            break
                        if open_tag == "p" or open_tag in closes:
                            close(at)
                            break
            if tag in ("article", "main") and not held:  # names around the first of them tell nothing
                held = True
                stack[:] = [(t, n, 0 if v == _BY_NAME else v, i) for t, n, v, i in stack]
            _, node, never, inside = stack[-1]
            label, own = _label(tag, attributes)
            if tag == "header" and not inside:
                own = _BY_TAG
            if tag not in _INLINE:
                node = node.child(label)
            elif own > never:
                ended()
            inside = inside or tag in ("article", "main")
            stack.append((tag, node, max(never, own), inside))
            opened[tag] += 1
    ended()
    return root, blocks


def signature_of(root: Node) -> str:
    """The tree as text; numbers the nodes in preorder."""
    parts, number, left = [], 0, [iter([root])]
    while left:
        node = next(left[-1], None)
        if node is None:
            left.pop()
            if left:
                parts.append(")")
            continue
        node.number = number
        number += 1
        parts += [node.label, "("]
        left.append(iter(node.children.values()))
    return "".join(parts)


def tree_of(signature: str) -> Node:
    root, stack, number = Node(""), [], 0
    for label, mark in re.findall(r"([^()]*)([()])", signature):
        if mark == ")":
            stack.pop()
            continue
        node = stack[-1].child(label) if stack else root
        node.number = number
        number += 1
        stack.append(node)
    return root


def matched(reference: Node, other: Node) -> dict[int, int]:
    """Simple tree matching: number of a node of ``other`` -> number of the node of ``reference`` it is aligned with."""
    if reference.label != other.label:
        return {}
    pairs = [(reference, other)]  # siblings have different labels, so a node can only be aligned with one other
    for a, b in pairs:
        pairs += [(x, b.children[x.label]) for x in a.children.values() if x.label in b.children]
    scores, chosen = {}, {}
    for a, b in reversed(pairs):
        first, second = list(a.children.values()), list(b.children.values())
        best = [[0] * (len(second) + 1) for _ in range(len(first) + 1)]
        for i, x in enumerate(first, 1):
            for j, y in enumerate(second, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1])
                if x.label == y.label:
                    best[i][j] = max(best[i][j], best[i - 1][j - 1] + scores[y.number])
        taken, i, j = [], len(first), len(second)
        while i and j:
            x, y = first[i - 1], second[j - 1]
            if x.label == y.label and best[i][j] == best[i - 1][j - 1] + scores[y.number]:
                taken.append((x, y))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        scores[b.number], chosen[b.number] = best[-1][-1] + 1, taken
    aligned, left = {}, [(reference, other)]
    while left:
        a, b = left.pop()
        aligned[b.number] = a.number
        left += chosen[b.number]
    return aligned


_BLOCK = pa.struct([("node", pa.int32()), ("never", pa.int8()), ("inside", pa.bool_()), ("text", pa.string())])
_PARSED = "id {id}, url string, host string, signature string, blocks array<struct<node:int,never:tinyint,inside:boolean,text:string>>"


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, signatures, blocks = [], [], []
        for url, page in zip(batch.column("url"), batch.column("html"), strict=True):
            host = _HOST.match(url.as_py() or "")
            hosts.append(host[1].lower() if host else "")
            root, found = blocks_of(page.as_py() or "")
            signatures.append(signature_of(root))
            blocks.append([{"node": n.number, "never": v, "inside": a, "text": t} for n, v, a, t in found])
        arrays = [batch.column("id"), batch.column("url"), pa.array(hosts, pa.string())]
        arrays += [pa.array(signatures, pa.string()), pa.array(blocks, pa.list_(_BLOCK))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "url", "host", "signature", "blocks"])


def parsed(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """id, url, host, signature (of the tree), tree (its hash), blocks of every page."""
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_parsed, _PARSED.format(id=kind)).withColumn("tree", F.xxhash64("signature"))


def _aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["host", "tree", "node", "slot", "common_slot"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            tree = tree_of(row["signature"])
            slots = matched(tree_of(row["reference"]), tree)
            common = matched(tree_of(row["common"]), tree)
            rows += [(row["host"], row["tree"], n, slots.get(n), common.get(n)) for n in slots.keys() | common.keys()]
        if rows:
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def _article() -> Column:
    """The blocks that can be text of the article, before the template is taken away."""
    blocks = F.filter("blocks", lambda b: b["never"] == 0)
    unnamed = F.filter("blocks", lambda b: b["never"] <= _BY_NAME)
    blocks = F.when(F.size(blocks) > 0, blocks).otherwise(unnamed)  # names and forms never empty a page
    return F.when(F.exists(blocks, lambda b: b["inside"]), F.filter(blocks, lambda b: b["inside"])).otherwise(blocks)


def _judged(texts: DataFrame, nodes: DataFrame, *slot: str) -> DataFrame:
    """slot, constant of the slots that enough pages have; texts have df, nodes have total (of df) and pages."""
    counts = nodes.where(F.col(slot[-1]).isNotNull()).groupBy(*slot)
    counts = counts.agg(F.sum("total").alias("total"), F.sum("pages").alias("pages")).where(F.col("pages") >= LEAST_TEXTS)
    frequent = texts.groupBy(*slot, "text").agg(F.sum("df").alias("df")).where(F.col("df") >= (1 - CONSTANT_SHARE) * LEAST_TEXTS)
    frequent = frequent.join(counts, list(slot)).where(F.col("df") >= (1 - CONSTANT_SHARE) * F.col("pages"))
    frequent = frequent.groupBy(*slot).agg(F.sum("df").alias("same"))
    varying = F.col("total") - F.coalesce("same", F.lit(0))
    return counts.join(frequent, list(slot), "left").select(*slot, (varying <= CONSTANT_SHARE * F.col("pages")).alias("constant"))


def _counted(texts: DataFrame, *node: str) -> tuple[DataFrame, DataFrame]:
    """(node, text, df) and (node, total, pages, inside) of distinct (node, text, page)."""
    by_text = texts.groupBy(*node, "text").agg(F.count(F.lit(1)).alias("df"), F.max("inside").alias("inside"))
    totals = by_text.groupBy(*node).agg(F.sum("df").alias("total"), F.max("inside").alias("inside"))
    pages = texts.groupBy(*node, "page").agg(F.lit(1).alias("one")).groupBy(*node).agg(F.count(F.lit(1)).alias("pages"))
    return by_text.drop("inside"), totals.join(pages, list(node))


def induced(pages: DataFrame) -> DataFrame:
    """host, tree, template (the constant nodes) for every kind of tree on every host, from parsed pages."""
    told = pages.select(
        "host", "tree", F.transform(_article(), lambda b: F.struct(b["node"].alias("node"), b["inside"].alias("inside"), F.xxhash64(b["text"]).alias("text"))).alias("told")
    )
    told = told.withColumn("page", F.array_min(F.transform("told", lambda b: b["text"])))
    texts = told.select("host", "tree", "page", F.inline(F.array_distinct("told")))
    texts = texts.groupBy("host", "tree", "node", "text", "page").agg(F.max("inside").alias("inside"))
    texts = written(texts, "texts")
    by_text, nodes = (written(df, "nodes") for df in _counted(texts, "host", "tree", "node"))
    signatures = pages.groupBy("tree").agg(F.max("signature").alias("signature"))
    trees = written(nodes.groupBy("host", "tree").agg(F.max("pages").alias("n")).join(signatures, "tree"), "trees")
    largest = F.max_by("signature", F.struct("n", "tree"))
    references = trees.groupBy("host").agg(largest.alias("reference"))
    alike = trees.groupBy("tree").agg(F.max("signature").alias("signature"), F.sum("n").alias("n"))
    common = alike.agg(largest.alias("common")).first()["common"] or "()"
    pairs = trees.join(references, "host").select("host", "tree", "signature", "reference")
    pairs = pairs.withColumn("common", F.lit(common))
    slots = written(pairs.mapInArrow(_aligned, "host string, tree long, node int, slot int, common_slot int"), "slots")
    node = ["host", "tree", "node"]
    by_text, nodes = by_text.join(slots, node), written(nodes.join(slots, node), "aligned")

    here = _judged(by_text, nodes, "host", "slot").withColumnRenamed("constant", "here")
    verdicts = _judged(by_text, nodes, "host", "common_slot").groupBy("common_slot")
    share = F.avg(F.col("constant").cast("int"))
    verdicts = verdicts.agg(F.count(F.lit(1)).alias("hosts"), share.alias("share"))
    # pages that several hosts have count once
    shared = slots.select("tree", "node", "common_slot").distinct()
    all_texts, all_nodes = (
        df.join(shared, ["tree", "node"]) for df in _counted(texts.drop("host").distinct(), "tree", "node")
    )
    everywhere = _judged(all_texts, all_nodes, "common_slot").withColumnRenamed("constant", "everywhere")
    others_agree = F.coalesce(F.col("share"), F.lit(1.0)) >= 1 - CONSTANT_SHARE
    by_others = others_agree & (F.coalesce("everywhere", F.lit(False)) | (F.coalesce("hosts", F.lit(0)) >= LEAST_HOSTS))
    found = nodes.join(here, ["host", "slot"], "left").join(verdicts, "common_slot", "left")
    found = found.join(everywhere, "common_slot", "left")
    constant = F.when(F.col("here").isNull(), by_others).otherwise(F.col("here") & (~F.col("inside") | others_agree))
    return found.where(constant).groupBy("host", "tree").agg(F.collect_set("node").alias("template"))


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """id, url, text, n_chars of every page. ``blocks`` can be told from the text: one per line."""
    rows = parsed(pages, id_column, url_column, html_column)
    wrappers = written(induced(rows), "wrappers")
    rows = rows.drop("signature").join(wrappers, ["host", "tree"], "left")
    template = F.coalesce("template", F.array().cast("array<int>"))
    slots = F.filter("article", lambda b: ~F.array_contains("known", b["node"]))
    kept = F.when(F.size(slots) > 0, slots).otherwise(F.col("article"))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    rows = rows.select("id", "url", _article().alias("article"), template.alias("known")).select("id", "url", text.alias("text"))
    return rows.select(
        F.col("id").alias(id_column), F.col("url").alias(url_column), "text", F.length("text").cast("long").alias("n_chars")
    )
