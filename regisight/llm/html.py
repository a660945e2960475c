"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every block element is a node with a label, content or not. The joint weight of a page's labels is a product of
node potentials (what is seen of the node, given its label) and parent-child potentials (the label given the
parent's). Sum-product messages go up from the leaves and down from the root, which gives each node's exact
marginal; its own text is kept where content is likelier. Inline elements belong to the block around them, so a
link or a bold word never splits a sentence.

The potentials are smoothed counts over labelled pages: all pages whose markup names one article label
themselves (inside the article and not inside a menu, form or the like), and so do the few EXAMPLES, which show
what real tables may lack. Counting is a Spark aggregation over all of them; the model is a table of bounded size,
as its keys are pairs of a few kinds and buckets. A single node potential is limited to CLIP in log odds, so that
a paragraph in a notice isn't kept just because paragraphs mostly are.

Defined results: a null or empty html gives an empty text with 0 characters; a page that is one block of any
length is handled whole; unclosed, misnested and unknown tags never fail; a bare < is text; white space is
Unicode's; repeated rows are handled each by itself; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+>|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>|<(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z][^>]*+>",
    re.S | re.I)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Elements by their role in HTML.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILER = set("head nav header footer aside form menu dialog button select fieldset iframe object".split())
CLOSED_BY = {"p": set("p h1 h2 h3 h4 h5 h6 div ul ol dl table section article aside nav header footer main form pre blockquote hr figure fieldset address details".split()),
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
KINDS = {t: k for k, ts in {"article": "article main", "heading": "h1 h2 h3 h4 h5 h6", "paragraph": "p blockquote pre figure figcaption dd dt", "list": "ul ol dl", "item": "li",
                            "table": "table tbody thead tr td th", "page": "html body", "container": "div section center"}.items() for t in ts.split()}
#: Words of class, id and role names.
BOILER_NAMES = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice alert popup modal overlay sidebar menu nav navbar navigation breadcrumb "
                   "breadcrumbs header masthead footer comment comments disqus reply replies respond related recommended share sharing social subscribe newsletter signup login form search widget pagination pager "
                   "toolbar tags legal copyright disclaimer complementary contentinfo".split())
CONTENT_NAMES = set("article content post entry story main text body".split())
CLIP, BACK_OFF = 1.5, 2.0

#: Labelled example pages.
EXAMPLES = tuple(f"<html><body>{a}<div>{b}</div>{c}</body></html>" for a, b, c in (
    ("<header><h1>Name</h1><p>motto of the site</p></header>", "<article><h1>Head</h1><p>some text</p><ul><li>point</li></ul><div><p>more</p></div></article>", "<footer><p>rights</p></footer>"),
    ("<div class='notice'><p>we use these</p></div>", "<main><h2>Head</h2><p>some text</p><section><h3>Part</h3><p>more</p></section></main>", "<aside><h3>See</h3><p>other</p></aside>"),
    ("<nav><ul><li>one</li></ul></nav><form><p>name</p></form>", "<div id='content'><h1>Head</h1><p>some text</p><blockquote>said</blockquote><table><tr><td>1</td></tr></table></div>", "<section class='comments'><h3>Replies</h3><div><p>nice</p></div></section>"),
    ("<nav>menu</nav>", "<article><nav><ul><li>top</li></ul></nav><h1>Head</h1><p>some text</p><form>name<p>mail</p></form><aside>see</aside><form>find</form><footer>by</footer><div class='share'>post</div></article>", "<form><p>mail</p></form>"),
    ("<div class='sidebar'><h3>More</h3><p>other text of some length here</p><ul><li>x</li></ul></div>", "<article><header><p>by</p></header><p>some text</p><div class='advert'><p>buy</p></div></article>", "<div class='footer'><p>end</p></div>"),
))


@dataclass
class Node:
    parent: int
    kind: str
    name: str
    boiler: bool
    tag: str
    parts: list[str] = field(default_factory=list)
    chars: int = 0
    link_chars: int = 0


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes, parents first, and the blocks of text (node, raw text) in page order."""
    nodes = [Node(-1, "page", "none", False, "")]
    open_: list[tuple[str, int]] = [("", 0)]  # open elements and the block node that holds their text
    blocks: list[tuple[int, list[str]]] = []
    links = 0
    fresh = True

    def text(raw: str) -> None:
        nonlocal fresh
        at = open_[-1][1]
        if not raw:
            return
        if fresh or not blocks or blocks[-1][0] != at:
            blocks.append((at, []))
            fresh = False
        blocks[-1][1].append(raw)
        n = len(raw.split()) and len(raw.strip())
        nodes[at].chars += n
        nodes[at].link_chars += n if links else 0

    def close(k: int) -> None:
        nonlocal links, fresh
        while len(open_) > k:
            tag, _ = open_.pop()
            links -= tag == "a"
            fresh = fresh or tag not in INLINE

    done = 0
    for m in TOKEN.finditer(page):
        text(page[done : m.start()])
        done = m.end()
        if end := m["end"]:
            end = end.lower()
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == end:
                    close(k)
                    break
                if end in INLINE and open_[k][0] not in INLINE:
                    break
        elif tag := m["tag"]:
            tag = tag.lower()
            if tag == "br":
                text(" ")
                continue
            if tag in VOID:
                fresh = fresh or tag == "hr"
                continue
            if tag not in INLINE:
                k = len(open_) - 1
                while k > 0 and open_[k][0] in INLINE:
                    k -= 1
                if k > 0 and tag in CLOSED_BY.get(open_[k][0], ()):
                    close(k)
                found = NAMES.findall(m["attrs"]) if m["attrs"] else ()
                words = {w for v in found for w in re.split(r"[^a-z]+", "".join(v).lower())}
                up = open_[-1][1]
                name = "boiler" if words & BOILER_NAMES else "content" if words & CONTENT_NAMES else "none"
                kind = "boiler" if tag in BOILER else KINDS.get(tag, "other")
                nodes.append(Node(up, kind, name, nodes[up].boiler or kind == "boiler" or name == "boiler", tag))
                open_.append((tag, len(nodes) - 1))
                fresh = True
            else:
                links += tag == "a"
                open_.append((tag, open_[-1][1]))
    text(page[done:])
    return nodes, [(at, "".join(p)) for at, p in blocks]


def seen(n: Node) -> tuple[str, ...]:
    """What is seen of a node: kind, kind of its names, amount of text, share of links."""
    amount = 0 if not n.chars else 1 if n.chars < 40 else 2 if n.chars < 200 else 3
    share = 0 if not n.chars else 1 + (2 * n.link_chars > n.chars)
    return f"kind={n.kind}", f"name={n.name}", f"text={amount},{share}"


def labels(nodes: list[Node]) -> list[int] | None:
    """Labels of a page whose markup names one article (else one main part or content box), else None."""
    for chosen in (lambda n: n.tag == "article", lambda n: n.tag == "main", lambda n: n.kind == "container" and n.name == "content"):
        roots = [k for k, n in enumerate(nodes) if chosen(n)]
        if len(roots) == 1:
            inside = [False] * len(nodes)
            for k, n in enumerate(nodes):
                inside[k] = k == roots[0] or (k > 0 and inside[n.parent])
            return [int(i and not n.boiler) for i, n in zip(inside, nodes, strict=True)]
        if roots:
            return None
    return None


@dataclass
class Model:
    """Log potentials; bounded tables."""

    node: dict[str, tuple[float, float]]
    edge: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    @staticmethod
    def fit(counts: dict[str, int], smooth: float = 0.5) -> Model:
        c = Counter(counts)
        for page in EXAMPLES:
            c.update(count_labels(page))
        total = [sum(v for k, v in c.items() if k.startswith("node|kind=") and k.endswith(f"|{y}")) + 1 for y in (0, 1)]
        node = {}
        for f in {k.split("|")[1] for k in c if k.startswith("node|")}:
            logs = [math.log((c[f"node|{f}|{y}"] + smooth) / (total[y] + 2 * smooth)) for y in (0, 1)]
            odds = max(-CLIP, min(CLIP, logs[1] - logs[0]))
            node[f] = (-odds / 2, odds / 2)
        edge = {}
        for kind in ("any", *sorted({k.split("|")[1] for k in c if k.startswith("edge|")} - {"any"})):
            shares = []
            for p in (0, 1):
                n = [c[f"edge|{kind}|{p}{y}"] for y in (0, 1)]
                prior = (0.5, 0.5) if kind == "any" else tuple(math.exp(x) for x in edge["any"][p])
                shares.append(tuple(math.log((n[y] + BACK_OFF * prior[y]) / (sum(n) + BACK_OFF)) for y in (0, 1)))
            edge[kind] = tuple(shares)
        return Model(node, edge)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node by sum-product."""

        def add(a: float, b: float) -> float:
            return max(a, b) + math.log1p(math.exp(-abs(a - b)))

        n = len(nodes)
        own = [[sum(self.node.get(f, (0.0, 0.0))[y] for f in seen(v)) for y in (0, 1)] for v in nodes]
        edge = []
        for v in nodes:  # what the pages didn't show is taken from the nearest kind
            like = (f"{v.kind},{v.name}", "container,boiler" if v.name == "boiler" else f"{v.kind},none", "any")
            edge.append(next(self.edge[k] for k in like if k in self.edge))
        belief = [list(x) for x in own]
        up = [(0.0, 0.0)] * n
        for v in range(n - 1, 0, -1):
            e, b = edge[v], belief[v]
            up[v] = add(e[0][0] + b[0], e[0][1] + b[1]), add(e[1][0] + b[0], e[1][1] + b[1])
            for p in (0, 1):
                belief[nodes[v].parent][p] += up[v][p]
        down = [(math.log(0.9), math.log(0.1))] + [(0.0, 0.0)] * (n - 1)
        out = []
        for v in range(n):
            if v:
                u, e = nodes[v].parent, edge[v]
                rest = [belief[u][p] + down[u][p] - up[v][p] for p in (0, 1)]
                down[v] = add(rest[0] + e[0][0], rest[1] + e[1][0]), add(rest[0] + e[0][1], rest[1] + e[1][1])
            a, b = (belief[v][y] + down[v][y] for y in (0, 1))
            out.append(math.exp(b - add(a, b)))
        return out


def extract(page: str, model: Model) -> str:
    nodes, blocks = parse(page)
    keep = model.marginals(nodes)
    return "\n\n".join(t for at, raw in blocks if keep[at] > 0.5 and (t := " ".join(entities.unescape(raw).split())))


def count_labels(page: str) -> Counter:
    nodes, _ = parse(page)
    y = labels(nodes)
    c: Counter = Counter()
    for k, v in enumerate(nodes if y else ()):
        for f in seen(v):
            c[f"node|{f}|{y[k]}"] += 1
        if k:
            for kind in (f"{v.kind},{v.name}", "any"):
                c[f"edge|{kind}|{y[v.parent]}{y[k]}"] += 1
    return c


def train(pages: DataFrame, html_col: str = "html") -> Model:
    """The model of all labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: Counter = Counter()
            for t in texts(b.column(0)):
                c.update(count_labels(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["key", "n"])

    counted = pages.select(F.col(f"`{html_col}`").alias("html")).mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return Model.fit({r["key"]: r["n"] for r in counted.collect()})  # a few hundred keys: kinds x buckets


def extract_pages(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or train(pages, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [extract(t, model) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    flat = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html"))
    return flat.mapInArrow(run, "page_id long, url string, text string, n_chars long")
