"""Main text of web pages by wrapper induction over the pages of each host.

1. Every page is parsed once into a block tree (``dom``): its shape, its texts in
   page order, and a hash and the lengths of the text of each node.
2. The most frequent shape of a host is its reference. Every other shape of the
   host is aligned with it by simple tree matching, once per distinct shape; a
   node without a partner is a slot of its own shape.
3. Over all pages of the host a slot whose text stays the same is template, one
   whose text varies is content. A varying slot is no content if its text is
   mostly links, or if its element or class names say so (menus, headers and
   footers, sidebars, notices, adverts, forms, reader comments). Where a shape
   has an ``article`` (else a ``main``) with content, only that part counts.
4. A page's main text is the text of its content slots in page order.

Shapes, not pages, are grouped by host, after map-side counts; a host's evidence
is counted per (slot, text hash) before it is brought together, so a host with a
third of all pages is no group of one task. Page texts meet the wrappers in one
join on (host, shape), whose other side has one row per distinct shape.

Defined results: null or empty html, and pages without content, give an empty
text; a null url, or one without a host, belongs to the host ''. Constant text is
template only from MIN_PAGES pages on, and not where nothing else would be left
(a host of copies). Repeated rows are extracted alike; an empty table gives no
row. Extra columns are left out. White space is Unicode white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.bloom_cascade import url_parts
from panelcast.llm.common import Work

#: Pages that a slot must be seen on, and the share of them with one text, to be template.
MIN_PAGES, CONSTANT_SHARE = 4, 0.8
#: Share of a slot's characters inside links that makes it a list of links.
LINK_SHARE = 0.5
#: Fixed words: elements, roles and class words of what is not main text.
DROPPED_TAGS = frozenset("nav footer aside form menu dialog fieldset head".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                          "form hidden".split())
DROPPED_WORDS = frozenset("""ad ads adv advert advertisement adverts advertising adsense adslot banner breadcrumb
    breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer footnav gdpr
    login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination paywall
    popup promo promoted promotion recommended related respond share sharing sidebar sidenav signup social sponsor
    sponsored subscribe subscription toolbar topbar widget widgets""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WRAPPING_TAGS = frozenset(["", "html", "body", "article", "main"])
ARTICLE, MAIN = "article", "main"


def parse_pages(pages: DataFrame, url_col: str, html_col: str, extra: list[str]) -> DataFrame:
    """Block trees of all rows; ``extra`` columns are carried along in a struct."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        from panelcast.llm.dom import Page
        from panelcast.llm.tokens import small_batches
        for batch in small_batches(batches, 200):
            cols: list[list] = [[], [], [], []]
            for source in batch.column(2).to_pylist():
                page = Page(source or "")
                seen: dict[int, list] = {}
                for node, text, links in page.items:
                    own = seen.setdefault(node, [hashlib.blake2b(digest_size=8), 0, 0])
                    own[0].update(text.encode("utf-8", "surrogatepass") + b"\n")
                    own[1] += len(text)
                    own[2] += links
                for c, v in zip(cols, (
                        hashlib.md5(page.shape.encode("utf-8", "surrogatepass")).hexdigest(), page.shape,
                        [{"node": n, "text": t.encode("utf-8", "replace").decode()} for n, t, _ in page.items],
                        [{"node": n, "hash": int.from_bytes(h.digest(), "little", signed=True), "chars": size, "links": k}
                         for n, (h, size, k) in seen.items()])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], items), pa.array(cols[3], nodes)],
                ["row", "host", "shape_id", "shape", "items", "nodes"])

    import pyarrow as pa
    items = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string())]))
    nodes = pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32()), ("links", pa.int32())]))
    host, _ = url_parts(F.col(url_col))
    source = pages.select(F.struct(*[F.col(c) for c in extra]).alias("row"), host.alias("host"),
                          F.col(html_col).cast("string").alias("html"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, host string, shape_id string, shape string, "
                                  "items array<struct<node:int,text:string>>, "
                                  "nodes array<struct<node:int,hash:long,chars:int,links:int>>")


def named_boilerplate(shape, k: int, inside: list[bool], holds: list[bool]) -> bool:
    """Whether the names of node ``k`` alone say that it is no main text. ``inside``: in an
    article or main element; ``holds``: has such an element inside."""
    tag, label = shape.tags[k], shape.labels[k]
    roles = {part.split(".")[0] for part in label.split("@")[1:]}
    words = set(label.split("@")[0].split(".")[1:])
    if tag in DROPPED_TAGS or roles & DROPPED_ROLES:
        return True
    if holds[k] or tag in WRAPPING_TAGS - {ARTICLE}:
        return False
    if not inside[k] and (tag == "header" or "header" in words):
        return True
    return bool(words & DROPPED_WORDS)


def describe(text: str) -> tuple[list[bool], list[int], list[bool]]:
    """Of every node of a shape: whether it or a node around it is named boilerplate, its
    region (2 in an article, 1 in a main element, 0 elsewhere), and whether it is a heading."""
    from panelcast.llm.dom import Shape
    shape = Shape(text)
    n = len(shape.labels)
    kind = [2 if t == ARTICLE else 1 if t == MAIN or "@main" in label else 0 for t, label in zip(shape.tags, shape.labels)]
    region, holds, drop = list(kind), [False] * n, [False] * n
    for k in range(n):
        if shape.parents[k] >= 0:
            region[k] = max(kind[k], region[shape.parents[k]])
    for k in range(n - 1, 0, -1):
        holds[shape.parents[k]] |= holds[k] or kind[k] > 0
    inside = [r > 0 for r in region]
    for k in range(n):
        drop[k] = named_boilerplate(shape, k, inside, holds) or (shape.parents[k] >= 0 and drop[shape.parents[k]])
    return drop, region, [t in HEADINGS for t in shape.tags]


def align_shapes(shapes: DataFrame) -> DataFrame:
    """(host, shape_id, node, slot, drop, region, heading) of every node of the distinct
    shapes (host, shape_id, shape, reference)."""
    def run(batches):
        import sys

        import pyarrow as pa

        from panelcast.llm.dom import Shape, match
        from panelcast.llm.wrapper_induction import describe
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 200_000))
        for batch in batches:
            for host, shape_id, shape, reference in zip(*(c.to_pylist() for c in batch.columns)):
                partners = match(Shape(shape), Shape(reference))
                slots = [f"{shape_id}:{k}" if p < 0 else str(p) for k, p in enumerate(partners)]
                drop, region, heading = describe(shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(slots)), pa.array([shape_id] * len(slots)),
                     pa.array(range(len(slots)), pa.int32()), pa.array(slots), pa.array(drop, pa.bool_()),
                     pa.array(region, pa.int32()), pa.array(heading, pa.bool_())],
                    ["host", "shape_id", "node", "slot", "drop", "region", "heading"])

    return shapes.select("host", "shape_id", "shape", "reference").mapInArrow(
        run, "host string, shape_id string, node int, slot string, drop boolean, region int, heading boolean")


def induce(parsed: DataFrame, work: Work) -> DataFrame:
    """(host, shape_id, keep): for every distinct shape of a host, per node whether its
    text is main text."""
    counted = parsed.groupBy("host", "shape_id").agg(F.first("shape").alias("shape"), F.count("*").alias("n"))
    counted = work.table(counted, "shapes")
    # The most frequent shape; of equally frequent ones that with the smallest hash.
    references = counted.groupBy("host").agg(F.min_by("shape", F.struct(-F.col("n"), "shape_id")).alias("reference"))
    nodes = work.table(align_shapes(counted.join(references, "host")), "nodes")
    seen = parsed.select("host", "shape_id", F.explode("nodes").alias("s")).select("host", "shape_id", "s.*")
    texts = seen.groupBy("host", "shape_id", "node", "hash").agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    texts = texts.join(nodes.select("host", "shape_id", "node", "slot"), ["host", "shape_id", "node"])
    texts = texts.groupBy("host", "slot", "hash").agg(*[F.sum(c).alias(c) for c in ("n", "chars", "links")])
    slots = texts.groupBy("host", "slot").agg(F.max("n").alias("most"), *[F.sum(c).alias(c) for c in ("n", "chars", "links")])
    wrapper = slots.select("host", "slot", (F.col("links") >= LINK_SHARE * F.col("chars")).alias("linked"),
                           ((F.col("n") >= MIN_PAGES) & (F.col("most") >= CONSTANT_SHARE * F.col("n"))).alias("constant"))
    judged = nodes.join(wrapper, ["host", "slot"])  # slots without text of their own have no row
    named = judged.where(~F.col("drop") & (~F.col("linked") | F.col("heading")))
    # A shape has few nodes: its rows meet in one window or list.
    shape = Window.partitionBy("host", "shape_id")
    varying = named.withColumn("varies", F.max(~F.col("constant")).over(shape))
    content = varying.where(~F.col("constant") | ~F.col("varies"))
    content = content.withColumn("best", F.max("region").over(shape)).where("region = best")
    return content.groupBy("host", "shape_id").agg(F.sort_array(F.collect_list("node")).alias("keep"))


def main_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               keep_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep_cols`` of every page and its main text (column ``text``)."""
    work = Work(pages.sparkSession, "wrappers")
    parsed = work.table(parse_pages(pages, url_col, html_col, list(keep_cols)), "parsed", compression="zstd")
    wrappers = work.table(induce(parsed, work), "wrappers")
    found = parsed.select("row", "host", "shape_id", "items").join(wrappers, ["host", "shape_id"], "left")
    return found.select(*[F.col("row")[c].alias(c) for c in keep_cols], kept_text("items", "keep").alias("text"))


def kept_text(items: str, keep: str) -> Column:
    own = F.filter(items, lambda i: F.array_contains(F.col(keep), i["node"]))
    return F.when(F.col(keep).isNull(), F.lit("")).otherwise(F.array_join(F.transform(own, lambda i: i["text"]), " "))
