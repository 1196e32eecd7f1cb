"""Layout-aware extraction: an HTML page as ordered blocks.

A page becomes its stream of tags and texts; block-level tags cut the stream, inline tags
are ignored, and the texts between two cuts are one block:

* ``title``, ``heading`` (with its level), ``list_item``, ``cell`` (with the numbers of
  its table, row and cell) or ``paragraph``, by the tag that was opened last; text after
  a closing tag or in a container is a paragraph;
* ``path`` holds the headings above the block, outermost first: a heading closes all
  headings of its level and below.

Malformed pages are defined by the same rule: an unclosed block ends at the next
block-level tag, a closing tag without an opening one just ends the block, a ``<`` without
``>`` is dropped and what follows it is text, as is an unclosed script, style or comment. Scripts, styles
and comments are dropped, entities decoded and white space collapsed as in
``documents.html_to_text``; blocks without text are left out. NULL and empty pages have
no blocks; repeated rows must differ in ``id_col``.

All built-in expressions: the stream is one array per page, exploded, and folded by
windows over the page. The unit of memory is one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Block-level tags; those that name the kind of the text after them.
BLOCK_TAGS = ("address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form",
              "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody",
              "td", "tfoot", "th", "thead", "title", "tr", "ul")
KINDS = {"title": "title", "li": "list_item", "td": "cell", "th": "cell"}
DROPPED = (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?s)<!--.*?-->")
TOKEN = r"(?s)<[^>]*>|[^<]+"
TAG = r"^<(/?[A-Za-z][A-Za-z0-9]*)"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _text(c: Column) -> Column:
    for entity, ch in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(ch))
    return F.regexp_replace(F.regexp_replace(c, r"[ \t\n\r\f]+", " "), "^ +| +$", "")


def blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``<id_col>, block, kind, level, path, table_no, row_no, cell_no, text`` in page order."""
    html = F.col(html_col)
    for pattern in DROPPED:
        html = F.regexp_replace(html, pattern, " ")
    tokens = pages.select(F.col(id_col).alias("id"), F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))).alias("pos", "token"))
    tag = F.lower(F.regexp_extract("token", TAG, 1))
    tokens = tokens.withColumn("tag", tag).withColumn("cut", F.regexp_replace("tag", "^/", "").isin(*BLOCK_TAGS))
    page = Window.partitionBy("id").orderBy("pos")
    so_far = page.rowsBetween(Window.unboundedPreceding, 0)
    tokens = tokens.select("id", "pos", "token", "tag", "cut", F.sum(F.col("cut").cast("int")).over(so_far).alias("no"),
                           F.sum((F.col("tag") == "table").cast("int")).over(so_far).alias("table_no"))
    in_table = Window.partitionBy("id", "table_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    tokens = tokens.withColumn("row_no", F.sum((F.col("tag") == "tr").cast("int")).over(in_table))
    in_row = Window.partitionBy("id", "table_no", "row_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    tokens = tokens.withColumn("cell_no", F.sum(F.col("tag").isin("td", "th").cast("int")).over(in_row))
    # a block: the tokens from one cut to the next; the cut is its first token
    pieces = F.sort_array(F.collect_list(F.when(~F.col("token").startswith("<") | (F.length("token") == 1), F.struct("pos", "token"))))
    found = tokens.groupBy("id", "no").agg(
        F.max(F.when(F.col("cut"), F.col("tag"))).alias("tag"), F.max("table_no").alias("table_no"), F.max("row_no").alias("row_no"),
        F.max("cell_no").alias("cell_no"), _text(F.concat_ws(" ", F.transform(pieces, lambda x: x["token"]))).alias("text")).filter("text <> ''")
    kind = F.coalesce(*(F.when(F.col("tag") == t, k) for t, k in KINDS.items()), F.when(F.col("tag").rlike("^h[1-6]$"), "heading"), F.lit("paragraph"))
    found = found.withColumn("kind", kind).withColumn("level", F.when(F.col("kind") == "heading", F.substring("tag", 2, 1).cast("int")))
    # headings above: per level the newest one, if no heading of an outer level came after it
    order = Window.partitionBy("id").orderBy("no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = {n: F.max(F.when(F.col("level") == n, F.col("no"))).over(before) for n in range(1, 7)}
    named = {n: F.last(F.when(F.col("level") == n, F.col("text")), ignorenulls=True).over(before) for n in range(1, 7)}
    found = found.select("*", F.row_number().over(order).alias("rank"), *(at[n].alias(f"at{n}") for n in at), *(named[n].alias(f"name{n}") for n in named))
    above = []
    for n in range(1, 7):
        open_ = F.col(f"at{n}").isNotNull() & (F.col("level").isNull() | (F.col("level") > n))
        for outer in range(1, n):
            open_ &= F.coalesce(F.col(f"at{outer}") < F.col(f"at{n}"), F.lit(True))
        above.append(F.when(open_, F.col(f"name{n}")))
    cell = F.col("kind") == "cell"
    return found.select(F.col("id").alias(id_col), (F.col("rank") - 1).cast("long").alias("block"), "kind", "level",
                        F.concat_ws(" > ", *above).alias("path"),
                        *(F.when(cell, F.col(c)).cast("long").alias(c) for c in ("table_no", "row_no", "cell_no")), "text")
