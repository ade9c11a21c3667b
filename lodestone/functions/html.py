"""HTML as Catalyst expressions: split the markup at tags, work on the pieces, stay in the row.

Nothing here explodes or shuffles: a page is one row before and one array afterwards.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import decode_entities, let, trim_ws

TAG = r"<(?:[/!?]|(?=[A-Za-z]))(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
_ATTR = r"(?s)(?<=[\s\"'/])([^\s\"'<>/=]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++)"

# Stands where markup was cut out, so that the texts on both sides stay two texts.
GAP = "<!---->"

# What is not closed goes on to the end of the page.
_COMMENTS = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style|template)(?=[\s/>]).*?(?:</\1\s*>|\z))"
_FURNITURE = r"(?:nav|footer|aside)(?=[\s/>])"

# A block ends at its own close tag or where one of these starts or ends.
_BREAKS = (
    "h[1-6]|p|ul|ol|li|dl|dt|dd|div|table|caption|thead|tbody|tfoot|tr|td|th|blockquote|pre|form"
    "|fieldset|address|center|hr|article|section|main|header|body|html"
)
_BOUNDARY = rf"(?i)(?=</?(?:{_BREAKS})[\s/>])"

# A heading may hold a div; it ends at these.
HEADING_STOP = r"^(/?h[1-6]|p|ul|ol|li|table|/(li|ul|ol|td|th|tr|table|body|html|article|section|main))$"

# The three page profiles. "script" finds what v2 finds, but keeps pages and tables without text.
_ALL_TAGS = ["h1", "h2", "h3", "h4", "h5", "p", "ul", "ol"]
BLOCK_TAGS = {"v2": _ALL_TAGS, "v1": ["h1", "h2", "p", "ul", "ol"], "script": _ALL_TAGS}
TABLE_MARK = {"v2": r"(?i)<t[dh]", "v1": r"(?i)<td", "script": r"(?i)<t[dh]"}


def strip_comments(html: Column) -> Column:
    """Cut comments, scripts, styles and templates: none of them is page content."""
    return F.regexp_replace(html, _COMMENTS, GAP)


def furniture_pairs(pieces: Column) -> Column:
    """Pairs ``struct<i,close>`` of places, counted from 1, of the outermost furniture that is closed, by a stack of names."""

    def token(piece: Column, n: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, f"(?i)^</?({_FURNITURE})", 1))
        return F.struct(name.alias("name"), piece.startswith("</").alias("ends"), (n + 1).alias("i"))

    def step(state: Column, t: Column) -> Column:
        stack, pairs = state["stack"], state["pairs"]
        names = F.transform(stack, lambda s: s["name"])
        at = F.size(stack) - F.array_position(F.reverse(names), t["name"]).cast("int")  # of the last one of this name
        found = F.array_contains(names, t["name"])
        opened = F.get(stack, at)["i"]
        outer = F.concat(F.filter(pairs, lambda p: p["i"] < opened), F.array(F.struct(opened.alias("i"), t["i"].alias("close"))))
        pushed = F.concat(stack, F.array(F.struct(t["name"].alias("name"), t["i"].alias("i"))))
        ended = F.struct(F.slice(stack, F.lit(1), F.greatest(at, F.lit(0))).alias("stack"), outer.alias("pairs"))
        return F.when(t["ends"] & found, ended).when(t["ends"], state).otherwise(F.struct(pushed.alias("stack"), pairs.alias("pairs")))

    start = F.struct(
        F.array().cast("array<struct<name:string,i:int>>").alias("stack"), F.array().cast("array<struct<i:int,close:int>>").alias("pairs")
    )
    tokens = F.filter(F.transform(pieces, token), lambda t: t["name"] != "")
    return F.aggregate(tokens, start, step)["pairs"]


def strip_boilerplate(html: Column) -> Column:
    """Also cut ``nav``, ``footer`` and ``aside`` with all that they hold; one that nothing closes stays.

    As in a tree parser, an element that ends closes what is still open inside it, and a close tag without its element is
    nothing.
    """

    def cut(pieces: Column) -> Column:
        closed = furniture_pairs(pieces)

        def kept(pairs: Column) -> Column:
            inside = lambda i: F.exists(pairs, lambda b: (b["i"] <= i) & (i < b["close"]))
            ends = lambda i: F.exists(pairs, lambda b: b["close"] == i)
            return F.transform(
                pieces,
                lambda p, i: F.when(inside(i + 1), "").when(ends(i + 1), F.regexp_replace(p, "^</[^>]*>", GAP)).otherwise(p),
            )

        return F.array_join(let(closed, kept), "")

    def page(h: Column) -> Column:
        parts = F.split(h, f"(?i)(?=</?{_FURNITURE})")
        return F.when(h.rlike(f"(?i)<{_FURNITURE}"), let(parts, cut)).otherwise(h)

    return let(strip_comments(html), page)


def element_text(html: Column, sep: str = "") -> Column:
    """Text of a piece of markup: each text node trimmed, joined with ``sep``."""
    nodes = F.transform(F.split(html, TAG), lambda node: trim_ws(decode_entities(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), sep)


def cell_text(html: Column) -> Column:
    """Text of a table cell: kept as it is, trimmed at the ends only."""
    text = F.regexp_replace(F.regexp_replace(html, r"(?i)<br[^>]*>", " "), TAG, "")
    return trim_ws(decode_entities(text))


def tag_attr(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of one start tag; null if absent."""
    pair = F.get(
        F.filter(F.regexp_extract_all(tag, F.lit(_ATTR), 0), lambda a: a.rlike(rf"(?i)^{name}\s*=")), F.lit(0)
    )
    return decode_entities(F.regexp_replace(pair, r"(?s)^[^=]*=\s*[\"']?|[\"']$", ""))


def start_tags(html: Column, name: str) -> Column:
    """All start tags of one element name, in document order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"), 0)


def keep_block(text: Column, profile: str = "v2") -> Column:
    """Block predicate: v2 wants more than two characters and no copyright line, v1 only no leading sign."""
    if profile == "v1":
        return (text != "") & ~text.startswith("©")
    return (F.length(text) > 2) & ~text.rlike(r"(?i)^(?:\s*Copyright|©|\d{4} All Rights)")


def _sum(steps: Column) -> Column:
    return F.aggregate(steps, F.lit(0), lambda acc, s: acc + s)


def _grow(steps: Column) -> Column:
    """Running sum that copies its result at every step: for short arrays."""
    start = F.array().cast("array<int>")
    return F.aggregate(
        steps, start, lambda acc, s: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + s))
    )


def running_sum(steps: Column) -> Column:
    """Running sum of an array of ints, in stretches of its square root, so that long arrays stay affordable."""

    def whole(all_steps: Column) -> Column:
        length = F.greatest(F.ceil(F.sqrt(F.size(all_steps))).cast("int"), F.lit(1))
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_steps), F.lit(1)), length)
        return let(F.transform(starts, lambda i: F.slice(all_steps, i, length)), joined)

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, _sum)
        before = F.zip_with(_grow(totals), totals, lambda upto, own: upto - own)
        return F.flatten(F.zip_with(parts, before, lambda p, o: F.transform(_grow(p), lambda x: x + o)))

    return let(steps, whole)


def bracket_pairs(steps: Column) -> Column:
    """Pairs ``struct<i,close>`` of every opening (+1) with its closing (-1) place, counted from 1, in order.

    ``close`` is one past the end where nothing closes. Sorted by level, an opening place is followed by its closing
    one, so no place is searched for.
    """

    def by_level(depth: Column, all_steps: Column) -> Column:
        places = F.zip_with(all_steps, depth, lambda s, d: F.struct(s.alias("s"), d.alias("d")))
        marked = F.transform(
            places,
            lambda p, i: F.when(
                p["s"] != 0,
                F.struct((p["d"] + F.when(p["s"] < 0, 1).otherwise(0)).alias("level"), (i + 1).alias("i"), p["s"].alias("s")),
            ),
        )
        return F.sort_array(F.filter(marked, lambda m: m.isNotNull()))

    def pairs(places: Column, end: Column) -> Column:
        def pair(m: Column, j: Column) -> Column:
            after = F.get(places, j + 1)
            closed = (after["level"] == m["level"]) & (after["s"] < 0)
            return F.when(m["s"] > 0, F.struct(m["i"].alias("i"), F.when(closed, after["i"]).otherwise(end).alias("close")))

        return F.sort_array(F.filter(F.transform(places, pair), lambda p: p.isNotNull()))

    def whole(all_steps: Column) -> Column:
        places = by_level(running_sum(all_steps), all_steps)
        return let(places, lambda p: pairs(p, F.size(all_steps) + 1))

    return let(steps, whole)


def table_step(piece: Column) -> Column:
    """+1 where a table opens, -1 where one closes."""
    return F.when(piece.rlike("(?i)^<table"), 1).when(piece.rlike("(?i)^</table"), -1).otherwise(0)


def split_blocks(html: Column) -> Column:
    return F.split(html, _BOUNDARY)


def tag_names(pieces: Column) -> Column:
    """Lower-case name of the tag each piece starts with, ``/name`` for a close tag."""
    return F.transform(pieces, lambda s: F.lower(F.regexp_extract(s, r"^<(/?[A-Za-z][A-Za-z0-9]*)", 1)))


def indexes(arr: Column, keep) -> Column:
    """Positions (from 1) of the items that ``keep`` accepts."""
    at = F.transform(arr, lambda t, i: F.when(keep(t), i + 1))
    return F.filter(at, lambda i: i.isNotNull())
