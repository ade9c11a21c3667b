"""Tables into rows, sentences and question texts. A table stays inside its row: nothing shuffles."""

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import first_non_empty, let, non_empty
from ..schema import GRID, KV

_CELL = "struct<th:boolean,text:string,colspan:int,rowspan:int>"
_WIDEST, _TALLEST = 1000, 65534  # the HTML standard's limits for colspan and rowspan

# The question text, and the columns that may name the thing a row is about.
QUESTION = "型號為{key}的{column}是什麼？答案：{value}"
KEY_COLUMNS = ["型號", "Model"]


@F.pandas_udf(GRID)
def place_cells(tables: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Grid of a table with cells that span rows: every covered spot repeats the text of its cell.

    Placement depends on all rows above, hence Python; other tables pass as null and cost nothing.
    """

    def grid(cells_json):
        if cells_json is None:
            return None
        rows, hanging = [], {}
        for cells in json.loads(cells_json):
            spots, below, col = dict(hanging), {}, 0
            for c, (text, left) in hanging.items():
                if left > 1:
                    below[c] = (text, left - 1)
            row = {c: {"text": text, "first": False} for c, (text, _) in spots.items()}
            for cell in cells:
                while col in spots:
                    col += 1
                for k in range(cell["colspan"]):
                    row[col + k] = {"text": cell["text"], "first": k == 0}
                    if cell["rowspan"] > 1:
                        below[col + k] = (cell["text"], cell["rowspan"] - 1)
                col += cell["colspan"]
            hanging = below
            width = max(row, default=-1) + 1
            rows.append([row.get(c, {"text": "", "first": True}) for c in range(width)])
        return rows

    for batch in tables:
        yield batch.map(grid)


def _span(cell: Column, name: str, limit: int) -> Column:
    digits = F.regexp_extract(cell, rf"(?is)^<[^>]*\s{name}\s*=\s*[\"']?\s*0*(\d*)", 1)
    # The zero in front makes a number of a missing value too; a failing cast per cell would be slow. HTML's own limits
    # hold, so a number of more digits than the limit has is the limit.
    number = F.when(F.length(digits) > 5, F.lit(limit)).otherwise(F.concat(F.lit("0"), digits).cast("int"))
    return F.greatest(F.least(number, F.lit(limit)), F.lit(1))


def _own_markup(table_html: Column) -> Column:
    """The markup with the row and cell tags of inner tables taken out; their text stays in the outer cell."""
    parts = F.split(table_html, r"(?i)(?=</?table[\s/>])")
    strip = lambda s: F.regexp_replace(s, r"(?i)</?(?:table|thead|tbody|tfoot|caption|tr|td|th)(?=[\s/>])[^>]*>", " ")
    own = let(
        parts,
        lambda p: F.zip_with(p, H.running_sum(F.transform(p, H.table_step)), lambda s, d: F.when(d > 1, strip(s)).otherwise(s)),
    )
    return F.array_join(own, "")


def parse_tables(tables: DataFrame) -> DataFrame:
    """Add ``table_rows``: the body rows as ordered key/value lists.

    Header rows are the leading rows that stand in ``thead`` or are made of ``th`` cells only, or else the first row. Their
    levels are joined by ``__``. A spanned cell gives its text once and ``""`` for the rest; a missing cell gives ``""``. Cells
    beyond the header get the keys ``column_n``, n counted from 1.
    """
    cells, grid, heads = F.col("_cells"), F.col("_grid"), F.col("_heads")

    def row_cells(row: Column, in_head: Column) -> Column:
        return F.transform(
            F.filter(F.split(row, r"(?i)(?=<t[dh][\s/>])"), lambda c: c.rlike(r"(?i)^<t[dh]")),
            lambda c: F.struct(
                (in_head | c.rlike("(?i)^<th")).alias("th"),
                H.cell_text(F.regexp_replace(c, r"(?is)</t[dhr]\s*>.*$", "")).alias("text"),
                _span(c, "colspan", _WIDEST).alias("colspan"),
                _span(c, "rowspan", _TALLEST).alias("rowspan"),
            ).cast(_CELL),
        )

    # A row belongs to the head if more heads open than close in the markup before it.
    count = lambda s, tag: F.size(F.split(s, tag)) - 1
    heads_open = lambda s: count(s, r"(?i)<thead(?=[\s/>])") - count(s, r"(?i)</thead(?=[\s/>])")
    parts = F.split(_own_markup(F.col("table_html")), r"(?i)(?=<tr[\s/>])")

    def marked(pieces: Column) -> Column:
        steps = F.transform(pieces, heads_open)
        before = F.zip_with(H.running_sum(steps), steps, lambda upto, own: upto - own)
        rows = F.zip_with(pieces, before, lambda s, b: F.struct(s.alias("row"), (b > 0).alias("head")))
        return F.filter(rows, lambda r: r["row"].rlike("(?i)^<tr"))

    rows = let(parts, marked)
    spread = F.transform(
        cells,
        lambda r: F.flatten(
            F.transform(
                r,
                lambda c: F.transform(
                    F.sequence(F.lit(1), c["colspan"]), lambda k: F.struct(c["text"].alias("text"), (k == 1).alias("first"))
                ),
            )
        ),
    )
    spans_rows = F.exists(cells, lambda r: F.exists(r, lambda c: c["rowspan"] > 1))
    body_at = F.array_position(F.transform(cells, lambda r: F.exists(r, lambda c: ~c["th"])), True).cast("int")
    head_count = F.when(body_at == 0, F.size(cells)).otherwise(F.greatest(body_at - 1, F.lit(1)))

    width = F.coalesce(F.array_max(F.transform(heads, F.size)), F.lit(0))
    names = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda c: F.array_join(
            F.array_distinct(F.filter(F.transform(heads, lambda h: F.get(h, c)["text"]), lambda t: t != "")), "__"
        ),
    )
    body = F.slice(grid, F.size(heads) + 1, F.size(grid))

    def keyed(row: Column, header: Column) -> Column:
        return F.transform(
            header,
            lambda n, c: F.struct(
                n.alias("k"),
                F.coalesce(F.when(F.get(row, c)["first"], F.get(row, c)["text"]), F.lit("")).alias("v"),
            ),
        )

    widest = F.greatest(width, F.coalesce(F.array_max(F.transform(body, F.size)), F.lit(0)))
    more = F.transform(F.sequence(width + 1, widest), lambda n: F.concat(F.lit("column_"), n.cast("string")))
    none = F.array().cast("array<string>")
    header = F.concat(F.when(width > 0, names).otherwise(none), F.when(widest > width, more).otherwise(none))
    table_rows = let(header, lambda n: F.transform(body, lambda r: keyed(r, n)))
    return (
        tables.withColumn("_cells", F.filter(F.transform(rows, lambda r: row_cells(r["row"], r["head"])), lambda r: F.size(r) > 0))
        .withColumn("_placed", place_cells(F.when(spans_rows, F.to_json(cells))))
        .withColumn("_grid", F.coalesce("_placed", spread.cast(GRID)))
        .withColumn("_heads", F.slice(grid, 1, head_count))
        .withColumn("table_rows", table_rows.cast(f"array<{KV}>"))
        .drop("_cells", "_placed", "_grid", "_heads")
    )


def recover_json_rows(text: Column, profile: str = "v2") -> Column:
    """Rows of the JSON array inside free text, keys in their order; null unless it is a list of objects.

    v2 also turns down an empty list. Wrapping the array in an object makes the parser read to its very end.
    """
    found = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    strict = {"allowSingleQuotes": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    parsed = F.from_json(F.concat(F.lit('{"v":'), found, F.lit("}")), "v array<string>, bad string", strict)

    def row(obj: Column) -> Column:
        def entries(values: Column) -> Column:
            return F.transform(
                F.array_distinct(F.json_object_keys(obj)),
                lambda k: F.struct(
                    k.alias("k"), F.element_at(F.filter(values, lambda e: e["key"] == k), -1)["value"].alias("v")
                ),
            )

        return let(F.map_entries(F.from_json(obj, "map<string,string>")), entries)

    def rows(p: Column) -> Column:
        objects = p["v"]
        good = p["bad"].isNull() & F.forall(objects, lambda o: o.startswith("{") & F.json_object_keys(o).isNotNull())
        if profile != "v1":
            good = good & (F.size(objects) > 0)
        return F.when(good, F.transform(objects, row))

    return F.when(found != "", let(parsed, rows))


def row_of(df: DataFrame, cols: list[str]) -> Column:
    """The named columns of any DataFrame as one ordered key/value list of texts."""
    pairs = [F.struct(F.lit(c).alias("k"), F.coalesce(df[c].cast("string"), F.lit("")).alias("v")) for c in cols]
    return F.array(*pairs)


def row_sentence(row: Column) -> Column:
    """``key: value`` pairs with a value, joined by commas."""
    filled = F.filter(row, lambda x: x["v"] != "")
    return F.array_join(F.transform(filled, lambda x: F.concat(x["k"], F.lit(": "), x["v"])), ", ")


def sentences_of(rows: Column) -> Column:
    """Sentences of all rows that have a value."""
    return F.filter(F.transform(rows, row_sentence), lambda s: s != "")


def with_sentences(tables: DataFrame) -> DataFrame:
    return tables.withColumn("table_sentences", sentences_of(F.col("table_rows")))


def header_of(rows: Column) -> Column:
    """Column names of a table: the keys of its first row."""
    return F.transform(F.get(rows, F.lit(0)), lambda x: x["k"])


def row_key(row: Column, header: Column, key_columns: list[str] | None = None) -> Column:
    """What a row is about: the first of the key columns, then of the header, that has a value."""

    def value(name: Column) -> Column:
        return F.element_at(F.filter(row, lambda x: x["k"] == name), 1)["v"]

    def lookup(name: Column) -> Column:
        return non_empty(F.when(F.exists(row, lambda x: x["k"] == name), value(name)))

    names = [F.lit(n) for n in (KEY_COLUMNS if key_columns is None else key_columns)]
    return first_non_empty(*[lookup(n) for n in names], lookup(F.get(header, F.lit(0))))


def question_text(key: Column, column: Column, value: Column, template: str = QUESTION) -> Column:
    out = F.lit(template.split("{key}")[0])
    rest = template.split("{key}")[1]
    before, after = rest.split("{column}")
    middle, tail = after.split("{value}")
    return F.concat(out, key, F.lit(before), column, F.lit(middle), value, F.lit(tail))


def questions_of(rows: Column, template: str = QUESTION, key_columns: list[str] | None = None) -> Column:
    """All cell questions of a table: ``array<struct<row_no,col_no,row_data,k,v,question>>``, numbered from 1."""

    def of_row(row: Column, r: Column, header: Column) -> Column:
        key = row_key(row, header, key_columns)
        numbered = F.transform(row, lambda x, c: F.struct((c + 1).alias("no"), x["k"].alias("k"), x["v"].alias("v")))
        wanted = F.filter(numbered, lambda x: (x["v"] != "") & ~F.array_contains(header, x["v"]))

        def question(x: Column, known: Column) -> Column:
            return F.struct(
                (r + 1).alias("row_no"),
                x["no"].alias("col_no"),
                row.alias("row_data"),
                x["k"].alias("k"),
                x["v"].alias("v"),
                question_text(known, x["k"], x["v"], template).alias("question"),
            )

        return let(key, lambda known: F.transform(wanted, lambda x: question(x, known)))

    return F.flatten(let(header_of(rows), lambda h: F.transform(rows, lambda row, r: of_row(row, r, h))))


def cell_questions(tables: DataFrame, template: str = QUESTION, key_columns: list[str] | None = None) -> DataFrame:
    """One row per cell that has a value and does not merely repeat a column name.

    Keeps the input columns and adds ``row_no``, ``col_no``, ``row_data``, ``k``, ``v`` and ``question``.
    """
    kept = [c for c in tables.columns if c != "table_rows"]
    return tables.select(*kept, F.inline(questions_of(F.col("table_rows"), template, key_columns)))
