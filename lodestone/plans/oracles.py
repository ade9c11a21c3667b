"""The registered queries in SQL, for a second engine to run on the same tables.

Nothing here comes from the engine: texts are written out once more, so that a slip in one of them shows.
"""

# White space: as a regex class, and as the characters one by one.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Texts around hits, questions and failures.
PROMPT_HEAD = """根據以下提供的資訊回答問題，如果提供的資訊不足以回答，請清楚表明。不要擅自添加未在資料中提及的資訊。
            
提供的資訊:
"""
PROMPT_QUESTION = "\n\n問題: "
PROMPT_TAIL = "\n\n回答:"
HISTORY_HEAD = "歷史對話："
HISTORY_TAIL = "以上回歷史路。 本次對話："
NO_EMBEDDING = "無法為查詢生成 embedding，請確認 embedding service / model 可用。"
EMBEDDING_ERROR = " 最後的 embedding 錯誤: "
NO_HITS = "索引中沒有可用的檢索結果。"
NO_ANSWER = "無法連線到 LLM 服務，但已成功檢索相關內容。請查看檢索結果或稍後再試。"
ANSWER_ERROR = "生成回答時發生錯誤: "

DIM = 64
SITE = "http://parts.example.com"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WS_SET = _lit(
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SEP = "chr(1)"


def _trim(x: str) -> str:
    return f"trim({x}, {_WS_SET})"


def _id(*parts: str) -> str:
    return f"sha256(concat_ws({_SEP}, {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)}))"


# ---- markup -------------------------------------------------------------------------------------

_SCRIPTS = "|".join(rf"<{t}[\s/>].*?</{t}\s*>" for t in ("script", "style", "template"))
_MENUS = "|".join(rf"<{t}[\s/>].*?</{t}\s*>" for t in ("nav", "footer", "aside"))
_BREAKS = (
    "h[1-6]|p|ul|ol|li|dl|dt|dd|div|table|caption|thead|tbody|tfoot|tr|td|th|blockquote|pre|form"
    "|fieldset|address|center|hr|article|section|main|header|body|html"
)


def _no_comments(html: str) -> str:
    return f"regexp_replace({html}, '(?is)<!--.*?-->|{_SCRIPTS}', '<!---->', 'g')"


def _clean(html: str) -> str:
    return f"regexp_replace({_no_comments(html)}, '(?is){_MENUS}', '<!---->', 'g')"


def _decode(x: str) -> str:
    for name, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")]:
        x = f"replace({x}, '&{name};', {_lit(char)})"
    return x


def _text(html: str, sep: str = "") -> str:
    out = f"regexp_replace({html}, '{WS}*<[^>]*>{WS}*', chr(2), 'g')"
    out = f"regexp_replace({out}, '[\\x02]+', {_lit(sep)}, 'g')"
    return _trim(_decode(out))


_BLOCKS = rf"""
pieces AS (
  SELECT page_id, url, unnest(string_split(
    regexp_replace({_clean("html")}, '(?i)(</?(?:{_BREAKS})[\s/>])', chr(1) || '\1', 'g'), chr(1))) AS piece,
    generate_subscripts(string_split(
    regexp_replace({_clean("html")}, '(?i)(</?(?:{_BREAKS})[\s/>])', chr(1) || '\1', 'g'), chr(1)), 1) AS pos
  FROM pages),
found AS (
  SELECT page_id, url, pos, lower(regexp_extract(piece, '^<([A-Za-z0-9]+)', 1)) AS tag, {_text("piece")} AS text FROM pieces),
blocks AS (SELECT * FROM found WHERE tag IN (%(tags)s) AND %(keep)s)"""

_V2 = _BLOCKS % {
    "tags": "'h1','h2','h3','h4','h5','p'",
    "keep": r"length(text) > 2 AND NOT regexp_matches(text, '(?i)^(?:\s*Copyright|©|\d{4} All Rights)')",
}
_V1 = _BLOCKS % {"tags": "'h1','h2','p'", "keep": "text <> '' AND NOT starts_with(text, '©')"}
_NUMBERED = """
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS ord, tag, text FROM blocks"""

# ---- links and crawl ----------------------------------------------------------------------------

# All hrefs are paths, so resolving is scheme and host in front.
_LINKS = rf"""
links AS (
  SELECT DISTINCT url AS src_url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || split_part(href, '#', 1) AS dst_url
  FROM (SELECT url, unnest(regexp_extract_all({_no_comments("html")}, '(?i)<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages))"""

_NEIGHBOURS = f"""{_LINKS},
edges AS (
  SELECT a.url AS src_url, b.url AS dst_url
  FROM (SELECT url, page_id, unnest([1, 2, 3, 5, 8, 13]) AS step FROM pages) a
  JOIN pages b ON b.page_id = a.page_id + a.step
  UNION ALL SELECT src_url, dst_url FROM links)"""


def _crawl(depth: int, cap: int) -> str:
    sql = f"WITH {_NEIGHBOURS}, v0 AS (SELECT DISTINCT url AS start_url, url, 0 AS depth FROM pages)"
    for d in range(1, depth + 1):
        sql += f""",
f{d} AS (
  SELECT DISTINCT v.start_url, e.dst_url AS url, {d} AS depth FROM v{d - 1} v JOIN edges e ON e.src_url = v.url
  WHERE v.depth = {d - 1} AND e.dst_url IN (SELECT url FROM pages)
  AND NOT EXISTS (SELECT 1 FROM v{d - 1} w WHERE w.start_url = v.start_url AND w.url = e.dst_url)),
v{d} AS (
  SELECT start_url, url, depth FROM (SELECT * FROM v{d - 1} UNION ALL SELECT * FROM f{d})
  QUALIFY row_number() OVER (PARTITION BY start_url ORDER BY depth, url) <= {cap})"""
    return sql + f" SELECT *, row_number() OVER (PARTITION BY start_url ORDER BY depth, url) AS ord FROM v{depth}"


_REFS = r"""
WITH p AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+):', 1) AS sch, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
b AS (SELECT *, sch || '://' || host AS root, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS folder FROM p),
r AS (
  SELECT page_id, '/x/../y?q=1' AS ref, root || '/y?q=1' AS found FROM b
  UNION ALL SELECT page_id, 'c/d', root || folder || 'c/d' FROM b
  UNION ALL SELECT page_id, '?z=2', root || path || '?z=2' FROM b
  UNION ALL SELECT page_id, '//o.example/p', sch || '://o.example/p' FROM b
  UNION ALL SELECT page_id, 'https://h.example/z#f', 'https://h.example/z#f' FROM b
  UNION ALL SELECT page_id, './e/./f', root || folder || 'e/f' FROM b
  UNION ALL SELECT page_id, 'mailto:a@b', 'mailto:a@b' FROM b
  UNION ALL SELECT page_id, '#top', root || path || regexp_extract(url, '(\?[^#]*)', 1) || '#top' FROM b)
SELECT page_id, ref, found, regexp_extract(found, '^([a-z]+):', 1) AS scheme,
  regexp_extract(found, '^[a-z]+://([^/?#]*)', 1) AS host FROM r"""

# ---- tables made from part ----------------------------------------------------------------------

_CELLS = """
cells AS (
  SELECT p_partkey // 40 AS block, p_partkey AS key, row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) AS row_no,
    'M-' || p_partkey AS model, replace(p_name, ' ', ' & ') AS name,
    CASE WHEN p_size = 1 THEN 'Price' WHEN p_size = 2 THEN '' ELSE CAST(p_size AS VARCHAR) END AS size,
    printf('%.2f', p_retailprice) AS price
  FROM part)"""


def _td(x: str) -> str:
    return f"'<td> ' || replace({x}, '&', '&amp;') || ' </td>'"


_ROW_HTML = "'<tr>' || " + " || ".join(_td(c) for c in ("model", "name", "size", "price")) + " || '</tr>'"
_FLAT = f"""
flat AS (
  SELECT block, '<table><tr><th>Model</th><th>Name</th><th>Size</th><th>Price</th></tr>'
    || string_agg({_ROW_HTML}, '' ORDER BY key) || '</table>' AS table_html FROM cells GROUP BY block)"""
_SENTENCE = (
    "'Model: ' || model || ', Name: ' || name || CASE WHEN size = '' THEN '' ELSE ', Size: ' || size END || ', Price: ' || price"
)


def _questions(alias: str = "cells") -> str:
    head, rest = "型號為{key}的{column}是什麼？答案：{value}".split("{key}")
    mid, rest = rest.split("{column}")
    end, tail = rest.split("{value}")
    columns = [("Model", "model"), ("Name", "name"), ("Size", "size"), ("Price", "price")]
    return " UNION ALL ".join(
        f"SELECT block, row_no, {i} AS col_no, model, name, size, price, "
        f"'{head}' || model || '{mid}{label}{end}' || {col} || '{tail}' AS question "
        f"FROM {alias} WHERE {col} NOT IN ('', 'Model', 'Name', 'Size', 'Price')"
        for i, (label, col) in enumerate(columns, 1)
    )


_IMAGES = f"""
images AS (
  SELECT '{SITE}/p/' || key AS url, 1 AS image_no, '{SITE}/img/' || key || '.jpg?v=1&w=2' AS image_url, name AS alt, key, name, model, size FROM cells
  UNION ALL
  SELECT '{SITE}/p/' || key, 2, 'http://cdn.example.com/' || key || '.png', '', key, name, model, size FROM cells)"""

_PART_ELEMENTS = f"""
parts AS (SELECT block, '{SITE}/list/' || block AS source_url FROM (SELECT DISTINCT block FROM cells)),
tables AS (SELECT block, string_agg({_SENTENCE}, chr(10) ORDER BY key) AS text, count(*) AS n_rows FROM cells GROUP BY block),
questions AS ({_questions()}),
part_elements AS (
  SELECT source_url, 'text/html' AS filetype, '1' AS ordinal, 'Block ' || block || chr(10) || 'Allparts' AS text, '' AS "row", 0 AS n_rows FROM parts
  UNION ALL SELECT source_url, 'table/html', '1', text, '', n_rows FROM parts JOIN tables USING (block)
  UNION ALL SELECT source_url, 'table_row_query', '1.' || row_no || '.' || col_no, question, {_SENTENCE}, 0 FROM parts JOIN questions USING (block)
  UNION ALL SELECT source_url, 'image', '1', 'Block ' || block, '', 0 FROM parts)"""
_PAGE_ELEMENTS = f"""{_V2},
page_elements AS (
  SELECT url AS source_url, 'text/html' AS filetype, '1' AS ordinal, trim(string_agg(text, chr(10) ORDER BY pos), {_WS_SET}) AS text
  FROM blocks GROUP BY page_id, url)"""
_ALL_ELEMENTS = f"""WITH {_CELLS}, {_PART_ELEMENTS}, {_PAGE_ELEMENTS},
elements AS (
  SELECT source_url, filetype, ordinal, text FROM part_elements UNION ALL SELECT source_url, filetype, ordinal, text FROM page_elements)"""
_STORED_ELEMENTS = f"""WITH {_CELLS}, {_PART_ELEMENTS}
SELECT {_id("source_url", "filetype", "ordinal", "text")} AS element_id, text, filetype, "row", n_rows FROM part_elements"""

# ---- embedding and search -----------------------------------------------------------------------


def _embedding(name: str, source: str) -> str:
    """CTEs from ``source(id, txt)`` to the sparse and dense hashed embedding ``(id, b, v)``."""
    return f"""
{name}_words AS (SELECT id, unnest(string_split_regex(lower(txt), '{WS}+')) AS w FROM ({source})),
{name}_counts AS (
  SELECT id, CAST(('0x' || substr(md5(w), 1, 7)) AS BIGINT) % {DIM} AS b, count(*) AS c
  FROM {name}_words WHERE w <> '' GROUP BY ALL),
{name}_sparse AS (SELECT id, b, CAST(c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS FLOAT) AS v FROM {name}_counts),
{name} AS (
  SELECT i.id, d.b, coalesce(s.v, CAST(0 AS FLOAT)) AS v
  FROM (SELECT DISTINCT id FROM {name}_sparse) i CROSS JOIN (SELECT unnest(range({DIM})) AS b) d
  LEFT JOIN {name}_sparse s ON s.id = i.id AND s.b = d.b)"""


_CHUNKS = f"""
doc_words AS (SELECT doc_id, lang, list_filter(string_split_regex(text, '{WS}+'), lambda x: x <> '') AS w FROM documents),
chunk_nos AS (
  SELECT doc_id, lang, w, unnest(range(CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= 350 THEN 1
    ELSE CAST(ceil((len(w) - 350) / 250.0) AS BIGINT) + 1 END)) AS chunk_no FROM doc_words),
chunks AS (SELECT doc_id, lang, chunk_no, array_to_string(w[chunk_no * 250 + 1 : chunk_no * 250 + 350], ' ') AS chunk FROM chunk_nos),
idx AS (SELECT {_id("doc_id", "chunk_no")} AS id, chunk AS txt, doc_id, lang FROM chunks)"""


def _nearest(index: str, queries: str, k: int, name: str) -> str:
    return f"""
{name}_dist AS (
  SELECT q.id AS query_id, i.id AS node_id, sum((CAST(i.v AS DOUBLE) - q.v) * (CAST(i.v AS DOUBLE) - q.v)) AS distance
  FROM {index} i JOIN {queries} q ON i.b = q.b GROUP BY ALL),
{name} AS (
  SELECT query_id, node_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), node_id) AS rank
  FROM {name}_dist QUALIFY rank <= {k})"""


def _hits(k: int = 5) -> str:
    return f"""{_CHUNKS}, {_embedding("ie", "SELECT id, txt FROM idx")},
{_embedding("qe", "SELECT item_id AS id, text AS txt FROM benchmark")}, {_nearest("ie", "qe", k, "near")},
hits AS (
  SELECT query_id, rank, node_id, distance, 'doc ' || doc_id AS source, txt AS text, CASE WHEN lang = 'fr' THEN 2 ELSE 0 END AS image_count
  FROM near JOIN idx ON idx.id = near.node_id)"""


_VECTORS = f"""
vec AS (SELECT vec_id AS id, label, generate_subscripts(embedding, 1) - 1 AS b, unnest(embedding) AS v FROM embeddings)"""
_LABELS = f"""{_VECTORS},
means AS (SELECT label AS id, b, CAST(round(avg(CAST(v AS DOUBLE)), 6) AS FLOAT) AS v FROM vec GROUP BY label, b)"""
_KNN_LABELS = f"""WITH {_LABELS}, {_nearest("vec", "means", 10, "near")}
SELECT query_id, node_id, round(distance, 6) AS distance, rank FROM near"""

_PIECE = f"'來源: ' || source || chr(10) || chr(10) || text"
_CONTEXT = f"SELECT query_id, string_agg({_PIECE}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY query_id"
_LINE = _trim("replace(text, chr(10), ' ')")
_SOURCE = (
    "rank || '. source=' || source || ', distance=' || printf('%.4f', distance) || chr(10) || "
    f"CASE WHEN length({_LINE}) > 700 THEN left({_LINE}, 700) || '...' ELSE {_LINE} END"
)


def _sources() -> str:
    return (
        f"SELECT query_id, string_agg({_SOURCE}, chr(10) || chr(10) ORDER BY rank) AS sources "
        "FROM hits GROUP BY query_id"
    )


_REFERENCE = """'- Source: ' || source || ' (distance=' || printf('%.3f', distance) || ')' || chr(10) || '  Content:' || chr(10) || '  ' ||
  CASE WHEN length(text) > 500 THEN left(text, 500) || '... (truncated, total length: ' || length(text) || ' characters)' ELSE text END
  || chr(10) || CASE WHEN image_count > 0 THEN '  Images: ' || image_count || ' found' || chr(10) ELSE '' END"""

# ---- documents as entries -----------------------------------------------------------------------

_BLANK = "' ' || chr(9) || ' '"
_ENTRIES = f"""
entries AS (
  SELECT doc_id AS id, 'http://docs.example.com/' || doc_id AS source_url, lang, n_chars,
    CASE WHEN lang = 'de' THEN 'de: ' || text WHEN n_chars % 11 = 0 THEN {_BLANK} ELSE text END AS text,
    CASE WHEN lang <> 'en' THEN source ELSE 'f' || doc_id END AS source,
    CASE lang WHEN 'fr' THEN 'table_row_query' WHEN 'es' THEN 'image' ELSE 'text/html' END AS filetype,
    CASE WHEN lang = 'es' THEN 1 ELSE 0 END AS n_images,
    CASE WHEN lang = 'fr' THEN {DIM} WHEN lang = 'es' AND n_chars % 2 = 0 THEN 3 END AS stored
  FROM documents),
{_embedding("fresh_e", f"SELECT id, text AS txt FROM entries WHERE stored IS NULL AND trim(text, {_WS_SET}) <> ''")},
totals AS (SELECT id, sum(CAST(v AS DOUBLE)) AS total FROM fresh_e_sparse GROUP BY id),
ingested AS (
  SELECT e.*, stored IS NULL AS fresh,
    CASE WHEN stored IS NOT NULL THEN stored WHEN t.id IS NOT NULL THEN {DIM} END AS dim,
    round(CASE WHEN stored IS NOT NULL THEN stored * (n_chars % 5) * 1.0 ELSE t.total END, 4) AS total,
    CASE WHEN stored IS NULL AND trim(text, {_WS_SET}) = '' THEN 'blank' WHEN stored = 3 THEN 'dim' END AS reason,
    {_id("source", "source_url", "filetype", "text")} AS node_id
  FROM entries e LEFT JOIN totals t ON t.id = e.id)"""
_INDEX = f"""WITH {_ENTRIES}
SELECT node_id, source, source_url, filetype, n_images, CAST(total AS DOUBLE) AS total FROM ingested WHERE reason IS NULL"""


def _described() -> str:
    n_text = "count(*)"
    rows = [
        ("type", "count(*)"), ("element_id", "0"), ("text", n_text), ("chunk", "CAST(count_if(lang IN ('de', 'en')) AS BIGINT)"),
        ("source", "CAST(count_if(lang <> 'en') AS BIGINT)"), ("metadata.filename", n_text), ("metadata.source_url", n_text),
        ("metadata.filetype", n_text), ("metadata.embedding", "count(stored)"), ("metadata.content_blocks", "0"),
        ("metadata.table_html", "0"), ("metadata.table_json", "0"), ("metadata.table_sentences", "0"),
        ("metadata.row_data", "0"), ("metadata.image_base64", "CAST(count_if(lang = 'es') AS BIGINT)"),
        ("metadata.image_mime_type", "0"), ("metadata.orig_img", "0"), ("metadata.label", "0"),
    ]
    sizes = {"metadata.embedding": ("min(stored)", "max(stored)"), "metadata.image_base64": ("1", "1")}
    parts = []
    for name, filled in rows:
        lo, hi = sizes.get(name, ("0", "0"))
        parts.append(
            f"SELECT '{name}' AS field, CAST({filled} AS BIGINT) AS filled, CAST({lo} AS INTEGER) AS shortest, "
            f"CAST({hi} AS INTEGER) AS longest FROM entries GROUP BY ()"
        )
    return f"WITH {_ENTRIES} " + " UNION ALL ".join(parts)


LABEL = (
    '\n'
    'You are a highly knowledgeable image classification assistant specializing in industrial mechanical components.\n'
    'Your job is to analyze a single image (provided as a Base64‐encoded string) in the context of its web page,\n'
    'and return exactly one concise English label that best describes what the image depicts.\n'
    '\n'
    'Requirements:\n'
    '- Respond with only the label, no additional commentary or punctuation.\n'
    '- Use Title-Case (e.g. "Horizontal Motor Gear Reducer").\n'
    '- Do not include words like "Photo of" or "Image of"; just the component name.\n'
    '- If the image shows a type of gear reducer, mention its orientation or mounting style\n'
    '  (e.g. Horizontal, Vertical, Direct-Drive, Dual-Shaft).\n'
    '- If uncertain between two, choose the more specific label.\n'
    '\n'
    'Now, based on the following context and image, provide only the best single label.\n'
    '\n'
    'PAGE CONTEXT:\n'
    '{page_context}\n'
    '\n'
    'IMAGE DATA (base64, truncated):\n'
    '{image_b64_truncated}\n'
    '\n'
    'Label:'
)
_B, _M = LABEL.split("{page_context}")
_M, _A = _M.split("{image_b64_truncated}")


def oracles() -> dict[str, str]:
    queries = {
        "read_pages": f"SELECT page_id, url, length(html) AS html_chars FROM pages WHERE html IS NOT NULL AND {_trim('html')} <> ''",
        "strip_boilerplate": f"SELECT page_id, {_clean('html')} AS html FROM pages",
        "strip_crossed": "SELECT page_id, CAST(no AS INTEGER) AS no, 'ak' || page_id AS kept FROM pages, range(5) r(no)",
        "text_blocks": f"WITH {_V2} {_NUMBERED}",
        "text_blocks_v1": f"WITH {_V1} {_NUMBERED}",
        "block_predicate": r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
marked AS (SELECT doc_id, line_no, ['', 'Copyright ', '© ', '2024 All Rights ', 'x '][line_no % 5 + 1] || line AS line FROM lines)
SELECT * FROM marked WHERE length(line) > 2 AND NOT regexp_matches(line, '(?i)^(?:\s*Copyright|©|\d{4} All Rights)')""",
        "element_text": f"SELECT page_id, {_text(_no_comments('html'))} AS text, {_text(_no_comments('html'), ' ')} AS spaced FROM pages",
        "page_text": f"WITH {_V2} SELECT page_id, {_trim('string_agg(text, chr(10) ORDER BY pos)')} AS text FROM blocks GROUP BY page_id",
        "page_text_v1": f"""WITH {_V1}, t AS (SELECT page_id, {_trim('string_agg(text, chr(10) ORDER BY pos)')} AS text FROM blocks GROUP BY page_id)
SELECT pages.page_id, coalesce(t.text, '') AS text FROM pages LEFT JOIN t USING (page_id)""",
        "html_tables": f"""WITH {_CELLS}, {_FLAT}
SELECT '{SITE}/list/' || block AS url, 1 AS table_no, table_html FROM flat
UNION ALL SELECT '{SITE}/list/' || block, 2, '<table><thead></thead></table>' FROM flat""",
        "page_images": f"WITH {_CELLS}, {_IMAGES} SELECT url, image_no, image_url, alt FROM images",
        "page_links": f"WITH {_LINKS} SELECT * FROM links",
        "resolve_urls": _REFS,
        "crawl_frontier": _crawl(1, 5),
        "crawl_frontier_deep": _crawl(2, 12),
        "unvisited_links": f"""WITH {_NEIGHBOURS}, l AS (SELECT src_url AS start_url, dst_url AS url FROM edges)
SELECT start_url, url FROM l EXCEPT (SELECT start_url, url FROM l WHERE url LIKE '%html' UNION ALL
SELECT url, url FROM pages WHERE starts_with(url, 'https'))""",
        "landed_links": f"WITH {_NEIGHBOURS} SELECT src_url AS start_url, dst_url AS url FROM edges WHERE dst_url IN (SELECT url FROM pages)",
        "parse_tables": f"""WITH {_CELLS}
SELECT block, row_no - 1 AS row_no, c.col_no, c.k, c.v FROM (SELECT block, row_no, unnest([
  {{'col_no': 0, 'k': 'Part__Model', 'v': model}}, {{'col_no': 1, 'k': 'Part__Name', 'v': name}},
  {{'col_no': 2, 'k': 'Detail__Size', 'v': size}}, {{'col_no': 3, 'k': 'Detail__Price', 'v': price}}]) AS c FROM cells)""",
        "parse_spanned_tables": f"""WITH {_CELLS}
SELECT block, row_no - 1 AS row_no, c.col_no, c.k, c.v FROM (SELECT block, row_no, unnest([
  {{'col_no': 0, 'k': 'Model', 'v': model}}, {{'col_no': 1, 'k': 'Detail__Size', 'v': size}},
  {{'col_no': 2, 'k': 'Detail__Price', 'v': price}},
  {{'col_no': 3, 'k': 'Block', 'v': CASE WHEN row_no = 1 THEN 'B' || block ELSE '' END}}]) AS c FROM cells)""",
        "recover_json": """
SELECT p_partkey, 0 AS row_no, c.col_no, c.k, c.v FROM (SELECT p_partkey, unnest([
  {'col_no': 0, 'k': 't', 'v': p_type}, {'col_no': 1, 'k': 'n', 'v': p_name}, {'col_no': 2, 'k': 'a', 'v': CAST(p_size AS VARCHAR)}]) AS c
  FROM part WHERE p_size % 5 NOT IN (1, 2))""",
        "row_sentences": """
SELECT p_partkey, 'p_name: ' || p_name || ', p_brand: ' || p_brand
  || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE ', p_type: ' || p_type END || ', p_size: ' || p_size AS sentence FROM part""",
        "table_elements": f"""WITH {_CELLS}, t AS (SELECT block, string_agg({_SENTENCE}, chr(10) ORDER BY key) AS text, count(*) AS n_rows FROM cells GROUP BY block)
SELECT {_id(f"'{SITE}'", "'table/html'", "block", "text")} AS element_id, text, n_rows FROM t""",
        "cell_questions": f"WITH {_CELLS} SELECT block, row_no, col_no, question FROM ({_questions()})",
        "row_keys": """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS by_header, p_brand AS by_brand FROM part""",
        "attach_images": f"""WITH {_CELLS}, {_IMAGES}
SELECT url, image_no, image_url,
  CASE WHEN image_no = 1 AND size <> '' THEN base64(encode(repeat(name, 5))) END AS image_base64,
  CASE WHEN image_no = 1 AND size <> '' THEN 'image/jpeg' END AS image_mime_type FROM images""",
        "image_bytes": f"""WITH {_CELLS}, {_IMAGES},
whole AS (SELECT *, image_no = 1 AND size <> '' AND length(image_url) % 3 <> 0 AS good FROM images)
SELECT url, image_no, CASE WHEN good THEN CAST(octet_length(encode(repeat(name, 5))) AS BIGINT) END AS n_bytes, CASE WHEN good THEN md5(repeat(name, 5)) END AS digest FROM whole""",
        "image_elements": f"""WITH {_CELLS}, {_IMAGES},
named AS (SELECT url, image_no, image_url, CASE WHEN image_no = 2 THEN NULL WHEN size <> '' AND starts_with(name, 'red') THEN 'Label ' || model ELSE alt END AS label FROM images)
SELECT {_id("url", "'image'", "image_no", "coalesce(label, '')")} AS element_id, label AS text, label AS filename, image_url FROM named""",
        "label_prompts": f"""
SELECT doc_id, {_lit(_B)} || CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END || {_lit(_M)}
  || left(base64(encode(text)), 200) || '...' || {_lit(_A)} AS prompt FROM documents""",
        "build_elements": f"{_ALL_ELEMENTS} SELECT {_id('source_url', 'filetype', 'ordinal', 'text')} AS element_id, source_url, filetype, text FROM elements",
        "build_elements_script": f"""{_ALL_ELEMENTS},
scripted AS (
  SELECT source_url, filetype, ordinal, CASE WHEN filetype = 'image' THEN '' ELSE text END AS text FROM elements
  UNION ALL SELECT url, 'text/html', '1', '' FROM pages WHERE page_id NOT IN (SELECT page_id FROM blocks))
SELECT {_id('source_url', 'filetype', 'ordinal', 'text')} AS element_id, source_url, filetype, text FROM scripted""",
        "element_ids": f"""SELECT doc_id, {_id("source", "'text/html'", "doc_id", "text")} AS element_id FROM documents""",
        "build_guard": f"{_ALL_ELEMENTS} SELECT count(*) AS elements, CAST(count_if(filetype <> 'image') AS BIGINT) AS embedded FROM elements",
        "profile_elements": f"""{_ALL_ELEMENTS}
SELECT count(*) AS elements, CAST(count_if(filetype LIKE 'table%') AS BIGINT) AS tables, CAST(count_if(filetype = 'image') AS BIGINT) AS images,
  CAST(count_if(filetype <> 'image') AS BIGINT) AS with_embedding, round(CAST(count_if(filetype <> 'image') AS BIGINT) * 100.0 / count(*), 2) AS embedding_pct FROM elements""",
        "count_by_type": f"{_ALL_ELEMENTS} SELECT filetype, count(*) AS n FROM elements GROUP BY filetype",
        "describe_elements": _described(),
        "embedding_sizes": f"WITH {_ENTRIES} SELECT CAST(coalesce(stored, 0) AS INTEGER) AS dim, count(*) AS n FROM entries GROUP BY stored",
        "page_report": """
SELECT 2 * count(*) AS pages, CAST(count(*) + count_if(html IS NULL OR trim(html) = '') AS BIGINT) AS blank FROM pages""",
        "pick_text_and_source": f"WITH {_ENTRIES} SELECT source_url, text, source, n_images FROM entries",
        "image_lists": """
SELECT doc_id, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 0 END AS n,
  CASE lang WHEN 'en' THEN source WHEN 'fr' THEN source || '|' || lang ELSE '' END AS images FROM documents""",
        "resolve_vectors": f"WITH {_ENTRIES} SELECT source_url, fresh, coalesce(dim, 0) AS dim, CAST(total AS DOUBLE) AS total FROM ingested",
        "embed_text": f"""WITH {_embedding("e", "SELECT doc_id AS id, text AS txt FROM documents")}
SELECT id AS doc_id, b AS bucket, round(CAST(v AS DOUBLE), 6) AS value FROM e_sparse""",
        "valid_vectors": f"WITH {_ENTRIES} SELECT source_url, reason FROM ingested",
        "node_ids": f"WITH {_ENTRIES} SELECT source_url, node_id FROM ingested",
        "ingest_report": f"""WITH {_ENTRIES}
SELECT CAST(count_if(reason IS NULL) AS BIGINT) AS processed, CAST(count_if(reason IS NOT NULL) AS BIGINT) AS skipped, CAST(count_if(filetype LIKE '%table%') AS BIGINT) AS tables,
  CAST(count_if(filetype LIKE '%image%') AS BIGINT) AS images FROM ingested""",
        "chunk_words": f"WITH {_CHUNKS} SELECT doc_id, chunk_no, chunk FROM chunks",
        "knn_search": f"""WITH {_VECTORS}, one AS (SELECT 0 AS id, b, CAST(0.125 AS DOUBLE) AS v FROM (SELECT unnest(range({DIM})) AS b)),
{_nearest("vec", "one", 10, "near")} SELECT node_id, round(distance, 6) AS distance, rank FROM near""",
        "knn_join": _KNN_LABELS,
        "knn_join_blocks": _KNN_LABELS,
        "hit_lookup": f"WITH {_hits()} SELECT query_id, rank, source, text, round(distance, 6) AS distance FROM hits",
        "lookup_payload": f"WITH {_hits()} SELECT query_id, rank, source, text, round(distance, 6) AS distance FROM hits",
        "clamp_k": "SELECT doc_id, greatest(1, least(n_chars % 40 - 5, 20)) AS k FROM documents",
        "search_status": f"""WITH {_hits(3)},
n AS (SELECT query_id, count(*) AS n FROM hits GROUP BY query_id)
SELECT way || kind || '-' || item_id AS query_id,
  CASE WHEN kind IN ('blank', 'failed') THEN 'no_embedding' WHEN kind = 'long-plain' THEN 'bad_dim' WHEN way <> '' OR n IS NULL THEN 'no_hits' ELSE 'ok' END AS status,
  CAST(CASE WHEN kind = 'plain' AND way = '' THEN coalesce(n, 0) ELSE 0 END AS BIGINT) AS n_hits,
  CASE WHEN kind = 'failed' THEN 'ValueError: no vector for this text' END AS error
FROM benchmark LEFT JOIN n ON n.query_id = item_id, (VALUES ('plain'), ('blank'), ('failed'), ('long-plain')) k(kind), (VALUES (''), ('none-')) w(way)""",
        "answer_records": f"""WITH {_hits(3)},
n AS (SELECT query_id, string_agg(source, '|' ORDER BY rank) AS sources FROM hits GROUP BY query_id),
rows AS (SELECT *, kind || '-' || item_id AS name FROM benchmark LEFT JOIN n ON n.query_id = item_id, (VALUES ('plain'), ('blank'), ('failed'), ('long-plain')) k(kind))
SELECT name AS query_id,
  CASE WHEN kind IN ('blank', 'failed') THEN 'no_embedding' WHEN kind = 'long-plain' THEN 'bad_dim' WHEN sources IS NULL THEN 'no_hits' ELSE 'ok' END AS status,
  CASE kind WHEN 'blank' THEN {_lit(NO_EMBEDDING)} WHEN 'failed' THEN {_lit(NO_EMBEDDING + EMBEDDING_ERROR)} || 'ValueError: no vector for this text'
    WHEN 'long-plain' THEN {_lit(NO_ANSWER)} ELSE CASE WHEN sources IS NULL THEN {_lit(NO_HITS)} WHEN length(text) % 2 = 1 THEN 'A: ' || text ELSE {_lit(ANSWER_ERROR + "E: ")} || name END END AS answer,
  CASE WHEN kind = 'failed' THEN 'ValueError: no vector for this text' END AS error,
  CASE WHEN kind = 'plain' THEN coalesce(sources, '') ELSE '' END AS sources
FROM rows""",
        "project_hits": f"WITH {_hits()} SELECT query_id, rank, source, image_count FROM hits",
        "build_context": f"WITH {_hits()} {_CONTEXT}",
        "build_prompts": f"""WITH {_hits()}, c AS ({_CONTEXT})
SELECT query_id, {_lit(PROMPT_HEAD)} || context || {_lit(PROMPT_QUESTION)} || text || {_lit(PROMPT_TAIL)} AS prompt
FROM c JOIN benchmark ON item_id = query_id""",
        "format_sources": f"WITH {_hits()} {_sources()}",
        "format_references": f"WITH {_hits()} SELECT query_id, string_agg({_REFERENCE}, chr(10) ORDER BY rank) AS refs FROM hits GROUP BY query_id",
        "answer_text": f"""WITH {_hits()}, s AS ({_sources()}), one AS (SELECT item_id AS query_id, text FROM benchmark UNION ALL SELECT -1 - item_id, text FROM benchmark)
SELECT query_id, CASE WHEN sources IS NULL THEN text ELSE 'Answer:' || chr(10) || text || chr(10) || chr(10) || 'Sources:' || chr(10) || sources END AS answer
FROM one LEFT JOIN s USING (query_id)""",
        "index_status": f"""WITH {_CHUNKS}
SELECT count(*) AS vectors, count(*) AS texts, {DIM} AS dimension, true AS consistent, count(*) > 0 AS ready FROM chunks""",
        "saved_index_status": f"""WITH {_CHUNKS}
SELECT count(*) AS vectors, count(*) AS texts, {DIM} AS dimension, true AS consistent, count(*) > 0 AS ready, true AS "exists" FROM chunks""",
        "history_prompts": f"""
WITH h AS (SELECT *, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS history FROM conversations)
SELECT conv_id, turn, history, {_lit(HISTORY_HEAD)} || history || {_lit(HISTORY_TAIL)} || text AS prompt FROM h""",
        "map_model": """
SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN len(list_filter(string_split(text, ' '), lambda x: x <> '')) ELSE -1 END AS n_words,
  CASE WHEN contains(text, chr(10)) THEN '' ELSE 'ValueError: one line' END AS error FROM documents""",
        "save_load_index": _INDEX,
        "append_index": _INDEX,
        "merge_indexes": _INDEX,
        "write_read_elements": _STORED_ELEMENTS,
        "write_read_elements_jsonl": _STORED_ELEMENTS,
        "write_read_elements_array": _STORED_ELEMENTS,
    }
    return {name: sql.strip() for name, sql in queries.items()}
