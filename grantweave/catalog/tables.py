"""Raw grids, cleaning, file gates and merging over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave import schema
from grantweave.catalog.base import SPACES, money_sql, pick, query, slug_sql, squeeze_sql, table
from grantweave.catalog.texts import DATE_TEXT, MONEY_TEXT
from grantweave.operators import clean, dedup, headers, selection
from grantweave.plans import build

# ------------------------------------------------------------------ raw grids
# One published list per customer: a banner, a header in one of four spellings,
# for half of them a repeated header, then the customer's orders.

_LIST = "concat('list-', cast(c_custkey as string))"
_HEADERS = [
    ["Cod SMIS", "Denumire beneficiar", "Titlu proiect", "Valoare eligibila (lei)", "Județ implementare proiect"],
    ["Nr.", "SMIS  code", "Beneficiary name", "Project title", "Total eligible value"],
    ["Cod proiect", "Beneficiar", "Beneficiar", "Stadiu", ""],
    ["Nr.", "Observații", "Alte date", "", ""],
]
_ENGLISH = ["SMIS code", "Beneficiary name", "Project title", "Total eligible value", "County"]
_AGAIN = ["Cod SMIS", "Beneficiar", "Titlu proiect", "", ""]
_CELLS = [
    "cast(100000 + o_orderkey as string)",
    "concat('  Firma ', substr(o_orderpriority, 3, 20), '  SRL ')",
    "concat('Proiect ', o_orderstatus)",
    "concat(cast(cast(floor(o_totalprice) as bigint) as string), ',50')",
    "'Cluj'",
]


def _quoted(items: list[str]) -> list[str]:
    return [f"'{i}'" for i in items]


def _list_sql(items: list[str]) -> str:
    return f"[{', '.join(items)}]"


def raw_grid(spark, sf):
    def array(items):
        return f"array({', '.join(items)})"

    head = table(spark, sf, "customer").selectExpr(
        f"{_LIST} AS file_path",
        f"""inline(array(
          named_struct('row_no', 0L, 'cells', array(concat('LISTA PROIECTELOR ', c_name))),
          named_struct('row_no', 1L, 'cells', {pick('c_custkey', *[array(_quoted(h)) for h in _HEADERS])}),
          named_struct('row_no', IF(c_custkey % 2 = 0, 2L, NULL), 'cells', {array(_quoted(_ENGLISH))})))""",
    ).where("row_no IS NOT NULL")
    orders = table(spark, sf, "orders")
    body = orders.selectExpr(
        "concat('list-', cast(o_custkey as string)) AS file_path",
        "o_orderkey + 3 AS row_no",
        f"""CASE WHEN o_orderkey % 17 = 0 THEN {array(_quoted(_AGAIN))}
          WHEN o_orderkey % 13 = 0 THEN {array(_CELLS[:2])} ELSE {array(_CELLS)} END AS cells""",
    )
    return head.unionByName(body)


_ALIAS_ROWS = ", ".join(f"('{a}', '{f}')" for a, f in headers._spellings(None))

_GRID_SQL = f"""
    SELECT {_LIST} AS file_path, 0 AS row_no, ['LISTA PROIECTELOR ' || c_name] AS cells FROM customer
    UNION ALL SELECT {_LIST}, 1, {pick('c_custkey', *[_list_sql(_quoted(h)) for h in _HEADERS])} FROM customer
    UNION ALL SELECT {_LIST}, 2, {_list_sql(_quoted(_ENGLISH))} FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'list-' || o_custkey, o_orderkey + 3,
      CASE WHEN o_orderkey % 17 = 0 THEN {_list_sql(_quoted(_AGAIN))}
        WHEN o_orderkey % 13 = 0 THEN {_list_sql(_CELLS[:2])} ELSE {_list_sql(_CELLS)} END FROM orders"""


def _grid_ctes(grid: str) -> str:
    return f"""
  grid AS ({grid}),
  aliases(alias, field) AS (VALUES {_ALIAS_ROWS}),
  cell AS (SELECT file_path, row_no, unnest(cells) AS c, generate_subscripts(cells, 1) - 1 AS pos FROM grid),
  keyed AS (SELECT file_path, row_no, pos, {squeeze_sql('c')} AS c, {slug_sql('c')} AS key FROM cell),
  known AS (SELECT key, arg_max(field, length(alias)) AS field
    FROM (SELECT DISTINCT key FROM keyed) JOIN aliases ON starts_with(key, alias) GROUP BY key),
  mapped AS (SELECT k.*, field FROM keyed k LEFT JOIN known USING (key)),
  scores AS (SELECT file_path, row_no, count(DISTINCT field) AS n FROM mapped WHERE row_no < 12 GROUP BY ALL),
  head AS (SELECT file_path, row_no AS header_row, n AS n_fields FROM scores WHERE n >= 2
    QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY n DESC, row_no) = 1),
  cols AS (SELECT file_path, field, min(pos) AS pos, arg_min(c, pos) AS header
    FROM mapped JOIN head USING (file_path) WHERE row_no = header_row AND field IS NOT NULL GROUP BY ALL),
  again AS (SELECT file_path, row_no FROM mapped
    WHERE c <> '' AND length(c) <= 90 AND NOT regexp_matches(c, '[0-9]')
    GROUP BY ALL HAVING count(*) >= 2 AND count(DISTINCT field) >= 2),
  body AS (SELECT g.file_path, g.row_no, cells,
      row_number() OVER (PARTITION BY g.file_path ORDER BY g.row_no) - 1 AS source_row
    FROM grid g JOIN head USING (file_path) ANTI JOIN again a ON g.file_path = a.file_path AND g.row_no = a.row_no
    WHERE g.row_no > header_row)
"""


GRID_CTES = _grid_ctes(_GRID_SQL)


_SHOWN = ["project_code", "beneficiary_name", "project_title", "total_eligible_amount", "county"]


@query("detect_header_row", f"WITH {GRID_CTES} SELECT file_path, cast(header_row AS bigint) AS header_row, n_fields FROM head")
def detect_header_row(spark, sf):
    found = headers.detect_headers(raw_grid(spark, sf))
    return found.select("file_path", "header_row", F.col("n_fields").cast("bigint").alias("n_fields"))


@query("map_headers", f"WITH {GRID_CTES} SELECT file_path, field, cast(pos AS bigint) AS position, header FROM cols")
def map_headers(spark, sf):
    mapped = headers.column_map(headers.detect_headers(raw_grid(spark, sf)))
    squeezed = F.trim(F.regexp_replace("header", r"\s+", " "))
    return mapped.select("file_path", "field", F.col("position").cast("bigint").alias("position"), squeezed.alias("header"))


@query("repeated_headers", f"WITH {GRID_CTES} SELECT file_path, cast(row_no AS bigint) AS row_no FROM again")
def repeated_headers(spark, sf):
    return raw_grid(spark, sf).where(headers.looks_like_header(F.col("cells"))).select("file_path", "row_no")


@query(
    "grid_to_table",
    f"WITH {GRID_CTES}, cell_of AS (SELECT b.file_path, b.source_row, field, coalesce({squeeze_sql('b.cells[pos + 1]')}, '') AS v "
    "FROM body b JOIN cols USING (file_path)) SELECT file_path, cast(source_row AS bigint) AS source_row, "
    + ", ".join(f"max(v) FILTER (field = '{f}') AS {f}" for f in _SHOWN)
    + " FROM cell_of GROUP BY ALL",
)
def grid_to_table(spark, sf):
    return headers.grid_to_table(raw_grid(spark, sf)).select("file_path", "source_row", *_SHOWN)


_RESOURCE = pick("c_custkey", "'Lista POCU 2024'", "'lista_por'", "'regio x'")


def _manifest(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "'portal' AS source", "c_mktsegment AS dataset", "c_name AS url", f"{_LIST} AS path", "sha2(c_name, 256) AS sha256",
        "c_custkey AS bytes", "cast(c_custkey as string) AS fetched_at", f"map('resource_name', {_RESOURCE}) AS meta",
    )
    return schema.conform(rows, schema.MANIFEST)


_TABLE_CTES = f"""{GRID_CTES},
  cell_of AS (SELECT b.file_path, b.source_row, field, coalesce({squeeze_sql('b.cells[pos + 1]')}, '') AS v
    FROM body b JOIN cols USING (file_path)),
  flat AS (SELECT file_path, source_row, """ + ", ".join(
    f"max(v) FILTER (field = '{f}') AS {f}" for f in _SHOWN
) + f""" FROM cell_of GROUP BY file_path, source_row),
  judged AS (SELECT *, coalesce(regexp_matches(beneficiary_name, '[A-Za-zÀ-ž]{{3}}')
    AND NOT regexp_matches(beneficiary_name, '{fv.TOTAL_ROW_WORDS}'), false) AS kept FROM flat)"""


@query(
    "extract_tables",
    f"""WITH {_TABLE_CTES} SELECT file_path AS source_file, cast(source_row AS bigint) AS source_row, project_code, beneficiary_name,
      {money_sql('total_eligible_amount')} AS total_eligible_amount, county,
      nullif(upper(regexp_extract({_RESOURCE}, '{fv.PORTAL_PROGRAMS}', 1)), '') AS program, c_mktsegment AS source_dataset,
      sha256(c_name) AS source_sha256, c_custkey::varchar AS fetched_at, 'RON' AS currency
    FROM judged JOIN customer ON file_path = {_LIST} WHERE kept""",
)
def extract_tables(spark, sf):
    return build.extract_tables(raw_grid(spark, sf), _manifest(spark, sf)).select(
        "source_file", "source_row", "project_code", "beneficiary_name", "total_eligible_amount", "county", "program",
        "source_dataset", "source_sha256", "fetched_at", "currency",
    )


@query(
    "extract_report",
    f"""WITH {_TABLE_CTES}, counts AS (SELECT file_path, count(*) AS n_rows, count(*) FILTER (kept) AS n_kept FROM judged GROUP BY 1),
    named AS (SELECT file_path, count(*) FILTER (field = 'beneficiary_name') AS has_name FROM cols GROUP BY 1)
    SELECT file_path, n_lines, coalesce(n_rows, 0) AS n_rows, coalesce(n_kept, 0) AS n_kept,
      CASE WHEN has_name IS NULL THEN 'no header row' WHEN has_name = 0 THEN 'no beneficiary column'
        WHEN coalesce(n_kept, 0) = 0 THEN 'no usable rows' END AS reason
    FROM (SELECT file_path, count(*) AS n_lines FROM grid GROUP BY 1) LEFT JOIN named USING (file_path) LEFT JOIN counts USING (file_path)""",
)
def extract_report(spark, sf):
    return build.extract_report(raw_grid(spark, sf)).select("file_path", "n_lines", "n_rows", "n_kept", "reason")


# Two readings of each list: the first lost every third order. Orders come in four tables (blocks) a
# list, and every fourth one has a cell too many.
_READ = "variant = 'second' OR row_no < 3 OR row_no % 3 > 0"
_BLOCK_NO = "CASE WHEN row_no < 1 THEN 0 WHEN row_no < 3 THEN 1 ELSE 2 + row_no % 4 END"


def archive_grid(spark, sf):
    rows = raw_grid(spark, sf).selectExpr("*", "explode(array('first', 'second')) AS variant").where(_READ)
    more = "IF(row_no >= 3 AND row_no % 4 = 3, array_append(cells, 'x'), cells) AS cells"
    return rows.selectExpr("file_path", "variant", f"cast({_BLOCK_NO} as int) AS block_no", "row_no", more)


_ARCHIVE_GRID = f"""SELECT file_path || '#' || variant AS file_path, row_no,
      CASE WHEN row_no >= 3 AND row_no % 4 = 3 THEN list_append(cells, 'x') ELSE cells END AS cells
    FROM ({_GRID_SQL}), (VALUES ('first'), ('second')) v(variant) WHERE {_READ}"""
_ARCHIVE_CTES = f"""{_grid_ctes(_ARCHIVE_GRID)},
  widths AS (SELECT file_path, {_BLOCK_NO} AS block_no, arg_min(len(cells), row_no) AS width FROM grid GROUP BY ALL),
  wanted AS (SELECT h.file_path, {_BLOCK_NO.replace('row_no', 'header_row')} AS header_block, w.width
    FROM head h JOIN widths w ON h.file_path = w.file_path AND w.block_no = {_BLOCK_NO.replace('row_no', 'header_row')}),
  fitting AS (SELECT file_path, block_no FROM widths w JOIN wanted USING (file_path)
    WHERE block_no >= header_block AND w.width = wanted.width),
  table_body AS (SELECT file_path, cells, row_number() OVER (PARTITION BY file_path ORDER BY row_no) - 1 AS source_row
    FROM (SELECT *, {_BLOCK_NO} AS block_no FROM body) JOIN fitting USING (file_path, block_no)),
  cell_of AS (SELECT b.file_path, b.source_row, field, coalesce({squeeze_sql('b.cells[pos + 1]')}, '') AS v
    FROM table_body b JOIN cols USING (file_path)),
  flat AS (SELECT file_path, source_row, """ + ", ".join(
    f"max(v) FILTER (field = '{f}') AS {f}" for f in _SHOWN
) + f""" FROM cell_of GROUP BY file_path, source_row),
  judged AS (SELECT *, coalesce(regexp_matches(beneficiary_name, '[A-Za-zÀ-ž]{{3}}')
      AND NOT regexp_matches(beneficiary_name, '{fv.TOTAL_ROW_WORDS}'), false) AS kept,
    coalesce(regexp_matches(project_code, '^\\s*\\d{{4,7}}\\s*$'), false) AS coded FROM flat),
  mapped_fields AS (SELECT file_path, count(*) FILTER (field = 'beneficiary_name') AS has_name,
    count(*) FILTER (field = 'project_code') AS has_code FROM cols GROUP BY 1),
  reading AS (SELECT f.file_path, has_name > 0 AND has_code > 0 AS usable, count(kept) AS n_rows,
      count(*) FILTER (kept) AS n_kept, count(*) FILTER (kept AND coded) AS n_coded
    FROM mapped_fields f LEFT JOIN judged USING (file_path) GROUP BY ALL),
  best AS (SELECT file_path, usable AND n_kept > 0 AND n_coded >= n_kept * {fv.MIN_CODE_SHARE} AND n_kept >= n_rows * {fv.MIN_KEPT_SHARE} AS passes
    FROM reading QUALIFY row_number() OVER (PARTITION BY split_part(file_path, '#', 1)
      ORDER BY CASE WHEN usable THEN n_kept ELSE 0 END DESC, file_path) = 1)"""


@query(
    "extract_archive",
    f"""WITH {_ARCHIVE_CTES} SELECT split_part(file_path, '#', 1) AS source_file, split_part(file_path, '#', 2) AS variant,
      cast(source_row AS bigint) AS source_row, project_code, beneficiary_name, {money_sql('total_eligible_amount')} AS total_eligible_amount
    FROM judged JOIN best USING (file_path) WHERE kept AND passes""",
)
def extract_archive(spark, sf):
    staged = build.stage_tables(archive_grid(spark, sf), archive=True)
    rows = build.extract_tables(staged, _manifest(spark, sf), archive=True)
    chosen = staged.files.select(F.col("file_path").alias("source_file"), "variant")
    return rows.join(chosen, "source_file").select(
        "source_file", "variant", "source_row", "project_code", "beneficiary_name", "total_eligible_amount"
    )


@query(
    "header_names",
    f"""WITH {GRID_CTES}, base AS (SELECT file_path, row_no, pos, CASE WHEN c = '' THEN 'col_' || pos ELSE c END AS name FROM keyed),
    seen AS (SELECT *, row_number() OVER (PARTITION BY file_path, row_no, name ORDER BY pos) - 1 AS k FROM base)
    SELECT file_path, cast(row_no AS bigint) AS row_no,
      array_to_string(list(CASE WHEN k > 0 THEN name || '_' || k ELSE name END ORDER BY pos), '|') AS names
    FROM seen GROUP BY ALL""",
)
def header_names(spark, sf):
    names = F.array_join(headers.header_names(F.col("cells")), "|")
    return raw_grid(spark, sf).select("file_path", "row_no", names.alias("names"))


@query(
    "number_rows",
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS source_row FROM events",
)
def number_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return headers.number_rows(events, ["event_type"], "event_id", chunk=1000)


# ------------------------------------------------------------ schemas, unions

_MINI = schema.struct("key BIGINT, name STRING, nation INT, balance DOUBLE, segment STRING, since DATE")


@query(
    "conform_union",
    """SELECT try_cast(regexp_extract(k, '[0-9]+$') AS bigint) AS key, name, nation, balance, segment, cast(since AS varchar) AS since FROM (
      SELECT cast(c_custkey AS varchar) AS k, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
        c_mktsegment AS segment, NULL::date AS since FROM customer
      UNION ALL SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE cast(s_suppkey AS varchar) END, s_name, s_nationkey, s_acctbal,
        NULL, DATE '2020-01-01' FROM supplier)""",
)
def conform_union(spark, sf):
    one = table(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "cast(c_nationkey as string) AS nation", "cast(c_acctbal as string) AS balance",
        "c_mktsegment AS segment",
    )
    two = table(spark, sf, "supplier").selectExpr(
        "IF(s_suppkey % 5 = 0, 'x', cast(s_suppkey as string)) AS key", "s_name AS name", "s_nationkey AS nation",
        "s_acctbal AS balance", "'2020-01-01' AS since", "1 AS unknown_column",
    )
    both = schema.union_conformed([one, two], _MINI, spark)
    return both.withColumn("since", F.col("since").cast("string"))


# -------------------------------------------------------- cleaning and gates

_NAME = pick(
    "c_custkey", "'TOTAL general'", "'Total general'", "concat('subtotal ', c_name)", "''", "'12.345'",
    "concat(' ', c_name, '   SRL ')", "'Școala'", "c_name", "'suma'", "concat('Fonduri ', c_name)",
)
_TOTAL_WORDS = fv.TOTAL_ROW_WORDS


@query(
    "clean_rows",
    f"""SELECT c_custkey, mode, name FROM (SELECT c_custkey, {squeeze_sql(_NAME)} AS name FROM customer),
      (VALUES ('literal'), ('intended')) m(mode)
    WHERE regexp_matches(name, '[A-Za-zÀ-ž]{{3}}')
      AND NOT (mode = 'literal' AND regexp_matches(name, '{_TOTAL_WORDS}'))
      AND NOT (mode = 'intended' AND regexp_matches(name, '(?i)^{_TOTAL_WORDS}'))""",
)
def clean_rows(spark, sf):
    names = table(spark, sf, "customer").selectExpr("c_custkey", f"{_NAME} AS beneficiary_name")
    both = [
        clean.clean_rows(names, mode).select("c_custkey", F.lit(mode).alias("mode"), F.col("beneficiary_name").alias("name"))
        for mode in ("literal", "intended")
    ]
    return both[0].unionByName(both[1])


@query(
    "clean_amounts",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, {money_sql('v')} AS total_eligible_amount FROM (
      SELECT l_orderkey, l_partkey, l_linenumber, {MONEY_TEXT} AS v FROM lineitem WHERE l_suppkey % 3 > 0)""",
)
def clean_amounts(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    rows = table(spark, sf, "lineitem").selectExpr(
        *keys, f"{MONEY_TEXT} AS total_eligible_amount",
        "CASE WHEN l_suppkey % 3 > 0 THEN concat('Firma ', cast(l_suppkey as string)) ELSE '000' END AS beneficiary_name",
    )
    return clean.clean_rows(rows).select(*keys, "total_eligible_amount")


_KEPT = "cast(round(l_discount * 100) as bigint) < 3 + l_suppkey % 9"
_CODE = "CASE WHEN l_linenumber <= 3 + l_suppkey % 5 THEN concat(' ', cast(100000 + l_suppkey as string)) ELSE 'n/a' END"
_REPORT = f"""
  report AS (SELECT l_suppkey, count(*) AS n_rows, count(*) FILTER ({_KEPT}) AS n_kept,
      count(*) FILTER ({_KEPT} AND regexp_matches({_CODE}, '^\\s*\\d{{4,7}}\\s*$')) AS n_coded
    FROM lineitem GROUP BY l_suppkey),
  judged AS (SELECT *, CASE WHEN n_kept = 0 THEN 'no usable rows' WHEN n_coded < n_kept * {fv.MIN_CODE_SHARE} THEN 'few project codes'
      WHEN n_kept < n_rows * {fv.MIN_KEPT_SHARE} THEN 'few usable rows' END AS reason FROM report)
"""


def _gate(spark, sf):
    lines = table(spark, sf, "lineitem")
    report = clean.file_report(lines, F.expr(_KEPT), clean.has_code(F.expr(_CODE)), ["l_suppkey"])
    return lines, report


@query("file_report", f"WITH {_REPORT} SELECT l_suppkey, n_rows, n_kept, n_coded, reason FROM judged")
def file_report(spark, sf):
    return _gate(spark, sf)[1]


@query(
    "file_gate",
    f"""WITH {_REPORT} SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem SEMI JOIN (
      SELECT l_suppkey FROM judged WHERE reason IS NULL) j USING (l_suppkey)""",
)
def file_gate(spark, sf):
    lines, report = _gate(spark, sf)
    return clean.keep_passing(lines, report, ["l_suppkey"]).select("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "best_variant",
    """WITH n AS (SELECT user_id, event_type, count(*) FILTER (value > 20) AS n_usable,
        min(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 + length(event_type) END) AS p
      FROM events GROUP BY ALL)
    SELECT user_id, event_type AS variant, n_usable FROM n
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n_usable DESC, p) = 1""",
)
def best_variant(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "variant")
    priority = F.expr("CASE variant WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 + length(variant) END")
    return clean.best_variant(events, F.col("value") > 20, priority, ["user_id"])


_BLOCK = "month(o_orderdate)"
_WIDTHS = f"""
  g AS (SELECT o_custkey, {_BLOCK} AS block_no, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 3 END AS w FROM orders),
  blocks AS (SELECT o_custkey, block_no, arg_min(w, o_orderkey) AS width FROM g GROUP BY ALL),
  head AS (SELECT o_custkey, min(block_no) AS h, arg_min(width, block_no) AS hw FROM blocks GROUP BY ALL)
"""


def _widths(spark, sf):
    grid = table(spark, sf, "orders").selectExpr(
        "o_custkey", f"{_BLOCK} AS block_no", "o_orderkey AS row_no",
        "IF(o_orderkey % 3 = 0, array('a', 'b'), array('a', 'b', 'c')) AS cells",
    )
    first = grid.groupBy("o_custkey").agg(F.min("block_no").alias("block_no"))
    return clean.check_widths(grid, first, ["o_custkey"])


@query(
    "width_check",
    f"""WITH {_WIDTHS} SELECT o_orderkey FROM g JOIN blocks USING (o_custkey, block_no) JOIN head USING (o_custkey)
    WHERE width = hw""",
)
def width_check(spark, sf):
    return _widths(spark, sf)[0].select(F.col("row_no").alias("o_orderkey"))


@query(
    "width_report",
    f"""WITH {_WIDTHS} SELECT o_custkey, count(*) FILTER (width = hw) AS blocks_kept,
      count(*) FILTER (width <> hw) AS blocks_skipped FROM blocks JOIN head USING (o_custkey) GROUP BY o_custkey""",
)
def width_report(spark, sf):
    return _widths(spark, sf)[1]


# --------------------------------------------------------------- selection

_FORMAT = pick("p_partkey", "'XLSX'", "'csv'", "'pdf'", "'xls'")
_URL1 = pick("p_partkey", "concat(' http://a.example/', p_name)", "''", "'/relative'", "''", "'https://b.example/x'")
_URL2 = "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('https://c.example/', cast(p_partkey as string)) END"
_MODIFIED = "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('2024-0', cast(p_size % 9 + 1 as string)) END"


@query(
    "select_resources",
    f"""SELECT dataset, id, coalesce(CASE WHEN regexp_matches(trim(u1), '^https?://') THEN trim(u1) END,
      CASE WHEN regexp_matches(u2, '^https?://') THEN u2 END) AS download_url FROM (
        SELECT p_brand AS dataset, cast(p_partkey AS varchar) AS id, {_FORMAT} AS f, {_URL1} AS u1, {_URL2} AS u2, {_MODIFIED} AS m FROM part
        WHERE lower({_FORMAT}) IN ('xlsx', 'xls', 'csv')
        QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY coalesce({_MODIFIED}, '') DESC, cast(p_partkey AS varchar)) <= 20)
    WHERE download_url IS NOT NULL""",
)
def select_resources(spark, sf):
    resources = table(spark, sf, "part").selectExpr(
        "p_brand AS dataset", "cast(p_partkey as string) AS id", f"{_FORMAT} AS format",
        f"{_URL1} AS datagovro_download_url", f"{_URL2} AS url", f"{_MODIFIED} AS last_modified",
    )
    return selection.select_resources(resources, 20).select("dataset", "id", "download_url")


_STAMP = "cast(20150000000000 + (l_orderkey * 7919) % 90000000000 as string)"
_FILE = pick(
    "l_partkey", "'Lista%20proiectelor'", "'lista_contractate'", "'proiecte-contractate'", "'Lista_proiectelor_respinse'",
    "'ghid'", "'contracte semnate'", "'lista_participantilor'",
)
_ENDING = pick("l_suppkey", "'.pdf'", "'.XLSX?v=1'", "'.doc'")
_ORIGINAL = f"concat('http://www.example.ro/images/', cast(l_suppkey as string), '/', {_FILE}, '_', cast(l_partkey % 20 as string), {_ENDING})"


@query(
    "select_snapshots",
    f"""WITH named AS (SELECT {_STAMP} AS timestamp, {_ORIGINAL} AS original FROM lineitem),
    files AS (SELECT *, split_part(split_part(url_decode(original), '?', 1), '/', -1) AS name FROM named),
    paths AS (SELECT *, substr(timestamp, 1, 4) || '/' || timestamp || '-' || name AS path FROM files
      WHERE regexp_matches(lower(name), '\\.(pdf|xlsx|xls)$') AND regexp_matches(name, '{fv.LIST_FILE_NAMES}')
        AND NOT regexp_matches(name, '{fv.OTHER_FILE_NAMES}'))
    SELECT timestamp, original, path FROM paths
    QUALIFY row_number() OVER (PARTITION BY path ORDER BY timestamp DESC, original DESC) = 1
    ORDER BY timestamp DESC, original DESC LIMIT 60""",
)
def select_snapshots(spark, sf):
    index = table(spark, sf, "lineitem").selectExpr(f"{_STAMP} AS timestamp", f"{_ORIGINAL} AS original")
    return selection.select_snapshots(index, 60)


@query("large_enough", f"SELECT page_id, octet_length(encode(html)) AS bytes FROM pages WHERE bytes >= {fv.MIN_PAYLOAD_BYTES}")
def large_enough(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.octet_length("html").cast("bigint").alias("bytes"))
    return pages.where(selection.large_enough(F.col("bytes")))


# ------------------------------------------------------------------ merging

_LATEST = "CASE WHEN event_id % 50 = 0 THEN NULL ELSE cast(cast(ts as date) as string) END"
_VALUE = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END"
_PROPS = "CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END"


@query(
    "merge_dedup",
    f"""WITH e AS (SELECT event_id, user_id, event_type, {_LATEST} AS seen, {_VALUE} AS value, {_PROPS} AS props FROM events),
    fills AS (SELECT user_id, event_type, first(value ORDER BY event_id) FILTER (value IS NOT NULL) AS fv,
      first(props ORDER BY event_id) FILTER (props IS NOT NULL) AS fp FROM e GROUP BY ALL)
    SELECT event_id, user_id, event_type, seen, coalesce(value, fv) AS value, coalesce(props, fp) AS props
    FROM e JOIN fills USING (user_id, event_type)
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY seen DESC NULLS FIRST, event_id) = 1""",
)
def merge_dedup(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "event_type", f"{_LATEST} AS seen", f"{_VALUE} AS value", f"{_PROPS} AS props"
    )
    return dedup.merge_duplicates(events, ["user_id", "event_type"], ["event_id"], "seen", ["value", "props"])


@query(
    "keep_first",
    "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1",
)
def keep_first(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return dedup.keep_top(turns, ["conv_id"], [F.asc("turn")])


@query(
    "newest_n_per_group",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 3",
)
def newest_n_per_group(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return dedup.keep_top(events, ["user_id"], [F.desc("ts"), F.asc("event_id")], 3).drop("ts")
