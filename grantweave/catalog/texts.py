"""Scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.catalog.base import (
    SPACES, company_sql, grouped, money_sql, number_sql, pick, query, slug_sql, squeeze_sql, table,
    text_of, two_digits,
)
from grantweave.functions import html, links, parse, places, text
from grantweave.operators import selection
from grantweave.sources.files import markdown_cells


@query("slug_text", f"SELECT doc_id, {slug_sql('text')} AS slug FROM documents")
def slug_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query("plain_letters", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def plain_letters(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.plain_letters(F.col("text")).alias("plain"))


@query("squeeze_text", f"SELECT conv_id, turn, {squeeze_sql('text')} AS squeezed FROM conversations")
def squeeze_text(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", text.squeeze(F.col("text")).alias("squeezed"))


_COMPANY = pick(
    "c_custkey", "concat('S.C. ', c_name, ' S.R.L.')", "concat(c_name, ' SRL')",
    "concat('SC ', c_name, ' S.A.')", "concat(c_name, ' SRL SA')", "c_name",
)


@query(
    "company_key",
    f"""SELECT c_custkey, {company_sql('name')} AS literal_key, {company_sql('name', 'intended')} AS intended_key
    FROM (SELECT c_custkey, {_COMPANY} AS name FROM customer)""",
)
def company_key(spark, sf):
    names = table(spark, sf, "customer").selectExpr("c_custkey", f"{_COMPANY} AS name")
    return names.select(
        "c_custkey",
        text.company_key(F.col("name")).alias("literal_key"),
        text.company_key(F.col("name"), "intended").alias("intended_key"),
    )


_FISCAL = pick(
    "c_custkey", "concat('RO ', cast(c_custkey * 977 + 12345 as string))",
    "concat('ro', cast(c_custkey * 977 + 12345 as string))", "'nan'", "'-'", "'000'",
    "concat('00', cast(c_custkey + 7000 as string), '.')", "c_name",
)


@query(
    "fiscal_code",
    f"""SELECT c_custkey, CASE WHEN lower(trim(v)) NOT IN ('', 'nan', 'none', '-') THEN
      nullif(ltrim(regexp_extract(replace(replace(v, '.', ''), ',', ''),
        '(?i)\\b(ro)?\\s?(\\d{{2,10}})\\b', 2), '0'), '') END AS fiscal_code
    FROM (SELECT c_custkey, {_FISCAL} AS v FROM customer)""",
)
def fiscal_code(spark, sf):
    values = table(spark, sf, "customer").selectExpr("c_custkey", f"{_FISCAL} AS v")
    return values.select("c_custkey", text.fiscal_code(F.col("v")).alias("fiscal_code"))


_FILE = "CASE WHEN l_linenumber < 7 THEN concat('liste/', cast(l_orderkey as string), '.xlsx') END"


@query(
    "record_id",
    f"""SELECT l_orderkey, l_partkey, l_linenumber,
      substr(sha1(l_returnflag || '|' || coalesce({_FILE}, 'None') || '|' || l_linenumber::varchar), 1, 16) AS record_id
    FROM lineitem""",
)
def record_id(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("file", F.expr(_FILE))
    made = text.record_id(F.col("l_returnflag"), F.col("file"), F.col("l_linenumber"))
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", made.alias("record_id"))


_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
_WHOLE = f"cast(floor({_CENTS} / 100) as bigint) * 37"
_PART = two_digits(f"({_CENTS} % 100)")
MONEY_TEXT = pick(
    "l_linenumber",
    f"concat({grouped(_WHOLE, '.')}, ',', {_PART}, ' lei')",
    f"concat('RON ', {grouped(_WHOLE, ',')}, '.', {_PART})",
    f"concat({text_of(_WHOLE)}, ',', {_PART})",
    grouped(_WHOLE, "."),
    f"concat('-', {text_of(_WHOLE)})",
    "'-'",
)


@query(
    "parse_money",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, v, {money_sql('v')} AS amount
    FROM (SELECT l_orderkey, l_partkey, l_linenumber, {MONEY_TEXT} AS v FROM lineitem)""",
)
def parse_money(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    texts = table(spark, sf, "lineitem").selectExpr(*keys, f"{MONEY_TEXT} AS v")
    return texts.select(*keys, "v", parse.money(F.col("v")).alias("amount"))


_Y, _M, _D = "cast(year(o_orderdate) as string)", "month(o_orderdate)", "day(o_orderdate)"
_MM, _DD = two_digits(_M), two_digits(_D)
DATE_TEXT = pick(
    "o_orderkey",
    f"concat({_DD}, '.', {_MM}, '.', {_Y})",
    f"concat({_D}, '/', {_M}, '/', {_Y})",
    f"concat({_Y}, '-', {_MM}, '-', {_DD}, ' 10:30')",
    f"concat({_DD}, '-', {_MM}, '-', {_Y})",
    f"concat({_MM}, '/', {_DD}, '/', {_Y})",
    f"concat({_DD}, '.', {_MM}, '.', substr({_Y}, 3, 2))",
    f"concat({_Y}, '/', {_MM}, '/', {_DD})",
    "cast(30000 + o_orderkey % 9000 as string)",
    f"concat('32.', {_MM}, '.', {_Y})",
    "'n/a'",
)


def date_sql(x: str) -> str:
    """Written formats in order, then day numbers."""
    word = f"split_part(trim({x}), ' ', 1)"

    def cast(pattern: str, y: int, m: int, d: int, prefix: str = "''") -> str:
        def part(i: int) -> str:
            return f"regexp_extract({word}, '{pattern}', {i})"

        return (
            f"CASE WHEN regexp_matches({word}, '{pattern}') THEN try_cast(({prefix}) || {part(y)} || '-' || "
            f"lpad({part(m)}, 2, '0') || '-' || lpad({part(d)}, 2, '0') AS date) END"
        )

    d12, d4 = r"(\d{1,2})", r"(\d{4})"
    short = rf"^{d12}\.{d12}\.(\d{{2}})$"
    century = f"CASE WHEN regexp_extract({word}, '{short}', 3) < '69' THEN '20' ELSE '19' END"
    serial = number_sql(f"replace(trim({x}), ',', '.')")
    return f"""coalesce(
      {cast(rf'^{d12}\.{d12}\.{d4}$', 3, 2, 1)},
      {cast(rf'^{d12}/{d12}/{d4}$', 3, 2, 1)},
      {cast(rf'^{d4}-{d12}-{d12}$', 1, 2, 3)},
      {cast(rf'^{d12}-{d12}-{d4}$', 3, 2, 1)},
      {cast(rf'^{d12}/{d12}/{d4}$', 3, 1, 2)},
      {cast(short, 3, 2, 1, century)},
      {cast(rf'^{d4}/{d12}/{d12}$', 1, 2, 3)},
      CASE WHEN ({serial}) > 1 AND ({serial}) < 200000
        THEN DATE '1899-12-30' + cast(floor({serial}) AS integer) END)"""


@query(
    "parse_dates",
    f"""SELECT o_orderkey, v, cast({date_sql('v')} AS varchar) AS day
    FROM (SELECT o_orderkey, {DATE_TEXT} AS v FROM orders)""",
)
def parse_dates(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} AS v")
    return texts.select("o_orderkey", "v", parse.date(F.col("v")).cast("string").alias("day"))


_MONTH_NAME = "CASE month(o_orderdate) " + " ".join(f"WHEN {i} THEN '{m}'" for m, i in fv.MONTHS.items()) + " END"
LONG_DATE_TEXT = pick(
    "o_orderkey",
    f"concat({_D}, ' ', {_MONTH_NAME}, ' ', {_Y}, ' 23:59')",
    f"concat('Până la ', {_D}, '  ', upper({_MONTH_NAME}), ' ', {_Y})",
    f"concat({_DD}, '.', {_MM}, '.', {_Y})",
    f"concat({_DD}, '/', {_MM}, '/', {_Y}, ' ora 10')",
    f"concat({_Y}, '-', {_MM}, '-', {_DD}, 'T00:00')",
    f"concat('31 ', {_MONTH_NAME}, ' ', {_Y})",
    f"concat({_D}, ' luna ', {_Y})",
)


def long_date_sql(x: str) -> str:
    t = f"lower(trim({x}))"
    pattern = r"(\d{1,2})\s+([a-zăîâșț]+)\s+(\d{4})"
    name = f"regexp_extract({t}, '{pattern}', 2)"
    number = f"CASE {name} " + " ".join(f"WHEN '{m}' THEN '{i:02d}'" for m, i in fv.MONTHS.items()) + " END"
    written = (
        f"try_cast(regexp_extract({t}, '{pattern}', 3) || '-' || ({number}) || '-' || "
        f"lpad(regexp_extract({t}, '{pattern}', 1), 2, '0') AS date)"
    )
    head = f"substr({t}, 1, 10)"
    numeric = (
        f"coalesce(try_strptime({head}, '%d.%m.%Y'), try_strptime({head}, '%d/%m/%Y'), "
        f"try_strptime({head}, '%Y-%m-%d'))::date"
    )
    return f"CASE WHEN ({number}) IS NOT NULL THEN {written} ELSE {numeric} END"


@query(
    "parse_long_dates",
    f"""SELECT o_orderkey, v, cast({long_date_sql('v')} AS varchar) AS day
    FROM (SELECT o_orderkey, {LONG_DATE_TEXT} AS v FROM orders)""",
)
def parse_long_dates(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{LONG_DATE_TEXT} AS v")
    return texts.select("o_orderkey", "v", parse.long_date(F.col("v")).cast("string").alias("day"))


_PRICE = "cast(floor(o_totalprice) as bigint) * 11"
AMOUNT_TEXT = pick(
    "o_orderkey", f"concat({grouped(_PRICE, '.')}, ' EUR')", f"concat({grouped(_PRICE, '.')}, ',50 lei')",
    "concat(cast(o_orderkey as string), ',5 RON')", f"concat('Euro: ', {text_of(_PRICE)})", "'fără buget'",
)


def amount_sql(x: str) -> tuple[str, str]:
    digits = f"regexp_replace({x}, '[^0-9,.]', '', 'g')"
    number = (
        f"CASE WHEN contains({digits}, ',') AND contains({digits}, '.') "
        f"THEN replace(replace({digits}, '.', ''), ',', '.') ELSE replace({digits}, '.', '') END"
    )
    currency = (
        f"CASE WHEN contains(upper({x}), 'EUR') THEN 'EUR' "
        f"WHEN contains(upper({x}), 'RON') OR contains(upper({x}), 'LEI') THEN 'RON' END"
    )
    return number_sql(f"({number})"), currency


@query(
    "call_amount",
    f"""SELECT o_orderkey, {amount_sql('v')[0]} AS amount, {amount_sql('v')[1]} AS currency
    FROM (SELECT o_orderkey, {AMOUNT_TEXT} AS v FROM orders)""",
)
def call_amount(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{AMOUNT_TEXT} AS v")
    return texts.select("o_orderkey", parse.call_amount(F.col("v")).alias("a")).select("o_orderkey", "a.*")


_KEY = "cast(event_id % 80 as string)"
JSON_TEXT = pick(
    "event_id",
    f"""concat('{{"a": ["', event_type, '", "x"], "b": "', {_KEY}, ',5", "p": ["', {_KEY}, '.25, 25.5"]}}')""",
    f"""concat('{{"a": "', event_type, '", "b": ', {_KEY}, ', "p": "', {_KEY}, '.5,-3"}}')""",
    """'{"a": [], "b": "n/a", "p": ["x,1"]}'""",
    "props",
)


def _first_json(name: str) -> str:
    return (
        f"CASE WHEN json_type(j, '$.{name}') = 'ARRAY' THEN j->>'$.{name}[0]' ELSE j->>'$.{name}' END"
    )


_POINT = f"({_first_json('p')})"


@query(
    "json_first",
    f"""SELECT event_id, {_first_json('a')} AS a, {number_sql("replace(" + _first_json('b') + ", ',', '.')")} AS b,
      CASE WHEN {number_sql(f"trim(split_part({_POINT}, ',', 2))")} IS NOT NULL
        THEN {number_sql(f"trim(split_part({_POINT}, ',', 1))")} END AS latitude,
      CASE WHEN {number_sql(f"trim(split_part({_POINT}, ',', 1))")} IS NOT NULL
        THEN {number_sql(f"trim(split_part({_POINT}, ',', 2))")} END AS longitude,
      cast(props::json->>'$.k' AS bigint) AS k
    FROM (SELECT event_id, props, ({JSON_TEXT})::json AS j FROM events)""",
)
def json_first(spark, sf):
    items = table(spark, sf, "events").selectExpr(
        "event_id", f"try_parse_json({JSON_TEXT}) AS j", "try_parse_json(props) AS own"
    )
    j = F.col("j")
    point = parse.lat_long(F.coalesce(parse.first_value(j, "p"), F.lit("")))
    return items.select(
        "event_id",
        parse.first_value(j, "a").alias("a"),
        parse.comma_decimal(parse.first_value(j, "b")).alias("b"),
        point["latitude"].alias("latitude"),
        point["longitude"].alias("longitude"),
        parse.first_value(F.col("own"), "k").try_cast("bigint").alias("k"),
    )


@query(
    "iso_dates",
    """SELECT event_id, cast(try_cast(substr(v, 1, 10) AS date) AS varchar) AS day FROM (
      SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'fără dată' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS v
      FROM events)""",
)
def iso_dates(spark, sf):
    stamp = F.when(F.col("event_id") % 5 == 0, F.lit("fără dată")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    )
    events = table(spark, sf, "events").select("event_id", stamp.alias("v"))
    return events.select("event_id", parse.iso_date(F.col("v")).cast("string").alias("day"))


@query(
    "clean_markup",
    f"""SELECT page_id, nullif({squeeze_sql("replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' ')")}, '') AS clean
    FROM pages""",
)
def clean_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", parse.clean_markup(F.col("html")).alias("clean"))


def unescape_sql(x: str) -> str:
    """Enough for the references the driver's pages hold; ``&amp;`` goes last."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, '{name}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def page_text_sql(page: str) -> str:
    t = f"regexp_replace({page}, '<script.*?</script>', ' ', 'gs')"
    t = f"regexp_replace({t}, '<style.*?</style>', ' ', 'gs')"
    t = f"regexp_replace({t}, '<[^>]+>', '|', 'g')"
    t = unescape_sql(f"regexp_replace({t}, '[ \\t\\x{{a0}}]+', ' ', 'g')")
    return f"regexp_replace({t}, '({SPACES}*\\|{SPACES}*)+', '|', 'g')"


@query("page_text", f"SELECT page_id, {page_text_sql('html')} AS page_text FROM pages")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.plain_text(F.col("html")).alias("page_text"))


_TITLE = "regexp_extract(html, '<title>([^<]*)', 1)"


@query("page_title", f"SELECT page_id, trim({unescape_sql(_TITLE)}) AS title FROM pages")
def page_title(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("page_id", f"{_TITLE} AS t")
    return pages.select("page_id", html.title_text(F.col("t")).alias("title"))


@query(
    "page_links",
    """SELECT page_id, array_to_string(list_slice(list_sort(list_distinct(
      regexp_extract_all(html, 'href="([^"]+)"', 1))), 1, 10), ' ') AS links FROM pages""",
)
def page_links(spark, sf):
    found = html.links(F.col("html"), 'href="([^"]+)"')
    return table(spark, sf, "pages").select("page_id", F.array_join(found, " ").alias("links"))


# The whole page, followed by the labelled part of a call page.
_DAY = two_digits("page_id % 28 + 1")
CALL_PAGE = f"""concat(html,
  '<h3>Buget UE:</h3> <b>', {grouped('page_id * 977 + 1000000', '.')}, ' EUR</b>',
  '<p>Data deschiderii:</p><p>', {_DAY}, '.03.2025</p>',
  CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('<p>Data închiderii:</p><p>', {_DAY}, ' iunie 2026 23:59</p>') END,
  '<p>Tip Apel:</p><p>', {pick('page_id', "'Competitiv'", "'Depunere fără termen'", "'Necompetitiv'")}, '</p>',
  '<p>Obiectivul specific:</p><p>RSO', cast(page_id % 7 as string), ' &amp; altele</p>',
  CASE WHEN page_id % 2 = 0 THEN '<p>Programe pentru care se aplică apelul</p><p>PoCIDIF</p>' ELSE '' END,
  '<p>Beneficiari eligibili</p><ul><li>IMM</li><li>ONG, UAT.</li><li>IMM</li><li>', url, '</li></ul>',
  '<p>Criterii de eligibilitate</p><p>da</p>',
  '<p>Domenii Apel:</p><p>Digitalizare</p><p>', substr(url, 9, 12), '</p><p>Zone Geografice</p>',
  '<a href="https://x.example/', cast(page_id as string), '.pdf">a</a><a href="https://x.example/0.pdf">b</a>')"""


def _value_sql(label: str, width: int = 260) -> str:
    tail = f"substr(t, strpos(t, '{label}') + {len(label)}, {width})"
    first = (
        f"list_filter(list_transform(string_split({tail}, '|'), lambda p: trim(p)), lambda p: p <> '')[1]"
    )
    return f"CASE WHEN strpos(t, '{label}') > 0 THEN {first} END"


def _list_sql(label: str, stops: list[str]) -> str:
    tail = f"substr(t, strpos(t, '{label}') + {len(label)}, 1200)"
    for stop in stops:
        tail = f"CASE WHEN strpos({tail}, '{stop}') > 1 THEN split_part({tail}, '{stop}', 1) ELSE {tail} END"
    pieces = f"list_transform(string_split(replace({tail}, '|', ','), ','), lambda p: trim(p, ' .:;'))"
    kept = f"list_filter({pieces}, lambda p: length(p) > 2 AND lower(p) NOT IN ('domenii', 'share'))"
    return f"CASE WHEN strpos(t, '{label}') > 0 THEN array_to_string(list_sort(list_distinct({kept})), '; ') ELSE '' END"


CALL_FIELDS_SQL = f"""
  SELECT page_id, {_value_sql(fv.PAGE_OBJECTIVE, 400)} AS specific_objective,
    {_value_sql(fv.PAGE_CALL_TYPE, 200)} AS call_type,
    {amount_sql(f"({_value_sql(fv.PAGE_BUDGET)})")[0]} AS budget_amount,
    {amount_sql(f"({_value_sql(fv.PAGE_BUDGET)})")[1]} AS budget_currency,
    cast({long_date_sql(f"({_value_sql(fv.PAGE_OPENS)})")} AS varchar) AS opens_at,
    cast({long_date_sql(f"({_value_sql(fv.PAGE_CLOSES)})")} AS varchar) AS closes_at,
    coalesce(contains(lower({_value_sql(fv.PAGE_CALL_TYPE, 200)}), 'fără termen'), false) AS continuous,
    coalesce({_value_sql(fv.PAGE_PROGRAMS, 300)}, '') AS programs,
    {_list_sql(fv.PAGE_BENEFICIARIES, fv.PAGE_BENEFICIARIES_END)} AS beneficiaries,
    {_list_sql(fv.PAGE_DOMAINS, fv.PAGE_DOMAINS_END)} AS domains,
    array_to_string(list_slice(list_sort(list_distinct(
      regexp_extract_all(page, 'href="(https?://[^"]+\\.pdf)"', 1))), 1, 10), ' ') AS documents
  FROM (SELECT page_id, page, {page_text_sql('page')} AS t FROM (SELECT page_id, {CALL_PAGE} AS page FROM pages))
"""


@query("call_page_fields", CALL_FIELDS_SQL)
def call_page_fields(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("page_id", f"{CALL_PAGE} AS page")
    pages = pages.withColumn("t", html.plain_text(F.col("page")))
    fields = html.call_page(F.col("t"), F.col("page"))
    fields |= {n: fields[n].cast("string") for n in ("opens_at", "closes_at")}
    fields |= {n: F.array_join(F.array_sort(fields[n]), "; ") for n in ("beneficiaries", "domains")}
    fields |= {n: F.array_join(fields[n], " ") for n in ("programs", "documents")}
    return pages.select("page_id", *[c.alias(n) for n, c in fields.items()])


_AS_OF = "1998-06-01"


@query(
    "call_status",
    f"""SELECT o_orderkey, CASE WHEN closes < d THEN 'Închis' WHEN opens > d THEN 'Urmează' WHEN closes >= d THEN 'Activ'
      WHEN continuous AND (opens IS NULL OR opens <= d) THEN 'Activ' ELSE 'Necunoscut' END AS status,
      CASE WHEN closes >= d THEN cast(date_diff('day', d, closes) AS integer) END AS days_left
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::date END AS opens,
      CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate::date + cast(o_orderkey % 900 AS integer) END AS closes,
      o_orderstatus = 'P' AS continuous, DATE '{_AS_OF}' AS d FROM orders)""",
)
def call_status(spark, sf):
    day, key = F.lit(_AS_OF).cast("date"), F.col("o_orderkey")
    calls = table(spark, sf, "orders").select(
        key,
        F.when(key % 5 > 0, F.col("o_orderdate").cast("date")).alias("opens"),
        F.when(key % 4 > 0, F.date_add(F.col("o_orderdate").cast("date"), (key % 900).cast("int"))).alias("closes"),
        (F.col("o_orderstatus") == "P").alias("continuous"),
    )
    return calls.select(
        "o_orderkey",
        places.call_status(F.col("opens"), F.col("closes"), F.col("continuous"), day).alias("status"),
        places.days_left(F.col("closes"), day).alias("days_left"),
    )


_LINK_SOURCE = pick("doc_id", "'kohesio'", "'portal'")
_LINK_CODE = "CASE WHEN doc_id % 6 = 0 THEN '' ELSE concat('Q', cast(doc_id as string)) END"


@query(
    "build_links",
    f"""SELECT doc_id,
      CASE WHEN s = 'kohesio' AND c <> '' THEN '{fv.PROJECT_PAGE}' || c END AS project_link,
      '{fv.PROJECT_SEARCH.split('{query}')[0]}' || replace(url_encode(substr(text || ' ' || source, 1, 120)), '%2F', '/')
        || '{fv.PROJECT_SEARCH.split('{query}')[1]}' AS search_link,
      CASE WHEN c <> '' THEN '{fv.FISCAL_PAGE}' || replace(url_encode(c), '%2F', '/') END AS fiscal_link
    FROM (SELECT *, {_LINK_SOURCE} AS s, {_LINK_CODE} AS c FROM documents)""",
)
def build_links(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("*", f"{_LINK_SOURCE} AS s", f"{_LINK_CODE} AS c")
    return docs.select(
        "doc_id",
        links.project_link(F.col("s"), F.col("c")).alias("project_link"),
        links.search_link(F.col("text"), F.col("source")).alias("search_link"),
        links.fiscal_link(F.col("c")).alias("fiscal_link"),
    )


_NAMED = pick("p_partkey", "'Lista POCU '", "'regio-'", "'lista_por_'", "'PODCA '", "'pocument '")
_NAME = f"concat({_NAMED}, p_name, '.xlsx')"
_STAMPED = "concat('https://web.archive.org/web/2024', lpad(cast(p_size % 12 + 1 as string), 2, '0'), '15125245id_/', p_name)"


@query(
    "file_names",
    f"""SELECT p_partkey, nullif(upper(regexp_extract(name, '{fv.PORTAL_PROGRAMS}', 1)), '') AS program,
      CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE nullif(upper(regexp_extract(name, '{fv.ARCHIVE_PROGRAMS}', 1)), '') END AS archive_program,
      strftime(strptime(regexp_extract(url, '/web/(\\d{{8}})', 1), '%Y%m%d'), '%Y-%m-%d') AS snapshot
    FROM (SELECT *, {_NAME} AS name, {_STAMPED} AS url FROM part)""",
)
def file_names(spark, sf):
    parts = table(spark, sf, "part").selectExpr("*", f"{_NAME} AS name", f"{_STAMPED} AS url")
    kind = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.lit(fv.UNKNOWN_PROGRAM))
    return parts.select(
        "p_partkey",
        selection.program_in(F.col("name")).alias("program"),
        selection.archive_program(kind, F.lit(""), F.col("name")).alias("archive_program"),
        selection.snapshot_date(F.col("url")).alias("snapshot"),
    )


_MD = pick("p_partkey", "concat('| ', p_name, ' |', p_brand, '||', p_type, ' |')", "concat('  |', p_name, '|x')", "'|---|:--:|'", "p_name")


@query(
    "markdown_cells",
    f"""SELECT p_partkey, array_to_string(list_transform(string_split(regexp_replace(trim(v), '^\\|+|\\|+$', '', 'g'), '|'),
      lambda c: trim(c)), '~') AS cells
    FROM (SELECT p_partkey, {_MD} AS v FROM part)
    WHERE starts_with(trim(v), '|') AND NOT regexp_matches(trim(v), '^\\|[\\s:|-]+\\|?$')""",
)
def markdown(spark, sf):
    lines = table(spark, sf, "part").selectExpr("p_partkey", f"{_MD} AS v")
    cells = lines.select("p_partkey", markdown_cells(F.col("v")).alias("c")).where("c IS NOT NULL")
    return cells.select("p_partkey", F.array_join("c", "~").alias("cells"))
