"""Queries over the test tables, one for each operator, and SQL that gives the same rows.

Texts are made from typed columns by the same recipe on both sides.  All
queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks, text
from ..functions.coerce import REJECT, Coercion, coerce, coerce_keep, prepared, quoted, to_bool, to_date, to_date_cz, to_float, to_int, where
from ..functions.layouts import parse_date
from ..operators import dedup as d
from ..operators import profile, sets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- recipes: raw texts from typed columns, and the same in SQL -------------


def dirty_int(k: Column) -> Column:
    s, m = k.cast("string"), k % 8
    return F.when(m == 0, F.concat(F.lit(" "), s, F.lit(" "))).when(m == 1, F.concat(s, F.lit(".0"))).when(m == 2, F.concat(F.lit("x"), s)).when(m == 3, "").when(m == 4, F.concat(s, F.lit(".5"))).otherwise(s)


DIRTY_INT = "CASE {k} % 8 WHEN 0 THEN ' ' || {k} || ' ' WHEN 1 THEN {k} || '.0' WHEN 2 THEN 'x' || {k} WHEN 3 THEN '' WHEN 4 THEN {k} || '.5' ELSE CAST({k} AS VARCHAR) END"


def dirty_date(day: Column, k: Column) -> Column:
    cz, iso, m = F.date_format(day, "dd.MM.yyyy"), F.date_format(day, "yyyy-MM-dd"), k % 7
    return F.when(m == 0, F.concat(F.lit("31.02."), F.date_format(day, "yyyy"))).when(m == 1, F.concat(cz, F.lit(" 10:00"))).when(m == 2, iso).when(m == 3, "").when(m == 4, "soon").when(m == 5, F.concat(F.lit(" "), cz)).otherwise(cz)


DIRTY_DATE = "CASE {k} % 7 WHEN 0 THEN '31.02.' || strftime({d}, '%Y') WHEN 1 THEN strftime({d}, '%d.%m.%Y') || ' 10:00' WHEN 2 THEN strftime({d}, '%Y-%m-%d') WHEN 3 THEN '' WHEN 4 THEN 'soon' WHEN 5 THEN ' ' || strftime({d}, '%d.%m.%Y') ELSE strftime({d}, '%d.%m.%Y') END"
WORDS = ("Ano", "ne", "TRUE", "f", " yes ", "0", "maybe", "", "Y", "false")


def word(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WORDS)), (k % len(WORDS) + 1).cast("int"))


WORD = "[" + ", ".join(f"'{w}'" for w in WORDS) + "][1 + {k} % " + str(len(WORDS)) + "]"
#: White space that the trims drop, as a class for SQL.
_BLANK = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_trim(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_BLANK}+', ''), '{_BLANK}+$', '')"


def sql_edges(c: str) -> str:
    return rf"CASE WHEN regexp_matches({c}, '^[ \t\n\r]') OR regexp_matches({c}, '[ \t\n\r]$') THEN {sql_trim(c)} ELSE {c} END"


def sql_int(c: str) -> str:
    return rf"CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN try_cast({c} AS BIGINT) WHEN regexp_matches({c}, '^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') AND floor(try_cast({c} AS DOUBLE)) = try_cast({c} AS DOUBLE) THEN try_cast(try_cast({c} AS DOUBLE) AS BIGINT) END"


def sql_cz(c: str) -> str:
    part = lambda a, n: f"CAST(substr({c}, {a}, {n}) AS INTEGER)"
    ok = rf"regexp_matches({c}, '^[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}')"
    return f"CASE WHEN {ok} THEN CASE WHEN {part(4, 2)} BETWEEN 1 AND 12 AND {part(1, 2)} BETWEEN 1 AND 31 THEN CAST(make_date({part(7, 4)}, {part(4, 2)}, 1) + ({part(1, 2)} - 1) AS DATE) END END"


def sql_iso(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END"


T_, F_ = "('1', 't', 'true', 'yes', 'y', 'ano')", "('0', 'f', 'false', 'no', 'n', 'ne')"
_INT_RAW = f"SELECT o_orderkey, {DIRTY_INT.format(k='o_orderkey')} AS raw FROM orders"
_INT_T = f"SELECT o_orderkey, raw, nullif({sql_edges('raw')}, '') AS t FROM ({_INT_RAW})"
_DATE_RAW = f"SELECT o_orderkey, {DIRTY_DATE.format(k='o_orderkey', d='o_orderdate')} AS raw FROM orders"
_DATE_T = f"SELECT o_orderkey, nullif({sql_edges('raw')}, '') AS t FROM ({_DATE_RAW})"


# ---- coercion ---------------------------------------------------------------


@query(f"SELECT o_orderkey, raw, {sql_int('t')} AS value FROM ({_INT_T})")
def coerce_int(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", dirty_int(F.col("o_orderkey")).alias("raw"))
    return o.select("o_orderkey", "raw", to_int(prepared(F.col("raw"))).alias("value"))


def _typed_orders(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(dirty_int(k).alias("key"), dirty_date(F.col("o_orderdate"), k).alias("day"), F.col("o_orderstatus").alias("status"), k.alias("_line"))
    return coerce(raw, {"key": Coercion("int"), "day": Coercion("date")})


_REASONS = f"""
SELECT i.o_orderkey AS line, CASE WHEN i.t IS NOT NULL AND {sql_int('i.t')} IS NULL THEN 'field "key": cannot coerce "' || i.t || '"'
  WHEN d.t IS NOT NULL AND coalesce({sql_cz('d.t')}, {sql_iso('d.t')}) IS NULL THEN 'field "day": cannot coerce "' || d.t || '"' END AS reason,
  {sql_int('i.t')} AS key, coalesce({sql_cz('d.t')}, {sql_iso('d.t')}) AS day
FROM ({_INT_T}) i JOIN ({_DATE_T}) d USING (o_orderkey)"""


@query(f"SELECT reason, count(*) AS n FROM ({_REASONS}) WHERE reason IS NOT NULL GROUP BY reason")
def coerce_reject_reasons(spark, sf_dir):
    return where(_typed_orders(spark, sf_dir), F.col(REJECT).isNotNull()).groupBy(F.col(REJECT).alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(reason) AS BIGINT) AS transform_rejected, CAST(count(*) FILTER (reason IS NULL AND key IS NULL) AS BIGINT) AS validate_dropped, CAST(count(*) FILTER (reason IS NULL AND key IS NOT NULL) AS BIGINT) AS inserted FROM ({_REASONS})")
def pipeline_counts(spark, sf_dir):
    rows = _typed_orders(spark, sf_dir)
    good = F.col(REJECT).isNull()
    bad = checks.stream_reason(rows.drop(REJECT), ["key"], {"key": "int", "day": "date"}).isNotNull()
    return rows.agg(F.count("*").alias("processed"), F.count(REJECT).alias("transform_rejected"), F.count_if(good & bad).alias("validate_dropped"), F.count_if(good & ~bad).alias("inserted"))


@query(f"""WITH r AS ({_REASONS}), k AS (SELECT *, left(reason, 12) AS bucket FROM r WHERE reason IS NOT NULL)
SELECT bucket AS reason, line AS _line, n, rank FROM (SELECT bucket, line, count(*) OVER (PARTITION BY bucket) AS n, row_number() OVER (PARTITION BY bucket ORDER BY line) AS rank FROM k) WHERE rank <= 3""")
def error_buckets_top3(spark, sf_dir):
    rows = _typed_orders(spark, sf_dir).withColumn(REJECT, F.left(REJECT, F.lit(12))).withColumn("_line", F.col("_line").cast("bigint"))
    return profile.error_buckets(rows)


@query(f"SELECT c_custkey, raw, CASE WHEN lower(t) IN {T_} THEN true WHEN lower(t) IN {F_} THEN false END AS value, CASE WHEN lower(t) = 'maybe' THEN true WHEN lower(t) IN ('ano', 'y') THEN false END AS own FROM (SELECT *, nullif({sql_edges('raw')}, '') AS t FROM (SELECT c_custkey, {WORD.format(k='c_custkey')} AS raw FROM customer))")
def coerce_bool_vocab(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", word(F.col("c_custkey")).alias("raw"))
    t = prepared(F.col("raw"))
    return c.select("c_custkey", "raw", to_bool(t).alias("value"), to_bool(t, ("Maybe",), ("ano", "Y")).alias("own"))


@query(f"SELECT o_orderkey, {sql_cz('t')} AS day FROM ({_DATE_T})")
def coerce_date_cz(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", dirty_date(F.col("o_orderdate"), F.col("o_orderkey")).alias("raw"))
    return o.select("o_orderkey", to_date_cz(prepared(F.col("raw"))).alias("day"))


@query(f"SELECT o_orderkey, coalesce({sql_cz('t')}, {sql_iso('t')}) AS cz_first, coalesce({sql_iso('t')}, {sql_cz('t')}) AS iso_first, CASE WHEN regexp_matches(t, '^[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{4}}$') THEN CAST(try_strptime(t, '%d.%m.%Y') AS DATE) END AS strict FROM ({_DATE_T})")
def coerce_date_layout_chain(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", prepared(dirty_date(F.col("o_orderdate"), F.col("o_orderkey"))).alias("t"))
    return o.select("o_orderkey", to_date(F.col("t")).alias("cz_first"), to_date(F.col("t"), "2006-01-02").alias("iso_first"), parse_date(F.col("t"), "02.01.2006").alias("strict"))


@query("SELECT p_partkey, nullif(trim(CASE WHEN p_partkey % 3 = 0 THEN '  ' WHEN p_partkey % 3 = 1 THEN ' ' || p_name ELSE p_name END), '') AS value FROM part")
def coerce_text_null(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", prepared(F.when(k % 3 == 0, "  ").when(k % 3 == 1, F.concat(F.lit(" "), F.col("p_name"))).otherwise(F.col("p_name"))).alias("value"))


@query(rf"SELECT o_orderkey, CASE WHEN regexp_matches(t, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast(t AS DOUBLE) END AS value FROM ({_INT_T})")
def coerce_float(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", to_float(prepared(dirty_int(F.col("o_orderkey")))).alias("value"))


@query(f"SELECT o_orderkey, CASE WHEN regexp_matches(raw, '^[+-]?[0-9]+$') THEN CAST(try_cast(raw AS BIGINT) AS VARCHAR) ELSE raw END AS value FROM ({_INT_RAW})")
def coerce_record_keep(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", coerce_keep(dirty_int(F.col("o_orderkey")), "int").alias("value"))


@query(f"SELECT o_orderkey, CASE WHEN trim(raw) = '' OR t IS NOT NULL AND {sql_int('t')} IS NULL THEN 'field \"raw\": cannot coerce \"' || coalesce(t, '') || '\"' END AS reason FROM ({_INT_T})")
def coerce_empty_rejects(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", dirty_int(F.col("o_orderkey")).alias("raw"))
    return coerce(o, {"raw": Coercion("int")}, empty_rejects=True).select("o_orderkey", F.col(REJECT).alias("reason"))


# ---- validation -------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'required field \"status\" missing' END AS reason FROM orders")
def validate_required(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"))
    return o.select("o_orderkey", checks.stream_reason(o, ["status", "no such column"], {}).alias("reason"))


@query(f"""SELECT o_orderkey, coalesce(
  CASE WHEN NOT (raw = '' OR regexp_matches(raw, '^[+-]?[0-9]+$')) THEN 'field "raw": "' || raw || '" not a valid int' END,
  CASE WHEN NOT lower(trim(w)) IN ('', {T_[1:-1]}, {F_[1:-1]}) THEN 'field "w": "' || w || '" not a valid bool' END,
  CASE WHEN day <> '' THEN 'field "day": "' || day || '" not a valid date' END) AS reason
FROM (SELECT o_orderkey, {DIRTY_INT.format(k='o_orderkey')} AS raw, {WORD.format(k='o_orderkey')} AS w, CASE WHEN o_orderkey % 3 = 0 THEN '2024-01-01' ELSE '' END AS day FROM orders)""")
def validate_kinds(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k, dirty_int(k).alias("raw"), word(k).alias("w"), F.when(k % 3 == 0, "2024-01-01").otherwise("").alias("day"), F.lit(1.0).alias("whole"))
    return o.select("o_orderkey", checks.stream_reason(o, [], {"raw": "int4", "w": "boolean", "day": "timestamptz", "whole": "int"}).alias("reason"))


FIELDS = (checks.Field("id", "int", required=True), checks.Field("flag", "bool"), checks.Field("day", "date", layout="02.01.2006"), checks.Field("status", "text", enum=("F", "O")))


@query(f"""SELECT o_orderkey, coalesce(
  CASE WHEN id = '' THEN 'required field "id" missing' END,
  CASE WHEN NOT regexp_matches(trim(id), '^[+-]?[0-9]+$') THEN 'field "id": "' || id || '" not an int' END,
  CASE WHEN flag <> '' AND NOT lower(trim(flag)) IN {T_} AND NOT lower(trim(flag)) IN {F_} THEN 'field "flag": "' || flag || '" not a recognized boolean' END,
  CASE WHEN day <> '' AND coalesce(CASE WHEN regexp_matches(trim(day), '^[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{4}}$') THEN try_strptime(trim(day), '%d.%m.%Y') END, CASE WHEN regexp_matches(trim(day), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN try_strptime(trim(day), '%Y-%m-%d') END) IS NULL THEN 'field "day": invalid date "' || trim(day) || '"' END,
  CASE WHEN status NOT IN ('F', 'O') THEN 'field "status": "' || status || '" not in enum [F O]' END) AS reason
FROM (SELECT o_orderkey, {DIRTY_INT.format(k='o_orderkey')} AS id, {WORD.format(k='o_orderkey')} AS flag, {DIRTY_DATE.format(k='o_orderkey', d='o_orderdate')} AS day, o_orderstatus AS status FROM orders)""")
def validate_contract_reason(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k, dirty_int(k).alias("id"), word(k).alias("flag"), dirty_date(F.col("o_orderdate"), k).alias("day"), F.col("o_orderstatus").alias("status"))
    return o.select("o_orderkey", checks.contract_reason(o, FIELDS).alias("reason"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def validate_enum(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return c.filter(checks.contract_reason(c, [checks.Field("c_mktsegment", enum=("BUILDING", "MACHINERY"))]).isNull())


@query("SELECT event_id, kind FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN ' ' ELSE event_type END AS kind FROM events) WHERE kind <> ''")
def require_non_empty(spark, sf_dir):
    m = F.col("event_id") % 4
    return checks.require(table(spark, sf_dir, "events").select("event_id", F.when(m == 0, "").when(m == 2, " ").when(m == 3, F.col("event_type")).alias("kind")), ["event_id", "kind"])


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS day, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || '.5' END AS half FROM orders")
def value_text(spark, sf_dir):
    from pyspark.sql import types as T

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 2 == 0, 0.0).otherwise(0.5)).alias("half"))
    return o.select("o_orderkey", checks.shown(F.col("day"), T.DateType()).alias("day"), checks.shown(F.col("half"), T.DoubleType()).alias("half"))


# ---- text -------------------------------------------------------------------

_NBSP = "CASE WHEN doc_id % 3 = 0 THEN chr(160) || text || ' ' || chr(160) WHEN doc_id % 3 = 1 THEN replace(text, ' the ', chr(160) || 'the ') ELSE text END"


@query(f"SELECT doc_id, {sql_edges('t')} AS text FROM (SELECT doc_id, replace({_NBSP}, chr(160), ' ') AS t FROM documents)")
def normalize_nbsp_trim(spark, sf_dir):
    m, t = F.col("doc_id") % 3, F.col("text")
    nbsp = F.lit(" ")
    raw = F.when(m == 0, F.concat(nbsp, t, F.lit(" "), nbsp)).when(m == 1, F.replace(t, F.lit(" the "), F.lit(" the "))).otherwise(t)
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize(raw).alias("text"))


_STRIP = "regexp_replace({c}, '<[^>]*>|>|<[^>]*$', '', 'g')"


@query(f"SELECT page_id, {_STRIP.format(c='html')} AS plain FROM pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@query(rf"SELECT page_id, {sql_trim('t')} AS plain FROM (SELECT page_id, regexp_replace(html, '[ \t\n\r]+', ' ', 'g') AS t FROM pages)")
def collapse_ws(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.collapse_whitespace(F.col("html")).alias("plain"))


@query(rf"SELECT page_id, {sql_trim('t')} AS plain FROM (SELECT page_id, regexp_replace({_STRIP.format(c='html')}, '[ \t\n\r]+', ' ', 'g') AS t FROM pages)")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_text(F.col("html")).alias("plain"))


@query("SELECT page_id, nullif(CASE WHEN strpos(html, '<title>') > 0 AND strpos(a, '</title>') > 0 THEN substr(a, 1, strpos(a, '</title>') - 1) END, '') AS title, nullif(CASE WHEN strpos(url, '?') > 0 THEN substr(url, strpos(url, '?') + 1) END, '') AS query FROM (SELECT *, substr(html, strpos(html, '<title>') + 7) AS a FROM pages)")
def extract_between(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.extract_between(F.col("html"), "<title>", "</title>").alias("title"), text.extract_between(F.col("url"), "?", "").alias("query"))


@query(rf"""WITH l AS (SELECT page_id, i - 1 AS pos, {sql_trim("regexp_replace(" + _STRIP.format(c='s[i]') + r", '[ \t\n\r]+', ' ', 'g')")} AS line
  FROM (SELECT page_id, string_split(html, chr(10)) AS s, unnest(range(1, len(string_split(html, chr(10))) + 1)) AS i FROM pages)), k AS (SELECT * FROM l WHERE line <> ''),
w AS (SELECT page_id, min(pos) FILTER (contains(line, 'the')) AS a, coalesce(min(pos) FILTER (contains(line, 'and')), 2147483647) AS b FROM k GROUP BY page_id)
SELECT page_id, CAST(pos AS INTEGER) AS pos, line FROM k JOIN w USING (page_id) WHERE a IS NOT NULL AND pos BETWEEN a AND b""")
def html_window(spark, sf_dir):
    return profile.html_window(table(spark, sf_dir, "pages"), "page_id", "html", "the", "and")


@query("SELECT page_id, list_transform(regexp_extract_all(url, '[0-9]+'), lambda x: CAST(x AS BIGINT)) AS ints FROM pages")
def extract_ints(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.extract_ints(F.col("url")).alias("ints"))


@query("SELECT url FROM pages WHERE page_id IN (SELECT page_id FROM (SELECT page_id, unnest(regexp_extract_all(url, '[0-9]+')) AS x FROM pages) JOIN supplier ON CAST(x AS BIGINT) = s_suppkey)")
def line_has_known_id(spark, sf_dir):
    return sets.keep_known(table(spark, sf_dir, "pages").select("url"), table(spark, sf_dir, "supplier"), "url", "s_suppkey")


@query("SELECT page_id, coalesce(nullif(regexp_replace(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '[^a-zA-Z0-9]+', '_', 'g'), ''), sha1(url)) AS name FROM pages")
def safe_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_filename(F.col("url")).alias("name"))


_FORMAT = "CASE WHEN t = '' THEN 'unknown' WHEN left(t, 1) IN ('{', '[') THEN 'json' WHEN left(t, 1) = '<' THEN 'xml' WHEN contains(left(t, 256), '<') AND contains(left(t, 256), '>') THEN 'xml' ELSE 'csv' END"


@query(f"SELECT kind, format, count(*) AS n FROM (SELECT kind, {_FORMAT} AS format FROM (SELECT 'page' AS kind, {sql_trim('html')} AS t FROM pages UNION ALL SELECT 'event', {sql_trim('props')} FROM events UNION ALL SELECT 'document', {sql_trim('text')} FROM documents)) GROUP BY ALL")
def detect_format(spark, sf_dir):
    one = lambda name, c, kind: table(spark, sf_dir, name).select(F.lit(kind).alias("kind"), text.detect_format(F.col(c)).alias("format"))
    rows = one("pages", "html", "page").unionByName(one("events", "props", "event")).unionByName(one("documents", "text", "document"))
    return rows.groupBy("kind", "format").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN strlen(text) > 63 THEN left(text, 10) || right(text, 53) ELSE text END AS name FROM documents")
def truncate_name(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_name(F.col("text")).alias("name"))


_NAME = "coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9_ .\\-]', '', 'g'), '[_ .\\-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'col')"


@query(f"SELECT p_partkey, {_NAME.format(c='raw')} AS name FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN '__' ELSE ' A-' || p_name || '.' || p_brand || '#! ' END AS raw FROM part)")
def normalize_name(spark, sf_dir):
    raw = F.when(F.col("p_partkey") % 9 == 0, "__").otherwise(F.concat(F.lit(" A-"), "p_name", F.lit("."), "p_brand", F.lit("#! ")))
    return table(spark, sf_dir, "part").select("p_partkey", text.ascii_field_name(raw).alias("name"))


@query("SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim(h))), '[^a-z0-9_ .\\-]', '', 'g'), '[_ .\\-]+', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM (SELECT doc_id, 'PČV ' || lang || ' žluťoučký' AS h FROM documents)")
def normalize_name_accents(spark, sf_dir):
    h = F.concat(F.lit("PČV "), "lang", F.lit(" žluťoučký"))
    return table(spark, sf_dir, "documents").select("doc_id", text.field_name_column(h).alias("name"))


@query("SELECT c_custkey, list_filter(string_split(n, '.'), lambda x: x <> '') AS parts, regexp_replace(regexp_replace(l, '\\n$', ''), '\\r$', '') AS line FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'dbo..' ELSE '.' END || c_name AS n, c_name || CASE c_custkey % 3 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(13) ELSE '' END AS l FROM customer)")
def split_and_strip(spark, sf_dir):
    k = F.col("c_custkey")
    n = F.concat(F.when(k % 2 == 0, "dbo..").otherwise("."), "c_name")
    line = F.concat("c_name", F.when(k % 3 == 0, "\r\n").when(k % 3 == 1, "\r").otherwise(""))
    return table(spark, sf_dir, "customer").select("c_custkey", text.split_name(n).alias("parts"), text.strip_line_end(line).alias("line"))


# ---- dedup, sets, joins -----------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 4 != 0, F.col("props")).otherwise("").alias("props"))


_EVENTS = "(SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 <> 0 THEN value END AS value, CASE WHEN event_id % 4 <> 0 THEN props ELSE '' END AS props FROM events)"
_KEYED = "SELECT event_id, user_id, event_type, value, props FROM " + _EVENTS + " QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY {o}) = 1"
_SCORE = "(20 + 10 + 10 * CAST(value IS NOT NULL AS INTEGER) + 10 * CAST(coalesce(props, '') <> '' AS INTEGER){more}) DESC, event_id DESC"


@query(_KEYED.format(o="event_id"))
def dedup_first(spark, sf_dir):
    return d.dedup(_events(spark, sf_dir), ["user_id", "event_type"], "Keep-First ", ["event_id"])


@query(_KEYED.format(o="event_id DESC"))
def dedup_last(spark, sf_dir):
    return d.dedup(_events(spark, sf_dir), ["user_id", "event_type"], "anything", ["event_id"])


@query(_KEYED.format(o=_SCORE.format(more="")))
def dedup_most_complete(spark, sf_dir):
    return d.dedup(_events(spark, sf_dir), ["user_id", "event_type"], d.MOST_COMPLETE, ["event_id"])


@query(_KEYED.format(o=_SCORE.format(more=" + CAST(value IS NOT NULL AS INTEGER)")))
def dedup_prefer(spark, sf_dir):
    return d.dedup(_events(spark, sf_dir), ["user_id", "event_type"], d.MOST_COMPLETE, ["event_id"], prefer=["value"])


_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _id_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_ORDER, dirty_int(F.col("l_partkey")).alias("raw"), F.when(F.col("l_linenumber") == 3, "").otherwise(F.col("l_linenumber").cast("string")).alias("check"))


_IDS = f"SELECT *, regexp_matches(trim(raw), '^[+-]?[0-9]+$') AND \"check\" <> '' AS ok FROM (SELECT *, {DIRTY_INT.format(k='l_partkey')} AS raw, CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS \"check\" FROM lineitem)"


@query(f"SELECT id, text FROM (SELECT CAST(trim(raw) AS BIGINT) AS id, trim(raw) AS text FROM ({_IDS}) WHERE ok) WHERE id <= 1000 QUALIFY row_number() OVER (PARTITION BY id) = 1 UNION ALL SELECT * FROM (SELECT CAST(trim(raw) AS BIGINT) AS id, trim(raw) AS text FROM ({_IDS}) WHERE ok) WHERE id > 1000")
def distinct_first_valid(spark, sf_dir):
    return d.distinct_first(_id_rows(spark, sf_dir), "raw", "check", _ORDER, max_id=1000)


@query(f"SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(DISTINCT CASE WHEN ok THEN trim(raw) END) AS BIGINT) AS written, CAST(count(*) FILTER (NOT ok) AS BIGINT) AS malformed FROM ({_IDS})")
def distinct_counts(spark, sf_dir):
    return d.distinct_counts(_id_rows(spark, sf_dir), "raw", "check")


_LINE = "o_orderkey || ',' || o_custkey || ',' || {status}"


@query(f"SELECT {_LINE.format(status='s')} AS value FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders) WHERE o_orderkey % 7 = 0")
def snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    line = lambda status: F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), status)
    new = o.select(F.concat(line(F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))), F.lit("\r")).alias("value"))
    return sets.snapshot_diff(new, o.select(line(F.col("o_orderstatus")).alias("value")))


@query("SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey BETWEEN 0 AND 1023")
def id_range_set(spark, sf_dir):
    return sets.id_set(table(spark, sf_dir, "lineitem"), "l_partkey", 1000)


@query("SELECT CAST(CASE WHEN l_partkey > 0 THEN 1 + (l_partkey - 1) // 32768 ELSE 0 END AS BIGINT) AS bucket, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def id_bitmap_counts(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    return sets.id_bitmaps(ids).select("bucket", "n")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_custkey, 'N' FROM orders WHERE o_orderkey % 3 = 0")
def upsert_emulation(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return sets.upsert(o, o.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"])


@query("SELECT o_orderkey, o_custkey, NULL::VARCHAR AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL::BIGINT, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def union_streams(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return sets.union_streams(o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus"))


@query("""SELECT CASE m WHEN 0 THEN a END AS a, CASE WHEN m < 3 THEN b END AS b, 'RSV' AS mark_, x FROM (SELECT c_custkey % 4 AS m, 'a' AS a, 'b' AS b, c_name AS x FROM customer) WHERE false
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, CASE WHEN c_custkey % 4 IN (0, 1, 2) THEN 'RSV' ELSE 'none' END, CASE c_custkey % 4 WHEN 0 THEN 'y' WHEN 3 THEN 'y' ELSE 'z' END FROM customer""".split("UNION ALL ")[1].replace("SELECT CAST(c_custkey AS VARCHAR), c_name,", "SELECT CAST(c_custkey AS VARCHAR) AS a, c_name AS b,").replace("END, CASE", "END AS mark, CASE", 1).replace("ELSE 'z' END", "ELSE 'z' END AS c, CASE c_custkey % 4 WHEN 0 THEN 'z' WHEN 3 THEN 'z' END AS d"))
def anchor_realign(spark, sf_dir):
    m = F.col("c_custkey") % 4
    c = table(spark, sf_dir, "customer")
    rows = c.select(
        F.col("c_custkey").cast("string").alias("a"),
        F.col("c_name").alias("b"),
        F.when(m == 0, "RSV").when(m == 3, "none").otherwise("junk").alias("mark"),
        F.when(m == 1, "RSV").when(m == 2, "RSV").otherwise("y").alias("c"),
        F.lit("z").alias("d"),
    )
    return sets.realign(rows, "mark", "RSV")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS nation_id, n_name AS name, NULL::VARCHAR AS missing FROM nation")
def header_project(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("Nation Key"), F.col("n_name").alias("Name"))
    return sets.project(n, ["nation_id", "name", "missing"], {"Nation Key": "nation_id", "Name": "name"})


@query("SELECT c_custkey, list_resize(CASE WHEN c_custkey % 2 = 0 THEN ['a', 'b', 'c', 'd'] ELSE ['a'] END, 3, '') AS cells FROM customer")
def fit_width(spark, sf_dir):
    cells = F.when(F.col("c_custkey") % 2 == 0, F.array(*map(F.lit, "abcd"))).otherwise(F.array(F.lit("a")))
    return table(spark, sf_dir, "customer").select("c_custkey", sets.fit_width(cells, 3).alias("cells"))


# ---- JSON -------------------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_prop(spark, sf_dir):
    from ..sources.json import json_field

    return table(spark, sf_dir, "events").select("event_id", json_field(F.col("props"), "k").alias("k"))


@query("SELECT event_id AS \"e.id\", event_type AS \"e.kind\", CAST(json_extract_string(props, '$.k') AS BIGINT) AS \"e.props.k\" FROM events")
def json_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return sets.flatten(e.select(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.from_json("props", "k bigint").alias("props")).alias("e")))


# ---- inference --------------------------------------------------------------


def _samples(spark, sf_dir) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(k.cast("string").alias("id"), F.when(k % 2 == 0, "Yes").otherwise("F").alias("flag"), F.concat(k.cast("string"), F.lit(".5")).alias("real"), F.when(k % 5 == 0, "").otherwise(F.col("p_size").cast("string")).alias("size"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")), "dd.MM.yyyy").alias("day"), F.when(k % 2 == 0, "1").otherwise("2.5").alias("mixed"), F.lit(" ").alias("blank"), F.col("p_name").alias("name"))


_SAMPLES = "(SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 2 = 0 THEN 'Yes' ELSE 'F' END AS flag, p_partkey || '.5' AS \"real\", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS size, strftime(DATE '2020-01-01' + CAST(p_partkey % 900 AS INTEGER), '%d.%m.%Y') AS day, CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE '2.5' END AS mixed, ' ' AS blank, p_name AS name FROM part)"


def _sql_infer(c: str) -> str:
    t, v = f"trim({c})", f"trim({c}) <> ''"
    ok = {
        "integer": f"regexp_matches({t}, '^[+-]?[0-9]+$')",
        "boolean": f"lower({t}) IN ('true', 'false', 't', 'f', 'yes', 'no', 'y', 'n', '1', '0')",
        "real": rf"regexp_matches({t}, '^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+[eE][+-]?[0-9]+)([eE][+-]?[0-9]+)?$')",
        "date": rf"regexp_matches({t}, '^[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}$')",
    }
    case = " ".join(f"WHEN bool_and({x}) FILTER ({v}) THEN '{k}'" for k, x in ok.items())
    return f"SELECT '{c}' AS \"column\", CASE WHEN count(*) FILTER ({v}) = 0 THEN 'text' {case} ELSE 'text' END AS type, CAST(count(*) FILTER ({v}) AS BIGINT) AS filled, coalesce(bool_and({v}), false) AS all_filled FROM {_SAMPLES}"


@query(" UNION ALL ".join(map(_sql_infer, ("id", "flag", '"real"', "size", "day", "mixed", "blank", "name"))).replace("'\"real\"'", "'real'"))
def infer_types(spark, sf_dir):
    return profile.infer_types(_samples(spark, sf_dir))


_LAYOUT_SQL = (("2006-01-02", "%Y-%m-%d", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), ("02.01.2006", "%d.%m.%Y", r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), ("01.02.2006", "%m.%d.%Y", r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), ("02/01/2006", "%d/%m/%Y", "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"))


@query(" UNION ALL ".join(f"SELECT '{name}' AS layout, CAST(count(CASE WHEN regexp_matches(day, '{guard}') THEN try_strptime(day, '{form}') END) AS BIGINT) AS matches FROM {_SAMPLES}" for name, form, guard in _LAYOUT_SQL))
def infer_layouts(spark, sf_dir):
    return profile.layout_scores(_samples(spark, sf_dir), "day", [x[0] for x in _LAYOUT_SQL])


@query("SELECT 'id' AS \"column\"")
def required_heuristic(spark, sf_dir):
    """The first integer column without blanks, in the order of the columns."""
    s = _samples(spark, sf_dir).select("size", "flag", "id", "name")
    order = F.create_map(*[x for i, c in enumerate(s.columns) for x in (F.lit(c), F.lit(i))])
    found = profile.infer_types(s).filter("type = 'integer' and all_filled")
    return found.agg(F.min_by("column", order[F.col("column")]).alias("column"))


@query("SELECT doc_id, '\"' || replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't') || '\"' AS shown FROM documents")
def quoted_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", quoted(F.col("text")).alias("shown"))


# ---- XML, from records made of rows -----------------------------------------


def _records(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    tail = F.when(k % 5 == 0, "").otherwise("</Rec>")
    return c.select(k.alias("record"), F.concat(F.lit("<Rec id='"), k.cast("string"), F.lit("'><A>"), "c_mktsegment", F.lit("</A>"), F.when(k % 2 == 0, "<A>more</A>").otherwise(""), F.lit("<B><C>"), "c_name", F.lit("</C></B>"), tail).alias("xml"))


@query("""SELECT 'A' AS path, CAST(count(*) + count(*) FILTER (c_custkey % 2 = 0) AS BIGINT) AS total_count, CAST(count(*) AS BIGINT) AS records_with, CAST(2 AS BIGINT) AS max_per_record FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT p, count(*), count(*), 1 FROM customer, (VALUES ('B'), ('B/C')) AS v(p) WHERE c_custkey % 5 <> 0 GROUP BY p""")
def xml_profile(spark, sf_dir):
    return profile.xml_paths(profile.xml_elements(_records(spark, sf_dir))).drop("examples")


@query("SELECT c_custkey AS record, c_mktsegment AS a FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey, 'more' FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 2 = 0")
def xml_shards(spark, sf_dir):
    from ..sources.xml import shard_column

    rows = _records(spark, sf_dir).select("record", F.explode(shard_column(F.col("xml"), "Rec")).alias("x"))
    return rows.select("record", F.explode(F.xpath("x", F.lit(".//A/text()"))).alias("a"))


FLAGSHIP = coerce_reject_reasons
