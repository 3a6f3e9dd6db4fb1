"""Probes: each operator of the inventory exercised on the driver tables, next to its DuckDB oracle SQL.

Stand-ins (the driver tables are TPC-H-like, the domain is price indices):
geography = region -> nation -> customer/supplier; trade chain = p_type -> p_brand -> p_name; facts =
lineitem/orders with ``annee = year(date)``; city text = nation names; accented text = documents; row objects =
``events.props``; paths = ``pages.url``.

Output columns use only string / int / bigint / double / boolean so both engines hash the same values; money and
shares are rounded doubles, counts are bigint.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions import text as X
from pricelake.operators import dims as D
from pricelake.operators import facts as FA
from pricelake.operators import hierarchies as HI
from pricelake.operators import likes as LK
from pricelake.operators import match as M
from pricelake.operators import paths as P
from pricelake.operators import quality as Q
from pricelake.operators import refs as R
from pricelake.operators import resolve as RS
from pricelake.operators import suffixes as SX
from pricelake.operators import weights as W
from pricelake.plans.tables import TABLES, Tables
from pricelake.session import stored
from pricelake.sources import files as FS
from pricelake.sources import ranges as RG

Probe = Callable[[SparkSession, str], DataFrame]
PROBES: dict[str, Probe] = {}
ORACLE: dict[str, str] = {}


def probe(name: str, sql: str | None = None):
    def deco(fn: Probe) -> Probe:
        PROBES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# SQL fragments shared by several oracles (RE2 syntax; same classes as the Spark side)
WS = X.WS_CLASS


def _tok_split(c: Column) -> Column:
    """Letter runs of a whole text (empty pieces removed)."""
    return F.filter(F.split(c, r"[^\p{L}]+"), lambda t: t != "")


def _distinct_words(docs: DataFrame) -> DataFrame:
    """(doc_id, tok): the distinct words of each doc_id. The words of a row are made distinct in place; only those of a
    doc_id that several rows have meet in a shuffle."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"))
    repeated = stored(repeated, "repeated")
    words = F.explode(F.array_distinct(_tok_split(F.col("text")))).alias("tok")
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    once, often = (docs.join(repeated, same, how).select("doc_id", words) for how in ("left_anti", "left_semi"))
    return once.unionByName(often.distinct())


# =============================================================================================== dimensions (J1-J3, ...)
@probe(
    "dim_lookup",
    """
SELECT c.c_custkey AS c_custkey,
       upper(trim(concat('  ', 'nation_', CAST(c.c_nationkey AS VARCHAR), ' '))) AS nation_key,
       n.n_nationkey AS id_nation, n.n_regionkey AS id_region
FROM customer c
LEFT JOIN nation n
  ON upper(trim(concat('  ', 'nation_', CAST(c.c_nationkey AS VARCHAR), ' '))) = upper(trim(n.n_name))
""",
)
def dim_lookup(spark, sf):
    t = Tables(spark, sf)
    facts = t.customer.select(
        "c_custkey", F.concat(F.lit("  "), F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("txt")
    )
    dim = t.nation.select(X.upper_trim("n_name").alias("key"), F.col("n_nationkey").alias("id_nation"), F.col("n_regionkey").alias("id_region"))
    out = D.lookup(facts, "txt", dim, "key", ["id_nation", "id_region"], how="left")
    return out.select("c_custkey", X.upper_trim("txt").alias("nation_key"), "id_nation", "id_region")


@probe(
    "dim_lookup_inner",
    """
SELECT s.s_suppkey AS s_suppkey, n.n_nationkey AS id_nation
FROM supplier s
JOIN nation n ON upper(trim(concat(' NATION_', CAST(s.s_nationkey AS VARCHAR)))) = upper(trim(n.n_name))
""",
)
def dim_lookup_inner(spark, sf):
    """Left join + ``id IS NOT NULL`` is an inner join."""
    t = Tables(spark, sf)
    facts = t.supplier.select("s_suppkey", F.concat(F.lit(" NATION_"), F.col("s_nationkey").cast("string")).alias("txt"))
    dim = t.nation.select(X.upper_trim("n_name").alias("key"), F.col("n_nationkey").alias("id_nation"))
    out = D.lookup(facts, "txt", dim, "key", ["id_nation"], how="left").where(F.col("id_nation").isNotNull())
    return out.select("s_suppkey", "id_nation")


_WORD_DIM_SQL = """
WITH existing AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(split_part(p_name, ' ', 1))) AS name FROM part
        WHERE trim(split_part(p_name, ' ', 1)) <> '')
), cand AS (
  SELECT DISTINCT upper(w) AS name FROM (SELECT unnest(string_split(p_name, ' ')[2:]) AS w FROM part) WHERE trim(w) <> ''
), fresh AS (
  SELECT name FROM cand WHERE name NOT IN (SELECT name FROM existing)
)
SELECT id, name FROM existing
UNION ALL
SELECT CAST((SELECT coalesce(max(id), 0) FROM existing) + row_number() OVER (ORDER BY name) AS BIGINT) AS id, name FROM fresh
"""


@probe("dim_new_rows", _WORD_DIM_SQL)
def dim_new_rows(spark, sf):
    """A word dimension holding the first words of part names grows with all the others."""
    part = Tables(spark, sf).part
    first = D.distinct_keys(part, F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)), "name")
    existing = D.assign_ids(first, "name", "id")
    words = part.select(F.explode(F.slice(F.split("p_name", " "), 2, F.greatest(F.size(F.split("p_name", " ")), F.lit(1)))).alias("w"))
    cand = D.distinct_keys(words, "w", "name")
    return D.grow_dim(existing, cand, "name", "id").select("id", "name")


@probe(
    "surrogate_ids",
    """
SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id, name
FROM (SELECT DISTINCT upper(trim(p_name)) AS name FROM part WHERE trim(p_name) <> '')
""",
)
def surrogate_ids(spark, sf):
    part = Tables(spark, sf).part
    return D.assign_ids(D.distinct_keys(part, "p_name", "name"), "name", "id").select("id", "name")


@probe(
    "min_parent",
    """
WITH brand AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_brand)) AS name FROM part WHERE trim(p_brand) <> '')
)
SELECT upper(trim(p.p_name)) AS name, min(b.id) AS id_parent
FROM part p JOIN brand b ON upper(trim(p.p_brand)) = b.name
GROUP BY upper(trim(p.p_name))
""",
)
def min_parent(spark, sf):
    part = Tables(spark, sf).part
    brands = D.assign_ids(D.distinct_keys(part, "p_brand", "name"), "name", "id")
    pairs = D.lookup(part.select(X.upper_trim("p_name").alias("name"), "p_brand"), "p_brand", brands.withColumnRenamed("name", "bkey"), "bkey", ["id"], how="left")
    return D.min_parent(pairs.withColumnRenamed("id", "id_parent"), "name", "id_parent")


@probe(
    "parent_fallback",
    """
SELECT n.n_nationkey AS n_nationkey,
       coalesce(r.r_regionkey, (SELECT min(r_regionkey) FROM region)) AS id_region,
       r.r_regionkey IS NULL AS id_region_fallback
FROM nation n
LEFT JOIN region r ON CAST(length(n.n_name) - 4 AS VARCHAR) = CAST(r.r_regionkey AS VARCHAR)
""",
)
def parent_fallback(spark, sf):
    """A nation whose region code (derived from its name length) is unknown falls back to the first region."""
    t = Tables(spark, sf)
    nat = t.nation.select("n_nationkey", (F.length("n_name") - 4).cast("string").alias("rcode"))
    reg = t.region.select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_regionkey").alias("id_region"))
    j = D.lookup(nat, "rcode", reg, "code", ["id_region"], normalise=False)
    return D.with_parent_fallback(j, "id_region", t.region, "r_regionkey").select("n_nationkey", "id_region", "id_region_fallback")


# =============================================================================================== matching
_CITY_SQL = """
WITH f AS (
  SELECT o.o_orderkey, upper(trim(n.n_name)) AS city
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
), pairs AS (
  SELECT v.city, d.n_nationkey AS id_match
  FROM (SELECT DISTINCT city FROM f) v JOIN nation d ON instr(upper(d.n_name), v.city) > 0
), cnt AS (SELECT city, count(*) AS n_candidates FROM pairs GROUP BY city)
SELECT f.o_orderkey AS o_orderkey, f.city AS city, p.id_match AS id_match,
       CAST(coalesce(c.n_candidates, 0) AS BIGINT) AS n_candidates
FROM f LEFT JOIN pairs p ON f.city = p.city LEFT JOIN cnt c ON f.city = c.city
"""


@probe("contains_join", _CITY_SQL)
def contains_join(spark, sf):
    """orders' city text (customer nation) matched by substring to nation names; fan-out kept."""
    t = Tables(spark, sf)
    f = (
        t.orders.select("o_orderkey", "o_custkey")
        .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
        .select("o_orderkey", X.upper_trim("n_name").alias("city"))
    )
    dim = t.nation.select("n_name", F.col("n_nationkey").alias("id_match"))
    out = M.contains_join(f, "city", dim, "n_name", ["id_match"])
    return out.select("o_orderkey", "city", "id_match", F.col("n_candidates").cast("long").alias("n_candidates"))


@probe(
    "suffix_contains",
    r"""
WITH w AS (
  SELECT DISTINCT upper(x) AS word FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}]+')) AS x FROM documents)
)
SELECT w.word AS word, count(*) AS n_pages, min(p.page_id) AS first_page
FROM w JOIN pages p ON instr(upper(p.url), w.word) > 0
GROUP BY w.word
""",
)
def suffix_contains(spark, sf):
    """J4/J5 on long and many names: every word of the documents against whole urls, by the sorted suffix table."""
    t = Tables(spark, sf, spread=True)
    words = t.documents.select(F.explode(_tok_split(F.col("text"))).alias("w")).select(F.upper("w").alias("word")).distinct()
    pages = t.pages.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    hits = SX.suffix_matches(words, "word", pages, "url", ["n", "first"])
    return hits.groupBy("word").agg(F.sum("n").cast("long").alias("n_pages"), F.min("first").alias("first_page"))


@probe(
    "like_join",
    r"""
WITH pat AS (
  SELECT 'nation\_' || n_nationkey AS pattern FROM nation
  UNION SELECT 'Nation_' || n_nationkey || '%' FROM nation
  UNION SELECT replace(p_name, ' ', '_') FROM part
  UNION SELECT substr(p_name, 1, 2) || '%' || substr(p_name, length(p_name) - 1) FROM part
  UNION SELECT repeat('_', p_size) FROM part
  UNION SELECT repeat('_', p_size) || '%' FROM part
  UNION SELECT '%\#%' || substr(c_name, length(c_name) - 2) FROM customer
  UNION SELECT '%' || substr(c_mktsegment, 2, 1) || '_' || substr(c_mktsegment, 4, 1) || '%' FROM customer
), names AS (
  SELECT p_name AS name FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT n_name FROM nation
  UNION ALL SELECT c_name FROM customer UNION ALL SELECT c_mktsegment FROM customer
)
SELECT pattern, count(*) AS n_names, min(name) AS first_name
FROM pat JOIN names ON upper(name) LIKE upper(pattern) ESCAPE '\'
GROUP BY pattern
""",
)
def like_join(spark, sf):
    """Texts that are LIKE patterns (``%``, ``_``, escaped ones, wildcards only) against all names."""
    t = Tables(spark, sf)
    n, p, c = t.nation, t.part, t.customer
    key, size, segment = F.col("n_nationkey").cast("string"), F.repeat(F.lit("_"), F.col("p_size")), F.col("c_mktsegment")
    patterns = [
        n.select(F.concat(F.lit("nation\\_"), key).alias("pattern")), n.select(F.concat(F.lit("Nation_"), key, F.lit("%"))),
        p.select(F.replace("p_name", F.lit(" "), F.lit("_"))), p.select(F.concat(F.substring("p_name", 1, 2), F.lit("%"), F.substring("p_name", -2, 2))),
        p.select(size), p.select(F.concat(size, F.lit("%"))),
        c.select(F.concat(F.lit("%\\#%"), F.substring("c_name", -3, 3))),
        c.select(F.concat(F.lit("%"), F.substring(segment, 2, 1), F.lit("_"), F.substring(segment, 4, 1), F.lit("%"))),
    ]
    names = [p.select(F.col("p_name").alias("name")), p.select("p_type"), n.select("n_name"), c.select("c_name"), c.select(segment)]
    names = functools.reduce(DataFrame.union, names).groupBy(F.col("name")).agg(F.count(F.lit(1)).alias("n"))
    hits = LK.like_matches(functools.reduce(DataFrame.union, patterns).distinct(), "pattern", names, "name", ["name", "n"])
    return hits.groupBy("pattern").agg(F.sum("n").cast("long").alias("n_names"), F.min("name").alias("first_name"))


@probe(
    "folded_contains_join",
    r"""
WITH toks AS (
  SELECT DISTINCT d.doc_id, t.tok
  FROM documents d, unnest(regexp_split_to_array(d.text, '[^\p{L}]+')) AS t(tok)
  WHERE t.tok <> ''
), v AS (SELECT DISTINCT tok, regexp_replace(upper(strip_accents(replace(tok, 'ß', 'ss'))), '[^0-9A-Z]+', '', 'g') AS k FROM toks),
dim AS (
  SELECT p_partkey, regexp_replace(upper(strip_accents(replace(p_name, 'ß', 'ss'))), '[^0-9A-Z]+', '', 'g') AS k FROM part
), hits AS (
  SELECT v.tok, count(*) AS n_parts FROM v JOIN dim ON length(v.k) > 0 AND instr(dim.k, v.k) > 0 GROUP BY v.tok
)
SELECT t.doc_id AS doc_id, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(count(h.tok) AS BIGINT) AS n_matched_tokens,
       CAST(coalesce(sum(h.n_parts), 0) AS BIGINT) AS n_candidates
FROM toks t LEFT JOIN hits h ON t.tok = h.tok
GROUP BY t.doc_id
""",
)
def folded_contains_join(spark, sf):
    """Accent- and punctuation-folded substring match of every distinct word of every document (whole texts)
    against part names; per document: distinct words, words with a hit, and candidates (fan-out)."""
    t = Tables(spark, sf, spread=True)
    docs, dim = t.documents, t.part.select("p_name", "p_partkey")
    values = docs.select(F.explode(_tok_split(F.col("text"))).alias("tok"))
    per_tok = M.contains_join(_distinct_words(docs), "tok", dim, "p_name", [], fold=True, count_col="n_parts", fan_out=False, values=values)
    return per_tok.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_tokens"),
        F.count_if(F.col("n_parts") > 0).cast("long").alias("n_matched_tokens"),
        F.sum("n_parts").cast("long").alias("n_candidates"),
    )


_CI_AI_WORDS = ["LE", "la", "Des", "THE", "and", "der", "Die", "und", "que", "de", "el", "Ete", "eaux", "ou", "pour"]


@probe(
    "ci_ai_in",
    r"""
SELECT doc_id,
       CAST(len(list_filter(regexp_split_to_array(text, '[^\p{L}]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(regexp_split_to_array(text, '[^\p{L}]+'),
            lambda x: lower(strip_accents(x)) IN ('le','la','des','the','and','der','die','und','que','de','el','ete','eaux','ou','pour')))
            AS BIGINT) AS n_in_list
FROM documents
""",
)
def ci_ai_in(spark, sf):
    """Case- and accent-insensitive membership of every word (ICU ``UNICODE_CI_AI`` collation), per document,
    without an explode: one higher-order filter per row."""
    d = Tables(spark, sf, spread=True).documents
    toks = _tok_split(F.col("text"))
    hits = F.filter(toks, lambda x: X.isin_ci_ai(x, _CI_AI_WORDS))
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"), F.size(hits).cast("long").alias("n_in_list"))


# =============================================================================================== text functions (F*)
@probe("accent_fold", "SELECT doc_id, md5(strip_accents(text)) AS text_md5, strip_accents(text) <> text AS changed FROM documents")
def accent_fold(spark, sf):
    d = Tables(spark, sf, spread=True).documents
    f = X.fold_accents("text")
    return d.select("doc_id", F.md5(f).alias("text_md5"), (f != F.col("text")).alias("changed"))


@probe(
    "normalize_header",
    f"""
SELECT doc_id,
  md5(coalesce(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(text)), '^{WS}+|{WS}+$', '', 'g'),
      '{WS}+', '_', 'g'), '[^0-9a-z_]+', '', 'g'), '')) AS header_md5
FROM documents
""",
)
def normalize_header(spark, sf):
    d = Tables(spark, sf, spread=True).documents
    return d.select("doc_id", F.md5(X.normalize_header("text")).alias("header_md5"))


@probe(
    "collapse_ws",
    f"""
SELECT conv_id, turn,
  md5(regexp_replace(regexp_replace(lower(coalesce(text, '')), '^{WS}+|{WS}+$', '', 'g'), '{WS}+', ' ', 'g')) AS text_md5
FROM conversations
""",
)
def collapse_ws(spark, sf):
    c = Tables(spark, sf, spread=True).conversations
    return c.select("conv_id", "turn", F.md5(X.collapse_ws("text")).alias("text_md5"))


def _code_text(c_nationkey: Column, c_mktsegment: Column) -> Column:
    return (
        F.when(c_mktsegment == "BUILDING", F.concat(c_nationkey.cast("string"), F.lit(".0")))
        .when(c_mktsegment == "AUTOMOBILE", F.concat(F.lit(" "), c_nationkey.cast("string"), F.lit(" ")))
        .when(c_mktsegment == "MACHINERY", F.concat(F.lit("x"), c_nationkey.cast("string"), F.lit(".50")))
        .when(c_mktsegment == "HOUSEHOLD", F.concat(c_nationkey.cast("string"), F.lit(".25")))
        .otherwise(F.lower(F.concat(F.lit("c-"), c_nationkey.cast("string"))))
    )


@probe(
    "normalize_code",
    r"""
WITH t AS (
  SELECT c_custkey,
    trim(CASE c_mktsegment
      WHEN 'BUILDING' THEN concat(CAST(c_nationkey AS VARCHAR), '.0')
      WHEN 'AUTOMOBILE' THEN concat(' ', CAST(c_nationkey AS VARCHAR), ' ')
      WHEN 'MACHINERY' THEN concat('x', CAST(c_nationkey AS VARCHAR), '.50')
      WHEN 'HOUSEHOLD' THEN concat(CAST(c_nationkey AS VARCHAR), '.25')
      ELSE lower(concat('c-', CAST(c_nationkey AS VARCHAR))) END) AS s
  FROM customer
)
SELECT c_custkey,
  upper(CASE WHEN contains(s, '.') AND TRY_CAST(s AS DOUBLE) IS NOT NULL
                  AND TRY_CAST(s AS DOUBLE) = floor(TRY_CAST(s AS DOUBLE))
             THEN CAST(CAST(TRY_CAST(s AS DOUBLE) AS DECIMAL(38,0)) AS VARCHAR) ELSE s END) AS code
FROM t
""",
)
def normalize_code(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", X.normalize_code(_code_text(F.col("c_nationkey"), F.col("c_mktsegment"))).alias("code"))


@probe(
    "decimal_comma",
    r"""
WITH t AS (
  SELECT event_id,
    CASE WHEN event_type = 'error' THEN concat(replace(printf('%.2f', value), '.', ','), 'x')
         WHEN event_type = 'view' THEN concat(' ', replace(printf('%.2f', value), '.', ','), ' ')
         ELSE replace(printf('%.2f', value), '.', ',') END AS s
  FROM events
)
SELECT event_id,
  CAST(CASE WHEN regexp_full_match(replace(trim(s), ',', '.'), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
            THEN TRY_CAST(replace(trim(s), ',', '.') AS DECIMAL(18,6)) END AS DOUBLE) AS price
FROM t
""",
)
def decimal_comma(spark, sf):
    """Comma-decimal text parsed to decimal(18,6); malformed text gives NULL (returned as double)."""
    e = Tables(spark, sf).events
    txt = F.replace(F.format_string("%.2f", F.col("value")), F.lit("."), F.lit(","))
    s = (
        F.when(F.col("event_type") == "error", F.concat(txt, F.lit("x")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), txt, F.lit(" ")))
        .otherwise(txt)
    )
    return e.select("event_id", X.parse_decimal(s).cast("double").alias("price"))


@probe(
    "reject_rows",
    r"""
WITH t AS (
  SELECT CASE WHEN event_type = 'error' THEN concat(json_extract_string(props, '$.k'), '.0')
              WHEN event_type = 'view' THEN concat(' ', json_extract_string(props, '$.k'), ' ')
              WHEN event_type = 'signup' THEN concat('y', json_extract_string(props, '$.k'))
              ELSE json_extract_string(props, '$.k') END AS s
  FROM events
), p AS (
  SELECT CASE WHEN regexp_full_match(trim(s), '[+-]?[0-9]+') THEN TRY_CAST(trim(s) AS INTEGER) END AS annee FROM t
)
SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(annee) AS BIGINT) AS accepted,
       CAST(count(*) - count(annee) AS BIGINT) AS skipped, CAST(sum(annee) AS BIGINT) AS sum_accepted
FROM p
""",
)
def reject_rows(spark, sf):
    """P3/Q-9: mandatory integer parse; rejected rows counted (the same counts are exposed as an Observation)."""
    e = Tables(spark, sf).events.withColumn("m", F.from_json("props", "map<string,string>"))
    k = RS.resolve_field("m", ["k"])
    s = (
        F.when(F.col("event_type") == "error", F.concat(k, F.lit(".0")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("y"), k))
        .otherwise(k)
    )
    accepted, rejected, _ = RS.require_int(e.select(s.alias("year")), "year", "annee")
    both = accepted.select("annee", F.lit(1).alias("ok")).unionByName(rejected.select("annee", F.lit(0).alias("ok")))
    return both.agg(
        F.count(F.lit(1)).cast("long").alias("processed"),
        F.sum("ok").cast("long").alias("accepted"),
        F.sum(1 - F.col("ok")).cast("long").alias("skipped"),
        F.sum(F.when(F.col("ok") == 1, F.col("annee"))).cast("long").alias("sum_accepted"),
    )


# =============================================================================================== row objects
@probe(
    "row_json",
    r"""
SELECT event_id, user_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS row_index,
  CAST(json_object('k', json_extract_string(props, '$.k'), 'event_type', event_type) AS VARCHAR) AS row_json
FROM events
""",
)
def row_json(spark, sf):
    """Each event becomes a flat row object (all values text) with a 1-based index per user in time
    order."""
    e = Tables(spark, sf).events
    m = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("event_type"), F.col("event_type")))
    rows = e.select("event_id", "user_id", "ts", F.to_json(m).alias("row_json"))
    # per-user numbering that never puts one user's rows into one task (a user may hold a third of the events)
    numbered = D.number_rows(rows, ["ts", "event_id"], ["user_id"], "row_index")
    return numbered.select("event_id", "user_id", F.col("row_index").cast("int").alias("row_index"), "row_json")


_CSV_SQL = r"""
SELECT c_custkey,
  CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN concat('Clé;Nom;Nation;Solde', chr(10), c_custkey, ';', c_name, ';', c_nationkey, ';', CAST(c_acctbal AS DECIMAL(18,2)), chr(10))
    WHEN 'BUILDING' THEN concat('"Clé","Nom","Nation","Solde"', chr(13), chr(10), '"', c_custkey, '","', c_name, ' ""x"",', chr(10), 'y","', c_nationkey, '","', CAST(c_acctbal AS DECIMAL(18,2)), '"', chr(13), chr(10))
    WHEN 'FURNITURE' THEN concat(chr(10), 'nation', chr(9), 'solde', chr(9), 'nom', chr(9), 'clé', chr(10), c_nationkey, chr(9), CAST(c_acctbal AS DECIMAL(18,2)), chr(9), c_name, chr(9), c_custkey)
    WHEN 'HOUSEHOLD' THEN concat('CLÉ|NOM|NATION|SOLDE', chr(10), 'too|long|a|row|!', chr(10), c_custkey, '|', c_name, '|', c_nationkey, '|', CAST(c_acctbal AS DECIMAL(18,2)), chr(10))
    ELSE concat('Nom ;Nation;Clé', chr(10), c_name, ';', c_nationkey, ';', c_custkey, chr(10), chr(10)) END AS content
FROM customer
"""


@probe(
    "csv_ranges",
    "SELECT conv_id, turn, coalesce(role, '') AS role, md5(coalesce(text, '')) AS text_md5, length(coalesce(text, '')) AS n_chars FROM conversations",
)
def csv_ranges(spark, sf):
    """S4/S5 for files of any size: the conversations as quoted CSV with line breaks in cells, read back in byte ranges."""
    from pricelake.session import scratch_folder

    path = scratch_folder(spark, "csv-ranges")
    t = Tables(spark, sf).conversations.select("conv_id", "turn", "role", "text")
    t.write.csv(path, header=True, quoteAll=True, escape='"', lineSep="\n", nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    m = FS.row_map("row_json")
    rows = RG.read_csv_ranges(spark, [path]).where("status = 'ok'").select(m.alias("m")).select(*[F.col("m")[c].alias(c) for c in t.columns])
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def _customer_files(spark, sf) -> DataFrame:
    """Every customer as a small CSV file of its own; separator, quoting, line ends and header differ by segment."""
    key, name, nation = (F.col(c).cast("string") for c in ("c_custkey", "c_name", "c_nationkey"))
    money = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    seg = F.col("c_mktsegment")
    text = (
        F.when(seg == "AUTOMOBILE", F.concat(F.lit("Clé;Nom;Nation;Solde\n"), F.concat_ws(";", key, name, nation, money), F.lit("\n")))
        .when(seg == "BUILDING", F.concat(F.lit('"Clé","Nom","Nation","Solde"\r\n"'), F.concat_ws('","', key, F.concat(name, F.lit(' ""x"",\ny')), nation, money), F.lit('"\r\n')))
        .when(seg == "FURNITURE", F.concat(F.lit("\nnation\tsolde\tnom\tclé\n"), F.concat_ws("\t", nation, money, name, key)))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("CLÉ|NOM|NATION|SOLDE\ntoo|long|a|row|!\n"), F.concat_ws("|", key, name, nation, money), F.lit("\n")))
        .otherwise(F.concat(F.lit("Nom ;Nation;Clé\n"), F.concat_ws(";", name, nation, key), F.lit("\n\n")))
    )
    rel = F.concat(F.lit("x/"), F.col("c_custkey").cast("string"), F.lit("_T1.csv"))
    return Tables(spark, sf, spread=True).customer.select(seg.alias("archive"), rel.alias("rel_path"), F.encode(text, "UTF-8").alias("content"))


@probe(
    "csv_rows",
    """
SELECT c_mktsegment AS archive, CAST(c_custkey AS VARCHAR) AS key,
  CASE WHEN c_mktsegment = 'BUILDING' THEN concat(c_name, ' "x",', chr(10), 'y') ELSE c_name END AS name,
  CAST(c_nationkey AS VARCHAR) AS nation,
  CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN '' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance,
  CAST(1 AS INTEGER) AS row_index
FROM customer
""",
)
def csv_rows(spark, sf):
    """Sniff, parse and tolerant look-up of every customer's CSV file: separators, quotes, doubled quotes, a
    line break in a cell, a rejected row, blank lines, other column orders and a missing column."""
    rows = FS.to_rows(FS.sniff(_customer_files(spark, sf))).where("status = 'ok'")
    rows = rows.select("archive", "row_index", FS.row_map("row_json").alias("m"))
    fields = {"key": ["cle", "clé"], "name": ["nom"], "nation": ["nation"], "balance": ["solde"]}
    return rows.select("archive", *[RS.resolve_field("m", v).alias(k) for k, v in fields.items()], "row_index")


@probe(
    "resolve_field",
    r"""
SELECT event_id, json_extract_string(props, '$.k') AS k_value, event_type AS type_value, '' AS missing_value
FROM events
""",
)
def resolve_field(spark, sf):
    """Tolerant lookup: ' K ' matches key 'k' exactly after lower+strip; 'type' matches 'Event_Type' by
    containment; an unknown alias gives ''."""
    e = Tables(spark, sf).events.select(
        "event_id",
        F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("Event_Type"), F.col("event_type"))).alias("m"),
    )
    # the map is parsed once per row (its own projection); the lookups reuse it
    return e.select(
        "event_id",
        RS.resolve_field("m", [" K "]).alias("k_value"),
        RS.resolve_field("m", ["typ", "type"]).alias("type_value"),
        RS.resolve_field("m", ["année", "annee"]).alias("missing_value"),
    )


# =============================================================================================== facts
_FACT_LOOKUP_SQL = """
WITH variety AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_name)) AS name FROM part WHERE trim(p_name) <> '')
), product AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_brand)) AS name FROM part WHERE trim(p_brand) <> '')
)
SELECT l.l_orderkey, l.l_linenumber,
  CASE l.l_returnflag WHEN 'R' THEN 'T1' WHEN 'A' THEN 'T3' ELSE 'UNKNOWN' END AS type_indice,
  CASE WHEN l.l_returnflag = 'R' THEN v.id WHEN l.l_returnflag = 'A' THEN pr.id ELSE NULL END AS id_reference,
  n.n_regionkey AS id_region
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN variety v ON upper(trim(p.p_name)) = v.name
LEFT JOIN product pr ON upper(trim(p.p_brand)) = pr.name
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
"""


def _type_of(flag: Column) -> Column:
    return F.when(flag == "R", F.lit("T1")).when(flag == "A", F.lit("T3")).otherwise(F.lit("UNKNOWN"))


@probe("fact_lookup", _FACT_LOOKUP_SQL)
def fact_lookup(spark, sf):
    """J6 + P14: lineitem decorated with variety/product ids by exact name and the region of its supplier; the
    reference id is polymorphic by type."""
    t = Tables(spark, sf, spread=True)
    part = t.part
    variety = D.assign_ids(D.distinct_keys(part, "p_name", "name"), "name", "id_variete")
    product = D.assign_ids(D.distinct_keys(part, "p_brand", "name"), "name", "id_produit")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")
    li = li.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey", "left")
    li = D.lookup(li, "p_name", variety, "name", ["id_variete"])
    li = D.lookup(li, "p_brand", product, "name", ["id_produit"])
    geo = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(
        t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("id_region")), "s_nationkey", "left"
    )
    li = li.join(geo, "l_suppkey", "left")
    typ = _type_of(F.col("l_returnflag"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        typ.alias("type_indice"),
        FA.poly_ref(typ, {"T1": "id_variete", "T3": "id_produit"}).alias("id_reference"),
        "id_region",
    )


@probe(
    "poly_ref",
    """
SELECT CASE l_returnflag WHEN 'R' THEN 'T1' WHEN 'A' THEN 'T3' ELSE 'UNKNOWN' END AS type_indice,
  CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(CASE WHEN l_returnflag = 'R' THEN l_partkey WHEN l_returnflag = 'A' THEN l_suppkey END) AS BIGINT) AS n_with_ref,
  CAST(count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey WHEN l_returnflag = 'A' THEN l_suppkey END) AS BIGINT) AS n_refs
FROM lineitem GROUP BY 1
""",
)
def poly_ref(spark, sf):
    """P14 alone: the reference points at the part for T1 and at the supplier for T3, NULL otherwise."""
    li = Tables(spark, sf).lineitem
    typ = _type_of(F.col("l_returnflag"))
    ref = FA.poly_ref(typ, {"T1": "l_partkey", "T3": "l_suppkey"})
    return li.select(typ.alias("type_indice"), ref.alias("ref")).groupBy("type_indice").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count("ref").cast("long").alias("n_with_ref"),
        F.count_distinct("ref").cast("long").alias("n_refs"),
    )


@probe(
    "top1_dedupe",
    """
SELECT annee, l_returnflag, l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, l_returnflag, l_partkey, l_orderkey, l_linenumber, l_extendedprice,
    row_number() OVER (PARTITION BY year(l_shipdate), l_returnflag, l_partkey
      ORDER BY coalesce(l_extendedprice, -1) DESC, coalesce(l_quantity, -1) DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1
""",
)
def top1_dedupe(spark, sf):
    li = Tables(spark, sf, spread=True).lineitem.withColumn("annee", F.year("l_shipdate").cast("int"))
    best = FA.top1(
        li,
        ["annee", "l_returnflag", "l_partkey"],
        [FA.desc_nulls_as("l_extendedprice", -1), FA.desc_nulls_as("l_quantity", -1), F.col("l_orderkey"), F.col("l_linenumber")],
    )
    return best.select("annee", "l_returnflag", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")


_SNAP = """
  SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
         round(sum(o_totalprice), 2) AS amount, CAST(count(*) AS BIGINT) AS n_orders, '{tag}' AS origin
  FROM orders WHERE o_orderdate {cmp} TIMESTAMP '1998-01-01 00:00:00'
  GROUP BY 1, 2
"""


@probe(
    "upsert_merge",
    "WITH t AS (" + _SNAP.format(tag="A", cmp="<") + "), s AS (" + _SNAP.format(tag="B", cmp=">=") + ")"
    + """
SELECT CASE WHEN s.n_orders IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.n_orders IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.n_orders IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
       CASE WHEN s.n_orders IS NOT NULL THEN s.n_orders ELSE t.n_orders END AS n_orders,
       CASE WHEN t.n_orders IS NOT NULL THEN t.origin ELSE s.origin END AS origin
FROM t FULL OUTER JOIN s
  ON t.o_custkey IS NOT DISTINCT FROM s.o_custkey AND t.status IS NOT DISTINCT FROM s.status
""",
)
def upsert_merge(spark, sf):
    """Snapshot A (orders before 1998) upserted by snapshot B (from 1998) on (customer, status) with NULL
    status for pending orders, matched null-safely; ``origin`` is not updated, so it shows which rows matched."""
    o = Tables(spark, sf).orders
    status = F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))

    def snap(cond, tag):
        return (
            o.where(cond)
            .groupBy("o_custkey", status.alias("status"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("amount"), F.count(F.lit(1)).cast("long").alias("n_orders"))
            .withColumn("origin", F.lit(tag))
        )

    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    a = snap(F.col("o_orderdate") < cut, "A")
    b = snap(F.col("o_orderdate") >= cut, "B")
    return FA.upsert(a, b, ["o_custkey", "status"], ["amount", "n_orders"])


_FACT_IDS_SQL = """
WITH nat AS (
  SELECT CAST(EXTRACT(year FROM l_shipdate) AS INTEGER) AS annee, 'T1' AS type_indice, CAST(l_partkey AS BIGINT) AS id_reference,
         CAST(l_suppkey AS BIGINT) AS id_province_prefecture, CAST(NULL AS BIGINT) AS id_region,
         CAST(max(l_extendedprice) AS DECIMAL(18,6)) AS prix_moyen, CAST(max(l_quantity) AS DECIMAL(18,6)) AS valeur_indice, 'X' AS match_quality,
         CAST(NULL AS VARCHAR) AS agglomeration_raw
  FROM lineitem GROUP BY 1, 3, 4
), old AS (
  SELECT *, row_number() OVER (ORDER BY annee, id_reference, id_province_prefecture) AS id_indice FROM nat WHERE annee <= 1995
), fresh AS (
  SELECT annee, id_reference, id_province_prefecture, prix_moyen + 1 AS prix_moyen FROM nat WHERE annee >= 1995
), merged AS (
  SELECT coalesce(f.annee, o.annee) AS annee, coalesce(f.id_reference, o.id_reference) AS id_reference,
         coalesce(f.id_province_prefecture, o.id_province_prefecture) AS id_province_prefecture,
         coalesce(f.prix_moyen, o.prix_moyen) AS prix_moyen, o.id_indice
  FROM old o FULL JOIN fresh f ON o.annee = f.annee AND o.id_reference = f.id_reference AND o.id_province_prefecture = f.id_province_prefecture
)
SELECT annee, id_reference, id_province_prefecture, CAST(prix_moyen AS DOUBLE) AS prix_moyen,
       CAST(coalesce(id_indice, (SELECT max(id_indice) FROM old)
         + row_number() OVER (PARTITION BY id_indice IS NULL ORDER BY annee, id_reference, id_province_prefecture)) AS BIGINT) AS id_indice
FROM merged
"""


@probe("fact_upsert", _FACT_IDS_SQL)
def fact_upsert(spark, sf):
    """The facts from 1995 on are upserted into an earlier version (up to 1995); known natural keys keep their ids,
    new ones are numbered from the greatest on. The region key is NULL throughout: keys match null-safely."""
    from pricelake.plans import index_facts as IF

    old, fresh = _yearly_facts(spark, sf)
    merged = FA.upsert(old.drop("id_indice"), fresh, IF.NATURAL_KEY, IF.UPDATE_COLS)
    out = IF.with_fact_ids(merged, known=old)
    return out.select("annee", "id_reference", "id_province_prefecture", F.col("prix_moyen").cast("double").alias("prix_moyen"), "id_indice")


@probe("fact_upsert_pruned", _FACT_IDS_SQL)
def fact_upsert_pruned(spark, sf):
    """U1/D1 on a stored fact: the same upsert, rewriting only the years from 1995 on; the folders of earlier years are
    carried over by the version's manifest, which also holds the greatest id."""
    from pricelake.plans import index_facts as IF
    from pricelake.session import scratch_folder
    from pricelake.sources import partitioned as PT

    old, fresh = _yearly_facts(spark, sf)
    root = scratch_folder(spark, "fact-upsert")
    PT.write_partitions(old.select("id_indice", *[f.name for f in IF.FACT_SCHEMA.fields]), root, "annee", "id_indice")
    IF.upsert_fact(fresh, root)
    out = PT.read_partitions(spark, root)
    return out.select("annee", "id_reference", "id_province_prefecture", F.col("prix_moyen").cast("double").alias("prix_moyen"), "id_indice")


def _yearly_facts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """An earlier version of the fact with ids (up to 1995) and its successor's rows from 1995 on."""
    from pricelake.plans import index_facts as IF

    nat = (
        Tables(spark, sf).lineitem.groupBy(
            F.year("l_shipdate").cast("int").alias("annee"), F.lit("T1").alias("type_indice"), F.col("l_partkey").cast("long").alias("id_reference"),
            F.col("l_suppkey").cast("long").alias("id_province_prefecture"), F.lit(None).cast("long").alias("id_region"),
        )
        .agg(F.max("l_extendedprice").cast("decimal(18,6)").alias("prix_moyen"), F.max("l_quantity").cast("decimal(18,6)").alias("valeur_indice"))
        .withColumn("match_quality", F.lit("X")).withColumn("agglomeration_raw", F.lit(None).cast("string"))
    )
    old = IF.with_fact_ids(nat.where("annee <= 1995"))
    return old, nat.where("annee >= 1995").withColumn("prix_moyen", (F.col("prix_moyen") + 1).cast("decimal(18,6)"))


# ---- overrides on unmatched cities (J7, U3, Q-10) and the reports over the result
_OVR_BASE_SQL = """
WITH f AS (
  SELECT c.c_custkey, CASE WHEN n.n_regionkey <= 1 THEN replace(n.n_name, '_', '') ELSE n.n_name END AS city
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
), m AS (
  SELECT f.c_custkey, upper(trim(f.city)) AS agglomeration_raw, d.n_nationkey AS id_province, d.n_regionkey AS id_region
  FROM f LEFT JOIN nation d ON upper(trim(f.city)) = upper(trim(d.n_name))
), ovr AS (
  SELECT replace(upper(trim(n.n_name)), '_', '') AS agglomeration_raw, n.n_nationkey AS id_province,
         n.n_regionkey AS id_region, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS row_count
  FROM nation n WHERE n.n_regionkey = 0
), fixed AS (
  SELECT m.c_custkey, m.agglomeration_raw,
    CASE WHEN m.id_region IS NULL AND o.id_province IS NOT NULL THEN o.id_province ELSE m.id_province END AS id_province,
    CASE WHEN m.id_region IS NULL AND o.id_province IS NOT NULL THEN o.id_region ELSE m.id_region END AS id_region,
    CASE WHEN m.id_region IS NULL AND o.id_province IS NOT NULL THEN 'MATCHED_MANUAL'
         WHEN m.id_province IS NULL THEN 'UNMATCHABLE' ELSE 'MATCHED' END AS match_quality,
    (m.id_region IS NULL AND o.id_province IS NOT NULL) AS overridden
  FROM m LEFT JOIN ovr o ON m.agglomeration_raw = o.agglomeration_raw
)
"""


def _overridden(spark, sf) -> tuple[DataFrame, DataFrame]:
    t = Tables(spark, sf)
    nat = t.nation
    city = F.when(F.col("n_regionkey") <= 1, F.replace(F.col("n_name"), F.lit("_"), F.lit(""))).otherwise(F.col("n_name"))
    f = t.customer.select("c_custkey", "c_nationkey").join(
        nat.select(F.col("n_nationkey").alias("c_nationkey"), city.alias("city")), "c_nationkey"
    )
    f = f.select("c_custkey", X.upper_trim("city").alias("agglomeration_raw"))
    dim = nat.select(X.upper_trim("n_name").alias("k"), F.col("n_nationkey").alias("id_province_prefecture"), F.col("n_regionkey").alias("id_region"))
    m = D.lookup(f, "agglomeration_raw", dim, "k", ["id_province_prefecture", "id_region"])
    m = m.withColumn("match_quality", M.match_label("id_province_prefecture"))
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("row_count"))
    ovr = (
        nat.where(F.col("n_regionkey") == 0)
        .select(
            F.replace(X.upper_trim("n_name"), F.lit("_"), F.lit("")).alias("agglomeration_raw"),
            X.upper_trim("n_name").alias("correct_province_name"),
            F.col("n_nationkey").alias("c_nationkey"),
        )
        .join(counts, "c_nationkey", "left")
        .withColumn("row_count", F.coalesce(F.col("row_count"), F.lit(0)))
        .drop("c_nationkey")
    )
    prov = nat.select(F.col("n_name").alias("nom_province_prefecture"), F.col("n_nationkey").alias("id_province_prefecture"), F.col("n_regionkey").alias("id_region"))
    resolved = FA.resolve_overrides(ovr, prov)
    return FA.apply_overrides(m, resolved), resolved


@probe(
    "apply_overrides",
    _OVR_BASE_SQL
    + "SELECT c_custkey, agglomeration_raw, id_province AS id_province_prefecture, id_region, match_quality FROM fixed",
)
def apply_overrides(spark, sf):
    applied, _ = _overridden(spark, sf)
    return applied.select("c_custkey", "agglomeration_raw", "id_province_prefecture", "id_region", "match_quality")


@probe(
    "override_report",
    _OVR_BASE_SQL
    + """
SELECT o.agglomeration_raw, CAST(o.row_count AS BIGINT) AS rows_expected,
       CAST(coalesce(x.n, 0) AS BIGINT) AS rows_fixed, CAST(coalesce(x.n, 0) - o.row_count AS BIGINT) AS delta
FROM ovr o LEFT JOIN (SELECT agglomeration_raw, count(*) AS n FROM fixed WHERE overridden GROUP BY 1) x
  ON o.agglomeration_raw = x.agglomeration_raw
""",
)
def override_report(spark, sf):
    applied, resolved = _overridden(spark, sf)
    return FA.override_report(applied, resolved).select("agglomeration_raw", "rows_expected", "rows_fixed", "delta")


@probe(
    "match_report",
    _OVR_BASE_SQL
    + """
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(id_region) AS BIGINT) AS matched_rows,
       CAST(count(*) - count(id_region) AS BIGINT) AS unmatchable_rows,
       CAST(round(100.0 * count(id_region) / count(*), 2) AS DOUBLE) AS success_rate
FROM fixed
""",
)
def match_report(spark, sf):
    applied, _ = _overridden(spark, sf)
    r = Q.match_report(applied, "id_region")
    return r.withColumn("success_rate", F.col("success_rate").cast("double"))


@probe(
    "share_of_total",
    _OVR_BASE_SQL
    + """
SELECT match_quality, CAST(count(*) AS BIGINT) AS n,
       CAST(round(100.0 * count(*) / (SELECT count(*) FROM fixed), 2) AS DOUBLE) AS pct
FROM fixed GROUP BY match_quality
""",
)
def share_of_total(spark, sf):
    applied, _ = _overridden(spark, sf)
    return Q.share_of_total(applied, "match_quality").withColumn("pct", F.col("pct").cast("double"))


@probe(
    "null_report",
    _OVR_BASE_SQL
    + """
SELECT CAST(count(*) FILTER (WHERE id_province IS NULL) AS BIGINT) AS null_id_province_prefecture,
       CAST(count(*) FILTER (WHERE id_region IS NULL) AS BIGINT) AS null_id_region,
       CAST(count(*) AS BIGINT) AS total_rows,
       CAST(round(100.0 * count(*) FILTER (WHERE id_province IS NULL) / count(*), 2) AS DOUBLE) AS pct_null_id_province_prefecture
FROM fixed
""",
)
def null_report(spark, sf):
    applied, _ = _overridden(spark, sf)
    r = Q.null_report(applied, ["id_province_prefecture", "id_region"])
    return r.withColumn("pct_null_id_province_prefecture", F.col("pct_null_id_province_prefecture").cast("double"))


@probe(
    "level_coverage",
    _OVR_BASE_SQL
    + """
SELECT 'PROVINCE' AS level, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT agglomeration_raw) AS BIGINT) AS n_refs
FROM fixed WHERE id_province IS NOT NULL
UNION ALL
SELECT 'REGION', CAST(count(*) AS BIGINT), CAST(count(DISTINCT agglomeration_raw) AS BIGINT) FROM fixed WHERE id_region IS NOT NULL
UNION ALL
SELECT 'NONE', CAST(count(*) AS BIGINT), CAST(count(DISTINCT agglomeration_raw) AS BIGINT) FROM fixed WHERE id_region IS NULL
""",
)
def level_coverage(spark, sf):
    applied, _ = _overridden(spark, sf)
    return Q.level_coverage(
        applied,
        {
            "PROVINCE": F.col("id_province_prefecture").isNotNull(),
            "REGION": F.col("id_region").isNotNull(),
            "NONE": F.col("id_region").isNull(),
        },
        "agglomeration_raw",
    )


# =============================================================================================== exclusions
@probe(
    "exclude_values",
    """
WITH f AS (SELECT c.c_custkey, upper(trim(n.n_name)) AS city FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ex AS (SELECT upper(trim(n_name)) AS agglomeration_raw, CASE WHEN n_regionkey = 3 THEN n_nationkey END AS target
       FROM nation WHERE n_regionkey IN (2, 3))
SELECT c_custkey, city FROM f
WHERE city NOT IN ('NATION_7', '') AND city IS NOT NULL
  AND city NOT IN (SELECT agglomeration_raw FROM ex WHERE target IS NULL)
""",
)
def exclude_values(spark, sf):
    """Drop literal values and exclusion-table values whose target is NULL (region 2's nations); rows
    of region 3 are in the table with a target, so they stay."""
    t = Tables(spark, sf)
    f = t.customer.select("c_custkey", "c_nationkey").join(
        t.nation.select(F.col("n_nationkey").alias("c_nationkey"), X.upper_trim("n_name").alias("city")), "c_nationkey"
    )
    ex = t.nation.where(F.col("n_regionkey").isin(2, 3)).select(
        X.upper_trim("n_name").alias("agglomeration_raw"),
        F.when(F.col("n_regionkey") == 3, F.col("n_nationkey")).alias("id_province_prefecture"),
    )
    return M.exclude_values(f, "city", ["NATION_7", ""], ex).select("c_custkey", "city")


# =============================================================================================== reports (A7, A8, A10, ...)
@probe(
    "profile_by_type",
    """
SELECT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '(NULL)') AS status,
  CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS n_years,
  CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_refs,
  round(min(o_totalprice), 2) AS min_value, round(max(o_totalprice), 2) AS max_value,
  round(avg(o_totalprice), 2) AS avg_value
FROM orders GROUP BY 1
""",
)
def profile_by_type(spark, sf):
    o = Tables(spark, sf).orders.select(
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.year("o_orderdate").alias("annee"),
        "o_custkey",
        "o_totalprice",
    )
    return Q.profile_by(o, "status", "o_totalprice", "annee", "o_custkey", digits=2)


@probe(
    "year_coverage",
    """
SELECT 'orders' AS fact, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS n_years,
       CAST(min(year(o_orderdate)) AS INTEGER) AS min_year, CAST(max(year(o_orderdate)) AS INTEGER) AS max_year FROM orders
UNION ALL
SELECT 'lineitem', CAST(count(*) AS BIGINT), CAST(count(DISTINCT year(l_shipdate)) AS BIGINT),
       CAST(min(year(l_shipdate)) AS INTEGER), CAST(max(year(l_shipdate)) AS INTEGER) FROM lineitem
""",
)
def year_coverage(spark, sf):
    t = Tables(spark, sf)
    return Q.year_coverage(
        {
            "orders": t.orders.select(F.year("o_orderdate").alias("annee")),
            "lineitem": t.lineitem.select(F.year("l_shipdate").alias("annee")),
        },
        "annee",
    )


@probe(
    "hierarchy_counts",
    """
SELECT r.r_name AS r_name, CAST(count(DISTINCT n.n_nationkey) AS BIGINT) AS n_nation,
       CAST(count(DISTINCT c.c_custkey) AS BIGINT) AS n_customer
FROM region r LEFT JOIN nation n ON n.n_regionkey = r.r_regionkey LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY r.r_name ORDER BY r.r_name DESC LIMIT 10
""",
)
def hierarchy_counts(spark, sf):
    """Members per level below each root, each level counted at its own table, TOP 10 by name."""
    t = Tables(spark, sf)
    levels = [("nation", t.nation, "n_nationkey", "n_regionkey"), ("customer", t.customer, "c_custkey", "c_nationkey")]
    counts = Q.hierarchy_counts(t.region.select("r_regionkey", "r_name"), "r_regionkey", levels).drop("r_regionkey")
    return Q.ordered_sample(counts, [F.col("r_name").desc()], 10)


@probe("hierarchy_counts_bitmap", ORACLE["hierarchy_counts"])
def hierarchy_counts_bitmap(spark, sf):
    """A8 by bitmaps that add up over runs: the customers in debt are one run, the others the next; the second run's bitmaps
    are merged with the first's."""
    t = Tables(spark, sf)
    geo = t.region.select("r_regionkey", "r_name").join(t.nation.select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey"), "r_regionkey", "left")
    state = None
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    for run in (in_debt, ~in_debt):
        chains = geo.join(t.customer.where(run).select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey"), "n_nationkey", "left")
        fresh = HI.distinct_bitmaps(chains, ["r_name"], {"nation": "n_nationkey", "customer": "c_custkey"})
        state = HI.merge_bitmaps(state, fresh, ["r_name"])
    counts = t.region.select("r_name").distinct().join(HI.bitmap_counts(state, ["r_name"], ["nation", "customer"]), "r_name", "left")
    counts = counts.select("r_name", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ("nation", "customer")])
    return Q.ordered_sample(counts, [F.col("r_name").desc()], 10)


@probe(
    "fk_orphans",
    """
SELECT 'lineitem.l_orderkey' AS check_name, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS null_fk,
  CAST(count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)) AS BIGINT) AS orphans
FROM lineitem
UNION ALL
SELECT 'lineitem.l_partkey', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE l_partkey IS NULL) AS BIGINT),
  CAST(count(*) FILTER (WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)) AS BIGINT)
FROM lineitem
UNION ALL
SELECT 'lineitem.l_suppkey', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE l_suppkey IS NULL) AS BIGINT),
  CAST(count(*) FILTER (WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)) AS BIGINT)
FROM lineitem
""",
)
def fk_orphans(spark, sf):
    """Q-1: three foreign keys of one table, totals and NULLs in one scan."""
    t = Tables(spark, sf)
    keys = [("l_orderkey", t.orders, "o_orderkey"), ("l_partkey", t.part, "p_partkey"), ("l_suppkey", t.supplier, "s_suppkey")]
    return Q.fk_orphans(t.lineitem, [(fk, parent, pk, f"lineitem.{fk}") for fk, parent, pk in keys]).drop("status")


@probe(
    "fk_verdict",
    """
SELECT 'orders.o_custkey' AS check_name,
  CASE WHEN count(*) FILTER (WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)) > 0 THEN 'WARN'
       WHEN count(*) = 0 THEN 'WARN' ELSE 'OK' END AS status
FROM orders
""",
)
def fk_verdict(spark, sf):
    t = Tables(spark, sf)
    return Q.fk_orphans(t.orders, [("o_custkey", t.customer, "c_custkey", "orders.o_custkey")]).select("check_name", "status")


@probe(
    "level_fk_check",
    """
WITH d AS (
  SELECT o.o_orderstatus AS level, c.c_custkey AS id_customer, n.n_nationkey AS id_nation, n.n_regionkey AS id_region
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)
SELECT 'F' AS level, 'id_customer' AS fk, CAST(count(*) FILTER (WHERE level = 'F') AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE level = 'F' AND id_customer IS NULL) AS BIGINT) AS missing_fk FROM d
UNION ALL
SELECT 'O', 'id_nation', CAST(count(*) FILTER (WHERE level = 'O') AS BIGINT),
  CAST(count(*) FILTER (WHERE level = 'O' AND id_nation IS NULL) AS BIGINT) FROM d
UNION ALL
SELECT 'P', 'id_region', CAST(count(*) FILTER (WHERE level = 'P') AS BIGINT),
  CAST(count(*) FILTER (WHERE level = 'P' AND id_region IS NULL) AS BIGINT) FROM d
""",
)
def level_fk_check(spark, sf):
    t = Tables(spark, sf)
    d = (
        t.orders.select(F.col("o_orderstatus").alias("level"), "o_custkey")
        .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("id_customer"), "c_nationkey"), "o_custkey", "left")
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").alias("id_nation"), F.col("n_regionkey").alias("id_region")), "c_nationkey", "left")
    )
    r = Q.level_fk_check(d, "level", {"F": "id_customer", "O": "id_nation", "P": "id_region"})
    return r.select("level", "fk", "n_rows", "missing_fk")


@probe(
    "key_duplicates",
    """
SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
)
def key_duplicates(spark, sf):
    return Q.key_duplicates(Tables(spark, sf).lineitem, ["l_partkey", "l_suppkey"])


@probe(
    "row_rules",
    """
WITH l AS (SELECT * FROM lineitem)
SELECT 'positive_quantity' AS rule_name, CAST(count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, false)) AS BIGINT) AS violations,
       CAST(count(*) AS BIGINT) AS total_rows FROM l
UNION ALL
SELECT 'discount_range', CAST(count(*) FILTER (WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.08, false)) AS BIGINT), CAST(count(*) AS BIGINT) FROM l
UNION ALL
SELECT 'at_least_one_measure', CAST(count(*) FILTER (WHERE NOT coalesce(l_extendedprice IS NOT NULL OR l_tax IS NOT NULL, false)) AS BIGINT), CAST(count(*) AS BIGINT) FROM l
UNION ALL
SELECT 'exactly_one_flag',
  CAST(count(*) FILTER (WHERE NOT coalesce((CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 1, false)) AS BIGINT),
  CAST(count(*) AS BIGINT) FROM l
""",
)
def row_rules(spark, sf):
    li = Tables(spark, sf).lineitem
    r_flag = F.when(F.col("l_returnflag") == "R", F.lit(1))
    o_flag = F.when(F.col("l_linestatus") == "O", F.lit(1))
    r = Q.row_rules(
        li,
        {
            "positive_quantity": F.col("l_quantity") > 0,
            "discount_range": F.col("l_discount").between(0, 0.08),
            "at_least_one_measure": Q.at_least_one("l_extendedprice", "l_tax"),
            "exactly_one_flag": Q.exactly_one(r_flag, o_flag),
        },
    )
    return r.select("rule_name", "violations", "total_rows")


# =============================================================================================== catalog (A1, Q-2..Q-8)
def _counts_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {n}" for n in TABLES)


@probe("table_counts", _counts_sql())
def table_counts(spark, sf):
    return Q.table_counts(Tables(spark, sf).all())


_REQUIRED = ["region", "nation", "customer", "orders", "lineitem"]
_OPTIONAL = ["labels", "embeddings"]


@probe(
    "health_check",
    "WITH c AS (" + _counts_sql() + ")\n"
    + f"""
SELECT table_name, row_count, table_name IN ({', '.join(repr(x) for x in _REQUIRED)}) AS required, row_count > 0 AS has_rows,
  CASE WHEN row_count > 0 THEN 'OK' WHEN table_name IN ({', '.join(repr(x) for x in _REQUIRED)}) THEN 'ERROR' ELSE 'WARN' END AS status
FROM c WHERE table_name IN ({', '.join(repr(x) for x in _REQUIRED + _OPTIONAL)})
""",
)
def health_check(spark, sf):
    return Q.health_check(Q.table_counts(Tables(spark, sf).all()), _REQUIRED, _OPTIONAL)


_MINIMUMS = {"region": 10, "nation": 50, "customer": 500, "lineitem": 1000, "supplier": 10}


@probe(
    "threshold_check",
    "WITH c AS (" + _counts_sql() + "), th AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', {v})" for k, v in _MINIMUMS.items())
    + """) v(table_name, min_rows))
SELECT th.table_name, CAST(coalesce(c.row_count, 0) AS BIGINT) AS row_count, CAST(th.min_rows AS BIGINT) AS min_rows,
  CASE WHEN coalesce(c.row_count, 0) >= th.min_rows THEN 'OK' ELSE 'WARN' END AS status
FROM th LEFT JOIN c ON th.table_name = c.table_name
""",
)
def threshold_check(spark, sf):
    return Q.threshold_check(Q.table_counts(Tables(spark, sf).all()), _MINIMUMS)


@probe(
    "run_snapshot",
    "WITH c AS (" + _counts_sql() + ")\n"
    + """
SELECT 'manual-run' AS run_id,
  concat('{', string_agg(concat('"', table_name, '":', CAST(row_count AS VARCHAR)), ',' ORDER BY table_name), '}') AS counts_json
FROM c
""",
)
def run_snapshot(spark, sf):
    """Q-8: counts snapshot of a run as JSON (the UTC stamp is left out of the probe: it changes every run)."""
    snap = Q.run_snapshot("manual-run", Q.table_counts(Tables(spark, sf).all()))
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries("counts")))
    return snap.select("run_id", F.to_json(sorted_map).alias("counts_json"))


@probe(
    "column_profile",
    """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS code, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)
SELECT 'p_name' AS column_name, round(avg(CASE WHEN regexp_matches(strip_accents(coalesce(p_name, '')), '[A-Za-z]') THEN 1.0 ELSE 0.0 END), 4) AS pct_letters,
       round(avg(CASE WHEN trim(coalesce(p_name, '')) = trim(code) THEN 1.0 ELSE 0.0 END), 4) AS pct_equal_code FROM p
UNION ALL
SELECT 'p_brand', round(avg(CASE WHEN regexp_matches(strip_accents(coalesce(p_brand, '')), '[A-Za-z]') THEN 1.0 ELSE 0.0 END), 4),
       round(avg(CASE WHEN trim(coalesce(p_brand, '')) = trim(code) THEN 1.0 ELSE 0.0 END), 4) FROM p
UNION ALL
SELECT 'p_type', round(avg(CASE WHEN regexp_matches(strip_accents(coalesce(p_type, '')), '[A-Za-z]') THEN 1.0 ELSE 0.0 END), 4),
       round(avg(CASE WHEN trim(coalesce(p_type, '')) = trim(code) THEN 1.0 ELSE 0.0 END), 4) FROM p
UNION ALL
SELECT 'p_size', round(avg(CASE WHEN regexp_matches(strip_accents(coalesce(p_size, '')), '[A-Za-z]') THEN 1.0 ELSE 0.0 END), 4),
       round(avg(CASE WHEN trim(coalesce(p_size, '')) = trim(code) THEN 1.0 ELSE 0.0 END), 4) FROM p
""",
)
def column_profile(spark, sf):
    """A13/F4 (and the basis of P10): share of values with a letter and share equal to the code, per column."""
    p = Tables(spark, sf).part.select(
        F.col("p_partkey").cast("string").alias("code"), "p_name", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size")
    )
    cols = ["p_name", "p_brand", "p_type", "p_size"]
    prof = RS.column_profile(p, cols, "code")
    stack = ", ".join(f"'{c}', `{c}__letters`, `{c}__equal_code`" for c in cols)
    long = prof.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, pct_letters, pct_equal_code)")
    return long.select("column_name", F.round("pct_letters", 4).alias("pct_letters"), F.round("pct_equal_code", 4).alias("pct_equal_code"))


# =============================================================================================== references
_REF_SQL = """
WITH raw AS (
  SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation
), t AS (
  SELECT CAST(CASE WHEN n_regionkey < 2 THEN 1000 + n_nationkey * 37 ELSE 10000 + n_nationkey * 101 END AS VARCHAR) AS code_txt,
         concat(' ', lower(n_name), ' ') AS name_txt,
         CASE WHEN n_regionkey = 0 THEN '' ELSE concat(CAST(n_regionkey AS VARCHAR), '.0') END AS parent_txt
  FROM raw
), c AS (
  SELECT DISTINCT upper(trim(code_txt)) AS code, upper(trim(name_txt)) AS name,
    upper(CASE WHEN contains(trim(parent_txt), '.') AND TRY_CAST(trim(parent_txt) AS DOUBLE) = floor(TRY_CAST(trim(parent_txt) AS DOUBLE))
               THEN CAST(CAST(TRY_CAST(trim(parent_txt) AS DOUBLE) AS DECIMAL(38,0)) AS VARCHAR) ELSE trim(parent_txt) END) AS parent_code
  FROM t
)
"""


@probe("clean_ref", _REF_SQL + "SELECT code, name, parent_code FROM c WHERE code <> '' AND name <> ''")
def clean_ref(spark, sf):
    return _clean_nation_ref(spark, sf)


def _clean_nation_ref(spark, sf) -> DataFrame:
    n = Tables(spark, sf).nation
    raw = n.unionByName(n)
    code = F.when(F.col("n_regionkey") < 2, F.lit(1000) + F.col("n_nationkey") * 37).otherwise(F.lit(10000) + F.col("n_nationkey") * 101)
    parent = F.when(F.col("n_regionkey") == 0, F.lit("")).otherwise(F.concat(F.col("n_regionkey").cast("string"), F.lit(".0")))
    t = raw.select(code.cast("string").alias("code_txt"), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("name_txt"), parent.alias("parent_txt"))
    return R.clean_ref(t, "code_txt", "name_txt", "parent_txt")


@probe(
    "fill_parent",
    _REF_SQL
    + """
SELECT code, name,
  CASE WHEN trim(parent_code) = '' AND length(rtrim(code)) > 3 THEN substring(rtrim(code), 1, length(rtrim(code)) - 3)
       ELSE parent_code END AS parent_code,
  CASE WHEN trim(parent_code) = '' THEN substring(code, 1, 2) ELSE parent_code END AS parent_code_compat
FROM c WHERE code <> '' AND name <> ''
""",
)
def fill_parent(spark, sf):
    """Blank parent codes repaired from the row's own code: all but the last 3 characters (length
    rule), and the 2-character prefix of the compatibility mode side by side."""
    c = _clean_nation_ref(spark, sf).withColumn("parent_code_compat", F.col("parent_code"))
    c = R.fill_parent_code(c, "code", "parent_code", drop_last=3)
    c = R.fill_parent_code(c, "code", "parent_code_compat", prefix_len=2)
    return c.select("code", "name", "parent_code", "parent_code_compat")


# =============================================================================================== paths
_URL_CODES = ["FR", "EN", "DE", "ES"]


def _rel_path_sql() -> str:
    return "regexp_extract(url, '^[a-zA-Z]+://([^?#]*)', 1)"


@probe(
    "classify_path",
    f"""
WITH u AS (SELECT page_id, {_rel_path_sql()} AS p, url FROM pages),
parts AS (
  SELECT page_id, url, p,
    list_filter(list_transform(string_split(replace(replace(p, '\\', '/'), '//', '/'), '/'),
        lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '') AS parts,
    list_filter(list_transform(string_split(lower(p), '/'), lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '') AS lparts
  FROM u
), f AS (
  SELECT page_id, url, p, parts,
    CASE WHEN len(parts) >= 2 AND upper(regexp_replace(parts[len(parts) - 1], '^{WS}+|{WS}+$', '', 'g')) NOT IN ('FR','EN','DE','ES','NATIONAL')
              AND regexp_matches(upper(regexp_replace(parts[len(parts) - 1], '^{WS}+|{WS}+$', '', 'g')), '\\p{{L}}')
         THEN upper(regexp_replace(parts[len(parts) - 1], '^{WS}+|{WS}+$', '', 'g')) END AS city,
    list_filter(list_transform(parts, lambda x: upper(x)), lambda x: x IN ('FR','EN','DE','ES'))[1] AS code,
    (CASE WHEN len(lparts) >= 2 THEN upper(lparts[len(lparts) - 1]) ELSE '' END) = 'NATIONAL'
      OR starts_with(coalesce(lparts[len(lparts)], ''), 'maroc_t') OR starts_with(coalesce(lparts[len(lparts)], ''), 'national_t') AS nat
  FROM parts
)
SELECT page_id, p AS rel_path,
  CASE WHEN city IS NOT NULL THEN 'VILLE' WHEN nat THEN 'NATIONAL' ELSE 'REGION' END AS niveau,
  CASE WHEN city IS NOT NULL THEN NULL WHEN nat THEN NULL ELSE code END AS region,
  city AS agglomeration,
  CASE WHEN (contains(lower(url), 'referentiels/') OR contains(lower(url), 'referentiels\\'))
        AND (contains(lower(url), 'region.csv') OR contains(lower(url), 'commune.csv') OR contains(lower(url), 'province.csv'))
       THEN 'referentiels' ELSE 'prix_indices' END AS dataset,
  CASE WHEN contains(lower(url), '_t1') OR contains(lower(url), 't1.') THEN 'T1'
       WHEN contains(lower(url), '_t3') OR contains(lower(url), 't3.') THEN 'T3' ELSE 'UNKNOWN' END AS file_type
FROM f
""",
)
def classify_path(spark, sf):
    """P4-P8/F17 over the path part of every page URL, with the language folders playing the region codes."""
    pg = Tables(spark, sf).pages.select("page_id", "url", F.regexp_extract("url", r"^[a-zA-Z]+://([^?#]*)", 1).alias("p"))
    lv = P.classify_level("p", None, _URL_CODES)
    return pg.select(
        "page_id",
        F.col("p").alias("rel_path"),
        lv.niveau.alias("niveau"),
        lv.region.alias("region"),
        lv.agglomeration.alias("agglomeration"),
        P.dataset_class("url").alias("dataset"),
        P.file_type("url").alias("file_type"),
    )


# =============================================================================================== manifests and runs
@probe(
    "manifest",
    "WITH f AS (" + _CSV_SQL + """)
SELECT 'manual_1' AS run_id, c.c_mktsegment AS archive, concat('x/', c.c_custkey, '_T1.csv') AS rel_path, 'prix_indices' AS dataset,
       CAST(1 AS INTEGER) AS row_count, md5(f.content) AS md5_hash
FROM f JOIN customer c USING (c_custkey)
""",
)
def manifest(spark, sf):
    """The manifest of the customers' CSV files, each parsed once (key, dataset, data rows, MD5 of the bytes)."""
    return FS.manifest(FS.to_rows(FS.sniff(_customer_files(spark, sf))), "Manual:1").drop("load_ts")


@probe(
    "latest_run",
    """
WITH runs AS (
  SELECT lower(replace(concat('Run:', source), ':', '_')) AS run_id, max(doc_id) AS load_ts FROM documents GROUP BY source
)
SELECT run_id FROM runs ORDER BY load_ts DESC, run_id DESC LIMIT 1
""",
)
def latest_run(spark, sf):
    """Run of the newest load (greatest load stamp, ties by run id) with ``max_by`` over a struct."""
    d = Tables(spark, sf).documents
    runs = d.groupBy("source").agg(F.max("doc_id").alias("load_ts")).select(
        X.normalize_run_id(F.concat(F.lit("Run:"), F.col("source"))).alias("run_id"), "load_ts"
    )
    return FS.latest_run(runs)


# =============================================================================================== ordered samples
@probe(
    "fact_sample",
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, p.p_name, s.s_name
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
ORDER BY l.l_extendedprice DESC, l.l_orderkey, l.l_linenumber LIMIT 10
""",
)
def fact_sample(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    top = Q.sample_with(li, order, [(t.part, "p_partkey", "l_partkey", ["p_name"]), (t.supplier, "s_suppkey", "l_suppkey", ["s_name"])])
    return top.select("l_orderkey", "l_linenumber", "l_extendedprice", "p_name", "s_name")


# =============================================================================================== weights
@probe(
    "unpivot_years",
    """
SELECT upper(trim(p.p_brand)) AS variete, CAST(year(l.l_shipdate) AS INTEGER) AS annee, round(sum(l.l_quantity), 4) AS value
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2
""",
)
def unpivot_years(spark, sf):
    """A wide table with one column per year (pivot) is turned back into (variete, annee, value)
    for every column whose name matches the year pattern."""
    wide = _yearly_pivot(spark, sf)
    return W.unpivot_years(wide, ["variete"]).select("variete", "annee", F.round("value", 4).alias("value"))


def _yearly_pivot(spark, sf) -> DataFrame:
    """Wide table: one row per variety (brand), one column per shipping year holding the quantity. The year
    list is computed by Spark (a distinct over the data), so the pivot grows with the data's years."""
    t = Tables(spark, sf)
    base = t.lineitem.select("l_partkey", "l_quantity", F.year("l_shipdate").cast("string").alias("annee")).join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), X.upper_trim("p_brand").alias("variete")), "l_partkey"
    )
    return base.groupBy("variete").pivot("annee").agg(F.sum("l_quantity"))


@probe(
    "weights_long",
    """
WITH base AS (
  SELECT upper(trim(p.p_brand)) AS variete, CAST(year(l.l_shipdate) AS INTEGER) AS annee, r.r_name AS region, l.l_quantity AS q
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
), nat AS (
  SELECT 'NATIONAL' AS niveau, 'MAROC' AS lieu, variete, annee, sum(q) AS v FROM base GROUP BY variete, annee
), reg AS (
  SELECT 'REGION' AS niveau, region AS lieu, variete, annee, sum(q) AS v FROM base GROUP BY region, variete, annee
), u AS (SELECT * FROM nat UNION ALL SELECT * FROM reg)
SELECT niveau, lieu, variete, annee, round(v / sum(v) OVER (PARTITION BY niveau, lieu, annee), 6) AS poids FROM u
""",
)
def weights_long(spark, sf):
    """Weights in long form at two levels (national, region) as the share of each variety in its place
    and year."""
    t = Tables(spark, sf)
    geo = (
        t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        .join(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
        .join(t.region.select("r_regionkey", F.col("r_name").alias("region")), "r_regionkey")
    )
    base = (
        t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", F.year("l_shipdate").cast("int").alias("annee"))
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), X.upper_trim("p_brand").alias("variete")), "l_partkey")
        .join(geo, "l_suppkey")
    )
    # a verbatim weight table, all text: place columns of both levels (a national row names its place as a city)
    weight = F.sum("l_quantity").cast("decimal(18,2)").cast("string").alias("Poids")
    nat = base.groupBy("variete", "annee").agg(weight).select(F.lit("MAROC").alias("Ville"), F.lit("").alias("Région"), "*")
    reg = base.groupBy("region", "variete", "annee").agg(weight).select(F.lit(" ").alias("Ville"), F.col("region").alias("Région"), "variete", "annee", "Poids")
    verbatim = nat.unionByName(reg).withColumnRenamed("variete", "Variété").withColumn("Année", F.concat(F.col("annee"), F.lit(" "))).drop("annee")
    out = W.shares(W.stage_weight_table(verbatim), ["niveau", "lieu", "annee"], "poids", "share")
    level = F.when(F.col("niveau") == K.LEVEL_CITY, F.lit("NATIONAL")).otherwise(F.col("niveau"))
    return out.select(level.alias("niveau"), "lieu", "variete", "annee", F.round(F.col("share").cast("double"), 6).alias("poids"))


def _register_flagship():
    from pricelake.plans import index_facts as IF

    probe("index_facts", IF.ORACLE_SQL)(IF.index_facts)
    probe("index_facts_compat", IF.ORACLE_SQL_COMPAT)(IF.index_facts_compat)


_register_flagship()


# =============================================================================================== weight fact
@probe(
    "weight_rollup",
    """
WITH RECURSIVE e AS (
  SELECT 'S' || s_suppkey AS child, 'N' || s_nationkey AS parent FROM supplier
  UNION SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION SELECT 'R' || r_regionkey, 'WORLD' FROM region
), up AS (
  SELECT child AS node, child AS ancestor FROM e UNION SELECT parent, parent FROM e
  UNION SELECT up.node, e.parent FROM up JOIN e ON up.ancestor = e.child
), v AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, 'S' || l_suppkey AS node, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2
)
SELECT v.annee, coalesce(up.ancestor, v.node) AS node, round(sum(v.q), 2) AS value, count(*) AS n_nodes
FROM v LEFT JOIN up ON v.node = up.node GROUP BY 1, 2
""",
)
def weight_rollup(spark, sf):
    """Yearly quantities of suppliers summed to nation, region and the whole, by a recursive closure."""
    t = Tables(spark, sf)

    def node(letter: str, key: str) -> Column:
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    edges = t.supplier.select(node("S", "s_suppkey").alias("child"), node("N", "s_nationkey").alias("parent"))
    edges = edges.unionByName(t.nation.select(node("N", "n_nationkey").alias("child"), node("R", "n_regionkey").alias("parent")))
    edges = edges.unionByName(t.region.select(node("R", "r_regionkey").alias("child"), F.lit("WORLD").alias("parent")))
    values = t.lineitem.select(F.year("l_shipdate").alias("annee"), node("S", "l_suppkey").alias("place"), "l_quantity")
    out = HI.rollup(values, "place", "l_quantity", edges, ["annee"])
    return out.select("annee", "node", F.round("value", 2).alias("value"), "n_nodes")


@probe(
    "names_per_region",
    """
SELECT 'region' AS level, r.r_name AS name, string_agg(n.n_name, ', ' ORDER BY n.n_name) AS names, count(*) AS n
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name
UNION ALL
SELECT 'nation', n.n_name, string_agg(s.s_name, ', ' ORDER BY s.s_name), count(*)
FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name
UNION ALL
SELECT 'brand', p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name), count(DISTINCT p_name) FROM part GROUP BY p_brand
UNION ALL
SELECT 'type', p_type, string_agg(p_brand, ', ' ORDER BY p_brand), count(p_brand) FROM part GROUP BY p_type
""",
)
def names_per_region(spark, sf):
    """The names below each region, nation, brand (each once) and type (each as often as it comes), in order."""
    t = Tables(spark, sf)
    nations = t.nation.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("name")), "n_regionkey")
    suppliers = t.supplier.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("name")), "s_nationkey")
    parts = {
        "region": HI.ordered_list(nations, ["name"], "n_name"),
        "nation": HI.ordered_list(suppliers, ["name"], "s_name"),
        "brand": HI.ordered_list(t.part.select(F.col("p_brand").alias("name"), "p_name"), ["name"], "p_name", distinct=True),
        "type": HI.ordered_list(t.part.select(F.col("p_type").alias("name"), "p_brand"), ["name"], "p_brand"),
    }
    return functools.reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("level"), "name", "names", "n") for k, df in parts.items()])


@probe(
    "variant_fields",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.absent') AS absent
FROM events
""",
)
def variant_fields(spark, sf):
    """The row objects of all events as VARIANT, their fields by type."""
    e = Tables(spark, sf).events.select("event_id", FS.row_variant("props").alias("v"))
    number, = FS.variant_fields("v", {"k": "bigint"})
    text, absent = FS.variant_fields("v", {"k": "string", "absent": "string"})
    return e.select("event_id", number, text.alias("k_text"), absent)


@probe(
    "weight_fact",
    """
WITH var AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_name)) AS name FROM part WHERE trim(p_name) <> '')
), base AS (
  SELECT n.n_name AS city, r.r_name AS region, p.p_name AS variete, CAST(year(o.o_orderdate) AS INTEGER) AS annee, l.l_discount AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
), staged AS (
  SELECT 'VILLE' AS niveau, city AS lieu, variete, annee, max(d) AS poids FROM base GROUP BY city, variete, annee
  UNION ALL
  SELECT 'REGION' AS niveau, region AS lieu, variete, annee, max(d) AS poids FROM base GROUP BY region, variete, annee
), looked AS (
  SELECT s.niveau, s.annee, s.poids, v.id AS id_reference, upper(trim(s.lieu)) AS lieu_key
  FROM staged s LEFT JOIN var v ON upper(trim(s.variete)) = v.name
), placed AS (
  SELECT l.annee, l.poids, l.niveau, l.id_reference, CAST(d.n_nationkey AS BIGINT) AS id_province_prefecture,
         CAST(d.n_regionkey AS BIGINT) AS id_region, l.lieu_key
  FROM looked l LEFT JOIN nation d ON instr(upper(d.n_name), upper(l.lieu_key)) > 0 WHERE l.niveau = 'VILLE'
  UNION ALL
  SELECT l.annee, l.poids, l.niveau, l.id_reference, CAST(NULL AS BIGINT), CAST(r.r_regionkey AS BIGINT), l.lieu_key
  FROM looked l LEFT JOIN region r ON upper(trim(r.r_name)) = l.lieu_key WHERE l.niveau <> 'VILLE'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY annee, niveau, id_reference, id_province_prefecture, id_region
                               ORDER BY coalesce(poids, -1) DESC, lieu_key) AS rn
  FROM placed
)
SELECT annee, CAST(poids AS DOUBLE) AS poids, niveau, id_reference, id_province_prefecture,
       CAST(NULL AS BIGINT) AS id_commune, id_region
FROM ranked WHERE rn = 1
""",
)
def weight_fact(spark, sf):
    """R3 on the driver tables: city weights (customer nation as the city) and region weights (the greatest
    discount of a variety in a place and year stands in for its weight), variety by exact name, city matched to
    nations by substring, region by name, one row per natural key, upserted into an empty fact."""
    t = Tables(spark, sf, spread=True)
    base = (
        t.lineitem.select("l_orderkey", "l_partkey", "l_discount")
        .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey")
        .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"), "n_regionkey"), "c_nationkey")
        .join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")), "n_regionkey")
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("variete")), "l_partkey")
        .select("city", "region", "variete", F.year("o_orderdate").cast("int").alias("annee"), "l_discount")
    )
    city = base.groupBy("city", "variete", "annee").agg(F.max("l_discount").alias("poids")).select(
        F.lit("VILLE").alias("niveau"), F.col("city").alias("lieu"), "variete", "annee", "poids"
    )
    reg = base.groupBy("region", "variete", "annee").agg(F.max("l_discount").alias("poids")).select(
        F.lit("REGION").alias("niveau"), F.col("region").alias("lieu"), "variete", "annee", "poids"
    )
    varieties = D.assign_ids(D.distinct_keys(t.part, "p_name", "name"), "name", "id")
    provinces = t.nation.select(F.col("n_name").alias("nom"), F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("id_parent"))
    regions = t.region.select(F.col("r_name").alias("nom"), F.col("r_regionkey").alias("id"))
    fact = W.weight_fact(city.unionByName(reg), varieties, provinces, regions)
    return fact.withColumn("poids", F.col("poids").cast("double"))


# =============================================================================================== Q20: rows that never reach the fact
@probe(
    "dropped_rows",
    """
WITH base AS (
  SELECT CASE WHEN n.n_regionkey = 0 THEN replace(n.n_name, '_', '') ELSE n.n_name END AS city,
         CASE l.l_returnflag WHEN 'R' THEN 'T1' WHEN 'A' THEN 'T3' ELSE 'UNKNOWN' END AS type_indice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
), excl AS (SELECT upper(trim(n_name)) AS agglomeration_raw FROM nation WHERE n_regionkey = 4),
tagged AS (
  SELECT type_indice,
    CASE WHEN upper(trim(city)) IS NULL THEN 'no city'
         WHEN upper(trim(city)) IN ('AL', '') THEN 'excluded literal'
         WHEN upper(trim(city)) IN (SELECT agglomeration_raw FROM excl) THEN 'exclusion table' END AS reason
  FROM base
)
SELECT type_indice, reason, CAST(count(*) AS BIGINT) AS n_rows FROM tagged WHERE reason IS NOT NULL GROUP BY 1, 2
""",
)
def dropped_rows(spark, sf):
    """Q20 on the flagship's staging stand-in: rows that the exclusion step removes before matching, per type and
    reason (one aggregate; the exclusion table is the nations of region 4, as in ``index_facts``)."""
    from pricelake.plans import index_facts as IF

    staging, exclusions = IF._staging(spark, sf), IF._exclusions(spark, sf)
    city = X.upper_trim("agglomeration")
    excl = exclusions.select(F.col("agglomeration_raw").alias("__x"), F.lit(True).alias("__excluded"))
    tagged = staging.select(X.upper_trim("file_type").alias("type_indice"), city.alias("__c")).join(
        excl, F.col("__c") == F.col("__x"), "left"
    )
    reason = (
        F.when(F.col("__c").isNull(), F.lit("no city"))
        .when(F.col("__c").isin("AL", ""), F.lit("excluded literal"))
        .when(F.col("__excluded"), F.lit("exclusion table"))
    )
    return (
        tagged.select("type_indice", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("type_indice", "reason")
        .agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
    )
