"""Text, time and date expressions, on whole tables and whole texts."""

import datetime

from pyspark.sql import functions as F

from courtledger.catalog.base import date, registry, table
from courtledger.functions import temporal, text
from courtledger.sources.tables import date_series as series_op

QUERIES, SQL, query = registry()


@query(r"""
    SELECT 'customer' AS source, c_custkey AS id, lower(regexp_replace(c_name, '[ \-.'']', '', 'g')) AS name_key FROM customer
    UNION ALL SELECT 'part', p_partkey, lower(regexp_replace(p_name, '[ \-.'']', '', 'g')) FROM part""")
def normalize_name(spark, sf):
    name = lambda t, key, c: table(spark, sf, t).select(F.lit(t).alias("source"), F.col(key).alias("id"),
                                                        text.normalize_name(c).alias("name_key"))
    return name("customer", "c_custkey", "c_name").unionByName(name("part", "p_partkey", "p_name"))


@query(r"""
    SELECT doc_id, length(k) AS n_kept, md5(k) AS digest
    FROM (SELECT doc_id, lower(regexp_replace(text, '[ \-.'']', '', 'g')) AS k FROM documents)""")
def normalize_text(spark, sf):
    """The same rule on whole documents."""
    key = text.normalize_name("text")
    return table(spark, sf, "documents").select("doc_id", F.length(key).cast("long").alias("n_kept"), F.md5(key).alias("digest"))


# What a name is to the name operators: parts with a suffix word now and then, and whole documents.
_NAMES = r"""
    SELECT 'part' AS source, p_partkey AS id, p_name || CASE WHEN p_size < 10 THEN ' ' || p_type || ' Jr.' WHEN p_size < 20 THEN ' III'
        WHEN p_size < 30 THEN ' ' || p_type || ' ' || p_brand || ' a b c' ELSE '' END AS name FROM part
    UNION ALL SELECT 'document', doc_id, text FROM documents"""


def _names(spark, sf):
    size = F.col("p_size")
    tail = (F.when(size < 10, F.concat(F.lit(" "), F.col("p_type"), F.lit(" Jr.")))
             .when(size < 20, F.lit(" III"))
             .when(size < 30, F.concat(F.lit(" "), F.col("p_type"), F.lit(" "), F.col("p_brand"), F.lit(" a b c"))).otherwise(F.lit("")))
    parts = table(spark, sf, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                            F.concat(F.col("p_name"), tail).alias("name"))
    return parts.unionByName(table(spark, sf, "documents").select(F.lit("document").alias("source"), F.col("doc_id").alias("id"),
                                                                  F.col("text").alias("name")))


# White space of any kind.
_WHITE = r"[\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORDS = rf"""
    names AS ({_NAMES}),
    split AS (SELECT *, string_split(trim(regexp_replace(name, '{_WHITE}+', ' ', 'g')), ' ') AS w,
                     length(name) - length(replace(name, ' ', '')) AS spaces FROM names),
    flagged AS (SELECT *, lower(w[-1]) IN ('jr.', 'sr.', 'ii', 'iii', 'iv', 'v') AS suffix FROM split)"""


@query(f"""
    WITH {_WORDS} SELECT source, id, array_to_string(CASE WHEN spaces <= 4 AND NOT suffix THEN w[-2:] ELSE w[-3:] END, ' ') AS tail
    FROM flagged""")
def name_tail(spark, sf):
    return _names(spark, sf).select("source", "id", text.name_tail("name").alias("tail"))


@query(f"""
    WITH {_WORDS} SELECT source, id, CASE WHEN spaces <= 2 AND NOT suffix
        THEN w[1] || ' ' || substr(w[2], 1, greatest(length(w[2]) - 2, 0))
        ELSE w[1] || ' ' || w[2] || ' ' || substr(w[3], 1, greatest(length(w[3]) - 2, 0)) END AS name FROM flagged""")
def undouble_name(spark, sf):
    return _names(spark, sf).select("source", "id", text.undouble_name("name").alias("name"))


# Minute texts in all the forms a sheet has, from the numbers of a line.
_MINUTE = """CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 'DNP - Injury/Illness'
        WHEN l_linenumber = 1 THEN 'N''a pas joué' WHEN l_linenumber = 2 AND l_linestatus = 'F' THEN NULL
        WHEN l_linenumber = 2 THEN '0:00' WHEN l_linenumber = 3 AND l_linestatus = 'F' THEN '0.000000:00'
        WHEN l_returnflag = 'R' THEN m || '.000000:' || s WHEN l_returnflag = 'A' THEN m || ':' || s
        WHEN l_linenumber = 7 THEN 'late' ELSE m || '.' || s END"""
_LINES = f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(m AS INTEGER) AS m, CAST(s AS INTEGER) AS s, {_MINUTE} AS minute FROM (
        SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS m, lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') AS s FROM lineitem)"""


def _minutes(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns({
        "m": F.col("l_quantity").cast("int").cast("string"), "s": F.lpad((F.col("l_suppkey") % 60).cast("string"), 2, "0")})
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_MINUTE.replace("''", "\\'")).alias("minute"))


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN minute = '0:00' OR minute = '0.000000:00' THEN 0
           WHEN minute = 'late' OR starts_with(minute, 'DNP') OR starts_with(minute, 'N''a') THEN NULL
           WHEN minute IS NOT NULL THEN m * 60 + s END AS seconds,
           CASE WHEN minute = '0:00' OR minute = '0.000000:00' THEN '00:00:00'
           WHEN minute IS NULL OR minute = 'late' OR starts_with(minute, 'DNP') OR starts_with(minute, 'N''a') THEN ''
           ELSE printf('00:%02d:%02d', m, s) END AS clock FROM ({_LINES})""")
def parse_minutes(spark, sf):
    rows = _minutes(spark, sf).withColumn("played", temporal.parse_minutes("minute"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", temporal.interval_seconds("played").cast("int").alias("seconds"),
                       temporal.format_duration("played").alias("clock"))


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN minute IS NULL THEN false WHEN minute = 'late' THEN NULL
           WHEN starts_with(minute, 'DNP') OR starts_with(minute, 'N''a') THEN true
           ELSE minute IN ('0:00', '0.000000:00') END AS dnp,
           coalesce(contains(minute, 'Injury/Illness'), false) AS blesse FROM ({_LINES})""")
def is_dnp(spark, sf):
    return _minutes(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", temporal.is_dnp("minute").alias("dnp"),
                                      temporal.is_injured("minute").alias("blesse"))


@query("""
    SELECT o_orderkey, CASE WHEN make_date(2000, month(o_orderdate), day(o_orderdate)) <= DATE '2000-06-15'
        THEN make_date(2000, month(o_orderdate), day(o_orderdate))
        ELSE make_date(1999, month(o_orderdate), day(o_orderdate)) END AS day FROM orders""")
def infer_year(spark, sf):
    return table(spark, sf, "orders").withColumn("updated", F.date_format("o_orderdate", "E, MMM d")).select(
        "o_orderkey", temporal.infer_year("updated", datetime.date(2000, 6, 15)).alias("day"))


@query("""
    SELECT CAST(d AS DATE) AS day, strftime(d, '%Y-%m-%d') AS day_text FROM (
        SELECT unnest(generate_series(min(CAST(ts AS DATE)), min(CAST(ts AS DATE)) + CAST(count(DISTINCT user_id) AS INTEGER) - 1,
                                      INTERVAL 1 DAY)) AS d FROM events)""")
def date_series(spark, sf):
    """As many days as there are users, from the first day of events."""
    first = table(spark, sf, "events").agg(F.min(date("ts")).alias("d"), F.countDistinct("user_id").alias("n")).first()
    return series_op(spark, first["d"], first["n"])


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS before, CAST(o_orderdate AS DATE) + 1 AS after,
           strftime(o_orderdate, '%Y-%m-%d') AS iso, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS days,
           CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed,
           make_date(CASE WHEN o_orderstatus = 'P' THEN 2021 ELSE 2021 - CAST(o_custkey % 20 AS INTEGER) END, 10, 1) AS entered FROM orders""")
def date_scalars(spark, sf):
    experience = F.when(F.col("o_orderstatus") == "P", "Rookie").otherwise(
        F.concat((F.col("o_custkey") % 20).cast("string"), F.lit(" Years")))
    orders = table(spark, sf, "orders").select("o_orderkey", date("o_orderdate").alias("day"), experience.alias("experience"))
    return orders.select("o_orderkey", temporal.day_before("day").alias("before"), temporal.day_after("day").alias("after"),
                         temporal.iso_date("day").alias("iso"), temporal.days_to_import("day", datetime.date(2002, 1, 1)).alias("days"),
                         F.to_date(temporal.iso_date("day")).alias("parsed"), temporal.entry_date("experience", 2021).alias("entered"))


@query("""
    SELECT p_partkey, 'https://scores.example.com/games?date=' || strftime(DATE '2020-01-01' + p_size, '%Y-%m-%d') AS url,
           CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 3 THEN lpad(CAST(p_partkey AS VARCHAR), 3, '0') ELSE CAST(p_partkey AS VARCHAR) END AS padded,
           substr(p_brand, 3, 4) AS part_of, upper(p_name) AS up, lower(p_type) AS low,
           array_to_string(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')[2:3], ' ') AS middle,
           length(p_name) - length(replace(p_name, 'i', '')) AS n_i FROM part""")
def text_scalars(spark, sf):
    words = F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")
    return table(spark, sf, "part").withColumn("day", F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("p_size"))).select(
        "p_partkey", text.dated_url("https://scores.example.com/games", "day").alias("url"),
        text.pad_left("p_partkey", 3).alias("padded"), F.substring("p_brand", 3, 4).alias("part_of"),
        F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), text.join_slice(words, F.lit(1), 2).alias("middle"),
        text.count_char("p_name", "i").cast("long").alias("n_i"))


@query("""
    WITH built AS (SELECT p_partkey, p_size, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 1 + p_size / 100.0 END AS h FROM part)
    SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN CAST(printf('%d.%02d', 1, CAST(p_size AS INTEGER)) AS DOUBLE) END AS taille,
           CASE WHEN p_size % 5 <> 0 THEN CAST(60 + p_size AS DOUBLE) END AS poids,
           CASE p_size % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'G-F' WHEN 2 THEN 'NC-C' ELSE 'NC' END AS position FROM built""")
def profile_scalars(spark, sf):
    size = F.col("p_size")
    text_of = {0: "Club | #1 | Guard", 1: "Club | #1 | Guard-Forward", 2: "Coach-Center", 3: "Club | Staff"}
    position = F.when(size % 4 == 0, text_of[0]).when(size % 4 == 1, text_of[1]).when(size % 4 == 2, text_of[2]).otherwise(text_of[3])
    built = table(spark, sf, "part").select(
        "p_partkey", F.when(size % 7 == 0, F.lit("unknown")).otherwise(F.format_string("6'2\" (1.%02dm)", size)).alias("height"),
        F.when(size % 5 == 0, F.lit("200lb")).otherwise(F.format_string("200lb (%dkg)", size + 60)).alias("weight"),
        position.alias("position_text"))
    return built.select("p_partkey", text.height_m("height").alias("taille"), text.weight_kg("weight").alias("poids"),
                        text.position_code("position_text").alias("position"))
