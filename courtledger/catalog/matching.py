"""Filters, joins, exclusions, keys."""

from pyspark.sql import functions as F

from courtledger.catalog.base import date, registry, table
from courtledger.functions.text import contains_any, normalize_name
from courtledger.operators.keys import add_members as add_members_op, allocate_ids as allocate_ids_op
from courtledger.operators.matching import (active_or_injured as active_op, all_duplicates as all_duplicates_op,
                                            drop_members, exclude_marginal, invert, keep_members, latest_per_key,
                                            lookup, mark_members, resolve_key as resolve_key_op, unknown_members as unknown_op,
                                            update_from as update_from_op)
from courtledger.operators.skew import own_shuffle
from courtledger.plans.injuries import unseen_with_history as unseen_with_op, unseen_without_history as unseen_without_op
from courtledger.sources.tables import max_of

QUERIES, SQL, query = registry()


@query("""
    WITH unseen AS (
        SELECT c.c_name, lower(n.n_name) AS kind FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)),
    played AS (
        SELECT c.c_name, o.o_custkey, CAST(o.o_orderdate AS DATE) AS day
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
    latest AS (
        SELECT DISTINCT ON (o_custkey) o_custkey, kind, day + 1 AS start_day
        FROM unseen u JOIN played p ON u.c_name = p.c_name ORDER BY o_custkey, day DESC, kind DESC)
    SELECT l.o_custkey, l.start_day, n.n_nationkey FROM latest l JOIN nation n ON l.kind = lower(n.n_name)
    WHERE NOT EXISTS (
        SELECT 1 FROM orders o JOIN lineitem i ON o.o_orderkey = i.l_orderkey
        WHERE o.o_custkey = l.o_custkey AND CAST(i.l_shipdate AS DATE) = l.start_day)""")
def unseen_with_history(spark, sf):
    """Customers without events: a spell from the day after their last order, unless a shipment of
    theirs falls on that day."""
    customer, orders, nation = (table(spark, sf, t) for t in ("customer", "orders", "nation"))
    events, lineitem = table(spark, sf, "events"), table(spark, sf, "lineitem")
    named = customer.select("c_custkey", "c_name", "c_nationkey")
    listed = named.join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
                  .select("c_name", F.lower("n_name").alias("kind"))
    users = events.select(F.col("user_id").alias("c_custkey"))
    seen = keep_members(named, users, ["c_custkey"], hot=False).select("c_name")
    last = orders.groupBy("o_custkey").agg(F.max(date("o_orderdate")).alias("day"))
    facts = last.join(named, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_custkey", "day")
    def shipped(candidates):
        """Shipping days of the candidates alone: orders are reduced before the line items are joined."""
        own = orders.select("o_orderkey", "o_custkey").join(own_shuffle(candidates), "o_custkey", "left_semi")
        return own.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", date("l_shipdate").alias("start_day"))
    return unseen_with_op(listed, seen, facts, nation, shipped, name="c_name", key="o_custkey", day="day",
                          kind="kind", kind_name="n_name", kind_id="n_nationkey", start="start_day")


@query("""
    WITH listed AS (
        SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS c_name,
               CAST(ts AS DATE) AS day, event_type FROM events)
    SELECT c.c_custkey, l.day, l.event_type FROM listed l JOIN customer c ON l.c_name = c.c_name
    WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN customer k ON o.o_custkey = k.c_custkey
                      WHERE k.c_name = l.c_name AND o.o_orderstatus = 'O' AND o.o_totalprice > 400000)""")
def unseen_without_history(spark, sf):
    """Event entries of customers without a large open order."""
    customer, orders, events = (table(spark, sf, t) for t in ("customer", "orders", "events"))
    listed = events.select(F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("c_name"),
                           date("ts").alias("day"), "event_type")
    busy = orders.filter("o_orderstatus = 'O' AND o_totalprice > 400000").select("o_custkey").distinct() \
                 .join(customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name")
    return unseen_without_op(listed, busy, customer, name="c_name", key="c_custkey", columns=["day", "event_type"])


@query("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice
    FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""")
def latest_order(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", date("o_orderdate").alias("day"), "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], ["day", "o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)""")
def unknown_members(spark, sf):
    orders = table(spark, sf, "orders")
    dim = table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"))
    return unknown_op(orders, dim, ["o_custkey"], ["o_orderkey", "o_custkey"])


@query("""
    WITH dim AS (SELECT DISTINCT user_id AS member_id, 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS name FROM events),
    fresh AS (SELECT DISTINCT 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS name FROM orders
              WHERE o_custkey NOT IN (SELECT user_id FROM events))
    SELECT member_id, name FROM dim
    UNION ALL
    SELECT (SELECT max(member_id) FROM dim) + row_number() OVER (ORDER BY name), name FROM fresh""")
def add_members(spark, sf):
    name = lambda c: F.concat(F.lit("customer#"), F.lpad(F.col(c).cast("string"), 9, "0")).alias("name")
    dim = table(spark, sf, "events").select(F.col("user_id").alias("member_id"), name("user_id")).distinct()
    facts = table(spark, sf, "orders").select(name("o_custkey"))
    return add_members_op(dim, facts, ["name"], ["name"], "member_id", max_of(dim, "member_id", 0))


@query("""
    SELECT o_orderkey, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_id
    FROM orders""")
def allocate_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return allocate_ids_op(orders, "new_id", ["o_orderdate", "o_orderkey"], max_of(orders, "o_orderkey", 0)) \
        .select("o_orderkey", "new_id")


_BIG = "o_totalprice > 450000"


@query(f"""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE NOT (CAST(o_orderdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE {_BIG})
               AND o_custkey IN (SELECT o_custkey FROM orders WHERE {_BIG}))""")
def marginal_exclude(spark, sf):
    orders = table(spark, sf, "orders")
    picks = orders.select("o_orderkey", "o_custkey", date("o_orderdate").alias("day"))
    known = orders.filter(_BIG).select("o_custkey", date("o_orderdate").alias("day"))
    return exclude_marginal(picks, known, {"day": "day", "o_custkey": "o_custkey"})


@query("""
    SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events e
    WHERE event_type <> 'error' AND NOT EXISTS (
        SELECT 1 FROM events x WHERE x.event_type = 'error' AND x.user_id = e.user_id
        AND CAST(x.ts AS DATE) = CAST(e.ts AS DATE))""")
def pair_exclude(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", date("ts").alias("day"), "event_type")
    errors = events.filter("event_type = 'error'")
    return drop_members(events.filter("event_type <> 'error'"), errors, ["user_id", "day"]) \
        .select("event_id", "user_id", "day")


@query("""
    SELECT doc_id, lang FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1""")
def all_duplicates(spark, sf):
    return all_duplicates_op(table(spark, sf, "documents").select("doc_id", "lang", "text"), ["text"]).select("doc_id", "lang")


@query(r"""
    WITH named AS (SELECT p_partkey, lower(regexp_replace(p_name, '[ \-.'']', '', 'g')) AS name_key, p_brand, p_type FROM part)
    SELECT p_partkey, name_key, p_brand FROM (
        SELECT *, count(*) OVER (PARTITION BY name_key, p_brand, p_type) AS n FROM named) WHERE n > 1""")
def duplicate_names(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", normalize_name("p_name").alias("name_key"), "p_brand", "p_type")
    return all_duplicates_op(named, ["name_key", "p_brand", "p_type"]).select("p_partkey", "name_key", "p_brand")


@query("""
    SELECT o.o_orderkey, o.o_custkey, CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND c.c_custkey IS NOT NULL
           THEN c.c_mktsegment ELSE o.o_orderpriority END AS o_orderpriority
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0""")
def backfill_type(spark, sf):
    """Orders with the placeholder priority take the segment of a customer in credit."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    source = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderpriority"))
    waiting = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    updated = update_from_op(orders.filter(waiting), source, ["o_custkey"], ["o_orderpriority"], ["o_orderpriority"])
    return orders.filter(~waiting).unionByName(updated)


@query("""
    WITH best AS (SELECT DISTINCT ON (l_orderkey) l_orderkey, l_returnflag FROM lineitem
                  ORDER BY l_orderkey, l_shipdate DESC, l_extendedprice DESC, l_returnflag DESC)
    SELECT o_orderkey, coalesce(l_returnflag, o_orderstatus) AS o_orderstatus, o_totalprice
    FROM orders LEFT JOIN best ON o_orderkey = l_orderkey""")
def update_from(spark, sf):
    """Order status from the order's latest line: the source has many rows per key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_extendedprice",
                                                F.col("l_returnflag").alias("o_orderstatus"))
    return update_from_op(orders, lines, ["o_orderkey"], ["o_orderstatus"], ["l_shipdate", "l_extendedprice", "o_orderstatus"])


@query("""
    SELECT o.o_orderkey, o.o_custkey, m.name FROM orders o
    LEFT JOIN (SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_suppkey, s_name FROM supplier) m ON o.o_custkey = m.k""")
def resolve_key(spark, sf):
    """Homonyms in the dimension (a customer and a supplier of one number) multiply rows; unknown keys give null."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return resolve_key_op(orders, customers.union(suppliers), ["o_custkey"], "name")


# Group -> members, for the look-up by inverted map.
_HEMISPHERES = {"south": ["AFRICA"], "west": ["AMERICA"], "east": ["ASIA", "MIDDLE EAST"], "north": ["EUROPE"]}


@query("""
    SELECT c.c_custkey, r.r_name, m.hemisphere FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN (VALUES ('AFRICA', 'south'), ('AMERICA', 'west'), ('ASIA', 'east'), ('MIDDLE EAST', 'east'), ('EUROPE', 'north'))
         AS m(r_name, hemisphere) ON r.r_name = m.r_name""")
def map_lookup(spark, sf):
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "r_name", lookup("r_name", invert(_HEMISPHERES)).alias("hemisphere")))


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE NOT (l_returnflag = 'N') OR l_linestatus = 'F'""")
def active_or_injured(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns({
        "dnp": F.col("l_returnflag") == "N", "blesse": F.col("l_linestatus") == "F"})
    return lines.filter(active_op()).select("l_orderkey", "l_partkey", "l_suppkey")


@query("""
    SELECT doc_id, n_chars FROM documents WHERE contains(text, 'DNP') OR contains(text, 'license')
        OR contains(text, 'ation') OR contains(text, '@')""")
def contains_tokens(spark, sf):
    return table(spark, sf, "documents").filter(
        contains_any("text", ["DNP", "license", "ation", "@"])).select("doc_id", "n_chars")


@query("""
    SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name, x.n_nationkey AS same_nation
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey JOIN nation x ON lower(n.n_name) = lower(x.n_name)
    WHERE c.c_mktsegment <> 'MACHINERY'""")
def dim_joins(spark, sf):
    orders, customer, nation, region = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    other = nation.select(F.col("n_nationkey").alias("same_nation"), F.lower("n_name").alias("lower_name"))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .filter("c_mktsegment <> 'MACHINERY'")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .join(other, F.lower("n_name") == F.col("lower_name"))
            .select("o_orderkey", "c_name", "n_name", "r_name", "same_nation"))


@query("""
    SELECT c_custkey, c_name, true AS has_orders FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
    UNION ALL
    SELECT c_custkey, c_name, false FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def semi_anti(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    partial = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return mark_members(customer, partial, ["c_custkey"], "has_orders", hot=False)


@query("""
    SELECT o.o_orderkey, c.c_name, o.o_orderstatus, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_mktsegment <> o.o_orderstatus AND o.o_totalprice > c.c_acctbal * 50""")
def join_then_compare(spark, sf):
    """Join on the id, then compare across the sides."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.filter("c_mktsegment <> o_orderstatus AND o_totalprice > c_acctbal * 50") \
                 .select("o_orderkey", "c_name", "o_orderstatus", "c_mktsegment")


@query("""
    WITH coded AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 99 ELSE 1 END AS code,
                          CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders)
    SELECT o_orderkey, code, day FROM coded
    WHERE code != 99 AND day <= DATE '1999-06-30' AND contains(o_orderpriority, 'I') AND lower(o_orderpriority) = lower('2-High')
    UNION ALL SELECT o_orderkey, code, day FROM coded WHERE code IS NULL
    UNION ALL SELECT o_orderkey, code, day FROM coded WHERE code = 99""")
def basic_filters(spark, sf):
    """A type code that may be null: != drops nulls, = keeps only equals, IS NULL finds them."""
    coded = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderpriority") == "1-URGENT", 99)
                       .otherwise(1).alias("code"), date("o_orderdate").alias("day"), "o_orderpriority")
    others = coded.filter((F.col("code") != 99) & (F.col("day") <= F.to_date(F.lit("1999-06-30")))
                          & F.col("o_orderpriority").contains("I")
                          & (F.lower("o_orderpriority") == F.lower(F.lit("2-High"))))
    parts = [others, coded.filter(F.col("code").isNull()), coded.filter(F.col("code") == 99)]
    return parts[0].union(parts[1]).union(parts[2]).select("o_orderkey", "code", "day")


@query("""
    SELECT 'orders' AS source, max(o_orderkey) AS max_id, max(CAST(o_orderdate AS DATE)) AS max_day,
           (SELECT count(*) FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) FROM orders)) AS n_distinct FROM orders
    UNION ALL
    SELECT 'lineitem', max(l_orderkey), max(CAST(l_shipdate AS DATE)),
           (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem)) FROM lineitem""")
def max_and_distinct(spark, sf):
    def marks(name, key, day, other):
        df = table(spark, sf, name)
        top = df.agg(F.max(key).alias("max_id"), F.max(date(day)).alias("max_day"))
        n = df.select(other, date(day).alias("d")).dropDuplicates().agg(F.count(F.lit(1)).alias("n_distinct"))
        both = top.unionByName(n, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(F.lit(name).alias("source"), "*")
    return marks("orders", "o_orderkey", "o_orderdate", "o_custkey").unionByName(
        marks("lineitem", "l_orderkey", "l_shipdate", "l_suppkey"))
