"""Projections, pivots and unpivots, files written and read back."""

from pyspark.sql import functions as F

from courtledger.catalog.base import date, registry, table
from courtledger.operators import reshape
from courtledger.plans.box_score import player_facts
from courtledger.session import scratch_path
from courtledger.sources import manifest, tables as stored

QUERIES, SQL, query = registry()


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'R' THEN
        round(l_quantity + l_extendedprice - (l_discount + (l_quantity - l_tax)), 4) END AS score FROM lineitem""")
def weighted_score(spark, sf):
    score = reshape.linear_score(["l_quantity", "l_extendedprice"], ["l_discount"], [("l_tax", "l_quantity")],
                                 when=F.col("l_returnflag") != "R")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(score, 4).alias("score"))


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
           CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS l_shipdate, l_returnflag
    FROM (SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag FROM lineitem)""")
def null_where(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                date("l_shipdate").alias("l_shipdate"), "l_returnflag")
    return reshape.null_where(lines, F.col("l_returnflag") == "R", keep=["l_orderkey", "l_linenumber", "l_returnflag"])


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS measure, {m} AS amount FROM lineitem" for m in _MEASURES))
def melt_measures(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_MEASURES)
    return reshape.melt(lines, ["l_orderkey", "l_linenumber"], variable="measure", value="amount")


@query("""
    SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_suppkey END) AS away,
           max(CASE WHEN l_linenumber = 2 THEN l_suppkey END) AS home FROM lineitem GROUP BY l_orderkey""")
def pivot_pair(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("idx", F.col("l_linenumber") - 1)
    return reshape.pivot_pair(lines, ["l_orderkey"], "idx", "l_suppkey", ["away", "home"])


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_missing_cols(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
                                                    F.col("s_suppkey").alias("id"))
    return reshape.union_by_name([customers, suppliers])


@query("""
    SELECT conv_id, turn, role, text FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)
    WHERE turn < last""")
def drop_footer(spark, sf):
    return reshape.drop_footer(table(spark, sf, "conversations"), ["conv_id"], ["turn"])


@query("""
    SELECT conv_id, turn, role FROM conversations
    WHERE (conv_id, turn) <> (SELECT (conv_id, turn) FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1)""")
def drop_last_row(spark, sf):
    return reshape.drop_footer(table(spark, sf, "conversations"), [], ["conv_id", "turn"]).select("conv_id", "turn", "role")


@query("""
    SELECT conv_id, turn, CASE WHEN turn < 5 THEN substr(text, 1, length(text) - 1) ELSE text END AS text FROM conversations""")
def head_edit(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return reshape.edit_head(turns, "text", "turn", 5, reshape.drop_last_char)


_CELLS = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS team, CAST(l_quantity AS INTEGER) AS a, CAST(l_suppkey AS INTEGER) AS b,
           CAST(l_partkey AS INTEGER) AS c, l_linenumber AS d, CAST(l_quantity + l_suppkey AS INTEGER) AS f FROM lineitem"""


def _cells(spark, sf):
    """Value arrays of five, six or seven items, as games without and with overtime have."""
    integer = lambda c: F.col(c).cast("int")
    q, s, n = integer("l_quantity"), integer("l_suppkey"), F.col("l_linenumber")
    values = F.concat(F.array(q, s, integer("l_partkey"), n),
                      F.when(n >= 6, F.array(n * 2)).otherwise(F.array().cast("array<int>")),
                      F.when(n >= 7, F.array(n * 3)).otherwise(F.array().cast("array<int>")),
                      F.array((F.col("l_quantity") + F.col("l_suppkey")).cast("int")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", values.alias("values"))


_PERIOD_SQL = f"""
    WITH cells AS ({_CELLS})
    SELECT l_orderkey, l_linenumber, l_partkey, 'q1' AS period, a AS points FROM cells
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'q2', b FROM cells
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'q3', c FROM cells
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'q4', d FROM cells
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'pr1', d * 2 FROM cells WHERE d >= 6
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'pr2', d * 3 FROM cells WHERE d >= 7
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'final', f FROM cells"""


@query(_PERIOD_SQL)
def period_rows(spark, sf):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    mapped = _cells(spark, sf).select(*ids, reshape.period_map("values").alias("periods"))
    return reshape.melt_map(mapped, ids, "periods", "period", "points")


@query(f"""
    SELECT l_partkey AS game, period AS id_periode, points, 'regular' AS kind FROM ({_PERIOD_SQL}) ORDER BY game, points DESC""")
def sorted_periods(spark, sf):
    """Renamed, a constant added, sorted by two keys, the second descending."""
    rows = period_rows(spark, sf).select("l_partkey", "period", "points")
    return (rows.withColumnsRenamed({"l_partkey": "game", "period": "id_periode"}).withColumn("kind", F.lit("regular"))
            .orderBy("game", F.desc("points")))


@query(f"""
    WITH cells AS ({_CELLS}) SELECT l_orderkey, l_linenumber, l_partkey, team, f AS final FROM cells""")
def score_line(spark, sf):
    lines = table(spark, sf, "lineitem")
    final = (F.col("l_quantity") + F.col("l_suppkey")).cast("int")
    rows = lines.withColumn("periods", F.create_map(F.lit("q1"), F.col("l_quantity").cast("int"), F.lit("final"), final)) \
                .withColumnRenamed("l_returnflag", "team")
    return reshape.score_line(rows, ["l_orderkey", "l_linenumber", "l_partkey"], "team")


@query("""
    SELECT p_partkey, TRY_CAST(text_size AS DOUBLE) AS text_size, p_retailprice,
           CASE WHEN p_size >= 45 THEN 'text_size' ELSE '' END AS rejected
    FROM (SELECT *, CASE WHEN p_size >= 45 THEN p_size || ' cm' WHEN p_size < 3 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS text_size FROM part)""")
def cast_measures(spark, sf):
    size = F.col("p_size")
    parts = table(spark, sf, "part").select("p_partkey", F.when(size >= 45, F.concat(size.cast("string"), F.lit(" cm")))
                                            .when(size >= 3, size.cast("string")).alias("text_size"), "p_retailprice")
    return reshape.cast_measures(parts, keep=["p_partkey"]).withColumn("rejected", F.array_join("rejected", ","))


@query("""
    SELECT l_orderkey AS k1, l_partkey AS k2, l_linenumber AS k3, l_returnflag AS k4 FROM lineitem""")
def rename_by_position(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    return reshape.rename_by_position(lines, ["k1", "k2", "k3", "k4"])


@query("""
    SELECT CASE WHEN l_linenumber = 7 THEN '' ELSE printf('00:%02d:%02d', CAST(l_quantity AS INTEGER), CAST(l_suppkey % 60 AS INTEGER)) END AS minute,
           l_quantity AS points, l_extendedprice AS rebonds, round(l_quantity * 2, 4) AS score_ttfl, l_suppkey AS id_joueur, l_orderkey AS id_match
    FROM lineitem WHERE l_returnflag <> 'N'""")
def fact_projection(spark, sf):
    """Line items as player rows: those who played, playing time as text."""
    minute = F.when(F.col("l_linenumber") != 7, F.make_dt_interval(
        F.lit(0), F.lit(0), F.col("l_quantity").cast("int"), (F.col("l_suppkey") % 60).cast("decimal(18,6)")))
    other = ["passes_dec", "steal", "contres", "tir_reussi", "tir_tentes", "pct_tir", "trois_pt_r", "trois_pt_t", "pct_3_pt",
             "lanc_frc_r", "lanc_frc_t", "pct_lfrc", "rebonds_o", "rebonds_d", "ball_perdu", "faute_p", "plus_moins"]
    rows = table(spark, sf, "lineitem").select(
        minute.alias("minute"), F.col("l_quantity").alias("points"), F.col("l_extendedprice").alias("rebonds"),
        *[F.lit(0.0).alias(c) for c in other], F.round(F.col("l_quantity") * 2, 4).alias("score_ttfl"),
        F.col("l_suppkey").alias("id_joueur"), F.col("l_orderkey").alias("id_match"), (F.col("l_returnflag") == "N").alias("dnp"))
    return player_facts(rows).select("minute", "points", "rebonds", "score_ttfl", "id_joueur", "id_match")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf):
    customer = table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    stored.write_csv(customer, path)
    return stored.read_csv(spark, path, customer.schema)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def json_round_trip(spark, sf):
    part = table(spark, sf, "part")
    path = scratch_path(spark, "json")
    stored.write_json(part, path)
    return spark.read.schema(part.schema).json(path)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def append_publish(spark, sf):
    """Groups published by appending: one group twice, with its columns in another order; one not at all."""
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    of = lambda status, names: orders.filter(F.col("o_orderstatus") == status).select(*names)
    root = scratch_path(spark, "published")
    groups = {"open": {"orders": of("O", columns)}, "filled": {"orders": of("F", columns)}, "partial": {"orders": of("P", columns)}}
    stored.publish(groups, root, ["open", "filled"])
    stored.publish({"filled": {"orders": of("F", columns[::-1])}}, root)
    return stored.read_table(spark, f"{root}/orders", columns)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_returnflag FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""")
def publish_once(spark, sf):
    """Two tables published together, in two publications; one of them is repeated, and a third does not get as far as its manifest."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    root = scratch_path(spark, "published")

    def of(status):
        some = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey", "o_orderstatus")
        return {"games": {"orders": some, "lines": lines.join(some.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")}}
    manifest.publish_once(of("O"), root, "open")
    for _ in range(2):
        manifest.publish_once(of("F"), root, "filled")
    of("P")["games"]["orders"].write.parquet(f"{root}/orders/partial")
    read = lambda name, like: manifest.read_published(spark, root, name, like.schema)
    found = read("orders", orders.select("o_orderkey", "o_custkey", "o_orderstatus")).join(read("lines", lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return found.select("o_orderkey", "o_custkey", "o_orderstatus", "l_linenumber", "l_returnflag")


@query("""
    SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT r_regionkey + 100, r_name, r_regionkey FROM region""")
def versioned_state(spark, sf):
    """A table replaced by its successor, which is computed from it."""
    root = scratch_path(spark, "versions")
    stored.write_version(table(spark, sf, "nation"), root)
    old = spark.read.parquet(stored.version_path(root, stored.latest_version(spark, root)))
    more = table(spark, sf, "region").select((F.col("r_regionkey") + 100).alias("n_nationkey"), F.col("r_name").alias("n_name"),
                                             F.col("r_regionkey").alias("n_regionkey"))
    stored.write_version(old.unionByName(more), root)
    return spark.read.parquet(stored.version_path(root, stored.latest_version(spark, root)))
