"""One query per operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates, jsondoc, numbers, text
from ..operators import aggregate, dedupe, joins, keys, merge, quality, repair
from .registry import Tables, query

_ITEM_KEY = ["l_orderkey", "l_linenumber"]
_ITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_ITEM_ORDER_SQL = ", ".join(_ITEM_ORDER)
_ITEM_DESC_SQL = ", ".join(f"{c} DESC" for c in _ITEM_ORDER)


# --- Projection and filters ---------------------------------------------------------------------


@query("status_marks", """
SELECT o_orderkey, status,
       CAST(CASE status WHEN 'under review' THEN 30 WHEN 'reviewed' THEN 100 WHEN 'rejected' THEN 80 ELSE 0 END AS DOUBLE) AS marks_pct,
       CAST(NULL AS INTEGER) AS mentor_id
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'under review' WHEN 'F' THEN 'reviewed' ELSE 'other' END AS status
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW'))""")
def status_marks(t: Tables):
    status = F.when(F.col("o_orderstatus") == "P", "under review").when(F.col("o_orderstatus") == "F", "reviewed")
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")).select(
        "o_orderkey", status.otherwise("other").alias("status")
    ).select(
        "o_orderkey", "status", numbers.marks_for_status(F.col("status")).cast("double").alias("marks_pct"),
        F.lit(None).cast("int").alias("mentor_id"),
    )


@query("prefix_filter", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE 'sm%' OR p_name LIKE 'hot w%'""")
def prefix_filter(t: Tables):
    return t.part.filter(text.has_prefix(F.col("p_name"), ["red", "sm", "hot w"])).select("p_partkey", "p_name")


@query("ilike_filter", """
SELECT c_custkey, c_mktsegment, c_mktsegment ILIKE '%hold%' AS is_leader
FROM customer WHERE c_mktsegment ILIKE 'building' OR c_mktsegment ILIKE 'h%'""")
def ilike_filter(t: Tables):
    segment = F.col("c_mktsegment")
    return t.customer.filter(F.ilike(segment, F.lit("building")) | F.ilike(segment, F.lit("h%"))).select(
        "c_custkey", "c_mktsegment", F.coalesce(F.ilike(segment, F.lit("%hold%")), F.lit(False)).alias("is_leader")
    )


@query("regex_filter", r"""
SELECT event_id, CAST(ts AS VARCHAR) AS ts_text, props
FROM events WHERE regexp_matches(CAST(ts AS VARCHAR), '\.[0-9]+') AND NOT regexp_matches(props, ': [1-4][0-9]')""")
def regex_filter(t: Tables):
    return t.events.filter(dates.has_fraction(F.col("ts")) & ~F.col("props").rlike(": [1-4][0-9]")).select(
        "event_id", F.col("ts").cast("string").alias("ts_text"), "props"
    )


_BLANKED_SQL = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN ' ' WHEN '2-HIGH' THEN 'NaN'
  WHEN '3-MEDIUM' THEN NULL ELSE ' ' || strftime(o_orderdate, '%Y-%m-%d') END AS submitted FROM orders"""


def _blanked(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", " ").when(F.col("o_orderpriority") == "2-HIGH", "NaN")
        .when(F.col("o_orderpriority") != "3-MEDIUM", F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
        .alias("submitted"),
    )


@query("filled_text", f"""
SELECT o_orderkey, CAST(trim(submitted) AS TIMESTAMP) AS submitted_at FROM ({_BLANKED_SQL})
WHERE trim(submitted) <> '' AND trim(submitted) <> 'NaN'""")
def filled_text(t: Tables):
    submitted = F.col("submitted")
    return _blanked(t).filter(text.is_filled(submitted)).select(
        "o_orderkey", dates.timestamp_from_text(submitted).alias("submitted_at")
    )


@query("null_tokens", f"""
SELECT o_orderkey, CASE WHEN submitted IN ('NaN', 'nan', '') THEN NULL ELSE submitted END AS submitted,
       submitted IS NULL OR trim(submitted) = '' AS was_blank
FROM ({_BLANKED_SQL})""")
def null_tokens(t: Tables):
    from ..sources.csv_files import null_tokens as apply

    return apply(_blanked(t).withColumn("was_blank", text.is_blank(F.col("submitted"))), ["submitted"])


@query("time_window", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")
def time_window(t: Tables):
    start, end = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12)
    ntz = [F.lit(x).cast("timestamp_ntz") for x in (start, end)]
    return t.events.filter(dates.in_window(F.col("ts"), *ntz)).select("event_id", "ts")


@query("untrimmed_values", """
SELECT DISTINCT padded AS original, trim(padded) AS cleaned
FROM (SELECT CASE WHEN c_nationkey < 12 THEN ' ' || c_mktsegment ELSE c_mktsegment END AS padded FROM customer)
WHERE padded <> trim(padded)""")
def untrimmed_values(t: Tables):
    from ..plans.repair import untrimmed_values as preview

    padded = F.when(F.col("c_nationkey") < 12, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment"))
    return preview(t.customer.select(padded.alias("padded")), "padded")


# --- Joins --------------------------------------------------------------------------------------


@query("inner_composite_join", """
SELECT l_orderkey, l_linenumber, p_partkey, p_size
FROM lineitem JOIN part ON l_partkey = p_partkey AND CAST(l_quantity AS INTEGER) = p_size""")
def inner_composite_join(t: Tables):
    on = (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_quantity").cast("int") == F.col("p_size"))
    return t.lineitem.join(t.part, on).select("l_orderkey", "l_linenumber", "p_partkey", "p_size")


@query("unnest_tags", """
SELECT p_brand, list(DISTINCT tag ORDER BY tag) AS tags, count(*) AS n
FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS tag FROM part WHERE p_name <> '') GROUP BY p_brand""")
def unnest_tags(t: Tables):
    words = joins.unnest_text(t.part.select("p_brand", "p_name"), "p_name", "tag", " ")
    return words.groupBy("p_brand").agg(
        aggregate.distinct_array(F.col("tag")).alias("tags"), F.count(F.lit(1)).alias("n")
    )


@query("distinct_id_array", """
SELECT o_custkey, list_concat(list(DISTINCT k ORDER BY k) FILTER (WHERE k IS NOT NULL),
                              CASE WHEN bool_or(k IS NULL) THEN [CAST(NULL AS INTEGER)] ELSE [] END) AS day_numbers
FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(extract(month FROM o_orderdate) AS INTEGER) END AS k
      FROM orders) GROUP BY o_custkey""")
def distinct_id_array(t: Tables):
    month = F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate"))
    return t.orders.select("o_custkey", month.alias("k")).groupBy("o_custkey").agg(
        aggregate.distinct_array(F.col("k")).alias("day_numbers")
    )


@query("normalised_join", """
SELECT l.c_custkey, l.padded, r.c_custkey AS other_key
FROM (SELECT c_custkey, '  ' || upper(c_name) || ' ' AS padded, upper(c_mktsegment) || ' ' AS seg FROM customer) l
JOIN (SELECT c_custkey, c_name, lower(c_mktsegment) AS seg FROM customer) r
ON lower(trim(l.padded)) = lower(trim(r.c_name)) AND lower(trim(l.seg)) = lower(trim(r.seg))""")
def normalised_join(t: Tables):
    left = t.customer.select(
        "c_custkey", F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("padded"),
        F.concat(F.upper("c_mktsegment"), F.lit(" ")).alias("seg"),
    )
    right = t.customer.select(
        F.col("c_custkey").alias("other_key"), "c_name", F.lower("c_mktsegment").alias("other_seg")
    )
    return joins.normalised_join(left, right, [("padded", "c_name"), ("seg", "other_seg")]).select(
        "c_custkey", "padded", "other_key"
    )


@query("range_join", """
SELECT event_id, CAST(ts AS DATE) AS day, n_nationkey
FROM events JOIN nation
ON CAST(ts AS DATE) BETWEEN DATE '2024-01-01' + n_nationkey AND DATE '2024-01-01' + (n_nationkey + n_regionkey)""")
def range_join(t: Tables):
    first = F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("n_nationkey"))
    ranges = t.nation.select(
        "n_nationkey", first.alias("first_day"), F.date_add(first, F.col("n_regionkey")).alias("last_day")
    )
    points = t.events.select("event_id", F.to_date("ts").alias("day"))
    hits = joins.range_join(points, ranges, F.col("day"), F.col("first_day"), F.col("last_day"), bucket_days=7)
    return hits.select("event_id", "day", "n_nationkey")


@query("semi_in_subquery", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def semi_in_subquery(t: Tables):
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("anti_unmatched", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 400000)""")
def anti_unmatched(t: Tables):
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("match_split", """
SELECT DISTINCT o_custkey AS user_key, EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey) AS matched FROM orders""")
def match_split(t: Tables):
    wanted = t.orders.select(F.col("o_custkey").alias("user_key"))
    return joins.match_split(wanted, t.events.select(F.col("user_id").alias("user_key")), ["user_key"])


@query("scalar_lookup", """
SELECT l_orderkey, l_linenumber, (SELECT min(s_name) FROM supplier WHERE s_nationkey = l_suppkey % 25) AS first_name
FROM lineitem""")
def scalar_lookup(t: Tables):
    items = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 25).cast("int").alias("_nation"))
    found = joins.look_up_one(items, t.supplier, ("_nation", "s_nationkey"), "s_name", "first_name")
    return found.select("l_orderkey", "l_linenumber", "first_name")


# --- Deduplication ------------------------------------------------------------------------------


def _ranked_sql(order: str, key: str = "l_orderkey, l_linenumber") -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"


@query("dedupe_last", _ranked_sql(_ITEM_DESC_SQL))
def dedupe_last(t: Tables):
    return dedupe.dedupe_keep_last(t.lineitem, _ITEM_KEY, _ITEM_ORDER)


@query("dedupe_first", _ranked_sql(_ITEM_ORDER_SQL))
def dedupe_first(t: Tables):
    return dedupe.dedupe_keep_first(t.lineitem, _ITEM_KEY, _ITEM_ORDER)


@query("dedupe_null_keys", """
WITH e AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id, event_type FROM events)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM e)
WHERE rn = 1 OR user_id IS NULL""")
def dedupe_null_keys(t: Tables):
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    rows = t.events.select("event_id", "ts", user.alias("user_id"), "event_type")
    return dedupe.dedupe_keep_last(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("dedupe_max_referenced", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS owner FROM orders),
top AS (SELECT max(o_orderkey) AS keep_id FROM o WHERE owner IS NOT NULL GROUP BY owner)
SELECT o_orderkey, owner,
       CASE WHEN owner IS NULL OR o_orderkey IN (SELECT keep_id FROM top) THEN 'kept'
            WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) THEN 'referenced'
            ELSE 'unreferenced' END AS disposition
FROM o""")
def dedupe_max_referenced(t: Tables):
    owner = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    rows = t.orders.select("o_orderkey", owner.alias("owner"))
    return dedupe.tag_by_max(rows, "owner", "o_orderkey", t.lineitem.filter("l_quantity > 45"), "l_orderkey")


@query("duplicate_report", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_report(t: Tables):
    return dedupe.duplicate_report(t.lineitem, _ITEM_KEY)


# --- Merges -------------------------------------------------------------------------------------


@query("upsert_orders", """
WITH target AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
source AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       t.o_orderpriority
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey""")
def upsert_orders(t: Tables):
    target = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    source = t.orders.filter("o_orderstatus <> 'F'").selectExpr(
        "o_orderkey", "o_custkey + 1 as o_custkey", "o_totalprice + 1 as o_totalprice"
    )
    return merge.upsert(target, source, ["o_orderkey"], ["o_totalprice"])


@query("upsert_small_source", """
SELECT CASE WHEN s.k IS NULL THEN c.c_custkey ELSE s.k END AS c_custkey,
       CASE WHEN s.k IS NULL THEN c.c_name ELSE s.nm END AS c_name,
       c.c_mktsegment
FROM customer c FULL JOIN (SELECT s_suppkey * 20 AS k, s_name AS nm FROM supplier) s ON c.c_custkey = s.k""")
def upsert_small_source(t: Tables):
    target = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    source = t.supplier.selectExpr("s_suppkey * 20 as c_custkey", "s_name as c_name")
    return merge.upsert(target, source, ["c_custkey"], small_source=True)


@query("upsert_null_keys", """
WITH target AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k, o_totalprice AS v FROM orders),
source AS (SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS k, o_totalprice * 2 AS v FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.v IS NULL THEN t.v ELSE s.v END AS v
FROM target t FULL JOIN source s ON t.k = s.k""")
def upsert_null_keys(t: Tables):
    target = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("k"), F.col("o_totalprice").alias("v")
    )
    source = t.orders.filter("o_orderstatus <> 'F'").select(
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("k"), (F.col("o_totalprice") * 2).alias("v")
    )
    return merge.upsert(target, source, ["k"])


_LAST_EVENT_SQL = """
SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts
FROM events GROUP BY user_id, event_type"""


@query("upsert_events_last", """
WITH last AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL),
target AS (SELECT c_custkey AS user_id, 'view' AS event_type, c_acctbal AS value FROM customer)
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type,
       CASE WHEN s.user_id IS NULL THEN t.value ELSE s.value END AS value
FROM target t FULL JOIN last s ON t.user_id = s.user_id AND t.event_type = s.event_type""")
def upsert_events_last(t: Tables):
    target = t.customer.selectExpr("c_custkey as user_id", "'view' as event_type", "c_acctbal as value")
    source = t.events.select("user_id", "event_type", "value", "ts", "event_id")
    return merge.upsert_in_order(target, source, ["user_id", "event_type"], ["ts", "event_id"])


@query("patch_non_null", """
WITH patch AS (
  SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS segment,
         arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS balance
  FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(segment, c_mktsegment) AS c_mktsegment, coalesce(balance, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN patch ON o_custkey = c_custkey""")
def patch_non_null(t: Tables):
    status = F.col("o_orderstatus")
    patch = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.when(status == "F", F.col("o_orderpriority")).alias("c_mktsegment"),
        F.when(status == "O", F.col("o_totalprice")).alias("c_acctbal"),
    )
    target = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return merge.patch_non_null(target, patch, "c_custkey", ["c_mktsegment", "c_acctbal"], ["o_orderkey"])


@query("fill_null_lookup", """
WITH s AS (SELECT s_suppkey, CASE WHEN s_acctbal < 5000 THEN NULL ELSE s_nationkey END AS nation, 'customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ' ' AS name FROM supplier),
l AS (SELECT lower(trim(c_name)) AS name, min(c_nationkey) AS nation FROM customer GROUP BY 1)
SELECT s_suppkey, coalesce(s.nation, l.nation) AS nation, s.name FROM s LEFT JOIN l ON lower(trim(s.name)) = l.name""")
def fill_null_lookup(t: Tables):
    target = t.supplier.select(
        "s_suppkey", F.when(F.col("s_acctbal") >= 5000, F.col("s_nationkey")).alias("nation"),
        F.concat(F.lit("customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit(" ")).alias("name"),
    )
    on = [(text.normalised(F.col("name")), text.normalised(F.col("c_name")))]
    return merge.fill_null_from_lookup(target, t.customer, on, "nation", "c_nationkey")


@query("update_where", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN o_orderkey ELSE o_custkey END AS o_custkey,
       CASE WHEN o_totalprice > 300000 THEN o_orderstatus || '!' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def update_where(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = merge.update_where(
        rows, F.col("o_totalprice") > 300000,
        {"o_custkey": F.col("o_orderkey"), "o_orderstatus": F.concat(F.col("o_orderstatus"), F.lit("!"))},
    )
    return changed.drop("o_totalprice")


_CHAIN = {"BUILDING": "HOUSEHOLD", "HOUSEHOLD": "HOME", "MACHINERY": "TOOLS", "AUTOMOBILE": "BUILDING"}


@query("recode_update", """
SELECT c_custkey, CASE trim(seg) WHEN 'BUILDING' THEN 'HOME' WHEN 'HOUSEHOLD' THEN 'HOME' WHEN 'MACHINERY' THEN 'TOOLS'
       WHEN 'AUTOMOBILE' THEN 'BUILDING' ELSE seg END AS segment
FROM (SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN c_mktsegment || ' ' ELSE c_mktsegment END AS seg FROM customer)""")
def recode_update(t: Tables):
    padded = F.when(F.col("c_nationkey") < 10, F.concat(F.col("c_mktsegment"), F.lit(" "))).otherwise(F.col("c_mktsegment"))
    return repair.recode(t.customer.select("c_custkey", padded.alias("segment")), "segment", _CHAIN)


@query("recode_from_table", """
SELECT p_partkey, coalesce(n_name, p_brand) AS p_brand
FROM part LEFT JOIN nation ON trim(p_brand) = 'Brand#' || n_nationkey""")
def recode_from_table(t: Tables):
    mapping = t.nation.select(F.concat(F.lit("Brand#"), F.col("n_nationkey")).alias("old"), "n_name")
    return repair.recode_from_table(t.part.select("p_partkey", "p_brand"), "p_brand", mapping, "old", "n_name")


@query("case_update", """
SELECT o_orderkey, o_orderpriority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '5-LOW' THEN 'L' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def case_update(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return repair.case_update(rows, "o_orderstatus", F.trim(F.col("o_orderpriority")), {"1-URGENT": "U", "5-LOW": "L"})


_LISTED_SQL = "SELECT ' ' || c_name AS email FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 450000 UNION ALL SELECT s_name FROM supplier"


def _listed(t: Tables):
    big = t.orders.filter("o_totalprice > 450000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return big.select(F.concat(F.lit(" "), F.col("c_name")).alias("email")).unionByName(
        t.supplier.select(F.col("s_name").alias("email"))
    )


@query("update_where_in", f"""
SELECT c_custkey, CASE WHEN trim(c_name) IN (SELECT trim(email) FROM ({_LISTED_SQL})) THEN 'LISTED' ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def update_where_in(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    done = repair.update_listed(rows, "c_name", _listed(t), "email", {"c_mktsegment": F.lit("LISTED")})
    return done.updated.drop("c_name")


@query("update_where_in_unmatched", f"""
SELECT DISTINCT trim(email) AS email FROM ({_LISTED_SQL}) WHERE trim(email) NOT IN (SELECT c_name FROM customer)""")
def update_where_in_unmatched(t: Tables):
    return repair.update_listed(t.customer, "c_name", _listed(t), "email", {}).unmatched


_GONE_SQL = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice > 250000 END"


def _gone(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return repair.delete_where(rows, F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_totalprice") > 250000))


@query("delete_where_kept", f"""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE NOT coalesce({_GONE_SQL}, FALSE)""")
def delete_where_kept(t: Tables):
    return _gone(t).kept


@query("delete_where_removed", f"SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE {_GONE_SQL}")
def delete_where_removed(t: Tables):
    return _gone(t).removed


@query("delete_in_subquery", """
SELECT event_id, user_id, event_type FROM events
WHERE NOT (event_type = 'error' AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 4000))""")
def delete_in_subquery(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type")
    rich = t.customer.filter("c_acctbal > 4000")
    return repair.delete_listed(rows, "user_id", rich, "c_custkey", F.col("event_type") == "error").kept


@query("delete_cascade", """
WITH ids AS (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)
SELECT 'lineitem' AS tbl, l_orderkey AS id, l_orderkey IN (SELECT o_orderkey FROM ids) AS removed FROM lineitem
UNION ALL
SELECT 'orders', o_orderkey, o_orderkey IN (SELECT o_orderkey FROM ids) FROM orders""")
def delete_cascade(t: Tables):
    ids = t.orders.filter("o_totalprice > 400000").select(F.col("o_orderkey").alias("doomed"))
    parts = repair.delete_cascade(
        {"lineitem": (t.lineitem, "l_orderkey"), "orders": (t.orders, "o_orderkey")}, ids, "doomed"
    )

    def tagged(name: str, column: str, removed: bool):
        df = parts[name].removed if removed else parts[name].kept
        return df.select(F.lit(name).alias("tbl"), F.col(column).alias("id"), F.lit(removed).alias("removed"))

    out = tagged("lineitem", "l_orderkey", False).unionByName(tagged("lineitem", "l_orderkey", True))
    return out.unionByName(tagged("orders", "o_orderkey", False)).unionByName(tagged("orders", "o_orderkey", True))


@query("add_mapped_column", """
SELECT n_nationkey, n_name, CAST(m.v AS INTEGER) AS duration
FROM nation LEFT JOIN (VALUES (1, '4'), (2, '3'), (7, '2')) m(k, v) ON m.k = n_nationkey""")
def add_mapped_column(t: Tables):
    from ..plans.repair import add_mapped_column as run

    return run(t.nation.select("n_nationkey", "n_name"), "n_nationkey", "duration", "int", {1: "4", 2: "3", 7: "2"})


@query("fill_from_table", """
SELECT c_custkey, CASE WHEN s_suppkey IS NULL THEN c_acctbal ELSE s_acctbal END AS c_acctbal
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def fill_from_table(t: Tables):
    values = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return merge.fill_from_table(t.customer.select("c_custkey", "c_acctbal"), "c_custkey", "c_acctbal", values)


@query("insert_select", """
SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def insert_select(t: Tables):
    target = t.supplier.selectExpr("s_suppkey as id", "s_name as name", "cast(null as string) as segment")
    rows = t.customer.selectExpr("cast(c_custkey as string) as id", "c_name as name", "c_mktsegment as segment")
    return merge.insert_select(target, rows, skip_known=["id"])


@query("audit_upsert", """
WITH target AS (SELECT o_orderkey, o_totalprice,
                       CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2020-01-01 00:00:00' END AS inserted_at FROM orders WHERE o_orderstatus <> 'P'),
source AS (SELECT o_orderkey, o_totalprice + 5 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NULL THEN TIMESTAMP '2024-03-01 09:30:00' ELSE t.inserted_at END AS inserted_at,
       CASE WHEN s.o_orderkey IS NULL THEN NULL ELSE TIMESTAMP '2024-03-01 09:30:00' END AS updated_at
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey""")
def audit_upsert(t: Tables):
    target = t.orders.filter("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey", "o_totalprice",
        "case when o_orderstatus = 'F' then timestamp_ntz'2020-01-01 00:00:00' end as inserted_at",
    )
    source = t.orders.filter("o_orderstatus <> 'F'").selectExpr("o_orderkey", "o_totalprice + 5 as o_totalprice")
    audit = merge.Audit(now=dt.datetime(2024, 3, 1, 9, 30))
    return merge.upsert(target, source, ["o_orderkey"], audit=audit)


# --- Aggregates, sets, ids, quality -------------------------------------------------------------


@query("filtered_aggregates", """
SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'N') AS n_open, count(*) FILTER (WHERE l_returnflag = 'R') AS n_done,
       max(l_shipdate) FILTER (WHERE l_returnflag = 'N') AS last_open
FROM lineitem GROUP BY l_suppkey""")
def filtered_aggregates(t: Tables):
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_suppkey").agg(
        aggregate.count_where(flag == "N").alias("n_open"), aggregate.count_where(flag == "R").alias("n_done"),
        aggregate.max_where(flag == "N", F.col("l_shipdate")).alias("last_open"),
    )


@query("joined_distinct", """
SELECT l_suppkey, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types,
       string_agg(DISTINCT CASE WHEN p_size > 60 THEN p_brand END, ', ') AS none
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_suppkey""")
def joined_distinct(t: Tables):
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return rows.groupBy("l_suppkey").agg(
        aggregate.joined_distinct(F.col("p_type")).alias("types"),
        aggregate.joined_distinct(F.when(F.col("p_size") > 60, F.col("p_brand"))).alias("none"),
    )


@query("union_literals", """
SELECT r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT 100, 'Incubator' UNION ALL SELECT 101, 'Accelerator'""")
def union_literals(t: Tables):
    from ..sources.csv_files import rows_source

    literal = rows_source(t.spark, [(100, "Incubator"), (101, "Accelerator")], "id int, name string")
    return t.region.selectExpr("r_regionkey as id", "r_name as name").unionByName(literal)


@query("assign_ids", """
WITH c AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS id, c_name FROM customer)
SELECT id, c_name FROM c WHERE id IS NOT NULL
UNION ALL
SELECT (SELECT max(id) FROM c) + row_number() OVER (ORDER BY c_name), c_name FROM c WHERE id IS NULL""")
def assign_ids(t: Tables):
    rows = t.customer.select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("id"), "c_name")
    return keys.assign_sequential_ids(rows, "id", ["c_name"])


@query("quality_summary", """
SELECT 'not_null' AS rule, 'o_custkey' AS "column", count(*) FILTER (WHERE o_custkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'domain', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) FROM orders
UNION ALL SELECT 'max_length', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 6) FROM orders
UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'reference', 'user_id', count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def quality_summary(t: Tables):
    rules = [
        quality.not_null("o_custkey"), quality.in_domain("o_orderstatus", ["O", "F"]),
        quality.max_length("o_orderpriority", 6),
    ]
    return (
        quality.rule_counts(t.orders, rules)
        .unionByName(quality.unique_count(t.lineitem, _ITEM_KEY))
        .unionByName(quality.orphan_count(t.events, "user_id", t.supplier, "s_suppkey"))
    )


@query("quarantine", """
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'domain:o_orderstatus' END,
         CASE WHEN length(o_orderpriority) > 6 THEN 'max_length:o_orderpriority' END) AS reasons
FROM orders WHERE o_orderstatus NOT IN ('O', 'F') OR length(o_orderpriority) > 6""")
def quarantine(t: Tables):
    rules = [quality.in_domain("o_orderstatus", ["O", "F"]), quality.max_length("o_orderpriority", 6)]
    _, bad = quality.quarantine(t.orders, rules)
    return bad.select("o_orderkey", F.array_join("reasons", ",").alias("reasons"))


@query("orphans", """
SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def orphans(t: Tables):
    return quality.orphans(t.events.select("event_id", "user_id"), "user_id", t.supplier, "s_suppkey")


@query("clustered_rows", "SELECT l_suppkey, l_partkey, l_orderkey FROM lineitem")
def clustered_rows(t: Tables):
    from ..sources.tables import clustered

    return clustered(t.lineitem.select("l_suppkey", "l_partkey", "l_orderkey"), ["l_suppkey", "l_partkey"])


# --- Scalar expressions -------------------------------------------------------------------------


@query("cohort_code", """
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'INC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')
                       WHEN c_nationkey % 3 = 1 THEN 'ACC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')
                       ELSE upper(left(c_mktsegment, 3)) || CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3
                            THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END END AS from_label,
       'INC' || right('000' || c_custkey, 3) AS from_number
FROM customer""")
def cohort_code(t: Tables):
    n = F.col("c_nationkey")
    label = (
        F.when(n % 3 == 0, F.concat(F.lit("Incubator "), n, F.lit(".0")))
        .when(n % 3 == 1, F.concat(F.lit(" accelerator  "), n))
        .otherwise(F.concat(F.lower("c_mktsegment"), F.lit(" "), F.col("c_custkey")))
    )
    return t.customer.select(
        "c_custkey", text.cohort_code_from_label(label).alias("from_label"),
        text.cohort_code(F.lit("INC"), F.col("c_custkey")).alias("from_number"),
    )


@query("student_code", """
SELECT o_orderkey, right(CAST(extract(year FROM o_orderdate) AS VARCHAR), 2) || 'INC00' || left(o_orderpriority, 1)
       || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS code
FROM orders""")
def student_code(t: Tables):
    cohort = F.concat(F.lit("INC00"), F.left(F.col("o_orderpriority"), F.lit(1)))
    return t.orders.select(
        "o_orderkey", text.student_code(F.col("o_orderdate"), cohort, F.col("o_custkey")).alias("code")
    )


@query("name_split", """
SELECT p_partkey,
       CASE WHEN full_name LIKE '%.%' THEN trim(split_part(full_name, '.', 2)) ELSE trim(regexp_replace(full_name, '\\s+\\S+$', '')) END AS first_name,
       CASE WHEN full_name LIKE '%.%' THEN split_part(full_name, '.', 1) ELSE split_part(full_name, ' ', -1) END AS last_name
FROM (SELECT p_partkey, CASE WHEN p_size < 15 THEN replace(p_name, ' ', '. ') WHEN p_size < 30 THEN p_name ELSE replace(p_name, ' ', '') END AS full_name FROM part)
""".replace("\\\\", "\\"))
def name_split(t: Tables):
    name = F.col("p_name")
    full = (
        F.when(F.col("p_size") < 15, F.replace(name, F.lit(" "), F.lit(". ")))
        .when(F.col("p_size") < 30, name).otherwise(F.replace(name, F.lit(" "), F.lit("")))
    )
    return t.part.select(
        "p_partkey", text.first_name(full).alias("first_name"), text.last_name(full).alias("last_name")
    )


_AS_OF = dt.date(2025, 6, 30)


@query("academic_year", """
WITH y AS (SELECT p_partkey, p_size % 5 + 1 AS duration,
                  CASE WHEN p_size < 10 THEN 'Final Year' ELSE (p_size % 9) || 'th Year' END AS label FROM part),
n AS (SELECT *, least(coalesce(CAST(nullif(regexp_replace(label, '[^0-9]', '', 'g'), '') AS INTEGER), 1), duration) AS study_year FROM y)
SELECT p_partkey, CAST(study_year AS INTEGER) AS study_year, CAST(2024 - (study_year - 1) AS INTEGER) AS start_year,
       CAST(2024 - (study_year - 1) + duration AS INTEGER) AS end_year FROM n""")
def academic_year(t: Tables):
    label = F.when(F.col("p_size") < 10, "Final Year").otherwise(F.concat(F.col("p_size") % 9, F.lit("th Year")))
    duration = F.col("p_size") % 5 + 1
    year = numbers.year_of_study(label, duration)
    return t.part.select(
        "p_partkey", year.alias("study_year"), dates.start_year(year, _AS_OF).alias("start_year"),
        dates.end_year(year, duration, _AS_OF).alias("end_year"),
    )


@query("date_parse", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_first, CAST(o_orderdate AS DATE) AS short_year,
       CAST(o_orderdate AS DATE) AS month_name, CAST(NULL AS DATE) AS unreadable,
       CAST(o_orderdate AS DATE) >= DATE '1998-06-30' AS active, dayname(o_orderdate) AS weekday
FROM orders""")
def date_parse(t: Tables):
    d = F.col("o_orderdate")

    def written(pattern: str):
        return F.date_format(d, pattern)

    return t.orders.select(
        "o_orderkey",
        dates.date_day_first(written("dd/MM/yyyy")).alias("day_first"),
        dates.date_day_first(written("d-M-yy")).alias("short_year"),
        dates.date_month_name(written("dd-MMM-yy")).alias("month_name"),
        dates.date_month_name(written("yyyy")).alias("unreadable"),
        dates.is_active(d.cast("date"), dt.date(1998, 6, 30)).alias("active"),
        dates.weekday_name(d).alias("weekday"),
    )


@query("rates", """
WITH c AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'N') AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS done
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN total = 0 THEN NULL ELSE CAST(round(CAST(done * 100 AS DECIMAL(18,6)) / total, 2) AS DOUBLE) END AS done_rate,
       CASE WHEN total > 1 THEN CAST(round(CAST((total - 1) * 100 AS DECIMAL(18,6)) / total, 2) AS DOUBLE) ELSE 0 END AS repeat_rate,
       greatest(total - 1, 0) AS repeats
FROM c""")
def rates(t: Tables):
    flag = F.col("l_returnflag")
    counts = t.lineitem.groupBy("l_orderkey").agg(
        aggregate.count_where(flag == "N").alias("total"), aggregate.count_where(flag == "R").alias("done")
    )
    total = F.col("total")
    return counts.select(
        "l_orderkey", numbers.share_pct(F.col("done"), total).cast("double").alias("done_rate"),
        numbers.repeat_pct(total).cast("double").alias("repeat_rate"), numbers.repeat_count(total).alias("repeats"),
    )


@query("casts", """
SELECT event_id, CAST(round_even(value, 0) AS INTEGER) AS from_double,
       CAST(round(CAST(value AS DECIMAL(12,2)), 0) AS INTEGER) AS from_decimal,
       left(CAST(event_id AS VARCHAR), 3) AS cut_text, lower(trim('  ' || upper(event_type) || ' ')) AS normal,
       user_id || '@example.org' AS email
FROM events""")
def casts(t: Tables):
    return t.events.select(
        "event_id", numbers.int_from_double(F.col("value")).alias("from_double"),
        numbers.int_from_decimal(F.col("value").cast("decimal(12,2)")).alias("from_decimal"),
        text.cut(F.col("event_id"), 3).alias("cut_text"),
        text.normalised(F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))).alias("normal"),
        text.synthetic_email(F.col("user_id"), "example.org").alias("email"),
    )


@query("json_edit", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS renamed_value, FALSE AS still_there,
       CASE WHEN event_type = 'view' THEN 'Pursued' ELSE event_type END AS replaced, TRUE AS kind_kept
FROM events""")
def json_edit(t: Tables):
    typed = F.when(F.col("event_type") == "view", "Persued").otherwise(F.col("event_type"))
    padded = F.concat(F.lit(" "), typed, F.lit("  "))
    doc = jsondoc.rename_keys(F.col("props"), {"k": "new_k"})
    form = jsondoc.build_object(form=padded, empty=F.lit(None).cast("string"), n=F.col("event_id"))
    fixed = jsondoc.replace_value(jsondoc.trim_value(form, "form"), "form", "persued", "Pursued")
    return t.events.select(
        "event_id", jsondoc.text_value(doc, "new_k").alias("renamed_value"),
        jsondoc.has_key(doc, "k").alias("still_there"), jsondoc.text_value(fixed, "form").alias("replaced"),
        (F.get_json_object(doc, "$.new_k").cast("int") == F.try_variant_get(F.parse_json(doc), "$.new_k", "int")).alias("kind_kept"),
    )
