"""The operators as queries over the analytics tables.

Each query takes ``(spark, folder)`` and reads whole tables. The base tables hold no missing
values, so queries that need some derive them from the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.functions import codes, text, values
from caseline.operators import collapse, columns, convert, filters, joins, profile, repair, rules
from caseline.plans import areas, extracts, final, specs, stages
from caseline.session import with_small_methods, work_folder, written
from caseline.sources import delimited, reports, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STATUS_LABELS = {"F": "FINISHED", "O": "OPEN"}
STATUS_RANK = ("F", "O", "P")
AS_OF = dt.date(2001, 6, 30)
LAST_MODIFIED = "Tue, 31 Jul 2001 11:59:25 GMT"
SPLIT_DAY = dt.date(1999, 1, 1)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(name: str) -> Column:
    return F.col(name).cast("date")


def case_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen as proceedings of a customer: open ones have no completion day."""
    return table(spark, folder, "orders").select(
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        day("o_orderdate").alias("order_day"),
        F.when(F.col("o_orderstatus") != "O", day("o_orderdate")).alias("completion_day"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("decision"),
    )


# --- ordered collapse -------------------------------------------------------------------------

_FIRST = {"first_day": "order_day", "first_decision": "decision"}
_LAST = {"last_completion": "completion_day", "last_decision": "decision", "last_price": "o_totalprice", "last_status": "o_orderstatus"}
_ORDER = ["completion_day", "decision", "o_orderkey"]


@query
def collapse_first_last(spark, folder):
    """SRT-1 AG-1: first and last order per customer, missing completion days sorted last."""
    return collapse.collapse_ends(case_orders(spark, folder), ["o_custkey"], _ORDER, _FIRST, _LAST)


@query
def collapse_na_first(spark, folder):
    """SRT-2 AG-1: the same with missing values sorted first."""
    return collapse.collapse_ends(case_orders(spark, folder), ["o_custkey"], _ORDER, _FIRST, _LAST, nulls="first")


@query
def collapse_constant_type(spark, folder):
    """FLT-3 AG-1: collapse only the customers whose orders share one priority, or all lack one."""
    return collapse.collapse_ends(
        case_orders(spark, folder), ["o_custkey"], _ORDER, _FIRST, _LAST, constant="decision"
    )


@query
def collapse_first_second_last(spark, folder):
    """AG-2: first, second and last event per user."""
    events = table(spark, folder, "events").select(
        "user_id", "event_id", "ts", "value", F.nullif(F.col("event_type"), F.lit("view")).alias("kind")
    )
    return collapse.first_second_last(
        events, ["user_id"], ["kind", "ts", "event_id"], {"event_id": "event_id", "kind": "kind", "value": "value"}
    )


@query
def first_n_wide(spark, folder):
    """AG-3: the first four events of each user side by side."""
    events = table(spark, folder, "events")
    return collapse.first_n_wide(
        events, ["user_id"], ["ts", "event_id"], 4, {"kind": "event_type", "value": "value"}
    )


@query
def conditional_last(spark, folder):
    """SRT-3 AG-4: last order status per priority, better statuses winning within a day."""
    orders = table(spark, folder, "orders").withColumn("decision", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    rank = codes.priority_rank(F.col("o_orderstatus"), STATUS_RANK)
    return collapse.last_per_code(
        orders,
        ["o_custkey"],
        [day("o_orderdate"), rank, "o_orderdate", "o_orderkey"],
        "o_orderpriority",
        "decision",
        {"urgent_last": "1-URGENT", "high_last": "2-HIGH", "medium_last": "3-MEDIUM", "low_last": "5-LOW"},
    )


@query
def group_invariant_filter(spark, folder):
    """FLT-3: lines of the orders that have one distinct return flag, a missing one counting."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag")
    )
    return collapse.keep_constant_groups(lines, ["l_orderkey"], "flag")


@query
def distinct_keep_first(spark, folder):
    """FLT-4: one whole line per order and return flag, the lowest by its natural order."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", day("l_shipdate").alias("ship_day"), "l_extendedprice"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "ship_day", "l_extendedprice"]
    return collapse.distinct_first(lines, ["l_orderkey", "l_returnflag"], order)


@query
def top1_by_weight(spark, folder):
    """AG-10: the part with the largest price share of each order."""
    lines = table(spark, folder, "lineitem")
    return collapse.top_by_weight(
        lines,
        ["l_orderkey"],
        "l_extendedprice",
        ["l_partkey", "l_suppkey", "l_linenumber"],
        {"l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "price": "l_extendedprice"},
    )


# --- joins ------------------------------------------------------------------------------------


def _nation_label(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return nation.select("n_nationkey", text.name_with_code(F.col("n_name"), F.col("n_nationkey").cast("string")).alias("label"))


@query
def decode_many(spark, folder):
    """JN-3 JN-5 SC-19: customer and supplier nations of every order line, from one lookup."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    fact = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "c_nationkey", "s_nationkey")
    )
    return joins.decode(
        fact, _nation_label(spark, folder), "n_nationkey", "label", {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"}
    )


@query
def decode_guarded(spark, folder):
    """JN-3 JN-8: region of each customer; the row count is the customers' whatever the lookup holds."""
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    named = joins.many_to_one(customer, nation, {"c_nationkey": "n_nationkey"}, {"nation": "n_name", "region_key": "n_regionkey"})
    return joins.many_to_one(named, table(spark, folder, "region"), {"region_key": "r_regionkey"}, {"region": "r_name"})


@query
def unique_lookup_only(spark, folder):
    """JN-6: part types by brand and name, for the names that occur once within their brand."""
    part = table(spark, folder, "part").withColumn("code", F.concat_ws("|", "p_brand", "p_name"))
    lookup = joins.unique_keys_only(part.select("code", "p_type"), "code")
    return joins.many_to_one(part.select("p_partkey", "code"), lookup, {"code": "code"}, {"part_type": "p_type"})


@query
def nullsafe_decode(spark, folder):
    """JN-4: two-column lookup in which a missing code matches a missing code."""
    part = table(spark, folder, "part").select(
        "p_partkey", "p_brand", "p_retailprice", F.nullif(F.col("p_type"), F.lit("SMALL")).alias("kind")
    )
    lookup = part.groupBy("p_brand", "kind").agg(F.max("p_retailprice").alias("top_price"), F.count("*").alias("parts"))
    return joins.many_to_one(
        part.select("p_partkey", "p_brand", "kind"),
        lookup,
        {"p_brand": "p_brand", "kind": "kind"},
        {"top_price": "top_price", "parts": "parts"},
        null_safe=True,
    )


@query
def inner_join_drop_report(spark, folder):
    """JN-2: customers kept and dropped by joining those with finished orders."""
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    customer_if_done = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    finished = table(spark, folder, "orders").withColumn("o_custkey", customer_if_done)
    by_case = collapse.collapse_ends(finished, ["o_custkey"], ["o_orderdate", "o_orderkey"], last={"last_price": "o_totalprice"})
    return joins.inner_join_report(customer, by_case.withColumnRenamed("o_custkey", "custkey"), "custkey")


@query
def bycase_assembly(spark, folder):
    """JN-1 PRJ-3 PRJ-5: customers with their collapsed orders and events, columns put in order."""
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "idncase")
    orders = collapse.collapse_ends(
        case_orders(spark, folder),
        ["o_custkey"],
        _ORDER,
        {"first_day": "order_day"},
        {"last_completion": "completion_day", "last_status": "o_orderstatus"},
    ).withColumnRenamed("o_custkey", "idncase")
    events = collapse.first_n_wide(
        table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], 2, {"event": "event_type"}
    ).withColumnRenamed("user_id", "idncase")
    # The last status is on both sides; the one that is already there stays.
    events = events.withColumn("last_status", F.lit("X"))
    cases = joins.left_by_key(customer, "idncase", orders, events, drop_shared=True)
    return columns.to_front(cases, ["idncase", "first_day", "last_completion", "event_1", "event_2"])


@query
def row_count_match(spark, folder):
    """JN-8: a decode keeps the number of rows."""
    customer = table(spark, folder, "customer")
    decoded = joins.decode(customer, table(spark, folder, "nation"), "n_nationkey", "n_name", {"c_nationkey": "nation"})
    return joins.row_count_report(customer, decoded)


# --- projections and filters --------------------------------------------------------------------


@query
def cohort_filter(spark, folder):
    """FLT-1 FLT-2 PRJ-1 PRJ-2: orders since a day with a wanted status, renamed and reduced."""
    orders = columns.rename(table(spark, folder, "orders"), {"o_orderdate": "start", "o_orderstatus": "kind"})
    orders = columns.drop_columns(orders, ["o_orderpriority", "o_totalprice"])
    kept = filters.cohort(orders, "start", "1997-10-01", "kind", ["F", "P"])
    return kept.withColumn("start", day("start"))


@query
def map_columns(spark, folder):
    """PRJ-4 PRJ-6: every text column but keys and codes in title case, days for timestamps."""
    orders = columns.project(
        table(spark, folder, "orders"),
        orderkey="o_orderkey",
        status_code="o_orderstatus",
        priority="o_orderpriority",
        placed="o_orderdate",
    )
    titled = columns.map_columns(
        orders, lambda f: f.dataType.simpleString() == "string" and "_code" not in f.name, text.title_case
    )
    return columns.map_columns(titled, lambda f: f.dataType.simpleString().startswith("timestamp"), values.utc_date)


# --- scalar functions -----------------------------------------------------------------------------


@query
def clean_text(spark, folder):
    """REP-1 SC-1 SC-2: whole texts of documents and conversations without controls and extra blanks."""
    docs = table(spark, folder, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text"
    )
    talk = table(spark, folder, "conversations").select(
        F.lit("conversation").alias("origin"), F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"), "text"
    )
    return repair.clean_columns(docs.unionByName(talk))


@query
def zip_normalise(spark, folder):
    """SC-4: leading digits of a postal-like code, padded to five."""
    customer = table(spark, folder, "customer")
    raw = F.concat(F.col("c_custkey").cast("string"), F.lit("-"), F.col("c_nationkey").cast("string"))
    return customer.select("c_custkey", text.zip5(raw).alias("zip"))


@query
def year_extract(spark, folder):
    """SC-5: year of a day written after other text."""
    orders = table(spark, folder, "orders")
    raw = F.concat_ws(" ", "o_orderpriority", F.when(F.col("o_orderstatus") != "P", day("o_orderdate").cast("string")))
    return orders.select("o_orderkey", text.year_of(raw).alias("year"))


@query
def charge_citation(spark, folder):
    """SC-6 SC-7: charge codes made of part attributes, read as citations."""
    part = table(spark, folder, "part")
    section = F.when(F.col("p_size") > 30, "212").when(F.col("p_size") > 20, "237").when(F.col("p_size") > 10, "2153").otherwise("")
    tail = F.when(F.col("p_size") > 45, "a03F").otherwise(
        F.concat(
            F.when(F.col("p_type") == "SMALL", "A").otherwise("a"),
            F.lpad(F.col("p_size").cast("string"), 2, "0"),
            F.substring("p_type", 1, 1),
            F.lit("-"),
            F.lower(F.substring("p_type", 2, 2)),
            F.upper(F.substring("p_name", 1, 1)),
        )
    )
    code = F.concat(section, F.when(section == "2153", F.substring("p_name", 1, 1)).otherwise(tail))
    return part.select("p_partkey", code.alias("charge")).withColumn("citation", codes.citation(F.col("charge")))


@query
def recode_default(spark, folder):
    """SC-8: labels for the known statuses, other codes kept."""
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", codes.recode(F.col("o_orderstatus"), STATUS_LABELS).alias("status"))


@query
def recode_strict(spark, folder):
    """SC-9 SC-10: labels for the known statuses, other codes missing and then filled."""
    orders = table(spark, folder, "orders")
    label = codes.recode_strict(F.col("o_orderstatus"), STATUS_LABELS)
    return orders.select("o_orderkey", label.alias("status"), values.fill_missing(label, "No application").alias("filled"))


@query
def conditional_null(spark, folder):
    """SC-11: zero amounts kept only for the decisions that give zero a meaning."""
    orders = table(spark, folder, "orders")
    decision = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    amount = F.when(F.col("o_orderstatus") == "F", F.lit(0.0)).when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    kept = values.null_zero_unless(amount, decision, ["1-URGENT", "2-HIGH"])
    return orders.select("o_orderkey", kept.alias("amount"))


@query
def later_date(spark, folder):
    """SC-12: the later of order and last shipping day when both are known."""
    done = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    lines = table(spark, folder, "lineitem")
    shipped = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(done).alias("shipped"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("placed")
    )
    both = orders.join(shipped, "o_orderkey", "left")
    return both.select("o_orderkey", values.later_date(F.col("placed"), F.col("shipped")).alias("last_day"))


@query
def flag_from_code(spark, folder):
    """SC-13: flags from a code and from the presence of a day."""
    orders = case_orders(spark, folder)
    return orders.select(
        "o_orderkey",
        codes.flag_from_code(F.col("decision"), "1-URGENT").alias("urgent"),
        F.col("completion_day").isNotNull().alias("completed"),
    )


@query
def duration_days(spark, folder):
    """SC-14 SC-15: days from order to shipping for every order line."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = values.days_between(values.utc_date(F.col("l_shipdate")), values.utc_date(F.col("o_orderdate")))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", days.alias("days"))


def _labelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    tail = (
        F.when(F.col("o_orderstatus") == "F", " (NO BOND SET BY DHS)")
        .when(F.col("o_orderstatus") == "O", "/GRANT WCAT v/d")
        .otherwise(" CATALOG 2ND_TRY")
    )
    return orders.select("o_orderkey", F.concat("o_orderpriority", tail).alias("raw"))


@query
def title_case(spark, folder):
    """SC-16: title case with word breaks at punctuation."""
    return _labelled_orders(spark, folder).select("o_orderkey", text.title_case(F.col("raw")).alias("label"))


@query
def abbr_caps(spark, folder):
    """SC-17: the same with the known abbreviations in capitals."""
    return _labelled_orders(spark, folder).select("o_orderkey", text.label_case(F.col("raw")).alias("label"))


@query
def prefix_title(spark, folder):
    """SC-18: title case before the bracket only."""
    return _labelled_orders(spark, folder).select("o_orderkey", text.title_before_bracket(F.col("raw")).alias("label"))


@query
def string_template(spark, folder):
    """SC-19: name and code of every supplier in one text, and a part of the name."""
    supplier = table(spark, folder, "supplier")
    code = F.col("s_nationkey").cast("string")
    return supplier.select(
        "s_suppkey",
        text.name_with_code(F.col("s_name"), code).alias("label"),
        F.substring("s_name", 1, 2).alias("prefix"),
    )


# --- typing and rules -------------------------------------------------------------------------------

CONVERT_KINDS = {"number": "integer", "amount": "double", "moment": "datetime", "day": "date"}


def text_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as text cells, some of which do not have the type they should."""
    events = table(spark, folder, "events")
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.when(kind == "error", F.col("props")).otherwise(F.regexp_substr("props", F.lit(r"\d+"))).alias("number"),
        F.when(kind != "error", F.concat(F.col("value").cast("string"), F.when(kind == "view", "").otherwise("0"))).alias("amount"),
        F.when(kind == "click", F.substring(moment, 1, 10)).otherwise(F.concat(moment, F.lit(".000"))).alias("moment"),
        F.when(kind == "click", F.substring(moment, 3, 8)).otherwise(moment).alias("day"),
    )


@query
def typed_convert(spark, folder):
    """TYP-1 TYP-2: text cells cast to their types, unparsable ones missing."""
    return convert.convert(text_events(spark, folder), CONVERT_KINDS).withColumn("moment", F.date_format("moment", "yyyy-MM-dd HH:mm:ss"))


@query
def typed_convert_report(spark, folder):
    """TYP-1 TYP-3: parse failures per column with rate and examples."""
    return convert.convert_report(text_events(spark, folder), CONVERT_KINDS)


def line_rules() -> list[rules.Rule]:
    return [
        rules.not_null("flag").at(0.25, 0.5),
        rules.matches("flag", "^[A-Z]$"),
        rules.matches("l_linestatus", "^[F]$").at(0.0001, 0.001),
        rules.in_set("flag", ["A"]).at(0.5, 0.9),
        rules.in_set("l_linestatus", ["O", "F"], na_pass=False),
        rules.not_in_set("l_returnflag", ["R"]).at(0.9, 0.95),
        rules.at_least("l_discount", 0.02).at(0.1, 0.5),
        rules.above("l_tax", 0.0).at(0.1, 0.9),
        rules.between("l_quantity", 1.0, 50.0),
        rules.holds("discount below tax", F.col("l_discount") <= F.col("l_tax")).at(0.2, 0.9),
        rules.ordered("l_linenumber", "l_partkey").at(0.01, 0.1),
        rules.valid_text("l_returnflag"),
        rules.in_lookup("l_suppkey").at(0.0001, 0.9),
    ]


@query
def rules_report(spark, folder):
    """DQ-1..7 DQ-11: all row rules over the order lines in one aggregation."""
    lines = table(spark, folder, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    solvent = table(spark, folder, "supplier").where("s_acctbal > 0")
    return rules.evaluate(rules.flag_known(lines, solvent, "s_suppkey", ["l_suppkey"]), line_rules())


@query
def rules_conditional(spark, folder):
    """DQ-9 DQ-10: rules on the rows with a code, and on aggregates of the table."""
    orders = case_orders(spark, folder).withColumn("label", codes.recode_strict(F.col("o_orderstatus"), STATUS_LABELS))
    finished = F.col("o_orderstatus") == "F"
    return rules.evaluate(
        orders,
        [
            rules.not_null("label").when(F.col("decision").isNotNull()).at(0.01, 0.05),
            rules.not_null("completion_day").when(finished).at(0.01, 0.05),
            rules.above("o_totalprice", 1000.0).when(~finished).at(0.0001, 0.001),
            rules.aggregate_holds("3 to 5 statuses", F.count_distinct("o_orderstatus").between(3, 5)),
            rules.aggregate_holds("one urgent order", F.count_if(F.col("decision") == "1-URGENT") >= 1),
        ],
    )


@query
def rules_distinct(spark, folder):
    """DQ-8: a key that repeats and one that does not."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return rules.distinct_rows(lines, ["l_orderkey", "l_linenumber"], 0.001, 0.01).unionByName(
        rules.distinct_rows(orders, ["o_orderkey"])
    )


# --- profiles and releases ----------------------------------------------------------------------------


def releases(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders as a new release (all) and an old one (before a day, other columns, other gaps)."""
    orders = case_orders(spark, folder)
    old = orders.where(F.col("order_day") < F.lit(SPLIT_DAY)).select(
        "o_custkey",
        "o_orderkey",
        (F.col("o_totalprice") * F.when(F.col("o_orderstatus") == "F", 2.0).otherwise(1.0)).alias("o_totalprice"),
        F.date_add("order_day", 5000).alias("order_day"),
        "completion_day",
        F.when(F.col("o_orderstatus") != "P", F.col("decision")).alias("decision"),
        F.col("o_orderstatus").alias("old_status"),
    )
    return orders, old


@query
def global_stats(spark, folder):
    """AG-5: counts, distinct counts, mean and maxima of the orders."""
    return profile.global_stats(
        case_orders(spark, folder),
        n=F.count("*"),
        open_orders=F.count_if(F.col("completion_day").isNull()),
        customers=F.count_distinct("o_custkey"),
        mean_price=F.round(F.avg("o_totalprice"), 4),
        top_price=F.max("o_totalprice"),
        last_day=F.max("order_day"),
    )


@query
def missingness_long(spark, folder):
    """AG-6: share of missing values per column."""
    return profile.missingness(case_orders(spark, folder))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query
def column_profile(spark, folder):
    """AG-7 SET-1: profiles of both releases under each other."""
    return _rounded(profile.combined_profile(*releases(spark, folder)))


@query
def column_distributions(spark, folder):
    """AG-7: distinct values, blanks, flag counts, quartiles and median days of the orders."""
    orders = case_orders(spark, folder).withColumns(
        {"is_open": F.col("o_orderstatus") == "O", "note": F.when(F.col("decision").isNull(), "  ").otherwise(F.col("decision"))}
    )
    return _rounded(profile.distributions(orders))


@query
def profile_join(spark, folder):
    """JN-7: both profiles side by side per type and column."""
    new, old = releases(spark, folder)
    keep = ["kind", "variable", "n_missing", "complete_rate", "mean"]
    return _rounded(
        joins.join_profiles(
            profile.column_profile(new).select(*keep), profile.column_profile(old).select(*keep), ["kind", "variable"]
        )
    )


@query
def drift_flags(spark, folder):
    """AG-8 QA-4: columns whose distribution moved between the releases."""
    new, old = releases(spark, folder)
    return profile.drift_flags(profile.column_profile(new), profile.column_profile(old))


@query
def label_dictionary(spark, folder):
    """AG-9: codes of the sorted distinct names and segments."""
    return profile.label_codes(table(spark, folder, "customer"), ["c_name", "c_mktsegment"])


@query
def label_encode(spark, folder):
    """AG-9: customers with both text columns replaced by their codes."""
    return profile.label_encode(table(spark, folder, "customer"), ["c_name", "c_mktsegment"])[0]


@query
def label_release(spark, folder):
    """AG-9: suppliers with every text column as label codes, under names of at most 32 characters."""
    suppliers = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    named = suppliers.select(
        "s_suppkey",
        F.col("s_name").alias("name_of_the_supplier_as_registered"),
        F.col("n_name").alias("nation_that_the_supplier_delivers_from"),
        F.concat_ws("/", "n_name", F.col("s_suppkey") % 7).alias("nation_that_the_supplier_delivers_frum"),
    )
    return profile.label_release(named)[0]


@query
def release_row_delta(spark, folder):
    """QA-1: row counts of both releases."""
    return profile.row_delta(*releases(spark, folder))


@query
def recency_gap(spark, folder):
    """QA-2: days between the file date and the latest plausible order."""
    return profile.recency(case_orders(spark, folder), "order_day", LAST_MODIFIED, AS_OF)


@query
def schema_delta(spark, folder):
    """QA-3 SET-2: columns added and removed, with the cells they fill."""
    return profile.schema_delta_report(*releases(spark, folder))


@query
def manifest_check(spark, folder):
    """SRC-2: rows per order priority against a manifest that misses the partly delivered ones of two."""
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderpriority", "table_name")
    counts = orders.groupBy("table_name").agg(F.count("*").alias("actual"))
    listed = orders.where("table_name != '3-MEDIUM' and not (o_orderstatus = 'P' and table_name in ('1-URGENT', '2-HIGH'))")
    return delimited.manifest_check(counts, listed.groupBy("table_name").agg(F.count("*").alias("expected")))


@query
def ragged_reader(spark, folder):
    """SRC-1: lines of orders split into cells: short, long, padded and with a carriage return."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = (
        F.when(status == "P", F.concat(key, F.lit("\t")))
        .when(status == "O", F.concat_ws("\t", key, F.concat(F.lit(" "), status), "o_orderpriority", F.lit(""), key))
        .otherwise(F.concat(F.concat_ws("\t", key, status, "o_orderpriority"), F.lit("\r")))
    )
    cells = delimited.split_cells(table(spark, folder, "orders").select(line.alias("value")), ["order_key", "status", "priority"])
    return cells.select("order_key", "status", "priority", F.array_join(repair.OVERFLOW, "|").alias("overflow"))


@query
def manifest_lines(spark, folder):
    """SRC-2: manifest lines made of the nations, some of them without a number or a name."""
    number = F.when(F.col("n_nationkey") % 5 == 1, F.lit("many")).otherwise((F.col("n_nationkey") * 100).cast("string"))
    name = F.when(F.col("n_nationkey") % 5 == 2, F.lit("")).otherwise(F.col("n_name"))
    end = F.when(F.col("n_nationkey") % 5 == 3, F.lit("\r")).otherwise(F.lit(""))
    lines = table(spark, folder, "nation").select(F.concat(name, F.lit("\t"), number, end).alias("value"))
    return delimited.parse_manifest(lines)


@query
def lookup_cleaning(spark, folder):
    """SRC-3: a code table of the suppliers with NUL bytes, loose blanks and empty cells."""
    raw = table(spark, folder, "supplier").select(
        F.concat(F.lit("\x00"), F.col("s_suppkey").cast("string")).alias("strCode"),
        F.concat(F.lit("  "), F.regexp_replace("s_name", "#", "  #\x00"), F.lit(" ")).alias("Supplier Name"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).otherwise(F.lit("x")).alias("blnActive"),
    )
    return delimited.clean_lookup(raw)


# --- repair -----------------------------------------------------------------------------------------------

RAGGED_RULES = repair.ShiftRules(dates=("PLACED", "COMPLETED"), others=("STATUS", "PRIORITY"))


def ragged_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text cells with stray separators.

    Urgent orders have one before STATUS, finished medium ones two before CUSTKEY. Partly delivered
    low ones have one before STATUS and lack the NOTE cell, so that nothing spills over. Partly
    delivered high ones have two before STATUS, which leaves no violation to start from.
    """
    orders = table(spark, folder, "orders")
    lead = [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")]
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    tail = [F.col("o_orderstatus"), stamp, F.col("o_orderpriority"), F.when(F.col("o_orderstatus") != "O", stamp)]
    note, none = F.col("o_orderpriority"), F.lit(None).cast("string")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    double = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "F")
    hidden = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    lost = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    cells = (
        F.when(urgent, F.array(*lead, none, *tail, note))
        .when(double, F.array(lead[0], none, none, lead[1], *tail, note))
        .when(lost, F.array(*lead, none, none, *tail, note))
        .when(hidden, F.array(*lead, none, *tail))
        .otherwise(F.array(*lead, *tail, note))
    )
    names = ["ORDERKEY", "CUSTKEY", "STATUS", "PLACED", "PRIORITY", "COMPLETED", "NOTE"]
    raw = orders.select(cells.alias("cells"))
    extra = F.when(F.size("cells") > len(names), F.slice("cells", len(names) + 1, F.size("cells")))
    return raw.select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)], extra.alias(repair.OVERFLOW))


@query
def ragged_repair(spark, folder):
    """SRC-1 REP-2..4: every shifted order back in its columns."""
    return repair.repair_shifts(ragged_orders(spark, folder), RAGGED_RULES).rows


@query
def ragged_repair_log(spark, folder):
    """REP-4: the audit log of the repair."""
    return repair.repair_shifts(ragged_orders(spark, folder), RAGGED_RULES, row_id="ORDERKEY").log


@query
def ragged_repair_summary(spark, folder):
    """REP-4: rows in, fixed, dropped and out."""
    return repair.repair_shifts(ragged_orders(spark, folder), RAGGED_RULES).summary()


@query
def address_repair(spark, folder):
    """REP-5: customer addresses with a stray cell inside the city, merged and shifted back."""
    names = ["IDNCASE", "ALIEN_CITY", "ALIEN_STATE", "ALIEN_ZIPCODE", "NAT", "E_28_DATE", "CUSTODY"]
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    rest = [F.lit("CA"), F.concat(F.lit("9"), key), F.lit("MX"), F.lit("2001-02-03 00:00:00"), F.lit("D")]
    none = F.lit(None).cast("string")
    cells = (
        F.when(segment == "BUILDING", F.array(key, F.lit("EAST"), segment, *rest))
        .when(segment == "FURNITURE", F.array(key, none, segment, *rest))
        .when(segment == "MACHINERY", F.array(key, segment, F.lit("XX"), *rest))
        .otherwise(F.array(key, segment, *rest))
    )
    raw = table(spark, folder, "customer").select(cells.alias("cells"))
    extra = F.when(F.size("cells") > len(names), F.slice("cells", len(names) + 1, F.size("cells")))
    ragged = raw.select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)], extra.alias(repair.OVERFLOW))
    return repair.repair_shifts(ragged, specs.CASES.shift).rows


# --- the stages and the final table over the tables as raw extracts ---------------------------------------


def _days(df: DataFrame) -> DataFrame:
    return columns.map_columns(df, lambda f: f.dataType.simpleString() == "timestamp", values.utc_date)


def _stage(build: Callable[..., stages.Stage], name: str, spark: SparkSession, folder: str, *more: object) -> DataFrame:
    raw = getattr(extracts, name)(with_small_methods(spark), folder)
    return _days(build(raw, extracts.lookups(spark, folder), *more).table)


@query
def stage_proceedings(spark, folder):
    """Stage: orders as proceedings, repaired, typed and collapsed per case."""
    return _stage(stages.proceedings, "proceedings", spark, folder)


@query
def stage_cases(spark, folder):
    """Stage: customers as the case table."""
    return _stage(stages.cases, "cases", spark, folder, AS_OF)


@query
def stage_custody(spark, folder):
    """Stage: events as detention spells, the first four per case."""
    return _stage(stages.custody, "custody", spark, folder)


@query
def stage_appeals(spark, folder):
    """Stage: the last appeal per case."""
    return _stage(stages.appeals, "appeals", spark, folder)


@query
def stage_applications(spark, folder):
    """Stage: the last decision per kind of application."""
    return _stage(stages.applications, "applications", spark, folder)


@query
def stage_bonds(spark, folder):
    """Stage: first, second and last bond hearing per case."""
    return _stage(stages.bonds, "bonds", spark, folder)


@query
def stage_charges(spark, folder):
    """Stage: the first four charges per case."""
    return _stage(stages.charges, "charges", spark, folder)


@query
def court_decision_lookups(spark, folder):
    """PRJ-4 FLT-1: the decision lookup split by kind."""
    decided, other = stages.court_decisions(extracts.lookups(spark, folder))
    return decided.select(F.lit("C").alias("kind"), "case_type_code", F.col("dec_code").alias("code"), F.col("case_outcome").alias("label")).unionByName(
        other.select(F.lit("O").alias("kind"), "case_type_code", F.col("other_comp").alias("code"), F.col("other_completion").alias("label"))
    )


def _written_lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Lookups, each written once; so are the codes that they are made of, which take a scan of the large tables."""
    def kept(df: DataFrame, name: str) -> DataFrame:
        return written(df.coalesce(1), name)

    return {n: kept(df, n) for n, df in extracts.lookups(with_small_methods(spark), folder, kept).items()}


def _by_case(stage: stages.Stage) -> DataFrame:
    """The by-case table of a stage; rows that are collapsed in two reads are written before, so that they are typed once."""
    return stage.collapse(written(stage.rows(stage.checked), f"{stage.spec.name}.rows")) if stage.read_twice else stage.table


def _written_stages(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """By-case tables in buckets and lookups, each written once and read again as the job does."""
    lookups = _written_lookups(spark, folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    built = stages.all_stages(extracts.sources(spark, folder), lookups, AS_OF)
    return {n: tables.write_bucketed(_by_case(s), work_folder(spark, n), "idncase", buckets) for n, s in built.items()}, lookups


@query
def release_table(spark, folder):
    """All stages and the final join over whole tables: one row per case, every column of the release."""
    built, lookups = _written_stages(spark, folder)
    return final.build_final(built, lookups, extracts.crosswalk(spark, folder)).select(*final.column_order())


# --- evidence: what a job counts in the files that it has committed -----------------------------------------


@query
def stage_counts(spark, folder):
    """SRC-2 REP-4: rows of every source table in and out of the repair, counted in committed files and held against a manifest."""
    parts, spark = None, with_small_methods(spark)
    for spec in specs.TABLES:
        marked = repair.repair_shifts(getattr(extracts, spec.name)(spark, folder), spec.shift).marked
        counts = repair.counts_of(written(marked.select(repair.MEND), spec.name)).select(
            F.lit(spec.name).alias("table_name"), "rows_in", "fixed", "dropped", "dropped_after_fix", "rows_out"
        )
        parts = counts if parts is None else parts.unionByName(counts)
    sizes = {"proceedings": "orders", "cases": "customer", "custody": "events", "charges": "lineitem", "bonds": "orders"}
    manifest = None
    for name, source in sizes.items():  # the manifest lacks two tables and is wrong about the bonds
        line = table(spark, folder, source).agg((F.count(F.lit(1)) - (7 if name == "bonds" else 0)).alias("expected")).select(F.lit(name).alias("table_name"), "expected")
        manifest = line if manifest is None else manifest.unionByName(line)
    checked = delimited.manifest_check(parts.select("table_name", F.col("rows_in").alias("actual")), manifest)
    return parts.join(checked.select("table_name", "expected", "level"), "table_name")


@query
def untouched_fingerprint(spark, folder):
    """REP-4: sums of row prints show that the repair left alone what it had no reason to touch."""
    raw = ragged_orders(spark, folder)
    sums = repair.repair_shifts(raw, RAGGED_RULES).fingerprints(raw)
    return sums.select(*[F.col(c).cast("string").alias(c) for c in ("print_before", "print_touched", "print_after")], "unchanged")


@query
def stage_rules(spark, folder):
    """DQ-1..7 TYP-1 DQ-3: the rule lines of all seven stages, from marks and codes in committed rows."""
    lookups = _written_lookups(spark, folder)
    lines = None
    for name, stage in stages.all_stages(extracts.sources(spark, folder), lookups, AS_OF).items():
        checked = written(stage.checked, f"{name}.rows")
        found = stage.row_lines(checked)
        result = stage.result_lines(written(stage.collapse(stage.rows(checked)), name))
        found = found if result is None else found.unionByName(result)
        lines = found if lines is None else lines.unionByName(found)
    return lines


@query
def final_rules(spark, folder):
    """DQ-1..9: the rule lines of the assembled cases, before the cohort filter."""
    built, lookups = _written_stages(spark, folder)
    return final.final_lines(written(final.assembled(built, lookups, extracts.crosswalk(spark, folder)), "assembled"), lookups)


@query
def lookup_duplicates(spark, folder):
    """JN-3 DQ-8: keys of several lookups that occur twice, found at once, with the rows that use them."""
    nation, supplier = table(spark, folder, "nation"), table(spark, folder, "supplier")
    regions = nation.select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("label"))
    pairs = supplier.select("s_nationkey", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_suppkey") % 3).alias("grade"))
    twice = joins.duplicate_keys({
        "nation": (nation, ["n_nationkey"]), "region": (regions, ["region"]), "supplier": (pairs, ["s_nationkey", "grade"])
    })
    customers = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 9).alias("region"),
        F.concat_ws("|", "c_nationkey", (F.col("c_custkey") % 4).cast("string")).alias("graded"),
    )
    return joins.used_duplicates(twice, customers, [("nation", "nation"), ("region", "region"), ("supplier", "graded")])


@query
def share_crosswalk(spark, folder):
    """SRC-5 AG-10: a crosswalk from share files, territories in the place of what the shares say."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    area = F.lpad((F.col("s_suppkey") % 40).cast("string"), 5, "0")
    county = F.lpad(F.col("s_nationkey").cast("string"), 5, "0")
    shares = supplier.groupBy(area.alias("zcta"), "s_nationkey").agg(F.max("s_acctbal").alias("share"))
    counties = shares.select("zcta", county.alias("county_fips_code"), F.concat(F.lit("County "), "s_nationkey").alias("county"), "share")
    places = shares.where("s_nationkey % 2 = 0").select(
        "zcta", F.lpad(F.col("s_nationkey").cast("string"), 7, "0").alias("place_fips_code"), F.concat(F.lit("place "), "s_nationkey").alias("place"), "share"
    )
    states = nation.select(F.substring(F.lpad(F.col("n_nationkey").cast("string"), 5, "0"), 1, 2).alias("state_fips_code"), F.lit("CA").alias("state")).distinct()
    territories = nation.where("n_regionkey = 0").select(
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zcta"), F.lit("PR").alias("state"), F.lit("72").alias("state_fips_code"),
        F.col("n_name").alias("county"), F.lpad((F.col("n_nationkey") + 72000).cast("string"), 5, "0").alias("county_fips_code"),
        F.lit(None).cast("string").alias("place"), F.lit(None).cast("string").alias("place_fips_code"),
    )
    made = areas.with_territories(areas.build_crosswalk(counties, places, states), territories)
    raw = made.select(
        "zcta", F.col("state").alias("stusps"), F.col("county_fips_code").alias("county_geoid"), "county", F.col("place_fips_code").alias("place_geoid"), "place"
    )
    return tables.crosswalk_columns(written(raw, "crosswalk"))


@query
def ragged_files(spark, folder):
    """SRC-1: orders as several files of lines, each with the header, and data lines that equal it."""
    names = ["ORDERKEY", "STATUS", "PRIORITY"]
    orders = table(spark, folder, "orders")
    odd = F.col("o_orderkey") % 50 == 0
    cells = [F.when(odd, F.lit(n)).otherwise(F.col(c).cast("string")).alias(n) for n, c in zip(names, ("o_orderkey", "o_orderstatus", "o_orderpriority"))]
    path = work_folder(spark, "lines")
    orders.repartition(3, "o_orderkey").select(*cells).write.option("header", "true").option("sep", "\t").option("quote", "\x00").csv(path)
    return delimited.read_ragged(spark, path).select(*names)


@query
def broken_text(spark, folder):
    """DQ-11: texts that end in half a character or hold a replacement character."""
    half = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C3"))).cast("string")
    docs = table(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, half).when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("\ufffd"))).when(F.col("doc_id") % 11 != 0, F.col("text")).alias("text"),
        "lang",
    )
    return rules.evaluate(docs, [rules.valid_text("text").at(0.1, 0.9), rules.valid_text("text", na_pass=False).at(0.0001, 0.3), rules.valid_text("lang")])


@query
def release_check(spark, folder):
    """QA-1..4 SRC-6: what a release is checked for against the one before, as rows."""
    new, old = releases(spark, folder)
    return reports.release_check(new, old, "order_day", LAST_MODIFIED, AS_OF)


@query
def release_check_first(spark, folder):
    """QA-1..2 SRC-6: the same for a first release, which has none before it."""
    new, _ = releases(spark, folder)
    missing = tables.read_optional(spark, f"{folder}/no-earlier-release")
    return reports.release_check(new, missing, "order_day", LAST_MODIFIED, AS_OF)
