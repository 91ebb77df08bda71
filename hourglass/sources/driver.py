"""Adapters from the driver's parquet tables to the library's data model.

The library works on a few canonical shapes (SURVEY section 1):

* stays       one row per stay: ``stay, person, admit_ts, discharge_ts,
              los_days, discharge_offset, age, mortality, discharge_location``
* events      long entity-attribute-value rows:
              ``stay, ts, feature, value, source``
* flat        one row per stay of static attributes
* code rows   ``stay, path, offset_min`` hierarchical code strings
* predictions ``y_true, y_pred`` (regression) / ``y_true, p`` (classification)

The mapping onto the test tables (``events``, ``customer``, ``nation``,
``region``, ``orders``, ``lineitem``, ``part``, ``labels``, ``documents``) is
fixed here, and mirrored one-to-one by the SQL in ``hourglass.plans.oracle``.
Every adapter is a lazy DataFrame over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators.joins import star_join
from hourglass.sources.io import scan_parquet

# Fixed values of the mapping (shared with the oracle SQL).
ADMIT_EVENT = "signup"          # first event of this type = unit admission
DISCHARGE_EVENT = "purchase"    # last event of this type = unit discharge
EXPIRED_BELOW_BALANCE = 500.0   # c_acctbal below this -> mortality 'EXPIRED'
FEATURE_BUCKETS = 10            # feature label = event_type || '_' || (k mod 10)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return scan_parquet(spark, d, name)


def age_text(acctbal) -> F.Column:
    """Age as text derived from the balance: ``'> 89'`` above 89, ``''`` below 5."""
    age = F.floor((acctbal + F.lit(1000.0)) / F.lit(110.0)).cast("int")
    return (F.when(age > 89, F.lit("> 89"))
            .when(age < 5, F.lit(""))
            .otherwise(age.cast("string")))


def stays(spark: SparkSession, d: str) -> DataFrame:
    """Stay (label) table: one row per event user joined with its customer row."""
    ev = _t(spark, d, "events").select("user_id", "ts", "event_type")
    spans = (ev.groupBy(F.col("user_id").alias("stay"))
             .agg(F.min(F.when(F.col("event_type") == ADMIT_EVENT, F.col("ts"))).alias("admit_ts"),
                  F.max(F.when(F.col("event_type") == DISCHARGE_EVENT, F.col("ts"))).alias("discharge_ts")))
    cust = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("stay"), F.col("c_nationkey").alias("person"),
        F.col("c_acctbal"), F.col("c_mktsegment"))
    out = spans.join(cust, "stay", "inner")
    return out.select(
        "stay", "person", "admit_ts", "discharge_ts",
        H.days_between("admit_ts", "discharge_ts").alias("los_days"),
        H.minutes_between("admit_ts", "discharge_ts").alias("discharge_offset"),
        age_text(F.col("c_acctbal")).alias("age"),
        F.when(F.col("c_acctbal") < EXPIRED_BELOW_BALANCE, F.lit("EXPIRED"))
         .otherwise(F.lit("ALIVE")).alias("mortality"),
        F.col("c_mktsegment").alias("discharge_location"),
    )


def event_k() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("int")


def events(spark: SparkSession, d: str) -> DataFrame:
    """Long events ``(stay, ts, feature, value, source)`` from ``events``."""
    ev = _t(spark, d, "events")
    feature = F.concat(F.col("event_type"), F.lit("_"),
                       F.pmod(event_k(), F.lit(FEATURE_BUCKETS)).cast("string"))
    return (ev.select(F.col("user_id").alias("stay"), "ts", feature.alias("feature"),
                      H.nan_to_null("value").alias("value"), F.lit("events").alias("source"))
            .where(F.col("feature").isNotNull()))


#: Features of the wide source: one column each, always encoded.
MONITOR_FEATURES = ("monitor_k", "monitor_value")


def event_sources(spark: SparkSession, d: str, sources=("events", "props")) -> DataFrame:
    """Several sources from ONE scan of ``events``, long and wide ones together.

    ``events`` and ``props`` are long sources (a label and a value a row), ``alarms`` a long one that
    only some events feed (so some stays lack it), ``monitor`` a wide one: its two columns become two features.  Every event row
    carries an array of the entries that it has for the requested sources; ``explode`` turns them into
    rows, so the table is read once, however many sources and columns there are.
    """
    ev = _t(spark, d, "events")
    label = F.concat(F.col("event_type"), F.lit("_"), F.pmod(event_k(), F.lit(FEATURE_BUCKETS)).cast("string"))
    k, value, alarm = event_k().cast("double"), H.nan_to_null("value"), (F.col("event_type") == "error") & (event_k() % 16 == 0)
    entries = {"events": [(F.lit(True), label, value)], "props": [(F.lit(True), label, k)], "alarms": [(alarm, label, k)],
               "monitor": [(alarm, F.lit("monitor_k"), k), (alarm, F.lit("monitor_value"), value)]}
    parts = [F.struct((when & feature.isNotNull()).alias("there"), F.lit(s).alias("source"), feature.alias("feature"),
                      v.alias("value")) for s in sources for when, feature, v in entries[s]]
    x = ev.select(F.col("user_id").alias("stay"), "ts", F.explode(F.array(*parts)).alias("_s"))
    return x.where(F.col("_s.there")).select("stay", "ts", "_s.feature", "_s.value", "_s.source")


def text_values(spark: SparkSession, d: str) -> DataFrame:
    """Text-valued chart rows: numbers, numbers with ``%`` and non-numeric junk."""
    ev = _t(spark, d, "events")
    k = event_k()
    txt = (F.when(F.col("event_type") == "error", F.lit("n/a"))
           .when(F.col("event_type") == "click", F.concat(k.cast("string"), F.lit("%")))
           .otherwise(F.col("value").cast("string")))
    return ev.select(F.col("event_id"), F.col("user_id").alias("stay"),
                     F.col("event_type").alias("feature"), txt.alias("value_text"))


def flat(spark: SparkSession, d: str, stay_table: DataFrame | None = None) -> DataFrame:
    """Static table: customer x nation x region for every stay (star join C2).

    Pass an already computed (e.g. persisted cohort) stay table to avoid
    re-aggregating ``events``.
    """
    st = (stays(spark, d) if stay_table is None else stay_table).select("stay", "admit_ts", "age")
    cust = _t(spark, d, "customer")
    nation = _t(spark, d, "nation")
    region = _t(spark, d, "region")
    # nation (25 rows) and region (5 rows) do not grow with the data
    j = star_join(cust, [(nation, cust.c_nationkey == nation.n_nationkey, True),
                         (region, nation.n_regionkey == region.r_regionkey, True),
                         (st, cust.c_custkey == st.stay, False)], distinct=False)
    seg = F.col("c_mktsegment")
    return j.select(
        "stay",
        F.when(seg.isin("MACHINERY", "BUILDING"), F.lit("Male"))
         .when(seg.isin("HOUSEHOLD", "FURNITURE"), F.lit("Female"))
         .otherwise(F.lit("Unknown")).alias("gender"),
        F.when(F.col("r_name").isin("AMERICA", "EUROPE"), F.lit("t")).otherwise(F.lit("f"))
         .alias("teachingstatus"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        seg.alias("segment"),
        "age",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 50.0).alias("height"),
        F.when(seg != "AUTOMOBILE", (F.col("c_acctbal") + 1000.0) / 100.0).alias("weight"),
        F.hour("admit_ts").alias("hour"),
        F.col("c_acctbal").alias("balance_after_24h"),
    )


# The family prefixes and boilerplate of the hierarchical code strings.
ADMISSION_PREFIX = "admission diagnosis|"
ADMISSION_ALL = "All Diagnosis|"
ADMISSION_APACHE = "Additional APACHE  Information|"
PAST_ORGAN = "notes/Progress Notes/Past History/Organ Systems/"
PAST_OPTIONS = "notes/Progress Notes/Past History/Past History Obtain Options/"


def code_sources(spark: SparkSession, d: str, stays: DataFrame | None = None) -> dict[str, DataFrame]:
    """Three code sources ``(stay, path, offset_min)`` like diagnosis/admission/history.

    With ``stays`` the cohort filter is applied to ``orders`` and ``customer``
    *before* the line-item join, so only the cohort's line items are joined.
    """
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    od = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = _t(spark, d, "customer")
    if stays is not None:
        ids = stays.select(F.col("stay").alias("_id"))
        od = od.join(ids, od.o_custkey == ids._id, "left_semi")
        cust = cust.join(ids, cust.c_custkey == ids._id, "left_semi")
    pt = _t(spark, d, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    diag = (li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
            .select(F.col("o_custkey").alias("stay"),
                    F.concat_ws("|", "p_type", "p_brand", "p_name").alias("path"),
                    ((F.col("l_linenumber") - 1) * 90).alias("offset_min")))
    nation = _t(spark, d, "nation")
    region = _t(spark, d, "region")
    c = (cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
             .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    seg = F.col("c_mktsegment")
    admit = c.select(
        F.col("c_custkey").alias("stay"),
        F.when(F.col("c_acctbal") < 0,
               F.concat(F.lit(ADMISSION_PREFIX + ADMISSION_APACHE), F.lit("Negative balance|"),
                        F.col("r_name")))
         .otherwise(F.concat(F.lit(ADMISSION_PREFIX + ADMISSION_ALL), seg, F.lit("|"),
                             F.lower(seg), F.lit("|"), F.col("n_name"))).alias("path"),
        F.lit(0).alias("offset_min"))
    history = c.select(
        F.col("c_custkey").alias("stay"),
        F.when(F.col("c_acctbal") > 9000, F.lit("notes/Other/unrouted"))
         .when(F.col("c_acctbal") > 5000,
               F.concat(F.lit(PAST_OPTIONS), F.lit("Performed")))
         .otherwise(F.concat(F.lit(PAST_ORGAN), F.col("r_name"), F.lit("/"), F.col("n_name"),
                             F.lit("/"), seg)).alias("path"),
        (F.col("c_nationkey") * 20).alias("offset_min"))
    return {"diagnosis": diag, "admission": admit, "history": history}


def los_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Regression pairs: per order, true LoS = sum(quantity)/10, prediction from price."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    od = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    per = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    return (od.join(per, od.o_orderkey == per.l_orderkey)
              .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("stay"),
                      (F.col("qty") / 10.0).alias("y_true"),
                      (F.col("o_totalprice") / 40000.0).alias("y_pred")))


def risk_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Classification pairs: ``labels.toxic`` vs a logistic score of document length."""
    lab = _t(spark, d, "labels").select("doc_id", "toxic")
    doc = _t(spark, d, "documents").select("doc_id", "n_chars", "source")
    j = lab.join(doc, "doc_id")
    return j.select("doc_id", "source", F.col("toxic").cast("double").alias("y_true"),
                    H.risk_link(F.ln(F.col("n_chars") + F.lit(1.0)) - F.lit(7.0)).alias("p"))
