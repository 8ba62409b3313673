"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver tables of ``sf_dir`` (or fixtures Spark derives
from them) in full. Names follow SURVEY 7.3; the DuckDB oracles live in
``pitfeat.oracles`` under the same names.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import aggregates as AG
from .functions.scalar import register_distance, split_bucket, years_365
from .operators import lookup as L
from .operators import quality as Q
from .operators import reshape as X
from .operators import rolling as R
from .operators import scd as S
from .plans import ml as M
from .plans import shap as SH
from .plans import training as T
from .plans.binned import BinnedTree, fit_binned_tree
from .session import materialize, scratch_path
from .sources import catalog as C
from .sources.tables import Tables
from .specs import (Agg, AggregateSpec, FeatureAggregation, FeatureFunction, FeatureLookup, FeatureSpec,
                    Lookback, TableSpec, expand_search_space)
from .streaming import changes as CH
from .streaming import jobs as ST
from .streaming import ring as RI

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rollups(t: Tables) -> DataFrame:
    """Sparse time-series feature table: 7/14-day totals per account at each active day."""
    spec = R.rolling_7_14_spec("account_id", "txn_date", "amount")
    out = R.aggregate_features(t.txn_orders(), spec, mode="facts")
    return out.withColumnRenamed("txn_date", "date")


@query
def rolling_7_14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (W1-W3, F6): rollups per account at every day it transacts."""
    return rollups(Tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------

REQUEST_DAY = "2000-06-15"


def feature_tables(t: Tables) -> dict[str, T.FeatureTable]:
    """The reference's three feature tables, re-derived from the driver tables."""
    return {
        "rollups": T.FeatureTable(rollups(t), TableSpec("account_id", time_key="date")),
        "merchants": T.FeatureTable(t.merchants(), TableSpec("merchant_id")),
        "accounts": T.FeatureTable(t.accounts_scd2(), TableSpec("account_id", time_key="valid_from"),
                                   valid_to="valid_to"),
    }


def fraud_features(spark: SparkSession) -> list:
    """The fraud-model lookups: rollups as-of, merchant exact, account as-of, distance."""
    register_distance(spark)
    return [
        FeatureLookup("rollups", ["14_day_total", "7_day_total", "7_day_transaction_count"],
                      "primary_account_number", time_key="observation_date"),
        FeatureLookup("merchants", ["merchant_zone"], "merchant_id"),
        FeatureLookup("accounts", ["zone"], "primary_account_number", time_key="observation_date"),
        FeatureFunction("distance", {"from_zone": "zone", "to_zone": "merchant_zone"},
                        "merchant_distance_from_home"),
    ]


def request_spine(t: Tables, day: str = REQUEST_DAY) -> DataFrame:
    """Requests of one day (T4, P8, P9): the date literal is compared as a string."""
    e = t.eol()
    return e.where(F.col("observation_date") == F.lit(day)).select(
        "primary_account_number", "merchant_id", F.to_date(F.lit(day)).alias("observation_date"), "amount")


# ---------------------------------------------------------------------------
# scans, views, simple aggregates
# ---------------------------------------------------------------------------
@query
def spine_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EOL view: card-present transactions with casts."""
    return Tables(spark, sf_dir).eol()


@query
def view_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine through a named view, read by SQL."""
    C.create_view(Tables(spark, sf_dir).eol(), "eol_spine")
    return spark.sql("SELECT * FROM eol_spine")


@query
def request_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_spine(Tables(spark, sf_dir))


@query
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global min / max transaction date (A2)."""
    x = Tables(spark, sf_dir).txn_lines()
    return x.agg(F.max("txn_date").alias("max"), F.min("txn_date").alias("min"))


@query
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sum and activity flag per (account, day)."""
    return R.daily_totals(Tables(spark, sf_dir).txn_lines(), "account_id", "txn_date", "amount")


# ---------------------------------------------------------------------------
# lookups
# ---------------------------------------------------------------------------
@query
def lookup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 merchant lookup; dangling merchants give NULL."""
    t = Tables(spark, sf_dir)
    return L.lookup_exact(t.eol(), t.merchants(), "merchant_id", "merchant_id",
                          ["merchant_name", "merchant_zone"])


def ship_spine(t: Tables) -> DataFrame:
    return t.txn_lines().select("transaction_id", F.col("account_id").alias("primary_account_number"),
                                F.col("ship_date").alias("observation_date"))


@query
def lookup_asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of the ship date, the latest rollup row of the account."""
    t = Tables(spark, sf_dir)
    r = L.AsOfRight(rollups(t), ["account_id"], "date",
                    ["14_day_total", "7_day_total", "7_day_transaction_count"])
    return L.lookup_asof(ship_spine(t), [r], "primary_account_number", "observation_date")


def _scd2_right(t: Tables) -> L.AsOfRight:
    return L.AsOfRight(t.accounts_scd2(), ["account_id"], "valid_from", ["zone", "account_name"],
                       valid_to="valid_to")


@query
def lookup_asof_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account version valid at the observation date, by valid_from."""
    t = Tables(spark, sf_dir)
    return L.lookup_asof(t.eol(), [_scd2_right(t)], "primary_account_number", "observation_date")


@query
def lookup_asof_scd2_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same answer through the size-checked broadcast plan."""
    t = Tables(spark, sf_dir)
    return L.lookup_asof(t.eol(), [_scd2_right(t)], "primary_account_number", "observation_date",
                         strategy="broadcast")


@query
def lookup_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """valid_from <= t < valid_to; equals the as-of answer here."""
    t = Tables(spark, sf_dir)
    return L.lookup_interval(t.eol(), t.accounts_scd2(), "primary_account_number", "account_id",
                             "observation_date", "valid_from", "valid_to", ["zone", "account_name"])


@query
def lookup_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal range join (equi-join + residual range), for comparison."""
    t = Tables(spark, sf_dir)
    return L.lookup_interval(t.eol(), t.accounts_scd2(), "primary_account_number", "account_id",
                             "observation_date", "valid_from", "valid_to", ["zone", "account_name"],
                             strategy="join")


@query
def function_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bound SQL function over two looked-up zones."""
    t = Tables(spark, sf_dir)
    feats = fraud_features(spark)[1:]
    df, _ = T.compile_features(t.eol(), feats, feature_tables(t))
    return df


# ---------------------------------------------------------------------------
# training / inference sets
# ---------------------------------------------------------------------------
# Keys, times and inputs of functions are no model inputs. ``customer_id``, which
# no frame here has, stays in the first list alone, to show that absent names are ignored.
TRAIN_EXCLUDE = ["transaction_id", "customer_id", "observation_date", "merchant_id",
                 "merchant_zone", "zone"]
INFER_EXCLUDE = ["transaction_id", "observation_date", "merchant_zone", "zone"]


@query
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine + lookups + function, label kept, exclusions."""
    t = Tables(spark, sf_dir)
    return T.training_set(t.eol(), fraud_features(spark), feature_tables(t), label="label",
                          exclude=TRAIN_EXCLUDE)


@query
def saved_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set written over an earlier table with another schema, and read back."""
    path = scratch_path(spark, "training-set")
    C.save_table(Tables(spark, sf_dir).merchants(), "", path=path)
    C.save_table(training_set(spark, sf_dir), "", path=path)
    return spark.read.parquet(path)


@query
def input_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two rows of the training set in a fixed order."""
    return C.input_example(training_set(spark, sf_dir), 2)


@query
def chained_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups keyed on earlier lookups' outputs: a line's account, its zone at shipping, the zone's name."""
    t = Tables(spark, sf_dir)
    spine = t.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                                     F.to_date("l_shipdate").alias("observation_date"))
    tables = {"orders": T.FeatureTable(t.txn_orders(), TableSpec("transaction_id")),
              "accounts": feature_tables(t)["accounts"],
              "zones": T.FeatureTable(t.raw("nation"), TableSpec("n_nationkey"))}
    feats = [FeatureLookup("orders", ["account_id"], "order_id", rename={"account_id": "primary_account_number"}),
             FeatureLookup("accounts", ["zone"], "primary_account_number", time_key="observation_date"),
             FeatureLookup("zones", ["n_name"], "zone", rename={"n_name": "zone_name"})]
    return T.compile_features(spine, feats, tables)[0]


@query
def training_set_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set without same-day leakage (H3): rollups as of the day
    before the observation (strict as-of), everything else unchanged."""
    t = Tables(spark, sf_dir)
    feats = fraud_features(spark)
    feats[0] = FeatureLookup("rollups", ["14_day_total", "7_day_total", "7_day_transaction_count"],
                             "primary_account_number", time_key="observation_date", strict=True)
    return T.training_set(t.eol(), feats, feature_tables(t), label="label", exclude=TRAIN_EXCLUDE)


@query
def inference_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same lookups, keys kept by a different exclusion list."""
    t = Tables(spark, sf_dir)
    return T.training_set(t.eol(), fraud_features(spark), feature_tables(t), label="label",
                          exclude=INFER_EXCLUDE)


# ---------------------------------------------------------------------------
# windowed aggregates: spine, facts and grid evaluation
# ---------------------------------------------------------------------------


# The search space, 2x2 plain windows + 2x2x2 offset windows
SEARCH_SPACE = [
    {"column": "amount", "window": [15, 30], "function": ["avg", "sum"]},
    {"column": "amount", "window": [5, 10], "offset": [5, 10], "function": ["avg", "sum"]},
]
EOL_ON = {"primary_account_number": "account_id", "observation_date": "txn_date"}
GRID_START = _dt.datetime(2023, 1, 1)


def search_space_spec() -> AggregateSpec:
    return AggregateSpec("account_id", "txn_date", expand_search_space(SEARCH_SPACE))


def search_space_features(t: Tables) -> DataFrame:
    """EOL spine with the 12 search-space aggregates of all lines."""
    return R.aggregate_features(t.txn_lines(), search_space_spec(), spine=t.eol(), on=EOL_ON)


@query
def search_space_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_space_features(Tables(spark, sf_dir))


@query
def window_avg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-day AVG and SUM at every active (user, day) of dense purchase events."""
    spec = AggregateSpec("account_id", "txn_date", [Agg("amount", "avg", Lookback(30)),
                                                    Agg("amount", "sum", Lookback(30))])
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="facts")


@query
def window_offset_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-day SUM shifted back 2 days (W5): the reference's offset=-2 days."""
    spec = AggregateSpec("account_id", "txn_date",
                         [Agg("amount", "sum", Lookback(5, offset=_dt.timedelta(days=-2)))])
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="facts")


@query
def window_closed_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-day leakage (H3): 7-day sums including and excluding the scored day."""
    t = Tables(spark, sf_dir)
    spec = AggregateSpec("account_id", "txn_date", [
        Agg("amount", "sum", Lookback(7)), Agg("amount", "sum", Lookback(7, closed="left")),
        Agg("amount", "count", Lookback(7)), Agg("amount", "count", Lookback(7, closed="left"))])
    return R.aggregate_features(t.txn_lines(), spec, spine=t.eol(), on=EOL_ON)


@query
def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7-day COUNT of purchases and active days per (user, day)."""
    spec = AggregateSpec("account_id", "txn_date", [Agg("amount", "count", Lookback(7)),
                                                    Agg("amount", "active_days", Lookback(7)),
                                                    Agg("amount", "min", Lookback(7)),
                                                    Agg("amount", "max", Lookback(7))])
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="facts")


@query
def window_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct merchants in 30 days, mergeable HLL sketches (A5)."""
    t = Tables(spark, sf_dir)
    spec = AggregateSpec("account_id", "txn_date",
                         [Agg("merchant_id", "approx_count_distinct", Lookback(30))])
    return R.aggregate_features(t.txn_lines(), spec, spine=t.eol(), on=EOL_ON)


HOUR = _dt.timedelta(hours=1)


@query
def window_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-grain windows over purchase events: 6-hour sum, 24-hour count, and a
    3-hour average ending an hour back, at every (user, hour) with purchases."""
    spec = AggregateSpec("account_id", "ts", [
        Agg("amount", "sum", Lookback(6 * HOUR)), Agg("amount", "count", Lookback(24 * HOUR)),
        Agg("amount", "avg", Lookback(3 * HOUR, offset=HOUR))], granularity=HOUR)
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="facts")


@query
def aggregate_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily grid from 2023-01-01 to the last event (A9): a 30-day average and an offset sum."""
    spec = AggregateSpec("account_id", "txn_date", [
        Agg("amount", "avg", Lookback(30)),
        Agg("amount", "sum", Lookback(5, offset=_dt.timedelta(days=-2)))], start=GRID_START, end=None)
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="grid")


@query
def attach_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine LEFT JOIN a precomputed aggregate table, key renamed and dropped."""
    t = Tables(spark, sf_dir)
    spec = AggregateSpec("account_id", "txn_date", [Agg("amount", "avg", Lookback(15)),
                                                    Agg("amount", "sum", Lookback(15))])
    aggs = R.aggregate_features(t.txn_lines(), spec, mode="facts")
    return T.attach(t.eol(), aggs, on={"primary_account_number": "account_id",
                                       "observation_date": "txn_date"})


@query
def dense_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense daily rollups from each account's first version to the last order.

    Entities are the SCD-2 rows (several per account): deduplicated before the
    calendar is built, so sums are not multiplied by the version count (H1).
    """
    t = Tables(spark, sf_dir)
    spec = R.rolling_7_14_spec("account_id", "txn_date", "amount")
    out = R.dense_daily(t.txn_orders(), spec, entities=t.accounts_scd2(), start_col="valid_from")
    return out.withColumnRenamed("account_id", "customer_id").withColumnRenamed("txn_date", "date")


# As TRAIN_EXCLUDE.
TRAIN_WIDE_EXCLUDE = ["transaction_id", "observation_date",
                      "merchant_id", "merchant_zone", "zone"]


def wide_training(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The 12 search-space aggregates and the lookups in one feature list: the
    aggregates and the account as-of lookup share one re-attach of the spine."""
    t = Tables(spark, sf_dir)
    tables = {**feature_tables(t), "txn_lines": T.FeatureTable(t.txn_lines(), TableSpec("transaction_id"))}
    feats = [FeatureAggregation("txn_lines", search_space_spec(), "primary_account_number", "observation_date"),
             *fraud_features(spark)[1:]]
    return T.training_set(t.eol(), feats, tables, label="label", exclude=TRAIN_WIDE_EXCLUDE, **kw)


@query
def training_set_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates attached first, then lookups; rows with any NULL feature dropped."""
    return wide_training(spark, sf_dir, nulls="drop")


SEARCH_NAMES = search_space_spec().names
WIDE_DEFAULTS = {**{n: 0.0 for n in SEARCH_NAMES}, "merchant_distance_from_home": -1.0}


@query
def training_set_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing features filled with defaults instead of dropping rows."""
    return wide_training(spark, sf_dir, defaults=WIDE_DEFAULTS)


# ---------------------------------------------------------------------------
# SCD-2, snapshots, validation, reshaping, splitting
# ---------------------------------------------------------------------------


@query
def build_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain signup changes into zip versions per account."""
    ch = Tables(spark, sf_dir).profile_changes()
    return S.build_scd2(ch, "account_id", "changed_at", ["change_id", "zip"], order_by=["change_id"])


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rollup row per account: what an online table keyed by account serves."""
    return S.latest_snapshot(rollups(Tables(spark, sf_dir)), "account_id", "date")


@query
def violations_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-unique transaction ids that repeat."""
    return Q.validate_unique(Tables(spark, sf_dir).txn_lines(), "transaction_id")


@query
def violations_timeseries_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose declared time-series key (account_id, txn_date TIMESERIES) repeats."""
    spec = TableSpec("account_id", time_key="txn_date")
    return Q.validate_spec(Tables(spark, sf_dir).txn_lines(), spec)["unique"]


@query
def violations_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL counts of the SCD-2 key columns; valid_to is NULL on open versions."""
    return Q.null_counts(Tables(spark, sf_dir).accounts_scd2(), ["account_id", "valid_from", "valid_to"])


@query
def violations_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions overlapping their successor (H11): profile changes, each declared valid for five days."""
    versions = Tables(spark, sf_dir).profile_changes().withColumn("valid_to", F.col("changed_at") + F.expr("INTERVAL 5 DAYS"))
    return Q.validate_versions(versions, "account_id", "changed_at", "valid_to", order_by=["change_id"])


@query
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose merchant is absent from the merchant dimension."""
    t = Tables(spark, sf_dir)
    facts = t.txn_lines().select("transaction_id", "account_id", "merchant_id", "txn_date")
    return Q.orphans(facts, "merchant_id", t.merchants(), "merchant_id")


@query
def flatten_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions built as array<struct> per customer, exploded and flattened."""
    return Tables(spark, sf_dir).accounts_scd2()


@query
def account_age_365(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole 365-day membership years up to the last order, and day shifts."""
    o = Tables(spark, sf_dir).txn_orders()
    as_of = o.select(F.max("txn_date")).scalar()
    m = o.groupBy("account_id").agg(F.min("txn_date").alias("member_since"))
    yrs = years_365(F.col("member_since"), as_of)
    return m.select("account_id", "member_since", as_of.alias("as_of"), yrs.alias("member_years"),
                    F.date_add("member_since", (yrs * 365).cast("int")).alias("last_anniversary"),
                    F.date_sub(as_of, (yrs * 365).cast("int")).alias("window_start"),
                    (yrs * 50).alias("expected_transactions"))


@query
def request_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests packed with struct(*) and read back field by field."""
    packed = X.request_struct(request_spine(Tables(spark, sf_dir)))
    return X.unpack_struct(packed)


SPLIT_SEED = 0


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split on the account key, stable across partitionings (M2)."""
    e = Tables(spark, sf_dir).eol()
    b = split_bucket("primary_account_number", seed=SPLIT_SEED)
    return e.withColumn("split", F.when(b < 8000, F.lit("train")).otherwise(F.lit("test")))


def override_requests(t: Tables) -> DataFrame:
    """Requests that supply the merchant zone on first lines only (T8 fixture)."""
    x = t.txn_lines().where(F.col("card_present"))
    return x.select(F.col("account_id").alias("primary_account_number"), "merchant_id",
                    F.col("txn_date").alias("observation_date"), F.col("amount").cast("double").alias("amount"),
                    F.when(F.col("pos_entry_mode") == 1, F.pmod(F.col("merchant_id"), F.lit(25)))
                    .cast("bigint").alias("merchant_zone"))


@query
def spec_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored feature spec applied to requests; supplied values win."""
    t = Tables(spark, sf_dir)
    spec = FeatureSpec("fraud_features", fraud_features(spark)[1:])
    spec = FeatureSpec.from_json(spec.to_json())
    return T.apply_spec(spec, override_requests(t), feature_tables(t), override=True)


@query
def override_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests supply a bound function's output for some rows; the rest is computed."""
    t = Tables(spark, sf_dir)
    req = override_requests(t).withColumn("merchant_distance_from_home", F.when(F.col("merchant_id") % 2 == 0, F.lit(-1)))
    spec = FeatureSpec("fraud_features", fraud_features(spark)[1:])
    return T.apply_spec(spec, req, feature_tables(t), override=True)


@query
def rollups_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups of discounted line prices: amounts and totals rounded to cents, NULL as 0."""
    t = Tables(spark, sf_dir)
    j = t.raw("lineitem").join(t.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    facts = j.select(F.col("o_custkey").alias("account_id"), F.to_date("o_orderdate").alias("txn_date"),
                     F.coalesce(F.round(price, 2), F.lit(0)).cast("decimal(18,2)").alias("amount"))
    aggs = [Agg("amount", "sum", Lookback(d), name=f"{d}_day_total", digits=2) for d in (14, 7)]
    return R.aggregate_features(facts, AggregateSpec("account_id", "txn_date", aggs), mode="facts").withColumnRenamed("txn_date", "date")


# ---------------------------------------------------------------------------
# model fitting and scoring (SQL checks the features and what holds for any model)
# ---------------------------------------------------------------------------


def checked_scores(scored: DataFrame) -> DataFrame:
    """The scored rows with what holds for any fitted tree in place of its scores."""
    return scored.select(*[c for c in scored.columns if c not in ("score", "prediction")],
                         F.col("score").between(0, 1).alias("score_in_range"),
                         (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("prediction_by_score"))


def fitted_tree(spark: SparkSession, sf_dir: str):
    ts = QUERIES["training_set"](spark, sf_dir)
    return M.fit_tree(ts, "label", max_depth=5)


@query
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree fitted on the training set; one day's requests get features looked up, then scored."""
    t = Tables(spark, sf_dir)
    model, feats = fitted_tree(spark, sf_dir)
    spec = FeatureSpec("fraud_features", fraud_features(spark))
    return checked_scores(M.score_batch(request_spine(t), spec, feature_tables(t), model, feats))


@query
def score_supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inference set already carries every feature: transform only."""
    model, feats = fitted_tree(spark, sf_dir)
    return checked_scores(M.score_supplied(QUERIES["inference_set"](spark, sf_dir), model, feats))


def checked_selection(out: DataFrame, k: int) -> DataFrame:
    """Each candidate with what holds for any selection in place of its rank and importance."""
    once = F.count(F.lit(1)).over(Window.partitionBy("rank")) == 1
    return out.select("feature", (F.col("rank").between(1, F.lit(out.count())) & once).alias("rank_in_permutation"),
                      (F.col("selected") == (F.col("rank") <= k)).alias("selected_by_rank"),
                      (F.col("selected") == F.col("eliminated_at").isNull()).alias("else_eliminated"),
                      (F.col("importance").between(0, 1) & F.col("eval_auc").between(0, 1)).alias("scores_in_range"))


@query
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 of the 12 search-space aggregates by boosted-tree elimination, 80/20 split (M2, M3)."""
    ts = materialize(QUERIES["training_set_defaults"](spark, sf_dir), name="select-set")  # both sides of the split read it
    train, test = M.split(ts, "primary_account_number", 0.8)
    always = [c for c in ts.columns if c not in SEARCH_NAMES and c != "label"]
    return checked_selection(M.select_features(train, test, "label", SEARCH_NAMES, always=always, k=5,
                                               max_iter=300, step_size=0.1, seed=123), 5)


# ---------------------------------------------------------------------------
# models whose values SQL can check
# ---------------------------------------------------------------------------

#: Fixed values of a check: two small trees over lineitem's numbers (quantity, price, discount).
#: Nodes: feature (0, 1, 2), threshold, left, right (-1: a leaf), value, cover.
CHECK_TREES = (
    ((0, 25.0, 1, 2, 0.0, 100.0), (1, 30000.0, 3, 4, 0.0, 60.0), (2, 0.05, 5, 6, 0.0, 40.0),
     (-1, 0.0, -1, -1, 0.5, 45.0), (-1, 0.0, -1, -1, -0.25, 15.0), (-1, 0.0, -1, -1, 0.125, 10.0), (-1, 0.0, -1, -1, 1.0, 30.0)),
    ((2, 0.03, 1, 2, 0.0, 80.0), (2, 0.01, 3, 4, 0.0, 32.0), (0, 40.0, 5, 6, 0.0, 48.0),
     (-1, 0.0, -1, -1, -1.0, 8.0), (-1, 0.0, -1, -1, 0.75, 24.0), (-1, 0.0, -1, -1, 0.25, 36.0), (-1, 0.0, -1, -1, -0.5, 12.0)),
)
CHECK_WEIGHTS = (1.0, 0.5)


def check_trees() -> list[SH.Tree]:
    return [SH.Tree(*zip(*[(f, t, left, right, v, c) for f, t, left, right, v, c in nodes])) for nodes in CHECK_TREES]


@query
def tree_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapley values of a fixed ensemble for every lineitem row (M3): one per feature, and the margin."""
    x = Tables(spark, sf_dir).raw("lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount")])
    out = SH.shap_values(x, ["l_quantity", "l_extendedprice", "l_discount"], check_trees(), CHECK_WEIGHTS)
    cols = [(F.round(F.col(SH.SHAP)[i], 9) + F.lit(0.0)).alias(f"shap_{n}") for i, n in enumerate(("quantity", "price", "discount"))]
    return out.select("l_orderkey", "l_linenumber", *cols, (F.round(SH.MARGIN, 9) + F.lit(0.0)).alias("margin"))


#: Inputs of the checked tree, in the order in which ties are broken.
TREE_INPUTS = ("amount", "14_day_total", "7_day_total", "7_day_transaction_count", "merchant_distance_from_home")


def checked_tree(spark: SparkSession, sf_dir: str) -> BinnedTree:
    """The tree fitted on the training set, saved and loaded again."""
    tree = fit_binned_tree(training_set(spark, sf_dir), "label", TREE_INPUTS, max_depth=2, bins=32)
    path = scratch_path(spark, "binned-tree")
    tree.save(spark, path)
    return BinnedTree.load(spark, path)


@query
def score_binned_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gini tree fitted by histograms, saved, loaded; a day's requests get features looked up, then its scores."""
    t = Tables(spark, sf_dir)
    spec = FeatureSpec("fraud_features", fraud_features(spark))
    looked_up = T.apply_spec(spec, request_spine(t), feature_tables(t), override=True)
    return checked_tree(spark, sf_dir).transform(looked_up)


@query
def score_binned_supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree over the inference set, which carries every feature."""
    return checked_tree(spark, sf_dir).transform(inference_set(spark, sf_dir))


@query
def split_hash_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split of customers on their name, a text key (M2)."""
    c = Tables(spark, sf_dir).raw("customer").select("c_custkey", "c_name")
    train, test = M.split(c, "c_name", 0.8, seed=SPLIT_SEED)
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))


# ---------------------------------------------------------------------------
# hot keys, long windows, overlapping versions
# ---------------------------------------------------------------------------


@query
def build_scd2_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signup changes chained as if of one account, day buckets of over 20 changes cut at quantiles of their times."""
    ch = Tables(spark, sf_dir).profile_changes().withColumn("account_id", F.lit(1).cast("bigint"))
    return S.build_scd2(ch, "account_id", "changed_at", ["change_id", "zip"], order_by=["change_id"], hot_rows=20)


@query
def enrich_batch_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases looked up as of their time among the changes of 3 accounts, hot buckets cut at quantiles."""
    t = Tables(spark, sf_dir)
    scd = t.profile_changes().withColumn("account_id", F.pmod("account_id", F.lit(3)))
    req = _requests(t.raw("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), F.pmod(F.col("user_id"), F.lit(3)).alias("account_id"), "ts", F.col("value").alias("amount")))
    right = L.AsOfRight(scd, ["account_id"], "changed_at", ["zip"], order_by=[F.col("change_id")])
    return L.lookup_asof(req, [right], "account_id", "ts", hot_rows=50)


@query
def enrich_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup by the streams' plan: chunks of 1,000 versions a key behind a directory (R2)."""
    t = Tables(spark, sf_dir)
    scd = t.profile_changes().withColumn("account_id", F.pmod("account_id", F.lit(3)))
    req = _requests(t.raw("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), F.pmod(F.col("user_id"), F.lit(3)).alias("account_id"), "ts", F.col("value").alias("amount")))
    right = L.AsOfRight(scd, ["account_id"], "changed_at", ["zip"], order_by=[F.col("change_id")])
    return L.lookup_asof(req, [right], "account_id", "ts", strategy="packed", hot_rows=50)


@query
def lookup_interval_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of an account under way (order date to its last line's shipping) at each ship date: versions overlap."""
    t = Tables(spark, sf_dir)
    lines = t.txn_lines()
    orders = lines.groupBy("account_id", F.floor(F.col("transaction_id") / 10).alias("order_id")).agg(
        F.min("txn_date").alias("placed"), F.max("ship_date").alias("closed"))
    spine = lines.select("transaction_id", "account_id", "ship_date")
    return L.lookup_interval(spine, orders, "account_id", "account_id", "ship_date", "placed", "closed", ["order_id"], strategy="join")


@query
def window_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """365- and 90-day windows as differences of running values, one shifted, one without the day itself."""
    aggs = [Agg("amount", "sum", Lookback(365)), Agg("amount", "avg", Lookback(365)), Agg("amount", "count", Lookback(90)),
            Agg("amount", "sum", Lookback(90, offset=-30)), Agg("amount", "active_days", Lookback(365, closed="left"), name="active_365_before")]
    return R.aggregate_features(Tables(spark, sf_dir).txn_orders(), AggregateSpec("account_id", "txn_date", aggs), mode="facts")


@query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables saved by name in a schema of their own, one over an earlier one of other columns, listed and read."""
    t = Tables(spark, sf_dir)
    schema = "pitfeat_" + scratch_path(spark, "s").rsplit("-", 1)[1]
    C.ensure_schema(spark, schema, use=False)
    C.save_table(t.accounts_scd2(), f"{schema}.merchants")
    C.save_table(t.merchants(), f"{schema}.merchants")
    C.save_table(t.raw("nation").select("n_nationkey", "n_name"), f"{schema}.zones")
    out = None
    for name in sorted(C.list_tables(spark, schema)):
        table = spark.table(f"{schema}.{name}")
        one = table.select(F.lit(name).alias("table_name"), F.lit(",".join(table.columns)).alias("columns"),
                           F.col(table.columns[0]).cast("bigint").alias("id"), F.col(table.columns[1]).alias("name"))
        out = one if out is None else out.union(one)
    return out


@query
def local_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants joined with a few local rows of a declared schema (S2): the names of three zones."""
    names = C.local_frame(spark, [(0, "north"), (1, "south"), (2, None)], "zone bigint, zone_name string")
    m = Tables(spark, sf_dir).merchants()
    return L.lookup_exact(m, names, "merchant_zone", "zone", ["zone_name"])


@query
def registered_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A windowed function given as an object (A6): the spread of amounts, from mergeable least and greatest values."""
    spread = AG.AggFunction("spread", {"min": F.min, "max": F.max}, lambda col, w, scale=0: AG._merge_max(col, w, scale) - AG._merge_min(col, w, scale), scaled=True)
    AG.register(spread)
    spec = AggregateSpec("account_id", "txn_date", [Agg("amount", spread.name, Lookback(30)), Agg("amount", AG.get(AG.REGISTRY["max"]).name, Lookback(30))])
    return R.aggregate_features(Tables(spark, sf_dir).txn_events(), spec, mode="facts")


@query
def weighted_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked tree with each positive label counted 5 times (M4): the leaf shares of the training set."""
    ts = training_set(spark, sf_dir).withColumn("weight", F.when(F.col("label") == 1, F.lit(5)).otherwise(F.lit(1)))
    tree = fit_binned_tree(ts, "label", TREE_INPUTS, max_depth=2, bins=32, weight_col="weight")
    return tree.transform(ts.drop("weight")).select("primary_account_number", "amount", "label", "score")


@query
def window_distinct_365(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct accounts of a merchant in 365 and 90 days, at every day it sells (A5): dyadic sketches."""
    aggs = [Agg("account_id", "approx_count_distinct", Lookback(365)), Agg("account_id", "approx_count_distinct", Lookback(90, offset=-7)),
            Agg("amount", "sum", Lookback(365))]
    return R.aggregate_features(Tables(spark, sf_dir).txn_lines(), AggregateSpec("merchant_id", "txn_date", aggs), mode="facts")


#: Days of a time bucket in which exact distinct counts are taken; the 364 days before it are dealt to it too.
DISTINCT_BUCKET = 4 * 365


def distinct_365_close(approximate: DataFrame, t: Tables) -> DataFrame:
    """How far the estimates are from the exact counts, as shares of rows: what SQL can hold an estimate to."""
    names = ("account_id_approx_count_distinct_365d", "account_id_approx_count_distinct_90d_offset_7d")
    day = F.datediff("txn_date", F.lit("1970-01-01").cast("date"))
    # Lines are dealt once, to their merchant's time bucket and to the next one if windows reach back to them from there;
    # all else happens within a bucket. All shuffle partitions are kept, since a line becomes four steps there.
    width, home = DISTINCT_BUCKET, F.floor(F.col("g") / DISTINCT_BUCKET)
    lines = t.txn_lines().select("merchant_id", day.alias("g"), "account_id").where(F.col("merchant_id").isNotNull())
    dealt = lines.withColumn("b", F.explode(F.sequence(home, F.floor((F.col("g") + 364) / width)))) \
        .repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "merchant_id", "b")
    # A day of an account is the last one in the windows of the points from then on, until the account's next day
    # or until it has left them: one count more from its first point, one less after its last, summed up over time.
    later = F.lead("g").over(Window.partitionBy("merchant_id", "b", "account_id").orderBy("g"))
    spans = dealt.distinct().withColumn("next", later)
    steps = [(1, 0, F.col("g"), 1), (1, 0, F.least(F.col("g") + 365, "next"), -1), (0, 1, F.col("g") + 7, 1), (0, 1, F.least(F.col("g") + 97, F.col("next") + 7), -1)]
    step = lambda g, d0, d1, point: F.struct(g.alias("g"), F.lit(d0).alias("d0"), F.lit(d1).alias("d1"), F.lit(point).alias("point"))
    counted = F.array(*[step(g, by * a, by * b, i == 0) for i, (a, b, g, by) in enumerate(steps)])
    changes = spans.select("merchant_id", "b", F.explode(F.when(F.col("account_id").isNotNull(), counted).otherwise(F.array(step(F.col("g"), 0, 0, True)))).alias("s"))
    daily = changes.select("merchant_id", "b", "s.*").groupBy("merchant_id", "b", "g").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"), F.max("point").alias("point"))
    so_far = Window.partitionBy("merchant_id", "b").orderBy("g").rowsBetween(Window.unboundedPreceding, 0)
    exact = daily.select(F.col("merchant_id").alias("m"), F.col("g").alias("p"), "point", (F.col("b") == home).alias("home"),
                         F.sum("d0").over(so_far).alias("x0"), F.sum("d1").over(so_far).alias("x1")).where("point and home").drop("point", "home")
    j = approximate.withColumn("g", F.datediff("txn_date", F.lit("1970-01-01").cast("date"))).join(
        exact, (F.col("merchant_id") == F.col("m")) & (F.col("g") == F.col("p")))
    near = lambda n, i: (F.abs(F.col(n) - F.col(f"x{i}")) <= F.greatest(F.lit(2.0), 0.08 * F.col(f"x{i}"))).alias(f"near_{i}")
    return j.select("merchant_id", "txn_date", "x0", "x1", near(names[0], 0), near(names[1], 1), F.col("amount_sum_365d").alias("amount_sum"))


@query
def window_distinct_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimates of ``window_distinct_365`` beside exact counts, within 8 percent or 2 (A5)."""
    return distinct_365_close(window_distinct_365(spark, sf_dir), Tables(spark, sf_dir))


@query
def grid_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of ``aggregate_grid`` without a twentieth of the events and the last week, brought up to date with them."""
    facts = Tables(spark, sf_dir).txn_events()
    late = (F.pmod("transaction_id", F.lit(20)) == 0) | (F.col("txn_date") > F.lit("2024-01-23").cast("date"))
    spec = AggregateSpec("account_id", "txn_date", [
        Agg("amount", "avg", Lookback(30)),
        Agg("amount", "sum", Lookback(5, offset=_dt.timedelta(days=-2)))], start=GRID_START, end=None)
    grid = materialize(R.aggregate_features(facts.where(~late), spec, mode="grid"), name="grid")
    return R.refresh_grid(grid, facts, facts.where(late), spec)


@query
def expand_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account's versions by a Python table function, called laterally per customer."""
    def versions(key, nation, count):
        starts = [_dt.date(1995, 1, 1) + _dt.timedelta(days=v * 700 + key % 97 if v else 0) for v in range(count)]
        return [(v, (nation + 7 * v) % 25, start, end) for v, (start, end) in enumerate(zip(starts, [*starts[1:], None]))]

    X.register_row_function(spark, "account_versions", versions,
                            lambda key, nation, count: StructType().add("version", "integer").add("zone", nation.dataType).add("valid_from", "date").add("valid_to", "date"))
    customers = Tables(spark, sf_dir).raw("customer").select("c_custkey", "c_name", "c_nationkey")
    X.spread(customers, "c_custkey").createOrReplaceTempView("__customers")
    return spark.sql("""SELECT c.c_custkey AS account_id, c.c_name AS account_name, v.version, v.zone, v.valid_from, v.valid_to,
                               CAST(v.valid_to IS NULL AS BIGINT) AS is_current
                        FROM __customers c, LATERAL account_versions(c.c_custkey, c.c_nationkey, CAST(c.c_custkey % 3 + 1 AS INT)) v""")


def merchant_states(t: Tables) -> list[DataFrame]:
    """Three states of the merchants: some close, some move, one that closed opens again."""
    m = t.merchants()
    moved = m.withColumn("merchant_zone", F.when(F.col("merchant_id") % 5 == 0, F.col("merchant_zone") + 100).otherwise(F.col("merchant_zone")))
    return [m.where(F.col("merchant_id") % 11 != 1), moved.where(F.col("merchant_id") % 7 != 0), moved.where(F.col("merchant_id") % 14 != 0)]


@query
def published_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three states published as changes, the second one twice; the feed with its tombstones."""
    path = scratch_path(spark, "merchant-changes")
    for number, state in enumerate(merchant_states(Tables(spark, sf_dir))):
        for _ in range(2 if number == 1 else 1):
            CH.publish_snapshot(spark, state, "merchant_id", path, number)
    return CH.read_changes(spark, path).withColumn(CH.NUMBER, F.col(CH.NUMBER).cast("bigint"))


@query
def published_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that these changes add up to: closed merchants are gone."""
    path = scratch_path(spark, "merchant-snapshot")
    for number, state in enumerate(merchant_states(Tables(spark, sf_dir))):
        CH.publish_snapshot(spark, state, "merchant_id", path, number)
    return CH.read_snapshot(spark, path, "merchant_id")


# ---------------------------------------------------------------------------
# streaming (run over all available input, then read the sink back)
# ---------------------------------------------------------------------------


@query
def stream_publish_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups streamed two files per batch into the keyed latest-row table (R1),
    then compacted.

    Equals ``latest_snapshot``: replaying in several batches gives the answer
    of one batch.
    """
    src = materialize(rollups(Tables(spark, sf_dir)), name="rollups-src")
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 2).parquet(
        src.inputFiles()[0].rsplit("/", 1)[0])
    out, ckpt = scratch_path(spark, "published"), scratch_path(spark, "published-ckpt")
    ST.publish_latest(stream, "account_id", "date", out, ckpt).awaitTermination()
    whole = scratch_path(spark, "published-compact")
    ST.compact_published(spark, out, whole, "account_id", "date")
    return ST.read_published(spark, whole, "account_id", "date")


@query
def stream_publish_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type-1 table without a time key, published by key: the row published last wins."""
    src = materialize(Tables(spark, sf_dir).merchants(), name="merchants-src")
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 2).parquet(src.inputFiles()[0].rsplit("/", 1)[0])
    out = scratch_path(spark, "merchants")
    ST.publish_latest(stream, "merchant_id", None, out, scratch_path(spark, "merchants-ckpt")).awaitTermination()
    return ST.read_published(spark, out, "merchant_id")


def _purchase_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = Tables(spark, sf_dir).raw("events").schema
    # the folder holds every table: the glob keeps the stream on the events file
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("account_id"), "ts",
        F.col("value").cast("decimal(18,2)").alias("amount"))


def _requests(df: DataFrame) -> DataFrame:
    """Purchase requests, money as double at the edge."""
    return df.withColumn("amount", F.col("amount").cast("double"))


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase requests enriched with the zip valid at request time (R2).

    The static side is the SCD-2 built from signup changes; equals the batch
    as-of join.
    """
    t = Tables(spark, sf_dir)
    scd = S.build_scd2(t.profile_changes(), "account_id", "changed_at", ["change_id", "zip"],
                       order_by=["change_id"])
    right = L.AsOfRight(scd, ["account_id"], "valid_from", ["zip"], valid_to="valid_to")
    enriched = ST.enrich_stream(_requests(_purchase_stream(spark, sf_dir)), [right], "account_id", "ts")
    out = scratch_path(spark, "enriched")
    ST.run_to_files(enriched, out, scratch_path(spark, "enriched-ckpt"))
    return spark.read.parquet(out)


@query
def enrich_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch as-of join the stream enrichment must equal (R2), on timestamps:
    the union plan runs with time buckets and carry-in rows here."""
    t = Tables(spark, sf_dir)
    scd = S.build_scd2(t.profile_changes(), "account_id", "changed_at", ["change_id", "zip"],
                       order_by=["change_id"])
    right = L.AsOfRight(scd, ["account_id"], "valid_from", ["zip"], valid_to="valid_to")
    req = _requests(t.raw("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("account_id"), "ts",
        F.col("value").cast("decimal(18,2)").alias("amount")))
    return L.lookup_asof(req, [right], "account_id", "ts", bucket=_dt.timedelta(days=7))


@query
def stream_partials_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh windowed aggregates from streamed daily partials (R3, A1): state per
    (user, day) in the stream, 30-day windows evaluated in batch over the
    emitted partials, days still open included."""
    spec = AggregateSpec("account_id", "ts", [Agg("amount", "avg", Lookback(30)),
                                              Agg("amount", "sum", Lookback(30))])
    parts, scales = ST.stream_partials(_purchase_stream(spark, sf_dir), spec, watermark="1 day")
    out = scratch_path(spark, "stream-partials")
    ST.run_updates(parts, out, scratch_path(spark, "stream-partials-ckpt"))
    res = R.from_partials(ST.read_published(spark, out, ["account_id", "__g"]), spec, scales)
    return res.withColumnRenamed("ts", "txn_date")


@query
def stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7-day windows sliding by a day, per user, windows still open included."""
    agg = ST.stream_rolling(_purchase_stream(spark, sf_dir), "account_id", "ts", "amount",
                            duration="7 days", slide="1 day", watermark="1 day")
    out = scratch_path(spark, "stream-rolling")
    ST.run_updates(agg, out, scratch_path(spark, "stream-rolling-ckpt"))
    return ST.read_published(spark, out, ["account_id", "window_start", "window_end"])


@query
def stream_rolling_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of ``stream_rolling`` from one ring of daily partials per user."""
    agg = RI.stream_rolling_ring(_purchase_stream(spark, sf_dir), "account_id", "ts", "amount", days=7, watermark="1 day")
    out = scratch_path(spark, "stream-ring")
    with RI.with_rocksdb(spark):
        ST.run_updates(agg, out, scratch_path(spark, "stream-ring-ckpt"))
    return ST.read_published(spark, out, ["account_id", "window_start", "window_end"])
