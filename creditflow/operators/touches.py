"""Touch-side stages: identity map, install touches, session touches and the
direct-visit re-attribution to app installs (C5-C8).

All inputs are restricted to the lookback (two windows before the mark) and
to the buyers of the run with left-semi joins, so the big session and
install tables are pruned before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.functions import rules as R
from creditflow.functions.timeutil import shift, touch_time
from creditflow.operators.joins import KeySet, grid_join, key_set, semi_reduce
from creditflow.operators.orders import Bounds, after_mark

TOUCH_COLUMNS = ["d_source", "user_uuid", "medium", "source", "campaign", "adset", "keyword",
                 "source_clean", "device_mapping", "country_code", "date", "visit_id", "gcl_id"]
INSTALL_COLUMNS = ["d_source", "uuid", "medium", "source", "campaign", "adset", "keyword",
                   "source_clean", "device_mapping", "country_code", "date", "visit_id"]
ENHANCED_COLUMNS = ["d_source_c", "user_uuid", "gcl_id", "medium_c", "source_c", "campaign_c",
                    "adset_c", "keyword_c", "source_clean_c", "country_code_c", "date_c",
                    "visit_id_c", "device_mapping_c"]


def identity_map(sessions: DataFrame) -> DataFrame:
    """Distinct (client_id, user_uuid) from sessions with a known user."""
    return (sessions.where(F.col("stitching_user_uuid").isNotNull())
            .select("client_id", F.col("stitching_user_uuid").alias("user_uuid")).distinct())


def buyer_keys(buyers: DataFrame) -> KeySet:
    """The run's buyer uuids as a measured key set."""
    return key_set(buyers, "uuid")


def resolved_installs(installs: DataFrame, people: DataFrame, buyers: KeySet) -> DataFrame:
    """Installs of buyers with ``r_uuid``, and ``m``: the rows that each stands for.

    An install with a user of its own stands for as many rows as its client has
    known users, at least one: only their number is joined.  One without becomes
    a row for each buyer known by its client id; those pairs are cut into cells
    where one client has many installs or many users.
    """
    known = installs.where(F.col("uuid").isNotNull()).withColumn("r_uuid", F.col("uuid"))
    known = semi_reduce(known, "uuid", buyers)
    sizes = people.groupBy("client_id").agg(F.count(F.lit(1)).alias("m"))
    known = known.join(sizes, F.col("customer_user_id") == F.col("client_id"), "left").withColumn("m", F.coalesce("m", F.lit(1)))
    unknown = installs.where(F.col("uuid").isNull() & F.col("customer_user_id").isNotNull()).withColumn("client_id", F.col("customer_user_id"))
    pairs = grid_join(unknown, semi_reduce(people, "user_uuid", buyers), ["client_id"])
    found = pairs.select(*["left." + c for c in installs.columns], F.col("right.user_uuid").alias("r_uuid"), F.lit(1).cast("long").alias("m"))
    return known.select(*installs.columns, "r_uuid", "m").unionByName(found)


def install_touches(installs: DataFrame, sessions: DataFrame, buyers: KeySet,
                    bounds: Bounds, people: DataFrame | None = None, cut=None) -> DataFrame:
    """App installs of the run's buyers inside the lookback, classified and deduplicated.

    ``people`` is the maintained client -> user map (``creditflow.sources.identity``);
    without it the map of the installing clients is taken from all ``sessions``.
    ``cut`` writes the lookback's installs and the map of their clients once, as
    key set, counts and joins all read them.
    """
    cut = cut or (lambda df: df)
    a = cut(installs.where(after_mark(F.col("attributed_touch_time"), bounds.mark, bounds.lookback_days)))
    clients = key_set(a, "customer_user_id")
    if people is None:
        people = identity_map(semi_reduce(sessions, "client_id", clients))  # reduced in the scan, before any shuffle
    else:
        people = semi_reduce(people, "client_id", clients)
    people = cut(people)
    a = resolved_installs(a, people, buyers)
    env = R.cols("campaign", "device_type", source="media_source", medium="af_channel")
    a, env = R.lowered(a, env, "source", "medium")
    out = a.select(
        F.lit(R.INSTALL_SOURCE_LABEL).alias("d_source"),
        F.col("r_uuid").alias("uuid"),
        F.col("af_channel").alias("medium"),
        F.col("media_source").alias("source"),
        "campaign",
        F.col("af_adset").alias("adset"),
        F.col("af_ad").alias("keyword"),
        R.install_channel(env).alias("source_clean"),
        R.install_device().spark(env).alias("device_mapping"),
        "country_code",
        touch_time("attributed_touch_time").alias("date"),
        F.lit("").alias("visit_id"),
        "m",
    )
    return out.groupBy(*INSTALL_COLUMNS).agg(F.sum("m").alias("n_rows"))


def session_touches(sessions: DataFrame, countries: DataFrame, buyers: KeySet,
                    bounds: Bounds) -> DataFrame:
    """Sessions of the run's buyers inside the lookback, classified and deduplicated.

    ``buyers`` is a ``buyer_keys`` key set; ``countries`` is the country
    dimension (pass it through ``bounded_broadcast`` to broadcast it after a
    size check).
    """
    s = semi_reduce(sessions.where(after_mark(F.col("visit_start_time"), bounds.mark, bounds.lookback_days)),
                    "stitching_user_uuid", buyers)
    dim = countries.select(F.col("name").alias("iso_name"), "alpha2")
    s = (s.withColumn("country_key", R.country_name().spark(R.cols("country")))
         .join(dim, F.col("iso_name") == F.col("country_key"), "left")
         .withColumn("path", R.session_path(F.col("source"), F.col("medium"))))
    env = R.cols("source", "medium", "path", "browser", "datasource", "device_category",
                 "operating_system", "alpha2")
    s, env = R.lowered(s, env, "source", "medium")
    out = s.select(
        R.session_source_label().spark(env).alias("d_source"),
        F.col("stitching_user_uuid").alias("user_uuid"),
        "medium", "source", "campaign",
        F.col("ad_content").alias("adset"),
        "keyword",
        R.session_channel().spark(env).alias("source_clean"),
        R.session_device().spark(env).alias("device_mapping"),
        R.alpha2_fix().spark(env).alias("country_code"),
        touch_time("visit_start_time").alias("date"),
        "visit_id", "gcl_id",
    )
    return out.groupBy(*TOUCH_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


def validate_countries(countries: DataFrame) -> None:
    """Data check: the country dimension must be unique on ``name`` and on ``alpha2``.

    Both lookups are left joins after which credit is summed; a duplicated
    key would multiply rows and make an order's credit exceed 1, so the run
    stops instead of silently deduplicating.  One small aggregate job.
    """
    dup = []
    for key in ("name", "alpha2"):
        rows = (countries.where(F.col(key).isNotNull()).groupBy(key).count()
                .where(F.col("count") > 1).limit(5).collect())
        dup += [f"{key}={r[key]!r}" for r in rows]
    if dup:
        raise ValueError("country dimension has duplicate keys: " + ", ".join(dup))


def _is_direct(medium, source):
    return (medium == F.lit(R.DIRECT_MEDIUM)) & (source == F.lit(R.DIRECT_SOURCE))


def _bucket(ts: Column, seconds) -> Column:
    """Number of the ``seconds``-wide bucket that a zone-less time lies in."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", start, ts) / seconds)


def _contains_network(*columns: str) -> Column:
    wide = F.lit(False)
    for net in R.WIDE_BAND_NETWORKS:
        for c in columns:
            wide = wide | F.coalesce(F.lower(c).contains(net), F.lit(False))
    return wide


def install_matches(direct: DataFrame, installs: DataFrame) -> DataFrame:
    """Pairs (aliases ``left`` and ``right``) of direct visits and installs of one user within the install's band.

    Each install has one band, a day for the wide networks and ten seconds for
    all others, and lies in buckets of about twice its band: the few that its
    band touches.  A visit looks up its own bucket of either width, so a pair
    meets once and installs of other bands are never compared.
    """
    day, narrow = 86_400, R.NARROW_BAND_SECONDS
    visits = direct.withColumns({
        "_wide": F.explode(F.array(F.lit(True), F.lit(False)))}).withColumn(
        "_bucket", F.when(F.col("_wide"), _bucket(F.col("date"), day)).otherwise(_bucket(F.col("date"), 2 * narrow)))
    wide = _contains_network("af_source", "af_medium")
    banded = installs.withColumn("_wide", wide).withColumns({
        "_from": F.when(F.col("_wide"), shift("af_date", -R.WIDE_BAND_DAYS, "day")).otherwise(shift("af_date", -narrow, "second")),
        "_to": F.when(F.col("_wide"), shift("af_date", R.WIDE_BAND_DAYS, "day")).otherwise(shift("af_date", narrow, "second"))})
    width = F.when(F.col("_wide"), F.lit(day)).otherwise(F.lit(2 * narrow))
    banded = banded.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("_from"), width), _bucket(F.col("_to"), width))))
    return grid_join(visits, banded, ["user_uuid", "_wide", "_bucket"], lambda g, a: (g["date"] >= a["_from"]) & (g["date"] <= a["_to"]))


def enhance_direct_touches(touches: DataFrame, installs: DataFrame) -> DataFrame:
    """Re-attribute direct visits to an app install of the same user nearby in time.

    A visit with medium ``(none)`` and source ``(direct)`` is matched to each
    install of its user within +-10 s (+-1 day when the install names Snapchat
    or Facebook; a direct visit names neither) and takes the install's
    attributes; other visits are kept as they are, and so are direct visits
    without a match.  Only direct visits take part in the join.
    """
    is_direct = _is_direct(F.col("medium"), F.col("source"))

    def as_visit(c) -> list[Column]:
        return [c("d_source").alias("d_source_c"), c("user_uuid").alias("user_uuid"), c("gcl_id").alias("gcl_id"),
                c("medium").alias("medium_c"), c("source").alias("source_c"), c("campaign").alias("campaign_c"),
                c("adset").alias("adset_c"), c("keyword").alias("keyword_c"), c("source_clean").alias("source_clean_c"),
                c("country_code").alias("country_code_c"), c("date").alias("date_c"),
                c("visit_id").cast("string").alias("visit_id_c"), c("device_mapping").alias("device_mapping_c")]

    kept = touches.where(~F.coalesce(is_direct, F.lit(False))).select(*as_visit(F.col))
    direct = touches.where(is_direct).drop("n_rows")
    inst = (installs.drop("n_rows").select(*[F.col(c).alias("af_" + c) for c in INSTALL_COLUMNS])
            .withColumnRenamed("af_uuid", "user_uuid"))
    j = install_matches(direct, inst)
    g = lambda c: F.col("left." + c)     # noqa: E731  visit side
    a = lambda c: F.col("right." + c)    # noqa: E731  install side
    take = F.coalesce(a("af_source"), a("af_medium")).isNotNull()
    pick = lambda c: F.when(take, a("af_" + c)).otherwise(g(c))
    moved = [F.coalesce(a("af_d_source"), g("d_source")).alias("d_source_c"), g("user_uuid").alias("user_uuid"), g("gcl_id").alias("gcl_id"),
             pick("medium").alias("medium_c"), pick("source").alias("source_c"), pick("campaign").alias("campaign_c"), pick("adset").alias("adset_c"),
             g("keyword").alias("keyword_c"), pick("source_clean").alias("source_clean_c"), pick("country_code").alias("country_code_c"),
             pick("date").alias("date_c"), F.when(take, a("af_visit_id")).otherwise(g("visit_id").cast("string")).alias("visit_id_c"),
             pick("device_mapping").alias("device_mapping_c")]
    # One grouping gives the distinct moved rows and the direct visits that no match has marked.
    both = F.array(F.struct(F.lit(True).alias("_moved"), *moved), F.struct(F.lit(False).alias("_moved"), *as_visit(g)))
    marked = j.select(F.explode(both).alias("row")).select("row.*").withColumn("_matched", F.lit(True))
    asked = direct.select(F.lit(False).alias("_moved"), *as_visit(F.col), F.lit(False).alias("_matched"))
    found = marked.unionByName(asked).groupBy("_moved", *ENHANCED_COLUMNS).agg(F.max("_matched").alias("_matched"))
    out = found.where(F.col("_moved") | ~F.col("_matched")).select(*ENHANCED_COLUMNS)
    # Direct rows always differ from kept rows (source/medium or d_source), so
    # the union is already duplicate-free.
    return kept.select(*ENHANCED_COLUMNS).unionByName(out)
