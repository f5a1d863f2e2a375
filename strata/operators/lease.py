"""Exclusive, time-limited leases resolved from a request log.

A request is a text message: ``grp`` books the group's cluster, ``grp off``
releases it, ``status`` asks for the listing. Per cluster, in time order:

* an ``off`` by the live holder frees the cluster (the booking time stays);
  an ``off`` by anyone else is answered with the status;
* a request books when the cluster is free or the lease is ``>= limit`` old;
* otherwise it waits, also for the holder itself (no renewal).

Expiry is eager: a lease is over at ``booked_at + limit`` whether or not a
request has looked at it since.

Scale: the bookings of a cluster are a pointer chain. The log is cut into pieces of bounded bytes, each
piece is worked by itself, and only what crosses a piece's border is joined (``lease_chain``), so a busy
cluster is split over many tasks and no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import micros, ntz_from_micros
from ..session import materialize
from .scan import Scan, ordered_scan

# fixed values: lease rules of the booking service
LIMIT_SECONDS = 15 * 60          # a booking lasts 15 minutes
IDLE_AFTER_SECONDS = 2 * 60      # jobs on a free cluster are flagged after 2 minutes
FRESH_WITHIN_SECONDS = 10        # foreign paths are checked in the first 10 seconds of a lease
STATUS_WORD = "status"
OFF_WORD = "off"
PATH_WHITE_LIST = ["/terainput20g-32m", "/terainput20g-64m", "/terainput20g-128m",
                   "/terainput20g-256m", "/terainput20g-512m", "/tmp", "/user", "/user/hduser",
                   "/user/hduser/.sparkStaging"]
USER_FOLDER = "/user/{grp}"
REPLY_OFF = "[{grp}] Your booking is off."
REPLY_ON = "[{grp}] Your booking is on. 15 minutes left."
REPLY_WAIT = "{holder} is on {cluster}. Please wait for [{min} min {sec} sec]."
REPLY_STATUS_ITEM = '["{cluster}": {holder}]'
REPLY_WRONG_GROUP = 'Wrong Group Name. Please use "groupXX", e.g., group01.'

MOST_CLUSTERS = 100_000          # every listing names all clusters
US = 1_000_000


# --------------------------------------------------------------------- L1-L3
def parse_requests(df: DataFrame, msg: str = "msg") -> DataFrame:
    """L1: strip white space of every kind, split on it; exactly two tokens make ``tok2 == 'off'``
    the off flag, any other count keeps only the first token (flag ignored)."""
    tok = F.split(F.regexp_replace(F.col(msg), r"^\s+|\s+$", ""), r"\s+")
    return df.withColumns({
        "grp": F.element_at(tok, 1),
        "is_off": F.coalesce((F.size(tok) == 2) & (F.element_at(tok, 2) == OFF_WORD), F.lit(False)),
    })


def resolve_cluster(requests: DataFrame, directory: DataFrame, grp: str = "grp",
                    cluster: str = "cluster", order: str | None = "cluster_order") -> DataFrame:
    """L2+L3: the first cluster (in directory order) that lists the group.

    Unknown groups get no cluster and ``kind = 'status'`` when the word is
    ``status``, else ``kind = 'wrong_group'``; the rest are ``'request'``.
    The directory is one row per group after the dedup; Spark broadcasts it
    when its measured size is under the broadcast threshold, and joins it by
    shuffle otherwise.
    """
    d = directory
    if order and order in d.columns:
        d = d.groupBy(grp).agg(F.min_by(cluster, order).alias(cluster))
    else:
        d = d.groupBy(grp).agg(F.min(cluster).alias(cluster))
    j = requests.join(d, grp, "left")
    kind = (F.when(F.col(cluster).isNotNull(), F.lit("request"))
             .when(F.col(grp) == STATUS_WORD, F.lit("status"))
             .otherwise(F.lit("wrong_group")))
    return j.withColumn("kind", kind)


# ------------------------------------------------------------------------ L4
def segment_requests(req: DataFrame, limit_s: int = LIMIT_SECONDS, n_partitions: int | None = None
                     ) -> DataFrame:
    """Number the segments of each cluster: a new one starts after a gap >= limit.

    One ordered scan (range exchange on ``(cluster, t_us, request_id)``);
    segment edges that fall on partition edges are stitched exactly.
    """
    return ordered_scan(req, ["t_us", "request_id"], ["cluster"],
                        [Scan("seg", "segment", "t_us", gap=limit_s * US)], n_partitions)


def resolve_leases(requests: DataFrame, limit_s: int = LIMIT_SECONDS, n_partitions: int | None = None) -> DataFrame:
    """L4: one action per request: book, wait, off, status or wrong_group.

    Input: ``request_id, ts, grp, is_off, cluster, kind`` (from L1-L3).
    Output adds ``t_us``, ``action``, ``holder`` (live holder after the
    request, '' if free) and ``booked_at`` (start of the lease in force;
    on an ``off`` row the lease just released; NULL when the cluster is free).

    The bookings of a cluster are a pointer chain, ranked by block exits (``lease_chain``), so a
    cluster that never rests is spread over all tasks like any other.
    """
    from .lease_chain import resolve_by_chain

    # written once: parsing and the directory join would else run again for the size, the bounds and both branches
    req = materialize(requests.withColumn("t_us", micros("ts")), "lease-requests")
    resolved = resolve_by_chain(req.where(F.col("kind") == "request"), limit_s * US, n_partitions)
    others = (req.where(F.col("kind") != "request")
                 .withColumns({"action": F.col("kind"), "holder": F.lit(None).cast("string"),
                               "booked_us": F.lit(None).cast("long")}))
    out = resolved.unionByName(others)
    return out.withColumn("booked_at", ntz_from_micros(F.col("booked_us")))


# ------------------------------------------------------------------------ L5
def wait_time(resolved: DataFrame, limit_s: int = LIMIT_SECONDS) -> DataFrame:
    """Time left on the lease for each waiting request, in whole minutes and seconds."""
    rem = F.lit(limit_s * US) - (F.col("t_us") - F.col("booked_us"))
    return (resolved.where(F.col("action") == "wait")
            .select("request_id", "cluster", "holder",
                    F.floor(rem / (60 * US)).cast("long").alias("wait_min"),
                    F.floor((rem % (60 * US)) / US).cast("long").alias("wait_sec")))


# ------------------------------------------------------------------------ L6
def _changes(resolved: DataFrame) -> DataFrame:
    """Lease changes: a booking sets the holder, an off clears it."""
    return resolved.where(F.col("action").isin("book", "off")).select(
        "cluster", "t_us", "request_id",
        F.when(F.col("action") == "book", F.col("grp")).otherwise(F.lit("")).alias("holder"),
        "booked_us")


def as_of_state(resolved: DataFrame, probes: DataFrame, limit_s: int = LIMIT_SECONDS,
                n_partitions: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """State of each probe's cluster at the probe's time (changes at the same
    instant count when their request id is lower).

    ``probes``: ``probe_id, cluster, t_us`` and the columns to ``keep``. Output adds ``raw_holder``,
    ``booked_us`` and ``holder`` ('' once expired). Union + forward fill per
    cluster, as an ordered scan: a busy cluster is split across tasks.
    """
    ch = _changes(resolved).select(
        "cluster", "t_us", F.col("request_id").alias("_id"), F.lit(0).alias("_kind"),
        F.col("holder").alias("_h"), F.col("booked_us").alias("_b"), F.lit(None).cast("long").alias("probe_id"))
    pr = probes.select("cluster", "t_us", F.col("probe_id").alias("_id"), F.lit(1).alias("_kind"),
                       F.lit(None).cast("string").alias("_h"), F.lit(None).cast("long").alias("_b"),
                       F.col("probe_id"), *keep)
    u = ch.unionByName(pr, allowMissingColumns=True)
    s = ordered_scan(u, ["t_us", "_id", "_kind"], ["cluster"],
                     [Scan("raw_holder", "ffill", "_h"), Scan("booked_us", "ffill", "_b")], n_partitions)
    live = (F.coalesce(F.col("raw_holder"), F.lit("")) != "") & \
           (F.col("t_us") - F.col("booked_us") < limit_s * US)
    return (s.where(F.col("_kind") == 1)
             .select("probe_id", "cluster", "t_us", *keep, "raw_holder", "booked_us",
                     F.when(live, F.col("raw_holder")).otherwise(F.lit("")).alias("holder")))


def cluster_list(directory: DataFrame, cluster: str = "cluster", order: str | None = "cluster_order") -> list[str]:
    """The clusters of a directory in its order (by name, if it has none). Every listing names them all, so there are
    at most ``MOST_CLUSTERS``."""
    by = F.min(order) if order and order in directory.columns else F.min(cluster)
    rows = directory.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(by.alias("_o")).orderBy("_o", cluster) \
        .limit(MOST_CLUSTERS + 1).collect()
    if len(rows) > MOST_CLUSTERS:
        raise ValueError(f"a listing of more than {MOST_CLUSTERS} clusters")
    return [r[cluster] for r in rows]


def listing_state(resolved: DataFrame, probes: DataFrame, clusters: Sequence[str],
                  limit_s: int = LIMIT_SECONDS, n_partitions: int | None = None) -> DataFrame:
    """Holder of every listed cluster at each probe, in long form: ``probe_id, pos, cluster, holder`` ('' when free
    or expired), ``pos`` being the cluster's place in the listing.

    One row per probe and cluster is what a listing consists of. The rows of a cluster and its lease
    changes are one time-ordered scan per cluster, which cuts a busy one into many tasks; the plan is the same for
    any number of clusters.
    """
    names = F.split(F.lit("\x00".join(clusters)), "\x00") if clusters else F.array().cast("array<string>")
    asked = probes.select("probe_id", "t_us", F.posexplode(names).alias("pos", "cluster"))
    st = as_of_state(resolved, asked, limit_s, n_partitions, keep=["pos"])
    return st.select("probe_id", "pos", "cluster", "holder")


def status_snapshot(resolved: DataFrame, probes: DataFrame, clusters: Sequence[str],
                    limit_s: int = LIMIT_SECONDS, n_partitions: int | None = None) -> DataFrame:
    """Holder of every cluster at each probe time; an expired lease shows ''.

    ``probes``: ``probe_id, t_us``. ``clusters``: the directory's ``cluster_list``.
    """
    return listing_state(resolved, probes, clusters, limit_s, n_partitions).select("probe_id", "cluster", "holder")


# ------------------------------------------------------------------------ L7
def lease_intervals(resolved: DataFrame, limit_s: int = LIMIT_SECONDS, log_end_us=None,
                    n_partitions: int | None = None) -> DataFrame:
    """``(cluster, holder, start, end, end_reason)`` for every booking.

    A lease ends at the holder's ``off`` or at ``start + limit``; a lease
    whose limit lies past the end of the log is ``open`` (end NULL).
    """
    ch = _changes(resolved)
    # the next change of the cluster, found by a lag over reversed time
    rev = ch.withColumns({"_rt": -F.col("t_us"), "_rid": -F.col("request_id"),
                          "_is_off": (F.col("holder") == "").cast("int")})
    nxt = ordered_scan(rev, ["_rt", "_rid"], ["cluster"],
                       [Scan("_next_t", "lag", "t_us"), Scan("_next_off", "lag", "_is_off")], n_partitions)
    if log_end_us is None:
        log_end_us = resolved.select(F.max("t_us")).scalar()
    book = nxt.where(F.col("holder") != "")
    expiry = F.col("t_us") + F.lit(limit_s * US)
    by_off = F.col("_next_off") == 1
    end_us = F.when(by_off, F.col("_next_t")).when(expiry <= log_end_us, expiry)
    reason = F.when(by_off, F.lit("off")).when(expiry <= log_end_us, F.lit("expired")).otherwise(F.lit("open"))

    def ts(c):
        return ntz_from_micros(c)

    return book.select("cluster", "holder", F.col("request_id").alias("booking_id"),
                       ts(F.col("t_us")).alias("start"), ts(end_us).alias("end"),
                       reason.alias("end_reason"),
                       (F.coalesce(end_us, F.lit(log_end_us)) - F.col("t_us")).alias("held_us"))


# ------------------------------------------------------------------------ L8
def replies(resolved: DataFrame, clusters: Sequence[str], limit_s: int = LIMIT_SECONDS,
            n_partitions: int | None = None) -> DataFrame:
    """The reply text of every request, as the service words it.

    Book, off and wait replies are followed by a newline and the status
    listing (after the request); status replies are the listing alone;
    unknown groups get the wrong-group text alone.
    """
    asked = resolved.where(F.col("action") != "wrong_group")
    st = listing_state(resolved, asked.select(F.col("request_id").alias("probe_id"), "t_us"), clusters, limit_s,
                       n_partitions)
    item = REPLY_STATUS_ITEM.replace("{cluster}", "%s").replace("{holder}", "%s")
    # one item per cluster: a list as long as the reply itself
    listed = st.groupBy("probe_id").agg(F.concat_ws(" ", F.transform(
        F.sort_array(F.collect_list(F.struct("pos", F.format_string(item, "cluster", "holder").alias("item")))),
        lambda x: x["item"])).alias("_listing"))
    st = asked.join(listed, F.col("request_id") == F.col("probe_id"), "left")
    listing = F.coalesce("_listing", F.lit(""))
    rem = F.lit(limit_s * US) - (F.col("t_us") - F.col("booked_us"))
    wait = F.format_string(
        REPLY_WAIT.replace("{holder}", "%s").replace("{cluster}", "%s").replace("{min}", "%d").replace("{sec}", "%d"),
        F.col("holder"), F.col("cluster"), F.floor(rem / (60 * US)).cast("long"),
        F.floor((rem % (60 * US)) / US).cast("long"))
    act = F.col("action")
    first = (F.when(act == "off", F.format_string(REPLY_OFF.replace("{grp}", "%s"), F.col("grp")))
              .when(act == "book", F.format_string(REPLY_ON.replace("{grp}", "%s"), F.col("grp")))
              .when(act == "wait", wait))
    text = F.when(act == "status", listing).otherwise(F.concat_ws("\n", first, listing))
    answered = st.select("request_id", act.alias("action"), text.alias("reply"))
    wrong = resolved.where(F.col("action") == "wrong_group").select(
        "request_id", "action", F.lit(REPLY_WRONG_GROUP).alias("reply"))
    return answered.unionByName(wrong)


# ----------------------------------------------------------------- L10, L11
def idle_jobs(resolved: DataFrame, sightings: DataFrame, idle_s: int = IDLE_AFTER_SECONDS,
              limit_s: int = LIMIT_SECONDS, n_partitions: int | None = None) -> DataFrame:
    """Jobs seen on a free cluster at least ``idle_s`` after the last
    booking *start* (a release does not reset it). A cluster never booked
    counts as free for long.

    ``sightings``: ``probe_id, cluster, t_us`` (one row per job seen).
    """
    st = as_of_state(resolved, sightings, limit_s, n_partitions)
    age = F.col("t_us") - F.col("booked_us")
    flagged = (F.col("holder") == "") & (F.col("booked_us").isNull() | (age >= idle_s * US))
    return st.where(flagged).select("probe_id", "cluster",
                                    F.floor(age / US).cast("long").alias("age_sec"))


def foreign_paths(resolved: DataFrame, listings: DataFrame, white_list: Sequence[str] = PATH_WHITE_LIST,
                  fresh_s: int = FRESH_WITHIN_SECONDS, limit_s: int = LIMIT_SECONDS,
                  n_partitions: int | None = None) -> DataFrame:
    """Paths listed while a lease is at most ``fresh_s`` old, minus the
    white list and minus the holder's own ``/user/<grp>`` folder.

    ``listings``: ``probe_id, cluster, t_us, path`` (one row per listed path).
    The white list is a fixed handful of paths: a broadcast anti join.
    """
    spark = listings.sparkSession
    st = as_of_state(resolved, listings.select("probe_id", "cluster", "t_us").distinct(), limit_s,
                     n_partitions)
    fresh = (F.col("holder") != "") & (F.col("t_us") - F.col("booked_us") <= fresh_s * US)
    held = st.where(fresh).select("probe_id", "holder")
    wl = spark.createDataFrame([(p,) for p in white_list], "path string")
    paths = listings.join(held, "probe_id").join(F.broadcast(wl), "path", "left_anti")
    own = F.format_string(USER_FOLDER.replace("{grp}", "%s"), F.col("holder"))
    return paths.where(F.col("path") != own).select("probe_id", "cluster", "holder", "path")


# ------------------------------------------------------------------------ L12
def usage(resolved: DataFrame, intervals: DataFrame) -> DataFrame:
    """Per cluster and group: bookings, waits, offs and time held (micros)."""
    counts = (resolved.where(F.col("cluster").isNotNull())
              .groupBy("cluster", "grp")
              .agg(F.count_if(F.col("action") == "book").alias("bookings"),
                   F.count_if(F.col("action") == "wait").alias("waits"),
                   F.count_if(F.col("action") == "off").alias("offs")))
    held = (intervals.groupBy("cluster", F.col("holder").alias("grp"))
            .agg(F.sum("held_us").alias("held_us")))
    return (counts.join(held, ["cluster", "grp"], "left")
            .select("cluster", "grp", "bookings", "waits", "offs",
                    F.coalesce(F.col("held_us"), F.lit(0)).cast("long").alias("held_us")))
