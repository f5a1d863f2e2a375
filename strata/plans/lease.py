"""Driver-table queries for the lease family.

The request log is built from ``events``: each user is a group, its cluster
is ``user_id % 4``. Message by event type: ``error`` -> ``g<u> off`` (between a tab and a line end),
``click`` -> ``  g<u> off please `` (three tokens: flag ignored),
``purchase`` -> ``g<u>`` and a newline (or the unknown ``x<u>`` when ``props.k >= 90``),
``signup`` -> ``status``. ``view`` rows are not requests: they are job
sightings (L10) and directory listings of a page path (L11).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import micros
from ..operators import lease as LS
from ..session import checkpoint_dir, is_written
from ..sources.tables import table

LISTING_PREFIX = "drwxr-xr-x   - hduser supergroup          0 2024-01-01 10:00 "


def request_log(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    msg = (F.when(F.col("event_type") == "error", F.concat(F.lit("\tg"), u, F.lit(" off\r\n")))
            .when(F.col("event_type") == "click", F.concat(F.lit("  g"), u, F.lit(" off please ")))
            .when((F.col("event_type") == "purchase") & (k >= 90), F.concat(F.lit("x"), u))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("g"), u, F.lit("\n")))
            .otherwise(F.lit("status")))
    return ev.where(F.col("event_type") != "view").select(
        F.col("event_id").alias("request_id"), "ts", msg.alias("msg"))


def directory(spark, sf_dir, one_cluster: bool = False):
    """Every user is a group; its cluster is ``user_id % 4``, or ``c0`` for
    all groups when ``one_cluster`` (the skew case: one cluster gets every
    request)."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    cluster = (F.lit("c0") if one_cluster
               else F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")))
    order = F.lit(0).cast("long") if one_cluster else (F.col("user_id") % 4)
    return users.select(F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("grp"),
                        cluster.alias("cluster"), order.alias("cluster_order"))


def _classified(spark, sf_dir):
    return LS.resolve_cluster(LS.parse_requests(request_log(spark, sf_dir)), directory(spark, sf_dir))


def _resolved(spark, sf_dir, one_cluster: bool = False):
    """The resolved log of the events files as they are now. It is a table in the shared folder, named after the
    application and a digest of the files' names, sizes and times, so the family of lease queries resolves
    a log once, and a changed table is resolved anew."""
    files = table(spark, sf_dir, "events").select("_metadata.file_path", "_metadata.file_size",
                                                  "_metadata.file_modification_time").distinct()
    n, digest = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
    path = (f"{checkpoint_dir(spark)}/lease-resolved-{spark.sparkContext.applicationId}-"
            f"{n}-{digest}-{'one' if one_cluster else 'all'}")
    if not is_written(spark, path):
        classified = LS.resolve_cluster(LS.parse_requests(request_log(spark, sf_dir)),
                                        directory(spark, sf_dir, one_cluster))
        LS.resolve_leases(classified).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _log_end(spark, sf_dir):
    return request_log(spark, sf_dir).select(F.max(micros("ts"))).scalar()


def lease_resolve_hot(spark, sf_dir):
    """L4 with a single cluster for all groups: one key holds every request."""
    return _resolved(spark, sf_dir, True).select("request_id", "cluster", "grp", "action", "holder", "booked_at")


def request_parse(spark, sf_dir):
    return LS.parse_requests(request_log(spark, sf_dir)).select("request_id", "grp", "is_off")


def request_cluster(spark, sf_dir):
    return _classified(spark, sf_dir).select("request_id", "grp", "cluster", "kind")


def lease_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).select("request_id", "cluster", "grp", "action", "holder",
                                           "booked_at")


def lease_wait(spark, sf_dir):
    return LS.wait_time(_resolved(spark, sf_dir))


def lease_status(spark, sf_dir):
    r = _resolved(spark, sf_dir)
    probes = r.where(F.col("action") == "status").select(F.col("request_id").alias("probe_id"), "t_us")
    return LS.status_snapshot(r, probes, LS.cluster_list(directory(spark, sf_dir)))


def lease_intervals(spark, sf_dir):
    return LS.lease_intervals(_resolved(spark, sf_dir), log_end_us=_log_end(spark, sf_dir))


def lease_reply(spark, sf_dir):
    return LS.replies(_resolved(spark, sf_dir), LS.cluster_list(directory(spark, sf_dir)))


def lease_usage(spark, sf_dir):
    r = _resolved(spark, sf_dir)
    return LS.usage(r, LS.lease_intervals(r, log_end_us=_log_end(spark, sf_dir)))


def _sightings(spark, sf_dir):
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    return ev.select(F.col("event_id").alias("probe_id"),
                     F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("cluster"),
                     micros("ts").alias("t_us"))


def idle_jobs(spark, sf_dir):
    return LS.idle_jobs(_resolved(spark, sf_dir), _sightings(spark, sf_dir))


def listings(spark, sf_dir):
    """One directory-listing line per sighting: the path of page ``event_id mod pages``."""
    pages = table(spark, sf_dir, "pages")
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    s = _sightings(spark, sf_dir).withColumn("page_id", F.col("probe_id") % n_pages)
    p = pages.select("page_id", F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1).alias("upath"))
    lines = s.join(p, "page_id").select("probe_id", "cluster", "t_us",
                                        F.concat(F.lit(LISTING_PREFIX), F.col("upath")).alias("line"))
    # The path is the text after the last " /" of the line
    return lines.select("probe_id", "cluster", "t_us",
                        F.regexp_extract("line", r"(.+) (/.*)", 2).alias("path")).where(F.col("path") != "")


def foreign_paths(spark, sf_dir):
    return LS.foreign_paths(_resolved(spark, sf_dir), listings(spark, sf_dir))


QUERIES = {
    "request_parse": request_parse,
    "request_cluster": request_cluster,
    "lease_resolve": lease_resolve,
    "lease_resolve_hot": lease_resolve_hot,
    "lease_wait": lease_wait,
    "lease_status": lease_status,
    "lease_intervals": lease_intervals,
    "lease_reply": lease_reply,
    "lease_usage": lease_usage,
    "idle_jobs": idle_jobs,
    "foreign_paths": foreign_paths,
}

_BASE = r"""
with recursive
req as (
  select event_id as request_id, ts, epoch_us(ts) as t_us,
         case when event_type = 'error' then chr(9) || 'g' || user_id || ' off' || chr(13) || chr(10)
              when event_type = 'click' then '  g' || user_id || ' off please '
              when event_type = 'purchase' and (props->>'k')::int >= 90 then 'x' || user_id
              when event_type = 'purchase' then 'g' || user_id || chr(10)
              else 'status' end as msg
  from events where event_type <> 'view'),
parsed as (
  select request_id, ts, t_us, tok[1] as grp, coalesce(len(tok) = 2 and tok[2] = 'off', false) as is_off
  from (select *, string_split_regex(regexp_replace(msg, '^\s+|\s+$', '', 'g'), '\s+') as tok from req)),
dir as (select distinct 'g' || user_id as grp, 'c' || (user_id % 4) as cluster from events),
cl as (
  select p.*, d.cluster,
         case when d.cluster is not null then 'request' when p.grp = 'status' then 'status'
              else 'wrong_group' end as kind
  from parsed p left join dir d using (grp)),
seq as (
  select *, row_number() over (partition by cluster order by t_us, request_id) as rn
  from cl where kind = 'request'),
fold as (
  select cluster, rn, request_id, grp, t_us,
         case when is_off then 'status' else 'book' end as action,
         case when is_off then '' else grp end as holder,
         case when is_off then null else t_us end as booked
  from seq where rn = 1
  union all
  select s.cluster, s.rn, s.request_id, s.grp, s.t_us,
         case when s.is_off then
                case when f.holder <> '' and s.t_us - f.booked < 900000000 and f.holder = s.grp
                     then 'off' else 'status' end
              else case when f.holder <> '' and s.t_us - f.booked < 900000000 then 'wait' else 'book' end
         end,
         case when f.holder <> '' and s.t_us - f.booked < 900000000
              then (case when s.is_off and f.holder = s.grp then '' else f.holder end)
              else (case when s.is_off then '' else s.grp end) end,
         case when not s.is_off and not (f.holder <> '' and s.t_us - f.booked < 900000000)
              then s.t_us else f.booked end
  from fold f join seq s on s.cluster = f.cluster and s.rn = f.rn + 1),
res as (
  select c.request_id, c.ts, c.t_us, c.grp, c.is_off, c.cluster, c.kind,
         coalesce(f.action, c.kind) as action, f.holder,
         case when f.holder <> '' or f.action = 'off' then f.booked end as booked_us
  from cl c left join fold f using (request_id)),
changes as (
  select cluster, t_us, request_id, case when action = 'book' then grp else '' end as holder, booked_us
  from res where action in ('book', 'off')),
clusters as (select cluster, row_number() over (order by cluster) as pos from (select distinct cluster from dir))
"""

_INTERVALS = """,
nx as (select *, lead(t_us) over w as next_t, lead(holder) over w as next_h from changes
       window w as (partition by cluster order by t_us, request_id)),
iv as (
  select cluster, holder, request_id as booking_id, make_timestamp(t_us) as start,
         case when next_h = '' then make_timestamp(next_t)
              when t_us + 900000000 <= (select max(t_us) from res) then make_timestamp(t_us + 900000000)
              end as "end",
         case when next_h = '' then 'off'
              when t_us + 900000000 <= (select max(t_us) from res) then 'expired' else 'open' end as end_reason,
         case when next_h = '' then next_t
              when t_us + 900000000 <= (select max(t_us) from res) then t_us + 900000000
              else (select max(t_us) from res) end - t_us as held_us
  from nx where holder <> '')"""

_ASOF = """
  select p.probe_id, p.cluster, p.t_us, c.holder as raw_holder, c.booked_us,
         case when coalesce(c.holder, '') <> '' and p.t_us - c.booked_us < 900000000
              then c.holder else '' end as holder
  from {probes} p asof left join changes c on p.cluster = c.cluster and p.t_us >= c.t_us"""

_WAIT = """
  select request_id, cluster, holder,
         floor((900000000 - (t_us - booked_us)) / 60000000)::bigint as wait_min,
         floor(((900000000 - (t_us - booked_us)) % 60000000) / 1000000)::bigint as wait_sec
  from res where action = 'wait'"""

_SIGHT = """,
sight as (select event_id as probe_id, 'c' || (user_id % 4) as cluster, epoch_us(ts) as t_us
          from events where event_type = 'view')"""



def _filled(template: str, **columns: str) -> str:
    """A reply template as a SQL expression over columns."""
    for name, column in columns.items():
        template = template.replace("{" + name + "}", f"' || {column} || '")
    return f"'{template}'"


SQL = {
    "request_parse": _BASE + " select request_id, grp, is_off from parsed",
    "request_cluster": _BASE + " select request_id, grp, cluster, kind from cl",
    "lease_resolve": _BASE + """
        select request_id, cluster, grp, action, holder, make_timestamp(booked_us) as booked_at from res""",
    "lease_resolve_hot": _BASE.replace("'c' || (user_id % 4) as cluster from events",
                                       "'c0' as cluster from events") + """
        select request_id, cluster, grp, action, holder, make_timestamp(booked_us) as booked_at from res""",
    "lease_wait": _BASE + _WAIT,
    "lease_status": _BASE + """,
        probes as (select r.request_id as probe_id, k.cluster, r.t_us from res r, clusters k
                   where r.action = 'status'),
        st as (""" + _ASOF.format(probes="probes") + """)
        select probe_id, cluster, holder from st""",
    "lease_intervals": _BASE + _INTERVALS + " select * from iv",
    "lease_reply": _BASE + """,
        probes as (select r.request_id as probe_id, k.cluster, k.pos, r.t_us from res r, clusters k
                   where r.action <> 'wrong_group'),
        st as (select a.*, p.pos from (""" + _ASOF.format(probes="probes") + """) a
               join probes p using (probe_id, cluster)),
        listing as (select probe_id as request_id,
                           string_agg('["' || cluster || '": ' || holder || ']', ' ' order by pos) as listing
                    from st group by probe_id),
        w as (""" + _WAIT + """)
        select r.request_id, r.action,
               case r.action
                 when 'wrong_group' then '{wrong}'
                 when 'status' then l.listing
                 when 'off' then {off} || chr(10) || l.listing
                 when 'book' then {on} || chr(10) || l.listing
                 when 'wait' then {wait} || chr(10) || l.listing
               end as reply
        from res r left join listing l using (request_id) left join w using (request_id)""".format(
        wrong=LS.REPLY_WRONG_GROUP, off=_filled(LS.REPLY_OFF, grp="r.grp"), on=_filled(LS.REPLY_ON, grp="r.grp"),
        wait=_filled(LS.REPLY_WAIT, holder="r.holder", cluster="r.cluster", min="w.wait_min", sec="w.wait_sec")),
    "lease_usage": _BASE + _INTERVALS + """
        select c.cluster, c.grp, c.bookings, c.waits, c.offs, coalesce(h.held_us, 0)::bigint as held_us
        from (select cluster, grp, count(*) filter (where action = 'book') as bookings,
                     count(*) filter (where action = 'wait') as waits,
                     count(*) filter (where action = 'off') as offs
              from res where cluster is not null group by all) c
        left join (select cluster, holder as grp, sum(held_us) as held_us from iv group by all) h
        using (cluster, grp)""",
    "idle_jobs": _BASE + _SIGHT + """,
        st as (""" + _ASOF.format(probes="sight") + """)
        select probe_id, cluster, floor((t_us - booked_us) / 1000000)::bigint as age_sec from st
        where holder = '' and (booked_us is null or t_us - booked_us >= 120000000)""",
    "foreign_paths": _BASE + _SIGHT + f""",
        pg as (select page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) as upath from pages),
        lst as (select s.probe_id, s.cluster, s.t_us,
                       regexp_extract('{LISTING_PREFIX}' || pg.upath, '(.+) (/.*)', 2) as path
                from sight s join pg on pg.page_id = s.probe_id % (select count(*) from pages)),
        st as (""" + _ASOF.format(probes="(select distinct probe_id, cluster, t_us from lst)") + f""")
        select l.probe_id, l.cluster, st.holder, l.path
        from lst l join st using (probe_id)
        where l.path <> '' and st.holder <> '' and l.t_us - st.booked_us <= 10000000
          and l.path not in ({", ".join(f"'{p}'" for p in LS.PATH_WHITE_LIST)})
          and l.path <> '/user/' || st.holder""",
}
