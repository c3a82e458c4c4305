"""Table maintenance as pure functions: (current, incoming) -> applied rows.

Every function returns the next version of the table with an ``action`` column
(keep, insert, update, ...). Write it once to a new version folder; the table
is ``next_rows`` and the change set ``changed_rows`` of what was written.
Applying the same input again gives only ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.labels import (
    ARCHIVE_ONLY,
    FIRST_OBSERVED,
    OFFICIAL_EXACT,
    PROXY_BASES,
    PUBLICATION_BASIS,
    choose,
    migrated_priority,
)
from ..functions.months import local_date, local_time
from .groups import build_bridge
from .pick import earliest, last_wins, retain_latest, retain_latest_distinct, top_per_key
from .views import exact_promotions

FAR_FUTURE = "9999-12-31 00:00:00"


def next_rows(applied: DataFrame) -> DataFrame:
    return applied.drop("action")


def changed_rows(applied: DataFrame) -> DataFrame:
    return applied.where(F.col("action") != "keep")


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def diff_upsert(
    cur: DataFrame,
    inc: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    retain: Sequence[str] = (),
    replace: Column | None = None,
) -> DataFrame:
    """Upsert that updates only on a null-safe difference in ``compare``.

    ``retain`` columns keep the stored value on update. ``replace`` overrides
    the difference test; it sees stored columns as ``c.x``, incoming as ``i.x``.
    """
    keys = list(keys)
    c = cur.withColumn("_c", F.lit(True)).alias("c")
    i = inc.select(*cur.columns).withColumn("_i", F.lit(True)).alias("i")
    joined = c.join(i, _all([F.col(f"c.{k}") == F.col(f"i.{k}") for k in keys]), "full_outer")
    differs = ~_all([F.col(f"c.{x}").eqNullSafe(F.col(f"i.{x}")) for x in compare]) if compare else F.lit(False)
    change = F.coalesce(replace if replace is not None else differs, F.lit(False))
    action = (
        F.when(F.col("c._c").isNull(), "insert")
        .when(F.col("i._i").isNull(), "keep")
        .when(change, "update")
        .otherwise("keep")
    )
    joined = joined.withColumn("action", action)
    out = []
    for x in cur.columns:
        if x in keys:
            value = F.coalesce(F.col(f"c.{x}"), F.col(f"i.{x}"))
        elif x in retain:
            value = F.when(F.col("action") == "insert", F.col(f"i.{x}")).otherwise(F.col(f"c.{x}"))
        else:
            value = F.when(F.col("action") == "keep", F.col(f"c.{x}")).otherwise(F.col(f"i.{x}"))
        out.append(value.alias(x))
    return joined.select(*out, "action")


def apply_versions(
    cur: DataFrame,
    inc: DataFrame,
    keys: Sequence[str],
    hash_col: str,
    compare: Sequence[str],
    on_insert: dict[str, Column] | None = None,
    on_reactivate: dict[str, Column] | None = None,
    refresh: Sequence[str] = (),
) -> DataFrame:
    """Versioned facts: one current row per key, earlier versions kept.

    An incoming row is skipped if its hash equals the current row's or all
    ``compare`` columns are equal null-safely. Otherwise the current row is
    deactivated; an earlier version with the incoming hash is reactivated (its
    ``refresh`` columns come from the incoming row), or else a new version is
    inserted. ``cur`` has ``version`` and ``is_current``; ``inc`` has one row
    per key. Actions: keep, deactivate, reactivate, insert; ``restated`` tells
    whether the key had a current row.
    """
    keys = list(keys)
    on_insert, on_reactivate = on_insert or {}, on_reactivate or {}
    # Both sides meet in one shuffle by key; the windows below share it.
    offers = inc.select(*keys, F.struct(*inc.columns).alias("_i"))
    both = cur.unionByName(offers, allowMissingColumns=True)
    whole, key = _all([F.col(k).isNotNull() for k in keys]), W.partitionBy(*keys)
    head = F.when(F.col("is_current"), F.struct(F.col(hash_col), *[F.col(x) for x in compare if x != hash_col]))
    met = both.withColumns(
        {
            "_offer": F.coalesce("_i", F.when(whole, F.first("_i", ignorenulls=True).over(key))),
            "_head": F.when(whole, F.first(head, ignorenulls=True).over(key)),
            "_top": F.when(whole, F.max("version").over(key)),
        }
    )
    offer, old = (lambda x: F.col("_offer")[x]), (lambda x: F.col("_head")[x])
    # Whether a stored version has the offered hash.
    known = F.bool_or(F.col("_i").isNull() & (F.col(hash_col) == offer(hash_col))).over(key)
    had = F.coalesce(old(hash_col).isNotNull(), F.lit(False))
    equal = _all([old(x).eqNullSafe(offer(x)) for x in compare]) if compare else F.lit(False)
    same = F.coalesce(had & ((old(hash_col) == offer(hash_col)) | equal), F.lit(False))
    met = met.withColumns(
        {
            "_known": F.coalesce(F.when(whole, known), F.lit(False)),
            "_changed": F.col("_offer").isNotNull() & ~same,
            "restated": had,
        }
    )

    fresh = F.col("_i").isNotNull()
    back = F.col("_changed") & F.coalesce(F.col(hash_col) == offer(hash_col), F.lit(False))
    action = (
        F.when(fresh, "insert")
        .when(back, "reactivate")
        .when(F.col("_changed") & offer(hash_col).isNotNull() & F.col("is_current"), "deactivate")
        .otherwise("keep")
    )
    out = met.where(~fresh | (F.col("_changed") & ~F.col("_known"))).withColumn("action", action)
    reactivated = F.col("action") == "reactivate"
    kept = {x: F.when(reactivated, offer(x)).otherwise(F.col(x)) for x in refresh}
    kept |= {x: F.when(reactivated, v).otherwise(F.col(x)) for x, v in on_reactivate.items()}
    kept["is_current"] = (
        F.when(reactivated, True).when(F.col("action") == "deactivate", False).otherwise(F.col("is_current"))
    )
    added = {"version": F.coalesce(F.col("_top"), F.lit(0)) + 1, "is_current": F.lit(True), **on_insert}
    new = lambda x: added[x] if x in added else F.col(x) if x in keys else offer(x)
    return out.select(
        *[F.when(fresh, new(x)).otherwise(kept.get(x, F.col(x))).alias(x) for x in cur.columns],
        "action",
        ((fresh | reactivated) & F.col("restated")).alias("restated"),
    )


def apply_facts(cur: DataFrame, inc: DataFrame, keys, compare, now) -> DataFrame:
    """Versioned facts with publication stamps.

    New and reactivated rows are first observed now; a reactivated row takes
    the new source file and correction flag.
    """
    at = F.lit(now).cast("timestamp")
    stamp = {
        "publication_timestamp": at,
        "publication_basis": F.lit(FIRST_OBSERVED),
        "last_observed_at": at,
    }
    return apply_versions(
        cur,
        inc,
        keys,
        "row_hash",
        compare,
        on_insert=stamp | {"first_observed_at": at},
        on_reactivate=stamp,
        refresh=("file_id", "corrected"),
    )


def version_counts(applied: DataFrame) -> DataFrame:
    """One row: rows written (inserts and reactivations) and restatements."""
    written = F.col("action").isin("insert", "reactivate")
    return applied.agg(
        F.count_if(written).alias("inserted"),
        F.count_if(written & F.col("restated")).alias("restatements"),
    )


def first_seen(applied: DataFrame, now, keys: Sequence[str] = ("entity", "month")) -> DataFrame:
    """Keys that changed in this run, first seen now."""
    return changed_rows(applied).select(*keys).distinct().withColumn(
        "first_seen", F.lit(now).cast("timestamp")
    )


def first_seen_dates(seen: DataFrame, now) -> DataFrame:
    """First sightings in the shape of incoming report dates."""
    at = F.col("first_seen")
    return seen.select(
        "entity",
        "month",
        local_date(at).alias("reported_date"),
        local_time(at).alias("reported_time"),
        at.alias("reported_at"),
        F.lit("mops_first_observed").alias("basis"),
        F.lit(2).alias("source_priority"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit(None).cast("string").alias("source_subject"),
        at.alias("first_recorded_at"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )


def apply_files(files: DataFrame, payloads: DataFrame) -> DataFrame:
    """Source-file registry: one current version per (month, market).

    Only files that brought changed rows belong in ``payloads``. A known hash
    is reactivated, never stored twice.
    """
    return apply_versions(files, payloads, ["month", "market"], "source_hash", [])


def changed_payloads(payloads: DataFrame, applied: DataFrame) -> DataFrame:
    """Payloads that at least one written row came from."""
    used = applied.where(F.col("action").isin("insert", "reactivate")).select("file_id").distinct()
    return payloads.join(used, "file_id", "left_semi")


def priority_upsert(
    cur: DataFrame,
    inc: DataFrame,
    keys: Sequence[str] = ("entity", "month"),
    retain: Sequence[str] = ("first_recorded_at",),
    seq: Sequence[str] = (),
) -> DataFrame:
    """Resolve report dates by source priority, then by earliest instant.

    A lower priority number always wins. At equal priority only a known and
    strictly earlier instant replaces the stored one. Several incoming rows per
    key resolve as if they came one after another in ``seq`` order. One
    aggregation over the union of both sides does it, so hot keys shrink before
    the shuffle.
    """
    keys = list(keys)
    columns = [x for x in cur.columns if x not in keys]
    order_cols = [F.lit(0).cast("long").alias(f"_s{n}") for n in range(len(seq))]
    stored = cur.select(*keys, *columns, F.lit(True).alias("_stored"), *order_cols)
    new = inc.select(
        *keys, *columns, F.lit(False).alias("_stored"), *[F.col(s).cast("long").alias(f"_s{n}") for n, s in enumerate(seq)]
    )
    order = F.struct(
        "source_priority",
        F.coalesce("reported_at", F.lit(FAR_FUTURE).cast("timestamp")).alias("at"),
        (~F.col("_stored")).alias("new"),
        *[f"_s{n}" for n in range(len(seq))],
    )
    payload = F.struct(*columns, "_stored")
    kept = [
        F.max_by(F.struct(x), F.when(F.col("_stored"), F.lit(1))).alias(f"_k_{x}") for x in retain
    ]
    solved = (
        stored.unionByName(new)
        .groupBy(*keys)
        .agg(F.min_by(payload, order).alias("_w"), F.bool_or("_stored").alias("_had"), *kept)
    )
    action = (
        F.when(F.col("_w._stored"), "keep").when(F.col("_had"), "update").otherwise("insert")
    )
    out = [
        F.when(F.col("_had"), F.col(f"_k_{x}.{x}")).otherwise(F.col(f"_w.{x}")).alias(x)
        if x in retain
        else F.col(f"_w.{x}").alias(x)
        for x in columns
    ]
    return solved.select(*keys, *out, action.alias("action"))


def company_release_upsert(cur: DataFrame, inc: DataFrame, keys=("entity", "month")) -> DataFrame:
    """Company releases over stored report dates.

    They replace a worse priority, and at equal priority anything that differs,
    even if earlier, unless an official exact source is stored.
    """
    differs = ~_all(
        [
            F.col(f"c.{x}").eqNullSafe(F.col(f"i.{x}"))
            for x in ("basis", "reported_at", "source_url", "source_subject")
        ]
    )
    better = F.col("i.source_priority") < F.col("c.source_priority")
    equal = F.col("i.source_priority") == F.col("c.source_priority")
    replace = better | (equal & ~F.col("c.basis").isin(*OFFICIAL_EXACT) & differs)
    return diff_upsert(cur, inc, keys, [], retain=("first_recorded_at",), replace=replace)


def trim_dates(dates: DataFrame, months: int = 12) -> DataFrame:
    """Report dates keep twelve months per entity."""
    return retain_latest(dates, months)


def apply_evidence(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """Evidence keyed by (basis, record id); updates only on a difference.

    Percents compare null-safely. For the other columns a null on a side counts
    as no difference.
    """
    strict = ["entity", "month", "published_at", "source_url", "source_title", "matched_revenue"]
    loose = [x for x in ("matched_mom", "matched_yoy") if x in cur.columns]
    tests = [F.coalesce(F.col(f"c.{x}") != F.col(f"i.{x}"), F.lit(False)) for x in strict]
    tests += [~F.col(f"c.{x}").eqNullSafe(F.col(f"i.{x}")) for x in loose]
    replace = reduce(lambda a, b: a | b, tests)
    return diff_upsert(
        cur, inc, ["basis", "record_id"], [], retain=("first_recorded_at", "exact"), replace=replace
    )


def trim_evidence(evidence: DataFrame, months: int = 12) -> DataFrame:
    """Evidence keeps the rows of twelve distinct months per entity."""
    return retain_latest_distinct(evidence, months)


def _promote(observations: DataFrame, offers: DataFrame, keys, allowed: Column) -> DataFrame:
    """Write offered (obs_id, new_timestamp, new_basis) where ``allowed``."""
    joined = observations.join(
        offers.select(*keys, "obs_id", "new_timestamp", "new_basis"), [*keys, "obs_id"], "left"
    )
    take = F.coalesce(F.col("new_basis").isNotNull() & F.col("is_current") & allowed, F.lit(False))
    return (
        joined.withColumn("action", F.when(take, "update").otherwise("keep"))
        .withColumn(
            "publication_timestamp",
            F.when(take, F.col("new_timestamp")).otherwise(F.col("publication_timestamp")),
        )
        .withColumn(
            "publication_basis",
            F.when(F.col("action") == "update", F.col("new_basis")).otherwise(F.col("publication_basis")),
        )
        .select(*observations.columns, "action")
    )


def _stamp_differs() -> Column:
    return ~(
        F.col("publication_timestamp").eqNullSafe(F.col("new_timestamp"))
        & F.col("publication_basis").eqNullSafe(F.col("new_basis"))
    )


def promote_exact(observations: DataFrame, report_dates: DataFrame, keys=("entity", "month")) -> DataFrame:
    """Exact dates become the timestamp of never-restated current rows."""
    offers = exact_promotions(observations, report_dates, keys)
    return _promote(observations, offers, list(keys), _stamp_differs())


def promote_company(observations: DataFrame, matched: DataFrame, keys=("entity", "month")) -> DataFrame:
    """Company releases stamp never-restated rows without an official time.

    ``matched`` has the matched releases: keys, obs_id, published_at.
    """
    from .views import never_restated

    latest = last_wins(matched, [*keys, "obs_id"], "published_at").select(
        *keys,
        "obs_id",
        F.col("published_at").alias("new_timestamp"),
        F.lit(PUBLICATION_BASIS["company_ir_monthly_revenue"]).alias("new_basis"),
    )
    clean = never_restated(observations, keys).select(*keys, "obs_id")
    offers = latest.join(clean, [*keys, "obs_id"], "left_semi")
    official = [PUBLICATION_BASIS[b] for b in OFFICIAL_EXACT]
    allowed = ~F.col("publication_basis").isin(*official) & _stamp_differs()
    return _promote(observations, offers, list(keys), allowed)


def promote_proxy(observations: DataFrame, dates: DataFrame, keys=("entity", "month")) -> DataFrame:
    """Proxies fill missing or archive-only stamps and replace later proxies.

    ``dates`` is the output of ``match.evidence_dates``.
    """
    codes = {b: PUBLICATION_BASIS[b] for b in PROXY_BASES}
    offers = dates.where(F.col("is_current")).select(
        *keys,
        "obs_id",
        F.col("reported_at").alias("new_timestamp"),
        choose("basis", codes).alias("new_basis"),
    )
    later = F.col("publication_basis").isin(*codes.values()) & (
        F.col("publication_timestamp") > F.col("new_timestamp")
    )
    allowed = (
        F.col("publication_basis").isNull() | (F.col("publication_basis") == ARCHIVE_ONLY) | later
    )
    return _promote(observations, offers, list(keys), allowed)


RATE_COMPARE = (
    "average_rate",
    "observations",
    "first_date",
    "last_date",
    "method",
    "source_name",
    "source_url",
)


def valid_rates(rates: DataFrame) -> DataFrame:
    """Rates that may be stored: first of month, plausible, with observations."""
    return rates.where(
        (F.dayofmonth("month") == 1)
        & F.col("average_rate").between(10, 100)
        & (F.col("observations") > 0)
    )


def apply_rates(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """Monthly rates; a new retrieval of the same figures changes nothing."""
    compare = [x for x in RATE_COMPARE if x in cur.columns]
    return diff_upsert(cur, inc, ["month"], compare)


def memo_worklist(notes: DataFrame, memo: DataFrame) -> DataFrame:
    """Distinct notes that are not translated yet, or still pending."""
    done = memo.where(F.col("status") != "pending").select("note_hash")
    return notes.dropDuplicates(["note_hash"]).join(done, "note_hash", "left_anti")


def apply_memo(memo: DataFrame, finished: DataFrame) -> DataFrame:
    """Note translations: pending may become complete, complete may change, and
    nothing goes back to pending."""
    better = (F.col("c.status") == "pending") & (F.col("i.status") == "complete")
    changed = (
        (F.col("c.status") == "complete")
        & (F.col("i.status") == "complete")
        & ((F.col("c.english") != F.col("i.english")) | (F.col("c.provider") != F.col("i.provider")))
    )
    return diff_upsert(memo, finished, ["note_hash"], [], replace=better | changed)


PROFILE_COMPARE = (
    "samples",
    "actual_samples",
    "ir_samples",
    "median_offset",
    "median_minute",
    "mad_days",
    "method",
    "confidence",
    "as_of_month",
)


def apply_profiles(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """Release profiles, one per entity; nine compared columns."""
    return diff_upsert(cur, inc, ["entity"], PROFILE_COMPARE)


def apply_schedule(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """Schedule rows, one per (entity, month); every figure is compared."""
    keys = ("entity", "month")
    ignored = (*keys, "updated_at", "last_evaluated_at")
    return diff_upsert(cur, inc, keys, [x for x in cur.columns if x not in ignored])


def apply_sources(sources: DataFrame, polls: DataFrame, now) -> DataFrame:
    """Source registry after a poll.

    A poll finds its source by (entity, url), else by (entity, parser) when the
    url moved, else it is new. An unavailable poll clears a stored error; a
    failed poll stores its error once; a good poll stores its content hash and
    clears the error. ``content_changed`` marks sources whose events to renew.
    Of several polls that lead to one source the last decides: the one of the
    highest ``poll_order``, where ``polls`` has that column, then of the greatest
    address.
    """
    at = F.lit(now).cast("timestamp")
    order = F.col("poll_order") if "poll_order" in polls.columns else F.lit(0)
    definition = ["source_type", "source_url", "parser_name", "source_priority", "enabled"]
    state = ["content_hash", "last_success_at", "last_error_at", "last_error_message"]
    p = polls.select(
        "entity",
        *[F.col(x).alias(f"p_{x}") for x in definition],
        F.col("unavailable").alias("p_unavailable"),
        F.col("error").alias("p_error"),
        F.col("content_hash").alias("p_hash"),
        order.alias("p_order"),
    )
    # An address polled again still finds its source once.
    hits = p.select("entity", F.col("p_source_url").alias("source_url"), F.lit(True).alias("_hit")).distinct()
    by_url = sources.join(
        hits,
        ["entity", "source_url"],
        "left",
    )
    url_hits = by_url.where("_hit").select("entity", F.col("source_url").alias("p_source_url"), "source_id")
    moved = p.join(url_hits, ["entity", "p_source_url"], "left_anti")
    candidates = moved.select("entity", "p_source_url", F.col("p_parser_name").alias("parser_name")).distinct().join(
        sources.select("entity", "parser_name", "source_id", "enabled"), ["entity", "parser_name"]
    )
    parser_hits = top_per_key(
        candidates, ["entity", "p_source_url"], [F.desc("enabled"), F.asc("source_id")]
    ).select("entity", "p_source_url", "source_id")
    located = p.join(url_hits.unionByName(parser_hits), ["entity", "p_source_url"], "left")
    # A new source gets an id from its definition, so a replay gives the same one.
    fresh_id = F.sha2(F.concat_ws("|", F.col("entity").cast("string"), "p_source_url", "p_parser_name"), 256)
    located = located.withColumn("_new", F.col("source_id").isNull()).withColumn(
        "source_id", F.coalesce("source_id", fresh_id)
    )
    # Two polled addresses can lead to one source; it takes the last of them.
    located = top_per_key(located, ["source_id"], [F.desc_nulls_last("p_order"), F.desc("p_source_url")])

    both = sources.alias("s").join(located.alias("p"), "source_id", "full_outer")
    polled = F.col("p._new").isNotNull()
    defined = polled & ~_all([F.col(f"s.{x}").eqNullSafe(F.col(f"p.p_{x}")) for x in definition])
    good = polled & ~F.col("p.p_unavailable") & F.col("p.p_error").isNull()
    failed = polled & ~F.col("p.p_unavailable") & F.col("p.p_error").isNotNull()
    gone = polled & F.col("p.p_unavailable")
    had_error = F.col("s.last_error_message").isNotNull()
    renewed = good & ~F.col("s.content_hash").eqNullSafe(F.col("p.p_hash"))
    success = renewed | (good & had_error)
    new_error = failed & ~F.col("s.last_error_message").eqNullSafe(F.col("p.p_error"))
    cleared = gone & (had_error | F.col("s.last_error_at").isNotNull())
    out = {
        "entity": F.coalesce("s.entity", "p.entity"),
        **{x: F.when(polled, F.col(f"p.p_{x}")).otherwise(F.col(f"s.{x}")) for x in definition},
        "content_hash": F.when(success, F.col("p.p_hash")).otherwise(F.col("s.content_hash")),
        "last_success_at": F.when(success, at).otherwise(F.col("s.last_success_at")),
        "last_error_at": F.when(success | cleared, F.lit(None)).when(new_error, at).otherwise(F.col("s.last_error_at")),
        "last_error_message": F.when(success | cleared, F.lit(None))
        .when(new_error, F.col("p.p_error"))
        .otherwise(F.col("s.last_error_message")),
    }
    action = (
        F.when(F.col("p._new"), "insert")
        .when(defined | success | new_error | cleared, "update")
        .otherwise("keep")
    )
    return both.select(
        "source_id",
        *[v.alias(k) for k, v in out.items()],
        F.coalesce(renewed, F.lit(False)).alias("content_changed"),
        F.coalesce(action, F.lit("keep")).alias("action"),
    )


def apply_events(events: DataFrame, polled: DataFrame, applied_sources: DataFrame, now) -> DataFrame:
    """Announced events of renewed sources.

    Every event of a renewed source is deactivated, then the polled ones are
    activated again by hash or inserted. ``polled`` has (source_id, entity,
    month, announced_date, announced_time, title, event_hash).
    """
    at = F.lit(now).cast("timestamp")
    renewed = applied_sources.where("content_changed").select("source_id", F.lit(True).alias("_renewed"))
    live = polled.join(renewed, "source_id").drop("_renewed").dropDuplicates(["source_id", "event_hash"])
    marked = events.join(renewed, "source_id", "left").join(
        live.select("source_id", "event_hash", F.lit(True).alias("_live")), ["source_id", "event_hash"], "left"
    )
    touched = F.coalesce("_renewed", F.lit(False))
    on = F.coalesce("_live", F.lit(False))
    action = (
        F.when(touched & on, "activate").when(touched & F.col("is_current"), "deactivate").otherwise("keep")
    )
    kept = marked.withColumn("action", action).withColumns(
        {
            "is_current": F.when(F.col("action") == "activate", True)
            .when(F.col("action") == "deactivate", False)
            .otherwise(F.col("is_current")),
            "last_detected_at": F.when(F.col("action") == "keep", F.col("last_detected_at")).otherwise(at),
        }
    )
    fresh = live.join(events.select("source_id", "event_hash"), ["source_id", "event_hash"], "left_anti")
    fresh = fresh.withColumns(
        {
            "first_detected_at": at,
            "last_detected_at": at,
            "is_current": F.lit(True),
            "action": F.lit("insert"),
        }
    )
    columns = [*events.columns, "action"]
    return kept.select(*columns).unionByName(fresh.select(*columns))


def onboard(rows: DataFrame, facts: DataFrame, keys: Sequence[str] = ("entity", "month")) -> DataFrame:
    """Rows of a new entity against stored facts: insert, skip, or conflict.

    A conflict (same key, other hash) must stop the load; nothing is ever
    overwritten here.
    """
    known = facts.select(*keys, F.col("row_hash").alias("_known"))
    action = (
        F.when(F.col("_known").isNull(), "insert")
        .when(F.col("_known") == F.col("row_hash"), "skip")
        .otherwise("conflict")
    )
    return rows.join(known, list(keys), "left").withColumn("action", action).drop("_known")


def refresh_manifest(dim: DataFrame, universe: DataFrame, now) -> DataFrame:
    """Renumber known entities from the universe file and add new ones.

    ``dim`` has (ticker, name, labels, row_number, created_at, updated_at);
    ``universe`` has (ticker, name, labels, row_number).
    """
    at = F.lit(now).cast("timestamp")
    u = universe.select("ticker", *[F.col(x).alias(f"u_{x}") for x in ("name", "labels", "row_number")])
    both = dim.withColumn("_known", F.lit(True)).join(u, "ticker", "full_outer")
    known = F.col("_known").isNotNull()
    found = F.col("u_row_number").isNotNull()
    return both.select(
        "ticker",
        F.coalesce("name", "u_name").alias("name"),
        F.coalesce("labels", "u_labels").alias("labels"),
        F.coalesce("u_row_number", "row_number").alias("row_number"),
        F.coalesce("created_at", at).alias("created_at"),
        F.when(found, at).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(~known, "insert").when(found, "renumber").otherwise("keep").alias("action"),
    )


def labels_of_new(manifest: DataFrame) -> DataFrame:
    """(ticker, classification, label_order) of entities that ``refresh_manifest`` inserts; known ones keep theirs."""
    new = manifest.where("action = 'insert'")
    return build_bridge(new.select(F.col("ticker").alias("entity"), "labels")).withColumnRenamed("entity", "ticker")


def migrate_dates(dates: DataFrame) -> DataFrame:
    """Stored report dates with the priority their basis now has."""
    return dates.withColumn("source_priority", migrated_priority("basis"))


def backfill_dates(announcements: DataFrame, schedule: DataFrame, facts: DataFrame) -> DataFrame:
    """Report dates from announcements that came true and from first sightings.

    Announced dates of months with a current fact come in at priority 3; first
    sightings of the schedule replace them at priority 2.
    """
    columns = ["entity", "month", "reported_date", "reported_time", "basis", "source_priority"]
    known = announcements.join(
        facts.select("entity", "month"), ["entity", "month"], "left_semi"
    ).select(
        "entity",
        "month",
        F.col("announced_date").alias("reported_date"),
        F.col("announced_time").alias("reported_time"),
        F.lit("ir_calendar_matched").alias("basis"),
        F.lit(3).alias("source_priority"),
    )
    seen = schedule.where(F.col("actual_date").isNotNull()).select(
        "entity",
        "month",
        F.col("actual_date").alias("reported_date"),
        F.col("actual_time").alias("reported_time"),
        F.lit("mops_first_observed").alias("basis"),
        F.lit(2).alias("source_priority"),
    )
    return top_per_key(
        known.unionByName(seen).select(*columns), ["entity", "month"], [F.asc("source_priority")]
    )


def run_counters(changes: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and action over the change sets of a run."""
    parts = [
        applied.where(F.col("action") != "keep")
        .groupBy("action")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table"), "action", "rows")
        for name, applied in changes.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def seed_dates(seeds: DataFrame, companies: DataFrame, facts: DataFrame) -> DataFrame:
    """Seed report dates of known entities and existing facts, local to UTC.

    ``seeds`` has (ticker, month, reported_date, reported_time, subject).
    """
    from ..functions.months import local_to_utc

    joined = seeds.join(companies.select("ticker", "entity"), "ticker").join(
        facts.select("entity", "month"), ["entity", "month"], "left_semi"
    )
    return joined.withColumns(
        {
            "reported_at": local_to_utc("reported_date", "reported_time"),
            "basis": F.lit("mops_revenue_announcement"),
            "source_priority": F.lit(1),
        }
    )


def earliest_evidence(*sources: DataFrame) -> DataFrame:
    """Union of evidence sources, one row per record id, earliest kept."""
    union = reduce(lambda a, b: a.unionByName(b), sources)
    return earliest(union, ["basis", "record_id"], "published_at", "entity")
