"""Rules over groups of events.

Three of them judge a whole group: it must hold enough and span no more than the window. Every group is
reduced to a few numbers, before and after the shuffle; failed logins are counted by user first, which
spreads a busy address. Only the names of qualifying groups are gathered. The events of an alert are not
looked at again here: ``operators.members`` gives them as rows.

The fourth counts, for every success, the failures shortly before it. Events are first reduced to one row per
address and moment. Every moment with successes then asks twice: how many failures its address has up to it, and how many
before the window; the difference is the answer. Moments and questions are sorted together over ranges of (address,
moment), so that an address with any number of them is spread over tasks: running sums within a range, and the sums of
the ranges before, one small row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.functions.times import MICROS, floor_bucket
from logwarden.operators.limits import with_limits
from logwarden.operators.numbering import RANGE, deal
from logwarden.plans.workarea import WorkArea
from logwarden.schema import CISCO, LINUX, position
from logwarden.settings import DetectionSettings

FINDING_COLUMNS = [
    "rule_id",
    "alert_key",
    "detected_at",
    "source",
    "source_ip",
    "user_name",
    "resource",
    "evidence",
    "event_count",
    "first_event_at",
    "last_event_at",
    "host_name",
    "own_event_id",
    "seen",
]


BRUTE_FORCE, ENUMERATION, SUCCESS, FLAP = "LINUX-AUTH-001", "LINUX-AUTH-002", "LINUX-AUTH-003", "CISCO-NET-001"


def span_within(first: Column, last: Column, window_seconds: Column) -> Column:
    """Whether a group's whole span, both ends included, fits into the window."""
    return F.unix_micros(last) - F.unix_micros(first) <= window_seconds * MICROS


def ssh_failures(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("source") == LINUX) & (F.col("action") == "ssh_login_failed") & F.col("source_ip").isNotNull()
    )


def ssh_successes(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("source") == LINUX) & (F.col("action") == "ssh_login_success") & F.col("source_ip").isNotNull()
    )


def interface_changes(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("source") == CISCO)
        & (F.col("action") == "cisco_interface_state_change")
        & (F.col("host_name") != "")
        & (F.col("resource") != "")
    )


def _scoped(events: DataFrame, keys: list[str], settings: DetectionSettings) -> tuple[DataFrame, list[str]]:
    if settings.batch_unit is None:
        return events, keys
    return events.withColumn("batch", F.date_trunc(settings.batch_unit, F.col("timestamp"))), ["batch", *keys]


def with_salt(events: DataFrame, salts: int) -> DataFrame:
    return events.withColumn("salt", F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int"))


def spread(groups: DataFrame, window_seconds: int, salts: int) -> DataFrame:
    """A group once per time bucket it touches and per salt."""
    buckets = F.array_distinct(
        F.array(floor_bucket(F.col("first_at"), window_seconds), floor_bucket(F.col("last_at"), window_seconds))
    )
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return groups.withColumn("bucket", F.explode(buckets)).withColumn("salt", salt)


def _key_text(columns: list[str]) -> Column:
    return F.concat_ws("\n", *[F.col(c).cast("string") for c in columns])


# --- SSH failures per address ------------------------------------------------------------------


def auth_users(events: DataFrame, settings: DetectionSettings) -> DataFrame:
    """Numbers of failed logins per (batch,) source_ip and user, invalid or not."""
    scoped, keys = _scoped(ssh_failures(events), ["source_ip"], settings)
    return (
        scoped.withColumn("invalid_user", F.coalesce(F.col("invalid_user"), F.lit(False)))
        .groupBy(*keys, "user_name", "invalid_user")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
            F.min(position()).alias("seen"),
        )
    )


def auth_groups(by_user: DataFrame) -> DataFrame:
    """Numbers per address, of all its failures and of those for invalid users, who are counted once each."""
    keys = [c for c in ("batch", "source_ip") if c in by_user.columns]
    tried = F.col("invalid_user")
    return by_user.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min("seen").alias("seen"),
        F.coalesce(F.sum(F.when(tried, F.col("n"))), F.lit(0)).alias("invalid_n"),
        F.min(F.when(tried, F.col("first_at"))).alias("invalid_first_at"),
        F.max(F.when(tried, F.col("last_at"))).alias("invalid_last_at"),
        F.count_if((F.col("user_name") != "") & tried).alias("invalid_names"),
    )


def qualifying_auth_groups(groups: DataFrame, settings: DetectionSettings, limits: DataFrame | None = None) -> DataFrame:
    """One row per address and rule that it fulfils, with the numbers of the events that rule covers."""
    brute, enum = settings.linux_brute_force, settings.linux_user_enumeration
    groups = with_limits(groups, limits, BRUTE_FORCE, "source_ip", brute.threshold, brute.window_seconds, "brute_")
    groups = with_limits(groups, limits, ENUMERATION, "source_ip", enum.distinct_user_threshold, enum.window_seconds, "enum_")

    is_brute = (F.col("n") >= F.col("brute_threshold")) & span_within(
        F.col("first_at"), F.col("last_at"), F.col("brute_window")
    )
    is_enum = (F.col("invalid_names") >= F.col("enum_threshold")) & span_within(
        F.col("invalid_first_at"), F.col("invalid_last_at"), F.col("enum_window")
    )
    keys = [c for c in ("batch", "source_ip") if c in groups.columns]
    rule = F.explode(F.array(F.lit(BRUTE_FORCE), F.lit(ENUMERATION))).alias("rule_id")
    both = groups.withColumns({"is_brute": is_brute, "is_enum": is_enum}).select("*", rule)
    by_rule = lambda a, b: F.when(F.col("rule_id") == BRUTE_FORCE, F.col(a)).otherwise(F.col(b))
    return both.where(by_rule("is_brute", "is_enum")).select(
        *keys,
        "seen",
        "rule_id",
        *[by_rule(name, f"invalid_{name}").alias(name) for name in ("n", "first_at", "last_at")],
    )


def auth_findings(events: DataFrame, settings: DetectionSettings, work: WorkArea, limits: DataFrame | None = None) -> DataFrame:
    """Brute force and user enumeration."""
    by_user = work.write(auth_users(events, settings), work.fresh("auth_users"))
    groups = work.write(qualifying_auth_groups(auth_groups(by_user), settings, limits), work.fresh("auth_groups"))
    keys = [c for c in ("batch", "source_ip") if c in by_user.columns]
    brute = F.col("rule_id") == BRUTE_FORCE
    named = by_user.where(F.col("user_name") != "").select(*keys, "user_name", "invalid_user")
    users = (
        groups.select(*keys, "rule_id")
        .join(named, keys)
        .where(brute | F.col("invalid_user"))
        .groupBy(*keys, "rule_id")
        .agg(F.array_join(F.array_sort(F.collect_set("user_name")), ", ").alias("users"))
    )
    users_text = F.coalesce("users", F.lit(""))
    return groups.join(users, [*keys, "rule_id"], "left").select(
        "rule_id",
        _key_text([*keys, "first_at", "last_at", "n"]).alias("alert_key"),
        F.col("last_at").alias("detected_at"),
        F.lit(LINUX).alias("source"),
        "source_ip",
        F.lit(None).cast("string").alias("user_name"),
        F.lit(None).cast("string").alias("resource"),
        F.when(
            brute,
            F.array(
                F.concat(F.col("n").cast("string"), F.lit(" failed SSH logins")),
                F.concat(F.lit("Targeted users: "), users_text),
            ),
        )
        .otherwise(F.array(F.concat(F.lit("Invalid users tested: "), users_text)))
        .alias("evidence"),
        F.col("n").alias("event_count"),
        F.col("first_at").alias("first_event_at"),
        F.col("last_at").alias("last_event_at"),
        F.lit(None).cast("string").alias("host_name"),
        F.lit(None).cast("string").alias("own_event_id"),
        "seen",
    )


# --- SSH success after failures ----------------------------------------------------------------

MOMENT = ["source_ip", "at"]


def auth_moments(events: DataFrame) -> DataFrame:
    """Failures and successes per address and moment."""
    failed = F.col("action") == "ssh_login_failed"
    logins = (F.col("source") == LINUX) & F.col("action").isin("ssh_login_failed", "ssh_login_success")
    return (
        events.where(logins & F.col("source_ip").isNotNull())
        .groupBy("source_ip", F.unix_micros("timestamp").alias("at"))
        .agg(F.count_if(failed).alias("failures"), F.count_if(~failed).alias("successes"))
    )


# Questions and answers at one moment: what came before the window's start, failures, what came up to the success.
_START, _FAILED, _END = 0, 1, 2


def _window_rows(moments: DataFrame) -> DataFrame:
    """source_ip, at, kind, of (the success asked for), failures, and the threshold of the address."""
    no, width = F.lit(None).cast("bigint"), F.col("window") * MICROS
    row = lambda at, kind, of, n: F.struct(at.alias("at"), F.lit(kind).alias("kind"), of.alias("of"), n.alias("failures"))
    at, zero = F.col("at"), F.lit(0).cast("bigint")
    asked = F.when(F.col("successes") > 0, F.array(row(at - width, _START, at, zero), row(at, _END, at, zero)))
    found = F.when(F.col("failures") > 0, F.array(row(at, _FAILED, no, F.col("failures"))))
    nothing = F.array().cast("array<struct<at:bigint,kind:int,of:bigint,failures:bigint>>")
    rows = F.concat(F.coalesce(found, nothing), F.coalesce(asked, nothing))
    return moments.select("source_ip", "threshold", F.explode(rows).alias("row")).select("source_ip", "row.*", "threshold")


def success_hits(
    moments: DataFrame, settings: DetectionSettings, work: WorkArea, limits: DataFrame | None = None
) -> DataFrame:
    """Address and moment of successes with enough failures before them, how many, and the first of them."""
    rule = settings.successful_login_after_failures
    order = [F.col(name) for name in ("source_ip", "at", "kind", "of")]
    moments = with_limits(moments, limits, SUCCESS, "source_ip", rule.failure_threshold, rule.window_seconds)
    dealt = deal(_window_rows(moments), order, work, "login-moments")
    ranges = dealt.groupBy("source_ip", RANGE).agg(
        F.sum("failures").alias("n"), F.min(F.when(F.col("kind") == _FAILED, F.col("at"))).alias("first_failure")
    )
    earlier = Window.partitionBy("source_ip").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("source_ip").orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    outside = ranges.select(
        "source_ip",
        RANGE,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("sum_before"),
        F.min("first_failure").over(later).alias("failure_after"),
    )
    here = Window.partitionBy("source_ip", RANGE)
    running = here.orderBy("at", "kind", "of").rowsBetween(Window.unboundedPreceding, 0)
    # from the range's end backwards: the nearest failure at or after each row
    backwards = here.orderBy(F.desc("at"), F.desc("kind"), F.desc("of")).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.select(
        "*",
        F.sum("failures").over(running).alias("sum"),
        F.min(F.when(F.col("kind") == _FAILED, F.col("at"))).over(backwards).alias("next_failure"),
    )
    answers = (
        summed.where(F.col("kind") != _FAILED)
        .join(work.write(outside, work.fresh("login-ranges")), ["source_ip", RANGE])
        .withColumn("total", F.col("sum") + F.col("sum_before"))
        .groupBy("source_ip", F.col("of").alias("at"))
        .agg(
            (F.max(F.when(F.col("kind") == _END, F.col("total"))) - F.max(F.when(F.col("kind") == _START, F.col("total")))).alias("n"),
            F.max(F.when(F.col("kind") == _START, F.coalesce("next_failure", "failure_after"))).alias("first_failure"),
            F.min("threshold").alias("threshold"),
        )
    )
    return answers.where(F.col("n") >= F.col("threshold")).drop("threshold")


def success_findings(events: DataFrame, settings: DetectionSettings, work: WorkArea, limits: DataFrame | None = None) -> DataFrame:
    """One finding per success that follows enough failures from its address."""
    salts = settings.scale.salts
    hits = work.write(success_hits(auth_moments(events), settings, work, limits), work.fresh("success_hits"))
    # successes of one moment may be many: each meets a copy of its moment's one row. The copies outgrow by far what the size of
    # the written file says, so they are never broadcast by it
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    successes = with_salt(ssh_successes(events), salts).select(
        F.unix_micros("timestamp").alias("at"), "source_ip", "salt", "timestamp", "user_name", "host_name", "event_id", position().alias("seen")
    )
    account = F.coalesce(F.col("user_name"), F.lit("None"))
    return successes.join(hits, [*MOMENT, "salt"]).select(
        F.lit(SUCCESS).alias("rule_id"),
        F.col("event_id").alias("alert_key"),
        F.col("timestamp").alias("detected_at"),
        F.lit(LINUX).alias("source"),
        "source_ip",
        "user_name",
        F.lit(None).cast("string").alias("resource"),
        F.array(
            F.concat(F.col("n").cast("string"), F.lit(" failures before success")),
            F.concat(F.lit("Successful account: "), account),
        ).alias("evidence"),
        (F.col("n") + 1).alias("event_count"),
        F.timestamp_micros("first_failure").alias("first_event_at"),
        F.col("timestamp").alias("last_event_at"),
        "host_name",
        F.col("event_id").alias("own_event_id"),
        "seen",
    )


# --- Interface state changes -------------------------------------------------------------------


def interface_groups(events: DataFrame, settings: DetectionSettings, limits: DataFrame | None = None) -> DataFrame:
    """Qualifying groups: an interface went down and up, all within the window."""
    scoped, keys = _scoped(interface_changes(events), ["host_name", "resource"], settings)
    groups = scoped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
        F.count_if(F.col("outcome") == "failure").alias("downs"),
        F.count_if(F.col("outcome") == "success").alias("ups"),
        F.min(position()).alias("seen"),
    )
    changed = groups.where((F.col("downs") > 0) & (F.col("ups") > 0))
    limited = with_limits(changed, limits, FLAP, "host_name", None, settings.cisco_interface_flap.window_seconds)
    return limited.where(span_within(F.col("first_at"), F.col("last_at"), F.col("window"))).drop(
        "downs", "ups", "threshold", "window"
    )


def interface_findings(events: DataFrame, settings: DetectionSettings, work: WorkArea, limits: DataFrame | None = None) -> DataFrame:
    groups = interface_groups(events, settings, limits)
    keys = [c for c in ("batch", "host_name", "resource") if c in groups.columns]
    return groups.select(
        F.lit(FLAP).alias("rule_id"),
        _key_text([*keys, "first_at", "last_at", "n"]).alias("alert_key"),
        F.col("last_at").alias("detected_at"),
        F.lit(CISCO).alias("source"),
        F.lit(None).cast("string").alias("source_ip"),
        F.lit(None).cast("string").alias("user_name"),
        "resource",
        F.array(
            F.concat(F.lit("Device: "), F.col("host_name")),
            F.concat(F.lit("Interface: "), F.col("resource")),
            F.concat(F.lit("State changes: "), F.col("n").cast("string")),
        ).alias("evidence"),
        F.col("n").alias("event_count"),
        F.col("first_at").alias("first_event_at"),
        F.col("last_at").alias("last_event_at"),
        "host_name",
        F.lit(None).cast("string").alias("own_event_id"),
        "seen",
    )


#: What finds each group rule's alerts.
CORRELATIONS = {
    (BRUTE_FORCE, ENUMERATION): auth_findings,
    (SUCCESS,): success_findings,
    (FLAP,): interface_findings,
}


def correlated_findings(
    events: DataFrame,
    settings: DetectionSettings,
    work: WorkArea,
    rules: set[str] | None = None,
    limits: DataFrame | None = None,
) -> list[DataFrame]:
    """Findings of all rules over groups, or of those in ``rules``; what finds none of these isn't run."""
    found = []
    for names, find in CORRELATIONS.items():
        if rules is None:
            found.append(find(events, settings, work, limits).select(*FINDING_COLUMNS))
        elif wanted := rules.intersection(names):
            some = find(events, settings, work, limits).where(F.col("rule_id").isin(*sorted(wanted)))
            found.append(some.select(*FINDING_COLUMNS))
    return found
