"""The `events` table as log lines: every row of a family becomes one line, by its columns alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR = 2024
#: Commands of the sudo lines, chosen by event_id.
COMMANDS = ["/usr/bin/cat /etc/shadow", "/usr/sbin/useradd eve", "/usr/bin/chmod 777 /srv", "/usr/sbin/visudo", "/usr/bin/ls /srv", "/usr/bin/id"]


def _mod(column: str, n: int) -> Column:
    return F.pmod(column, F.lit(n)).cast("string")


def _lines(events: DataFrame, text: Column, path: str) -> DataFrame:
    """value, path, line_number; a row's line stands at its event_id."""
    return events.select(text.alias("value"), F.lit(path).alias("path"), (F.col("event_id") + 1).cast("bigint").alias("line_number"))


def linux_lines(events: DataFrame, garbage: bool = False) -> DataFrame:
    """Failed and accepted logins and sudo commands, of all rows but views; with `garbage`, one line in ten is none."""
    user, ip = F.concat(F.lit("u"), F.col("user_id")), F.concat(F.lit("198.51.100."), _mod("user_id", 4))
    login = F.concat(user, F.lit(" from "), ip, F.lit(" port "), (F.col("user_id") + 40000).cast("string"), F.lit(" ssh2"))
    command = F.get(F.array(*map(F.lit, COMMANDS)), F.pmod("event_id", F.lit(len(COMMANDS))).cast("int"))
    message = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("Failed password for "), login))
        .when(F.col("event_type") == "signup", F.concat(F.lit("Failed password for invalid user "), login))
        .when(F.col("event_type") == "click", F.concat(F.lit("Accepted password for "), login))
        .otherwise(F.concat(user, F.lit(" : TTY=pts/0 ; PWD=/home/"), user, F.lit(" ; USER=root ; COMMAND="), command))
    )
    process = F.when(F.col("event_type") == "purchase", "sudo").otherwise(F.concat(F.lit("sshd["), F.col("event_id"), F.lit("]")))
    text = F.concat(F.date_format("ts", "MMM d HH:mm:ss"), F.lit(" srv-"), _mod("user_id", 3), F.lit(" "), process, F.lit(": "), message)
    if garbage:
        text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("not a record "), F.col("event_id"))).otherwise(text)
    return _lines(events.where("event_type <> 'view'"), text, "events/auth.log")


def interface_lines(events: DataFrame) -> DataFrame:
    """Interface state changes, of the views."""
    state = F.when(F.col("event_id") % 2 == 0, "up").otherwise("down")
    text = F.concat(F.date_format("ts", "MMM d HH:mm:ss"), F.lit(" DIST-"), _mod("user_id", 4), F.lit(" %LINK-3-UPDOWN: Interface GigabitEthernet0/"), _mod("user_id", 8), F.lit(", changed state to "), state)
    return _lines(events.where("event_type = 'view'"), text, "events/switch.log")


def device_lines(events: DataFrame, garbage: bool = False) -> DataFrame:
    """Configuration changes, logins and others, of all rows, by event_id."""
    user, ip = F.concat(F.lit("u"), F.col("user_id")), F.concat(F.lit("203.0.113."), _mod("user_id", 250))
    kind = F.col("event_id") % 5
    message = (
        F.when(kind == 0, F.concat(F.lit("%SYS-5-CONFIG_I: Configured from console by "), user, F.lit(" on vty0 ("), ip, F.lit(")")))
        .when(kind == 1, F.concat(F.lit("%SEC_LOGIN-4-LOGIN_FAILED: Login failed [user: "), user, F.lit("] [Source: "), ip, F.lit("] [localport: 22]")))
        .when(kind == 2, F.concat(F.lit("%SEC_LOGIN-5-LOGIN_SUCCESS: Login Success [user: "), user, F.lit("] [Source: "), ip, F.lit("] [localport: 22]")))
        .when(kind == 3, F.concat(F.lit("%SYS-5-RESTART: System restarted [user: "), user, F.lit("]")))
        .otherwise(F.concat(F.lit("%LINEPROTO-5-UPDOWN: Line protocol on Interface Vlan"), _mod("user_id", 8), F.lit(", changed state to up")))
    )
    text = F.concat(F.date_format("ts", "MMM d HH:mm:ss"), F.lit(" CORE-"), _mod("user_id", 4), F.lit(" "), message)
    if garbage:
        text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("not a record "), F.col("event_id"))).otherwise(text)
    return _lines(events, text, "events/core.log")


def cloudtrail_lines(events: DataFrame, garbage: bool = False) -> DataFrame:
    """Console logins, stopped trails, policies, open ports and listings, of all rows, by event_id."""
    kind, user = F.col("event_id") % 5, F.concat(F.lit("u"), F.col("user_id"))
    of = lambda *values: F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), kind.cast("int"))
    identity = F.struct(
        F.when(kind == 0, "Root").otherwise("IAMUser").alias("type"),
        F.when(kind == 0, F.lit(None)).otherwise(user).alias("userName"),
        F.concat(F.lit("arn:aws:iam::1:user/"), user).alias("arn"),
    )
    cidr = F.when(F.col("event_id") % 2 == 0, "0.0.0.0/0").otherwise("10.0.0.0/8")
    permissions = F.when(kind == 3, F.struct(F.lit(20).alias("fromPort"), F.lit(25).alias("toPort"), F.array(F.struct(cidr.alias("cidrIp"))).alias("ipRanges")))
    policy = F.when(F.col("event_id") % 2 == 0, "arn:aws:iam::aws:policy/AdministratorAccess").otherwise("arn:aws:iam::aws:policy/ReadOnlyAccess")
    parameters = F.struct(
        F.when(kind == 3, F.concat(F.lit("sg-"), F.col("user_id"))).alias("groupId"),
        F.when(kind == 2, policy).alias("policyArn"),
        F.when(kind == 1, F.lit("trail")).alias("trailName"),
        permissions.alias("ipPermissions"),
    )
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        of("ConsoleLogin", "StopLogging", "AttachUserPolicy", "AuthorizeSecurityGroupIngress", "ListBuckets").alias("eventName"),
        of("signin.amazonaws.com", "cloudtrail.amazonaws.com", "iam.amazonaws.com", "ec2.amazonaws.com", "s3.amazonaws.com").alias("eventSource"),
        identity.alias("userIdentity"),
        F.concat(F.lit("203.0.113."), _mod("user_id", 250)).alias("sourceIPAddress"),
        F.lit("111122223333").alias("recipientAccountId"),
        F.when(F.col("event_type") == "error", "AccessDenied").alias("errorCode"),
        F.when(kind.isin(1, 2, 3), parameters).alias("requestParameters"),
    )
    text = F.to_json(record)
    if garbage:
        text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{not json "), F.col("event_id"))).otherwise(text)
    return _lines(events, text, "events/trail.jsonl")


def write_text(lines: DataFrame, files: int, path: str) -> str:
    """Lines as text files in folders `file=0` and so on, dealt by the row that a line comes from; each in the rows' order.

    Every seventh row's line follows a blank one, and every third ends with a carriage return, too.
    """
    row = F.col("line_number") - 1
    text = F.concat(F.when(row % 7 == 0, " \n").otherwise(""), F.col("value"), F.when(row % 3 == 0, "\r").otherwise(""))
    dealt = lines.select((row % files).cast("int").alias("file"), "line_number", text.alias("value"))
    ordered = dealt.repartition(files, "file").sortWithinPartitions("file", "line_number")
    ordered.drop("line_number").write.partitionBy("file").text(path)
    return path
