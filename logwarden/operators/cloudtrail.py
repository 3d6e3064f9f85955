"""AWS CloudTrail records, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import with_canonical_ip
from logwarden.functions.json_values import as_text, field, fields, is_text, kind, plain_text, text_or_null, truthy
from logwarden.functions.times import with_iso_timestamp
from logwarden.operators.routing import AT_LINE, parsed_rows
from logwarden.schema import CLOUDTRAIL
from logwarden.sources.lines import prepare_lines

# The first of these request parameters that holds something names the resource. Fixed values.
RESOURCE_FIELDS = ("groupId", "policyArn", "bucketName", "roleName", "userName", "trailName")
IDENTITY_FIELDS = ("userName", "type")

# Category and type by event name or, failing that, by event source. Fixed values.
BY_EVENT_NAME = {"ConsoleLogin": (("authentication",), ("start",))}
BY_EVENT_SOURCE = {
    "iam.amazonaws.com": (("iam",), ("change",)),
    "ec2.amazonaws.com": (("network", "configuration"), ("change",)),
    "cloudtrail.amazonaws.com": (("configuration",), ("change",)),
}
OTHERWISE = (("configuration",), ("info",))

INVALID_JSON = "Invalid CloudTrail JSON" + AT_LINE
NOT_AN_OBJECT = "CloudTrail record must be an object" + AT_LINE
MISSING_FIELDS = "CloudTrail record missing required fields" + AT_LINE
INVALID_TIME = "Invalid CloudTrail eventTime"
NESTED_NOT_AN_OBJECT = "CloudTrail userIdentity and requestParameters must be objects"
INVALID_ACCOUNT = "CloudTrail recipientAccountId must be a string"

# Top-level fields in use, with the column each is kept in.
FIELDS = {
    "event_time": "eventTime",
    "event_name": "eventName",
    "event_source": "eventSource",
    "identity": "userIdentity",
    "parameters": "requestParameters",
    "address": "sourceIPAddress",
    "account": "recipientAccountId",
    "region": "awsRegion",
    "error_code": "errorCode",
    "error_message": "errorMessage",
}


def _classes(position: int) -> Column:
    value = lambda pair: F.array(*[F.lit(v) for v in pair[position]])
    choice = F
    for name, pair in BY_EVENT_NAME.items():
        choice = choice.when(F.col("action") == name, value(pair))
    for name, pair in BY_EVENT_SOURCE.items():
        choice = choice.when(F.col("event_source_text") == name, value(pair))
    return choice.otherwise(value(OTHERWISE))


def json_pair(text: Column, digest: Column) -> Column:
    """A list of the JSON value a text begins with and, if the text is one complete value, its digest.

    Spark's parser stops after the first complete value. The text is therefore parsed as the first of
    two list items, the second being its digest: only a text that is one complete value leaves the
    digest as the second item.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]')))


def parse_cloudtrail(lines: DataFrame) -> DataFrame:
    """One row per line: a normalized event, or the reason why there is none.

    Objects are taken apart in one pass each, and the kind and the text of a value are worked out once: a look into a VARIANT
    is what costs most here.
    """
    identity, parameters = F.col("identity"), F.col("parameters")
    known = lambda name: (F.col(f"{name}_kind"), F.col(f"{name}_plain"))
    looked_at = ("event_time", "event_name", "event_source", "address")
    some = lambda group, names: F.coalesce(*[F.col(f"{group}.{name}") for name in names]).isNotNull()
    rows = (
        prepare_lines(lines)
        .withColumn("digest", F.md5("raw_event"))
        .withColumn("pair", json_pair(F.col("raw_event"), F.col("digest")))
        .withColumn("is_json", F.coalesce(F.try_variant_get("pair", "$[1]", "string") == F.col("digest"), F.lit(False)))
        .withColumn("record", F.when(F.col("is_json"), fields(F.col("pair"), "$[0]", FIELDS.values())))
        .withColumns({column: F.col(f"record.{name}") for column, name in FIELDS.items()})
        .withColumns(
            {
                "who": fields(identity, "$", IDENTITY_FIELDS),
                "what": fields(parameters, "$", RESOURCE_FIELDS),
                **{f"{name}_kind": kind(F.col(name)) for name in looked_at},
                **{f"{name}_plain": plain_text(F.col(name)) for name in looked_at},
            }
        )
        .withColumns(
            {
                # an object with one of the fields holds something; others are looked at as a whole
                "has_identity": F.when(some("who", IDENTITY_FIELDS), True).otherwise(truthy(identity)),
                "has_parameters": F.when(some("what", RESOURCE_FIELDS), True).otherwise(truthy(parameters)),
                "action": as_text(F.col("event_name"), known("event_name")),
                "event_source_text": as_text(F.col("event_source"), known("event_source")),
                "address_text": as_text(F.col("address"), known("address")),
                "user_field": F.col("who.userName"),
                "type_field": F.col("who.type"),
                "arn_field": field(identity, "arn"),
                "time_text": as_text(F.col("event_time"), known("event_time")),
                **{name: F.col(f"what.{name}") for name in RESOURCE_FIELDS},
            }
        )
        .transform(with_iso_timestamp, "time_text", "timestamp")
        .transform(with_canonical_ip, "address_text", "source_ip")
        .withColumns(
            {
                "identity_type": text_or_null(F.col("type_field")),
                "request_parameters": F.when(F.col("has_parameters"), parameters).otherwise(
                    F.parse_json(F.lit("{}"))
                ),
            }
        )
    )
    resource = F.coalesce(*[F.when(truthy(F.col(name)), as_text(F.col(name))) for name in RESOURCE_FIELDS])
    user = (
        F.when(truthy(F.col("user_field")), as_text(F.col("user_field")))
        .when(F.col("identity_type") == "Root", "root")
        .when(truthy(F.col("arn_field")), F.substring_index(as_text(F.col("arn_field")), "/", -1))
    )
    required = [truthy(F.col(name), known(name)) for name in ("event_time", "event_name", "event_source")]
    attributes = F.to_variant_object(
        F.struct(
            F.col("event_source"),
            F.col("region").alias("aws_region"),
            F.col("type_field").alias("identity_type"),
            F.col("address_text").alias("source_identity"),
            F.col("error_code"),
            F.col("error_message"),
            F.col("request_parameters"),
        )
    )
    reject_reason = (
        F.when(~F.col("is_json"), INVALID_JSON)
        .when(~F.col("raw_event").startswith("{"), NOT_AN_OBJECT)
        .when(~(required[0] & required[1] & required[2]), MISSING_FIELDS)
        .when(F.col("timestamp").isNull(), INVALID_TIME)
        .when(
            (F.col("has_identity") & F.col("who").isNull()) | (F.col("has_parameters") & F.col("what").isNull()),
            NESTED_NOT_AN_OBJECT,
        )
        .when(
            F.col("account").isNotNull() & (kind(F.col("account")) != "VOID") & ~is_text(F.col("account")),
            INVALID_ACCOUNT,
        )
    )
    return parsed_rows(
        rows.withColumns(
            {
                "category": _classes(0),
                "event_type": _classes(1),
                "outcome": F.when(truthy(F.col("error_code")), "failure").otherwise("success"),
                "message": F.concat(F.col("action"), F.lit(" recorded by "), F.col("event_source_text")),
                "host_name": text_or_null(F.col("account")),
                "user_name": user,
                "resource": F.when(F.col("has_parameters"), resource),
                "attributes": attributes,
            }
        ),
        CLOUDTRAIL,
        reject_reason,
    )
