"""The contract of an order event, and what happens to events that break it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakevault.sources.schemas import EVENT_SCHEMA

# Fixed values of the contract.
REQUIRED_FIELDS = (
    "event_id",
    "event_type",
    "event_timestamp",
    "customer.customer_unique_id",
    "customer.customer_name",
    "customer.customer_city",
    "customer.customer_state",
    "customer.customer_zip_code_prefix",
    "order.order_id",
    "order.product_category_name",
    "order.product_name",
    "order.items_count",
    "order.price",
    "order.freight_value",
    "payment.payment_type",
    "payment.payment_installments",
)
STATE_LENGTH = 2
AT_LEAST = {
    "order.items_count": 1,
    "order.price": 0,
    "order.freight_value": 0,
    "payment.payment_installments": 1,
}
# Amounts beyond this are mistakes; the views add amounts as 18-digit decimals.
AT_MOST = {"order.price": 1_000_000_000, "order.freight_value": 1_000_000_000}
REQUEST_EVENTS = (1, 500)
MAX_ATTEMPTS = 4

MALFORMED = "malformed"
BROKEN = "_broken"
REQUEST_SIZE = "request_size"


def violations(event: str = "") -> Column:
    """Names of the rules an event breaks, empty for a good one. ``event`` is the struct column holding it."""
    prefix = f"{event}." if event else ""
    column = {name: F.col(prefix + name) for name in REQUIRED_FIELDS}
    broken = [F.when(column[name].isNull(), F.lit(f"{name}:required")) for name in REQUIRED_FIELDS]
    state = column["customer.customer_state"]
    broken.append(F.when(F.length(state) != STATE_LENGTH, F.lit("customer.customer_state:length")))
    broken += [F.when(column[name] < least, F.lit(f"{name}:minimum")) for name, least in AT_LEAST.items()]
    # (Not a number compares as greater than any.)
    broken += [F.when(column[name] > most, F.lit(f"{name}:maximum")) for name, most in AT_MOST.items()]
    return F.array_compact(F.array(*broken))


def checked(events: DataFrame) -> DataFrame:
    """Events with a ``violations`` column."""
    return events.withColumn("violations", violations())


def checked_requests(events: DataFrame, request: str) -> DataFrame:
    """Contract at request level: one bad event, or a wrong number of events, rejects all its events.

    The verdict is an aggregate per request, so a request of any size is combined on the map side
    and never gathered in one place. Events without a request id form one request.
    """
    judged = checked(events)
    low, high = REQUEST_EVENTS
    size = F.count(F.lit(1))
    verdict = judged.groupBy(F.col(request).alias("_request")).agg(
        (~size.between(low, high)).alias("wrong_size"), F.max(F.size("violations") > 0).alias("any_bad")
    )
    own = F.when(F.col("wrong_size"), F.array_append("violations", F.lit(REQUEST_SIZE))).otherwise(F.col("violations"))
    return (
        judged.join(verdict, F.col(request).eqNullSafe(F.col("_request")))
        .withColumns({"violations": own, "rejected": F.col("any_bad") | F.col("wrong_size")})
        .drop("wrong_size", "any_bad", "_request")
    )


def parsed(messages: DataFrame) -> DataFrame:
    """Messages (message_id, body) with the event they carry and the rules it breaks.

    A body that is no JSON object breaks the one rule ``malformed``; every message is judged alone.
    The event goes through a generator so that a body is parsed once: as a plain column the
    optimizer would copy the parsing into every filter and field that uses it.
    """
    shape = StructType([*EVENT_SCHEMA.fields, StructField(BROKEN, StringType())])
    event = F.from_json("body", shape, {"columnNameOfCorruptRecord": BROKEN})
    read = messages.select("*", F.explode(F.array(event)).alias("event"))
    # A single bad value also marks the record, but leaves a body that is valid JSON.
    no_object = F.col("event").isNull() | (
        F.col(f"event.{BROKEN}").isNotNull() & F.get_json_object("body", "$").isNull()
    )
    found = F.when(no_object, F.array(F.lit(MALFORMED))).otherwise(violations("event"))
    return read.withColumn("violations", found)


def accepted(judged: DataFrame) -> DataFrame:
    """The good messages' events, nested, with their message id."""
    fields = [F.col(f"event.{name}").alias(name) for name in EVENT_SCHEMA.fieldNames()]
    return judged.where(F.size("violations") == 0).select("message_id", "body", *fields)


def quarantined(judged: DataFrame, attempt: Column | None = None) -> DataFrame:
    """The bad messages as received, with the reasons and the number of attempts so far."""
    tries = F.lit(1) if attempt is None else attempt
    return judged.where(F.size("violations") > 0).select(
        "message_id", "body", F.col("violations").alias("reasons"), tries.cast("int").alias("attempt")
    )


def redrive(quarantine: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Judge quarantined messages again: (accepted, still quarantined, given up).

    A message is tried at most ``MAX_ATTEMPTS`` times; after that it stays in the last group.
    """
    retry = parsed(quarantine.where(F.col("attempt") < MAX_ATTEMPTS).select("message_id", "body", "attempt"))
    again = quarantined(retry, F.col("attempt") + 1)
    spent = quarantine.where(F.col("attempt") >= MAX_ATTEMPTS)
    return accepted(retry), again, spent
