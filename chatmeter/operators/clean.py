"""From raw log lines to cleaned requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.functions import chatlog
from chatmeter.functions.text import field, strip


def clean_events(
    lines: DataFrame,
    check_time: bool = True,
    ignore_case: bool = True,
    strip_ids: bool = False,
    day_mode: str = "event",
    as_of: str | None = None,
    kind: str = chatlog.REQUEST_KIND,
) -> DataFrame:
    """Keep real user requests and give them the columns of ``schema.REQUEST``.

    ``lines`` has ``value`` and, when it comes from topics, ``topic``; extra columns are dropped.
    Three strictnesses are in use: the default (time checked, test users found in any case),
    ``check_time=False``, and ``check_time=False, ignore_case=False``.

    ``day_mode="event"`` takes the day from the line and the stripped time text as the second.
    ``day_mode="processing"`` takes today (``as_of`` when given) and the time text as it stands.
    ``kind`` other than requests keeps lines of that kind, by the same rules.
    """
    if day_mode not in ("event", "processing"):
        raise ValueError(f"day_mode must be 'event' or 'processing', not {day_mode!r}")
    product = chatlog.product_of(F.col("topic")) if "topic" in lines.columns else F.lit(None).cast("string")

    # Generator output is evaluated once per row and stays where it is. As plain columns, the split
    # and the parse would be copied into the filters, once per use, and done again each time.
    # The payload is the fourth field; a limit of five leaves any later text unsplit.
    fields = F.col("fields")
    requests = (
        lines.select(product.alias("product"), F.explode(F.array(F.split("value", "\t", 5))).alias("fields"))
        .where(F.size(fields) > chatlog.PAYLOAD_FIELD)
        .where(field(fields, chatlog.KIND_FIELD) == kind)
        .select(
            "product",
            field(fields, chatlog.TIME_FIELD).alias("raw_time"),
            strip(field(fields, chatlog.TIME_FIELD)).alias("time"),
            F.btrim(field(fields, chatlog.PAYLOAD_FIELD), F.lit(chatlog.JSON_BLANKS)).alias("payload"),
        )
    )

    payload = F.col("payload")
    needs_event_day = check_time or day_mode == "event"
    event_day = chatlog.event_day(F.col("time")) if needs_event_day else F.lit(None).cast("date")
    parsed = F.struct(chatlog.parse_payload(payload).alias("item"), event_day.alias("event_day"))
    requests = requests.select("*", F.inline(F.array(parsed)))

    bot_name, user_id = F.col("item.bot_name"), F.col("item.user_id")
    kept = requests.where(
        chatlog.is_truthy(payload, "bot_name", bot_name)
        & chatlog.is_truthy(payload, "user_id", user_id)
        & ~chatlog.is_test_user(user_id, ignore_case)
    )
    if check_time:
        kept = kept.where(F.col("event_day").isNotNull())

    if strip_ids:
        bot_name, user_id = strip(bot_name), strip(user_id)
    if day_mode == "event":
        day, second = F.col("event_day"), F.col("time")
    else:
        day, second = (F.lit(as_of).cast("date") if as_of else F.current_date()), F.col("raw_time")
    return kept.select(
        "product", bot_name.alias("bot_name"), user_id.alias("user_id"), day.alias("day"), second.alias("second")
    )
