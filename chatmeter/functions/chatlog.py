"""Column expressions over the fields of a chat-log line."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmeter.functions.text import WHITESPACE

# Fixed values of the log format.
TIME_FIELD, KIND_FIELD, PAYLOAD_FIELD = 0, 1, 3
REQUEST_KIND = "REQ"
TEST_USER_MARKS = ("trio_test", "monitor")
TOPIC_PREFIX = "chatlog_"

# `%Y-%m-%d %H:%M:%S` as Python's `strptime` reads it: one-digit parts, a blank before a
# one-digit day, any run of white space before the clock, seconds up to 61. Group 1 is the date.
_TIME = (
    r"^((?!0000)[0-9]{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12][0-9]|0?[1-9]| [1-9]))"
    r"[" + WHITESPACE.replace(" ", r"\x20") + r"]+"
    r"(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:(?:6[01]|[0-5]?[0-9])\z"
)

_FIELDS = "bot_name string, user_id string"
# Python's parser takes double quotes only, and sets no limit on the length of numbers and texts; Spark's
# defaults would drop such lines. Nesting has a limit in both: Python's is its stack.
_JSON = {
    "allowSingleQuotes": "false",
    "maxNumLen": str(2**31 - 1),
    "maxStringLen": str(2**31 - 1),
    "maxNestingDepth": "100000",
}
# Fixed value: what JSON counts as white space.
JSON_BLANKS = " \t\n\r"

# How `from_json` prints the JSON values that Python counts as false.
_FALSY_TEXT = ("0", "-0", "0.0", "-0.0", "false", "[]", "{}")
_NON_STRING_TYPES = ("double", "boolean", "array<string>", "map<string,string>")


def event_day(time_text: Column) -> Column:
    """The date of a stripped time text, null when the text is not a valid time."""
    date_text = F.regexp_extract(time_text, _TIME, 1)
    return F.replace(date_text, F.lit(" "), F.lit("")).try_cast("date")


def parse_payload(payload: Column) -> Column:
    """``struct<bot_name, user_id>`` of a payload without outer blanks; null unless it is one JSON object.

    Text that cannot be an object is not parsed: a failed parse costs many times a good one.
    """
    looks_like_object = payload.startswith("{") & payload.endswith("}")
    return F.when(looks_like_object & _is_single(payload), F.from_json(payload, _FIELDS, _JSON))


def _is_single(payload: Column) -> Column:
    """Nothing follows the first object, where ``from_json`` stops and ignores the rest.

    That is plain when the only closing brace is the last character. Otherwise the payload must be
    the only element of an array, and, as one with a ``]`` could close that array itself, then
    also a member of an object.
    """
    is_flat = F.instr(payload, "}") == F.length(payload)
    # Elements as structs of one field: what else is in them is passed over, however deep.
    elements = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), "array<struct<closed: boolean>>", _JSON)
    is_only_element = F.size(elements) == 1
    member = F.from_json(F.concat(F.lit('{"item":'), payload, F.lit(',"closed":true}')), "closed boolean", _JSON)
    is_member = ~payload.contains("]") | F.coalesce(member["closed"], F.lit(False))
    return is_flat | (is_only_element & is_member)


def is_truthy(payload: Column, name: str, text: Column) -> Column:
    """Python truth of a payload field: 0, false, [] and {} are false, the strings "0" or "[]" are not.

    ``from_json`` prints both kinds alike, so the few rows with such a text are read again with
    non-string types; only a value that is not a JSON string answers to one of them.
    """
    not_a_string = reduce(
        or_,
        (F.from_json(payload, f"{name} {kind}", _JSON)[name].isNotNull() for kind in _NON_STRING_TYPES),
    )
    return (text != "") & F.when(text.isin(*_FALSY_TEXT), ~not_a_string).otherwise(True)


def is_test_user(user_id: Column, ignore_case: bool = True) -> Column:
    text = F.lower(user_id) if ignore_case else user_id
    return reduce(or_, (text.contains(mark) for mark in TEST_USER_MARKS))


def product_of(topic: Column) -> Column:
    """Product line of a topic: the topic name without its prefix."""
    rest = F.substr(topic, F.lit(len(TOPIC_PREFIX) + 1))
    return F.when(topic.startswith(TOPIC_PREFIX), rest).otherwise(topic)
