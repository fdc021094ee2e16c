"""Strictness of decoding, by table and against Python's own JSON reader."""

import json
import random
import re
from datetime import date

import pytest

from helpers import GOOD, event, messages
from pagetide.functions import times
from pagetide.operators.decode import decode

RAW_GOOD = event()


def with_value(field, token):
    """The good event with the JSON token of one field replaced."""
    return RAW_GOOD.replace(json.dumps(GOOD[field]), token, 1)


MUST_FAIL = {
    "fraction": with_value("view_duration_ms", "1.5"),
    "whole fraction": with_value("view_duration_ms", "1.0"),
    "exponent": with_value("view_duration_ms", "1e3"),
    "quoted number": with_value("view_duration_ms", '"7"'),
    "empty number": with_value("view_duration_ms", '""'),
    "20 digits": with_value("view_duration_ms", "12345678901234567890"),
    "one past 64 bit": with_value("view_duration_ms", "9223372036854775808"),
    "leading zeros": with_value("view_duration_ms", "007"),
    "NaN": with_value("view_duration_ms", "NaN"),
    "number object": with_value("view_duration_ms", '{"a":1}'),
    "numeric page": with_value("page_id", "5"),
    "fraction page": with_value("page_id", "-5.25e1"),
    "true page": with_value("page_id", "true"),
    "object page": with_value("page_id", '{"a":1}'),
    "array user": with_value("user_id", "[1]"),
    "numeric region": with_value("region", "7"),
    "numeric agent": with_value("user_agent", "7"),
    "false address": with_value("ip_address", "false"),
    "quoted bool": with_value("is_bounce", '"false"'),
    "numeric bool": with_value("is_bounce", "0"),
    "date only": with_value("timestamp", '"2024-01-30"'),
    "empty time": with_value("timestamp", '""'),
    "zoneless": with_value("timestamp", '"2024-01-30T10:20:30"'),
    "space separated": with_value("timestamp", '"2024-01-30 10:20:30Z"'),
    "lower case": with_value("timestamp", '"2024-01-30t10:20:30z"'),
    "impossible day": with_value("timestamp", '"2024-02-30T10:20:30Z"'),
    "impossible hour": with_value("timestamp", '"2024-01-30T24:00:00Z"'),
    "one-digit hour": with_value("timestamp", '"2024-01-30T1:20:30Z"'),
    "comma fraction": with_value("timestamp", '"2024-01-30T10:20:30,5Z"'),
    "newline after zone": with_value("timestamp", '"2024-01-30T10:20:30Z\\n"'),
    "numeric time": with_value("timestamp", "1706610000"),
    "trailing text": RAW_GOOD + " xyz",
    "two objects": RAW_GOOD + "," + RAW_GOOD,
    "object and null": RAW_GOOD + ",null",
    "closing bracket": RAW_GOOD + "]",
    "reopened bracket": RAW_GOOD + "],[",
    "faked closing": RAW_GOOD + ",null],{}",
    "faked seal": RAW_GOOD + ',{"view_duration_ms":1}],{}',
    "in array": "[" + RAW_GOOD + "]",
    "empty array": "[]",
    "empty": "",
    "blank": "  ",
    "single quotes": RAW_GOOD.replace('"', "'"),
    "number": "5",
    "string": '"s"',
    "bool": "true",
    "cut off": RAW_GOOD[:-5],
    "trailing comma": RAW_GOOD[:-1] + ",}",
    "comment": RAW_GOOD + "/* c */",
    "bare key": "{page_id:1}",
    "control character": RAW_GOOD.replace("page_1", "page\t1"),
    "control character in an optional field": RAW_GOOD.replace('"EU"', '"E\x01'),
    "unknown escape": RAW_GOOD.replace("page_1", "page\\x1"),
    "short unicode escape": RAW_GOOD.replace("user_2", "\\u01"),
    "tombstone": None,
    "earlier key of a wrong type": '{"page_id":7,' + RAW_GOOD[1:],
    "earlier key of a wrong type in other case": '{"PAGE_ID":["x"],' + RAW_GOOD[1:],
    "earlier key of a wrong type, escaped": '{"page\\u005fid":7,' + RAW_GOOD[1:],
    "middle key of a wrong type": RAW_GOOD[:-1] + ',"is_bounce":"no","is_bounce":true}',
    "earlier number with a fraction": '{"view_duration_ms":1.0,' + RAW_GOOD[1:],
    "earlier time that is none": '{"timestamp":"yesterday",' + RAW_GOOD[1:],
    "last key of a wrong type": RAW_GOOD[:-1] + ',"user_id":{"a":1}}',
}

MUST_PASS = {
    "good": (RAW_GOOD, {}),
    "null": ("null", None),
    "padded null": (" null ", None),
    "empty object": ("{}", None),
    "repeated key": (RAW_GOOD[:-1] + ',"page_id":"q"}', {"page_id": "q"}),
    "repeated key, the last null": (RAW_GOOD[:-1] + ',"page_id":"q","page_id":null}', {"page_id": "q"}),
    "repeated key, the first null": ('{"page_id":null,' + RAW_GOOD[1:], {"page_id": "page_1"}),
    "repeated time": ('{"timestamp":"2024-01-29T00:00:00Z",' + RAW_GOOD[1:], {"timestamp_text": GOOD["timestamp"]}),
    "repeated key, spaced": (RAW_GOOD[:-1] + ',"page_id" \n: "q"}', {"page_id": "q"}),
    "nested known key": ('{"x":{"page_id":7,"y":{"page_id":[]}},' + RAW_GOOD[1:], {"page_id": "page_1"}),
    "repeated unknown key": ('{"x":7,"x":"a","X":null,' + RAW_GOOD[1:], {"page_id": "page_1"}),
    "repeated key in an unknown field": ('{"x":{"a":1,"a":2},' + RAW_GOOD[1:], {"page_id": "page_1"}),
    "the same with another case": ('{"x":[{"a":1,"a":2}],' + RAW_GOOD[1:].replace("user_id", "User_ID"), {"user_id": "user_2"}),
    "escaped key": (RAW_GOOD.replace("page_id", "page\\u005fid"), {"page_id": "page_1"}),
    "null page": (with_value("page_id", "null"), {"page_id": ""}),
    "null duration": (with_value("view_duration_ms", "null"), {"view_duration_ms": 0}),
    "null bounce": (with_value("is_bounce", "null"), {"is_bounce": False}),
    "null optional": (with_value("region", "null"), {"region": ""}),
    "negative": (with_value("view_duration_ms", "-5"), {"view_duration_ms": -5}),
    "minus zero": (with_value("view_duration_ms", "-0"), {"view_duration_ms": 0}),
    "11 digits": (with_value("view_duration_ms", "12345678901"), {"view_duration_ms": 12345678901}),
    "smallest": (with_value("view_duration_ms", str(-(2**63))), {"view_duration_ms": -(2**63)}),
    "digits as text": (event(page_id="12", user_id="-3.5"), {"page_id": "12", "user_id": "-3.5"}),
    "literal as text": (event(region="true"), {"region": "true"}),
    "braces as text": (event(user_agent='{"a":1}'), {"user_agent": '{"a":1}'}),
    "escapes": (event(user_agent='q"\\/\né'), {"user_agent": 'q"\\/\né'}),
    "unknown keys": (RAW_GOOD[:-1] + ',"x":{"a":[1,{"b":"]}"}],"a":2}}', {}),
    "other case": (RAW_GOOD.replace('"page_id"', '"Page_ID"'), {"page_id": "page_1"}),
    "other case of an optional key": (RAW_GOOD.replace('"region"', '"REGION"'), {"region": "EU"}),
    "other case repeated": (
        RAW_GOOD.replace('"user_id"', '"USER_ID"')[:-1] + ',"User_Id" : "z"}',
        {"user_id": "z"},
    ),
    "exact and other case": (event(page_id="123")[:-1] + ',"Page_ID":"q"}', {"page_id": "q"}),
    "exact text and other case": (event(page_id="abc")[:-1] + ',"Page_ID":""}', {"page_id": ""}),
    "other case before the exact one": ('{"Page_ID":"q",' + RAW_GOOD[1:], {"page_id": "page_1"}),
    "key as text": (
        event(user_agent='"Region":', region=...),
        {"region": "", "user_agent": '"Region":'},
    ),
    "spaced": (json.dumps(GOOD, indent=2) + "\n", {}),
    "offset": (event(timestamp="2024-01-30T10:20:30+03:00"), {}),
    "no optional": (event(user_agent=..., ip_address=..., region=...), {"region": ""}),
}


def test_undecodable(spark):
    decoded = decode(messages(spark, MUST_FAIL.values())).orderBy("offset").collect()
    wrong = [name for name, row in zip(MUST_FAIL, decoded) if row.decoded]
    assert wrong == []


def test_decodable(spark):
    rows = decode(messages(spark, [v for v, _ in MUST_PASS.values()]))
    rows = rows.orderBy("offset").collect()
    for (name, (_, changes)), row in zip(MUST_PASS.items(), rows):
        assert row.decoded, name
        if changes is None:
            assert (row.page_id, row.user_id, row.view_duration_ms) == ("", "", 0), name
            assert (row.is_bounce, row.timestamp_text) == (False, None), name
            continue
        for field, value in changes.items():
            assert row[field] == value, name


def test_stray_bytes_are_replaced(spark):
    value = bytearray(RAW_GOOD.replace("page_1", "p?").encode())
    value[value.index(b"?")] = 0xFF
    from pyspark.sql import functions as F

    df = messages(spark, ["x"]).withColumn("value", F.lit(bytes(value)))
    row = decode(df).first()
    assert row.decoded and row.page_id == "p�"


def test_other_columns_are_kept(spark):
    row = decode(messages(spark, [RAW_GOOD], partition=3, start=9)).first()
    assert (row.partition, row.offset, row.topic, row.value) == (3, 9, "page-views", RAW_GOOD)


RFC3339 = re.compile(times.RFC3339.replace(r"\z", r"\Z"))


def is_time(text):
    if not RFC3339.match(text):
        return False
    try:
        date.fromisoformat(text[:10].replace("0000-", "2000-", 1))
    except ValueError:
        return False
    return True


def expected_fields(text):
    """What a strict reader makes of a message; None where it fails."""

    def no_constants(_):
        raise ValueError

    try:
        value = json.loads(
            text,
            parse_int=lambda s: ("int", int(s)),
            parse_float=lambda s: ("float", s),
            parse_constant=no_constants,
            object_pairs_hook=Pairs,
        )
    except ValueError:
        return None
    if value is None:
        value = Pairs()
    if type(value) is not Pairs:
        return None
    fields = {name: None if name == "timestamp" else type(good)() for name, good in GOOD.items()}
    for key, found in value:
        name = key.lower()
        if name not in GOOD or found is None:
            continue
        good = GOOD[name]
        if type(good) is int:
            if type(found) is not tuple or found[0] != "int":
                return None
            if not -(2**63) <= found[1] < 2**63:
                return None
            found = found[1]
        elif type(found) is not type(good):
            return None
        elif name == "timestamp" and not is_time(found):
            return None
        fields[name] = found
    return fields


class Pairs(list):
    """The keys and values of a JSON object, repeated ones too."""


FRAGMENTS = """ " ' { } [ ] , : null true false 1 1.0 1e2 - 0 \\ NaN nul tru 00 é /*
"x" {"a":1} [] "page_id": "region":7 "user_agent":nul "view_duration_ms": Infinity
"timestamp":"2024" \\u00 \\n "page_id":7, "Region":"x", "region":null, "is_bounce":true,
,"x":{"a":1,"a":2}""".split() + [" ", "\t", "\n", "\x01"]


def damaged_messages(count, seed):
    spaced = (
        '{ "is_bounce" : true , "x":{"a":[1,2,{"b":"]}"}]}, "view_duration_ms" : -5 ,'
        '"page_id":null,"user_id":"\\u00e9\\n","timestamp":null}'
    )
    bases = [RAW_GOOD, event(page_id="1", user_id="22", region=...), spaced, "null", "{}"]
    rnd = random.Random(seed)
    made = dict.fromkeys(bases)
    while len(made) < count:
        text = rnd.choice(bases)
        for _ in range(rnd.choice([1, 1, 1, 2, 3])):
            start = rnd.randrange(len(text) + 1)
            end = min(len(text), start + rnd.choice([0, 0, 1, 1, 2, 5, 8]))
            text = text[:start] + rnd.choice(FRAGMENTS + [""] * 8) + text[end:]
        made[text] = None
    for base in bases[:2]:
        for token in re.finditer(r':("[^"]*"|true|false|-?\d+)', base):
            for fragment in FRAGMENTS:
                made[base[: token.start() + 1] + fragment + base[token.end() :]] = None
    return list(made)


@pytest.mark.parametrize("seed", [1, 2])
def test_damaged_messages_match_a_strict_reader(spark, seed):
    texts = damaged_messages(4000, seed)
    rows = decode(messages(spark, texts)).orderBy("offset").collect()
    wrong = []
    for text, row in zip(texts, rows):
        fields = expected_fields(text)
        if fields is None:
            good = not row.decoded
        else:
            got = {name: row[name] for name in GOOD if name != "timestamp"}
            good = row.decoded and got | {"timestamp": row.timestamp_text} == fields
        if not good:
            wrong.append((text, row.decoded, fields))
    assert wrong == []
