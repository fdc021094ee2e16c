"""Strict decoding of messages into typed events.

Accepts exactly one JSON object (or ``null``) per message, whose known fields
hold the right JSON type or null. Unknown fields are ignored. Keys match in any
case. A key may be repeated, however spelled: every value of it must be right, and the
last one that is not null counts. Everything else fails as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pagetide.functions import times
from pagetide.operators.once import once
from pagetide.schema import EVENT

_PARSER = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"

_TYPE = {f.name: f.dataType.simpleString() for f in EVENT.fields}
_TYPED = "array<struct<" + ",".join(f"{name}:{kind}" for name, kind in _TYPE.items()) + ">>"
_AS_VARIANT = "array<struct<" + ",".join(f"{name}:variant" for name in _TYPE) + ">>"
_ALL_KEYS = "array<map<string, variant>>"

_REQUIRED = ["page_id", "user_id", "view_duration_ms", "is_bounce"]
_OPTIONAL = ["user_agent", "ip_address", "region"]
_TEXTS = ["page_id", "user_id", *_OPTIONAL]

# A text column filled from a JSON number, literal, object or array reads like
# this; a JSON string may read so too, and is then looked at more closely.
_MAYBE_NOT_A_STRING = r"(?m)^(?:[{\[]|-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?$|true$|false$)"

_ESCAPE = r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})'
_PLAIN_STRING = r'"[^"\\\x00-\x1f]*+"'

# A key with space before its colon, which is not counted with the others.
_SPACED_KEY = r'"\s+:'

# No string holds a control character or an unknown escape. The parser leaves a
# field null when its string is malformed and reads on, so this is asked wherever
# a field is null.
_BARE = f"regexp_replace(regexp_replace(_text, r'{_ESCAPE}', ''), r'{_PLAIN_STRING}', '')"
_STRINGS_WELL_FORMED = rf"""NOT {_BARE} RLIKE r'["\\]'"""


def _bracketed(text: str) -> str:
    """The message as first of two array elements, the second holding its hash.

    A parser stops at the end of the first value it reads. Only a message that
    is one complete value leads it to the closing element; a message that closes
    the bracket itself would have to contain its own hash.
    """
    seal = "CAST(xxhash64(_text) AS STRING)"
    return f"""concat('[', {text}, ',{{"view_duration_ms":', {seal}, '}}]')"""


def _exact_keys() -> str:
    """The message with the known keys in lower case."""
    text = "_text"
    for name in _TYPE:
        text = rf'''regexp_replace({text}, r'"(?i:{name})"(\s*:)', '"{name}"$1')'''
    return text


def _clear() -> str:
    """The typed parse can be trusted as it stands."""
    typed = "get(_typed, 0)"
    conditions = ["size(_typed) = 2", "get(_typed, 1).view_duration_ms = xxhash64(_text)"]
    conditions += [f"{typed}.{name} IS NOT NULL" for name in _REQUIRED]
    texts = ", ".join(f"{typed}.{name}" for name in _TEXTS)
    conditions.append(f"NOT concat_ws('\\n', {texts}) RLIKE r'{_MAYBE_NOT_A_STRING}'")
    present = " AND ".join(f"{typed}.{name} IS NOT NULL" for name in ["timestamp", *_OPTIONAL])
    conditions.append(f"(({present}) OR ({_STRINGS_WELL_FORMED}))")
    # each field found accounts for one key, so no key is repeated or spelled otherwise
    found = " + ".join(f"CAST({typed}.{name} IS NOT NULL AS INT)" for name in _TYPE)
    conditions.append(f"octet_length(_text) - octet_length(replace(_text, '\":', '\"')) = {found}")
    conditions.append(f"NOT _text RLIKE r'{_SPACED_KEY}'")
    return f"coalesce({' AND '.join(conditions)}, false)"


def _sealed(parsed: str, seal: str) -> str:
    return f"size({parsed}) = 2 AND try_variant_get({seal}, '$', 'bigint') <=> xxhash64(_text)"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _values() -> str:
    """All keys with their values, in order; null where the message is no JSON object.

    A map keeps repeated keys. It cannot be had of a message that repeats a key inside
    an unknown field, of which the known fields are then taken alone.
    """
    keyed = f"from_json({_bracketed('_text')}, '{_ALL_KEYS}', {_PARSER})"
    known = f"from_json({_bracketed(_exact_keys())}, '{_AS_VARIANT}', {_PARSER})"
    fields = ", ".join(f"named_struct('key', '{name}', 'value', get(c, 0).{name})" for name in _TYPE)
    alone = _let("c", known, f"CASE WHEN {_sealed('c', 'get(c, 1).view_duration_ms')} THEN array({fields}) END")
    entries = "coalesce(map_entries(get(k, 0)), array())"
    sealed = _sealed("k", "get(k, 1)['view_duration_ms']")
    return _let("k", keyed, f"CASE WHEN {sealed} THEN {entries} ELSE {alone} END")


def _slow() -> str:
    """The event by a parse that knows the type of every value; null where it is none.

    Nulls are left out before fields are looked up, as they change nothing.
    """
    kinds = " ".join(f"WHEN '{name}' THEN '{kind.upper()}'" for name, kind in _TYPE.items())
    typed = "named_struct('key', lower(e.key), 'value', e.value, 'kind', coalesce(schema_of_variant(e.value), 'VOID'))"
    given = f"filter(transform(v, e -> {typed}), e -> e.kind <> 'VOID')"
    right = f"e.kind = CASE e.key {kinds} ELSE e.kind END"
    text = "try_variant_get(e.value, '$', 'string')"
    times_right = _let("t", text, f"{times.parse_rfc3339('t')} IS NOT NULL")
    wrong = f"NOT ({right}) OR (e.key = 'timestamp' AND NOT {times_right})"
    fields = ", ".join(
        f"'{name}', try_variant_get(try_element_at(filter(g, e -> e.key = '{name}'), -1).value, '$', '{kind}')"
        for name, kind in _TYPE.items()
    )
    event = f"CASE WHEN NOT exists(g, e -> {wrong}) THEN named_struct({fields}) END"
    found = _let("v", _values(), f"CASE WHEN v IS NOT NULL THEN {_let('g', given, event)} END")
    return f"CASE WHEN NOT _clear AND coalesce({_STRINGS_WELL_FORMED}, false) THEN {found} END"


def _field(name: str) -> str:
    return f"CASE WHEN _clear THEN get(_typed, 0).{name} ELSE _slow.{name} END"


_EVENT = f"""inline(array(named_struct(
    'decoded', (_clear OR _slow IS NOT NULL) AND (timestamp_text IS NULL OR _instant IS NOT NULL),
    'page_id', coalesce({_field('page_id')}, ''),
    'user_id', coalesce({_field('user_id')}, ''),
    'view_duration_ms', coalesce({_field('view_duration_ms')}, 0L),
    'event_ts', nullif(_instant, TIMESTAMP '{times.ZERO_TIME}'),
    'user_agent', coalesce({_field('user_agent')}, ''),
    'ip_address', coalesce({_field('ip_address')}, ''),
    'region', coalesce({_field('region')}, ''),
    'is_bounce', coalesce({_field('is_bounce')}, false))))"""


def decode(messages: DataFrame) -> DataFrame:
    """Add ``decoded`` and the event's fields to each message.

    Absent and null fields become empty, zero or false. ``event_ts`` is the
    instant of ``timestamp_text``, null where that is absent or the zero time.
    Where ``decoded`` is false the fields mean nothing.

    One typed parse serves nearly all messages. Those it cannot vouch for - a
    field it left empty, a text that might have been a bare number, more keys than
    fields - are parsed again into a map of variants, which keeps repeated keys and
    remembers the JSON type of each value.
    """
    df = messages.selectExpr("*", "make_valid_utf8(CAST(value AS STRING)) AS _text")
    df = once(df, "_typed", f"from_json({_bracketed('_text')}, '{_TYPED}', {_PARSER})")
    df = once(df, "_clear", _clear())
    df = once(df, "_slow", _slow())
    df = df.selectExpr("*", f"{_field('timestamp')} AS timestamp_text")
    df = once(df, "_instant", times.parse_rfc3339("timestamp_text"))
    return df.selectExpr(*[f"`{name}`" for name in messages.columns], "timestamp_text", _EVENT)
