"""IP text to canonical IPv6 text with built-in string functions only.

Runs inside the JVM: no Python worker sees the addresses. The three steps are
SQL expressions that build on one another and are meant to be named with
``once`` in between; plain IPv4 addresses skip the first two.
"""

from __future__ import annotations

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = "[0-9a-fA-F]{1,4}"

# Used where the text is no address.
UNKNOWN = "::ffff:0.0.0.0"


def _ipv6_pattern() -> str:
    """Eight groups, or fewer around one ``::`` that stands for at least one."""
    forms = [f"(?:{_GROUP}:){{7}}{_GROUP}"]
    for left in range(8):
        head = f"{_GROUP}(?::{_GROUP}){{{left - 1}}}" if left else ""
        room = 7 - left
        tail = f"(?:{_GROUP}(?::{_GROUP}){{0,{room - 1}}})?" if room else ""
        forms.append(f"{head}::{tail}")
    return r"^(?:" + "|".join(forms) + r")\z"


def _zero_runs_pattern() -> str:
    """Runs of 8 down to 2 zero groups; alternation order makes the longest win.

    Each alternative captures what stands before and after the leftmost such run.
    """
    return "|".join(
        rf"^((?:[0-9a-f]+:)*?)0(?::0){{{run - 1}}}((?::[0-9a-f]+)*)$" for run in range(8, 1, -1)
    )


_IPV6 = _ipv6_pattern()
_ZERO_RUNS = _zero_runs_pattern()
# Groups of the alternatives that did not match are empty, so all can be named.
_AROUND_RUN = "".join(f"${n}" for n in range(1, 15, 2)) + "::" + "".join(
    f"${n}" for n in range(2, 15, 2)
)


def is_ipv4(text: str) -> str:
    return rf"{text} RLIKE r'^{_IPV4}\z'"


def colon_groups(text: str) -> str:
    """Step 1: texts other than IPv4 and empty ones, without dotted tails.

    A trailing dotted quad is rewritten as two hexadecimal groups.
    """
    quad = rf"regexp_extract({text}, r':({_IPV4})\z', 1)"

    def group(high: int) -> str:
        low = high + 1
        return (
            f"lower(hex(CAST(split_part({quad}, '.', {high}) AS INT) * 256"
            f" + CAST(split_part({quad}, '.', {low}) AS INT)))"
        )

    return f"""CASE WHEN {text} = '' OR {is_ipv4(text)} THEN NULL
        WHEN contains({text}, '.') AND {quad} <> ''
        THEN concat(substring({text}, 1, length({text}) - length({quad})),
                    {group(1)}, ':', {group(3)})
        ELSE {text} END"""


def full_groups(text: str) -> str:
    """Step 2: all eight groups of a well-formed IPv6 address, else null.

    ``::`` is spelled out and leading zeros are dropped. n groups carry n - 1
    colons; ``::`` adds one more, or none where it stands at an end.
    """
    present = f"""CASE WHEN {text} = '::' THEN 0 ELSE
        length({text}) - length(replace({text}, ':'))
        - CAST(startswith({text}, '::') AS INT) - CAST(endswith({text}, '::') AS INT) END"""
    zeros = f"repeat('0:', 8 - ({present}))"
    filled = f"""CASE WHEN contains({text}, '::')
        THEN trim(':' FROM replace({text}, '::', concat(':', {zeros}))) ELSE {text} END"""
    return rf"""CASE WHEN {text} RLIKE r'{_IPV6}'
        THEN lower(regexp_replace({filled}, r'\b0+(?=[0-9a-fA-F])', '')) END"""


def canonical(text: str, full: str) -> str:
    """Step 3: IPv4 as ``::ffff:a.b.c.d``, IPv6 compressed, else UNKNOWN."""

    def byte(group: int, start: int) -> str:
        padded = f"lpad(split_part({full}, ':', {group}), 4, '0')"
        return f"conv(substring({padded}, {start}, 2), 16, 10)"

    dotted = f"concat_ws('.', {byte(7, 1)}, {byte(7, 3)}, {byte(8, 1)}, {byte(8, 3)})"
    shortened = f"regexp_replace({full}, r'{_ZERO_RUNS}', '{_AROUND_RUN}')"
    return f"""CASE WHEN {is_ipv4(text)} THEN concat('::ffff:', {text})
        WHEN {full} IS NULL THEN '{UNKNOWN}'
        WHEN startswith({full}, '0:0:0:0:0:ffff:') THEN concat('::ffff:', {dotted})
        ELSE regexp_replace({shortened}, ':::+', '::') END"""
