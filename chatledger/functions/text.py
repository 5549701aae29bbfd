"""Text predicates over message contents and users."""

from __future__ import annotations

from collections.abc import Iterable
from os.path import commonprefix

from chatledger import rules as R
from chatledger.rules import DEFAULT_RULES, Rules

# Everything that counts as blank at the ends of a text, not only the ASCII space.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quoted(value: str) -> str:
    """A SQL string literal, whatever the session's escaping rules are."""
    if "\\" in value:
        raise ValueError("backslashes are not supported in rule texts")
    parts = [f"'{part}'" for part in value.split("'")]
    return parts[0] if len(parts) == 1 else f"concat({', chr(39), '.join(parts)})"


def strip(text: str) -> str:
    return f"btrim({text}, {quoted(BLANKS)})"


def normalize(text: str) -> str:
    """Null becomes '', blanks at the ends go, lower case."""
    return f"lower({strip(f'coalesce({text}, {quoted(str())})')})"


def one_of(text: str, values: Iterable[str]) -> str:
    listed = ", ".join(quoted(v) for v in values)
    return f"{text} IN ({listed})" if listed else "false"


def contains_any(normalized: str, terms: Iterable[str]) -> str:
    """Substring match of any term on an already normalised text. A term that
    contains another one adds nothing and is not tested."""
    terms = list(dict.fromkeys(terms))
    needed = [t for t in terms if not any(o != t and o in t for o in terms)]
    tests = [f"contains({normalized}, {quoted(t)})" for t in needed]
    prefix = commonprefix(needed)
    if prefix and len(needed) > 2:
        # one search settles the texts that have not even the common beginning
        return f"(contains({normalized}, {quoted(prefix)}) AND ({' OR '.join(tests)}))"
    return f"({' OR '.join(tests) or 'false'})"


def is_call_marker(normalized: str, rules: Rules = DEFAULT_RULES) -> str:
    """The whole text is a call marker."""
    return one_of(normalized, rules.call_markers)


def is_system_user(user: str, rules: Rules = DEFAULT_RULES) -> str:
    """No user, a user of the system domain, or one with the system prefix."""
    return (
        f"coalesce({user} = '' OR contains(upper({user}), {quoted(rules.system_domain)})"
        f" OR startswith(upper({user}), {quoted(rules.system_prefix)}), true)"
    )


def speaker(direction: str, user: str, rules: Rules = DEFAULT_RULES) -> str:
    """P10: ``cliente``, ``bot`` or ``humano``."""
    return (
        f"CASE WHEN {direction} = 'INBOUND' THEN 'cliente'"
        f" WHEN {is_system_user(user, rules)} THEN 'bot' ELSE 'humano' END"
    )


def is_trivial(normalized: str, rules: Rules = DEFAULT_RULES) -> str:
    """Too short, a greeting, or a courtesy / survey phrase."""
    bare = f"btrim({normalized}, {quoted(R.TRIVIAL_STRIP)})"
    return (
        f"(length({bare}) <= {R.TRIVIAL_LENGTH} OR {one_of(bare, rules.greetings)}"
        f" OR {contains_any(bare, rules.non_substantive)})"
    )


def is_multimedia(normalized: str, rules: Rules = DEFAULT_RULES) -> str:
    """No text, a media file name, an omitted attachment, or a bare media word."""
    bare = f"btrim({normalized}, {quoted(R.MEDIA_STRIP)})"
    return (
        f"({normalized} = '' OR {contains_any(normalized, rules.media_extensions)}"
        f" OR contains({normalized}, {quoted(R.OMITTED_MEDIA)})"
        f" OR {one_of(bare, rules.media_words)})"
    )


def agent_name(user: str) -> str:
    """the part before the first ' - '; nothing left means no name."""
    name = strip(f"substring_index({user}, ' - ', 1)")
    return f"nullif({name}, '')"


def label_missing(text: str, label: str) -> str:
    """null gets a visible label; an empty text stays as it is."""
    return f"coalesce({text}, {quoted(label)})"
