"""Placeholder, symbol, tag and escape expressions, and their multiset comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token shapes. \p{Nd} is every Unicode decimal digit.
POSITIONAL = r"\{(\p{Nd}+)\}"
NAMED = r"\{([A-Za-z_][A-Za-z0-9_]*)\}"
RULEPACK = r"\[([A-Za-z_]*[a-z_][A-Za-z0-9_]*)\]"
RICH_TEXT = r"(</?(?:b|i|color)(?:=[^<>]*)?>)"
CURLY = r"\{(\p{Nd}+|[A-Za-z_][A-Za-z0-9_]*)\}"  # positional and named in one pass
ENTITY = r"&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
CURLY_TOKEN = CURLY.replace("(", "(?:")
SQUARE_TOKEN = RULEPACK.replace("(", "(?:")
ANY_TOKEN = f"{CURLY_TOKEN}|{SQUARE_TOKEN}"

# mechanism -> (pattern, text before a token, text after it, character every token holds)
MECHANISMS = {
    "positional": (POSITIONAL, "{", "}", "{"),
    "named": (NAMED, "{", "}", "{"),
    "rulepack": (RULEPACK, "[", "]", "["),
    "richtext": (RICH_TEXT, "", "", "<"),
}

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


NO_TEXT = "cast(array() as array<string>)"


def sql_text(text: str) -> str:
    """A raw SQL string literal; none of the texts used here holds a single quote."""
    return f"r'{text}'"


def tokens_sql(mechanism: str, text: str) -> str:
    """SQL for the tokens of ``text``; the regular expression runs only where one can match."""
    pattern, _, _, mark = MECHANISMS[mechanism]
    found = f"regexp_extract_all({text}, {sql_text(pattern)}, 1)"
    return (
        f"case when contains({text}, '{mark}') then {found} "
        f"when {text} is not null then {NO_TEXT} end"
    )


def tokens_of(mechanism: str, c: Column | str) -> Column:
    pattern, _, _, mark = MECHANISMS[mechanism]
    text = _col(c)
    # The search for one character is far cheaper than a regular expression that cannot match.
    return F.when(
        F.contains(text, F.lit(mark)), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    ).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))


def positional_tokens(c: Column | str) -> Column:
    return tokens_of("positional", c)


def named_tokens(c: Column | str) -> Column:
    return tokens_of("named", c)


def rulepack_symbols(c: Column | str) -> Column:
    return tokens_of("rulepack", c)


def rich_text_tags(c: Column | str) -> Column:
    return tokens_of("richtext", c)


def curly_sql(text: str) -> str:
    """Positional and named tokens of ``text`` in one pass."""
    found = f"regexp_extract_all({text}, {sql_text(CURLY)}, 1)"
    return (
        f"case when contains({text}, '{{') then {found} "
        f"when {text} is not null then {NO_TEXT} end"
    )


def curly_kind_sql(mechanism: str, curly: str) -> str:
    """The positional or the named tokens among the curly ones."""
    negate = "" if mechanism == "positional" else "not "
    return rf"filter({curly}, t -> {negate}rlike(t, r'^\p{{Nd}}'))"


def token_signature(text: str) -> Column:
    """Sorted placeholders as one short string; the token multisets are equal iff it is."""
    return F.expr(f"array_join(sort_array({curly_sql(text)}), ',')")


def token_sequence(c: Column | str) -> Column:
    """Placeholders and symbols in the order in which they occur."""
    text = _col(c)
    found = F.array_join(F.regexp_extract_all(text, F.lit(ANY_TOKEN), F.lit(0)), ",")
    marked = F.contains(text, F.lit("{")) | F.contains(text, F.lit("["))
    return F.when(marked, found).otherwise("")


def _surplus_sql(mechanism: str, have: str, other: str, verb: str, tail: str) -> str:
    """Messages for tokens more frequent in ``have`` than in ``other``, in code-point order."""
    _, before, after, _ = MECHANISMS[mechanism]
    counted = (
        f"transform(sort_array(array_distinct({have})), t -> named_struct('token', t, 'n', "
        f"size(filter({have}, x -> x = t)) - size(filter({other}, y -> y = t))))"
    )
    return (
        f"transform(filter({counted}, s -> s.n > 0), s -> concat("
        f"'{mechanism} token {before}', s.token, '{after} {verb} ', s.n, 'x {tail}'))"
    )


def multiset_messages_sql(mechanism: str, src: str, out: str) -> str:
    """Missing tokens first, then extra ones, one message per distinct token.

    ``src`` and ``out`` are token arrays, given as column names. Equal multisets are the common
    case and cost one comparison of sorted arrays.
    """
    missing = _surplus_sql(mechanism, src, out, "missing", "in translation")
    extra = _surplus_sql(mechanism, out, src, "appears", "extra in translation")
    return (
        f"case when sort_array({src}) = sort_array({out}) then {NO_TEXT} "
        f"else concat({missing}, {extra}) end"
    )


def failure_messages(src: str, out: str, mechanisms=("positional", "named")) -> Column:
    """Placeholder failures of a pair of text columns, in the documented order.

    Tokens are bound once per text by a one-element transform; inside lambdas they would be
    extracted again for every element.
    """
    bound = [
        f"element_at(transform(array(named_struct('a', {tokens_sql(m, src)}, 'b', "
        f"{tokens_sql(m, out)})), p -> {multiset_messages_sql(m, 'p.a', 'p.b')}), 1)"
        for m in mechanisms
    ]
    return F.expr(f"concat({', '.join(bound)})")


def occurrences_sql(text: str, needle: str) -> str:
    """How often ``needle`` occurs, from byte lengths; one cheap search where it does not."""
    literal = "'\\n'" if needle == "\n" else sql_text(needle)
    removed = f"octet_length({text}) - octet_length(replace({text}, {literal}, ''))"
    counted = f"({removed}) div {len(needle)}"
    return f"case when contains({text}, {literal}) then {counted} else 0L end"


# name -> what is counted in both texts
ESCAPES = {"escaped": "\\n", "newlines": "\n", "doubled": "\\\\n"}


def escape_messages_sql(src: str, out: str) -> str:
    """Messages from the counted columns ``<src><name>`` / ``<out><name>`` of ``ESCAPES``."""
    lost = f"({src}escaped - {out}escaped)"
    return (
        f"filter(array(if({lost} <> 0, concat('escape count differs by ', -{lost}), null), "
        f"if({out}newlines > {src}newlines, 'escape expanded to a newline', null), "
        f"if({out}doubled > {src}doubled, 'escape doubled', null)), m -> m is not null)"
    )


def escape_sequence_check(src: str, out: str) -> Column:
    """Messages for lost, expanded or doubled newline escapes of a pair of text columns."""
    counts = [
        f"'{side}{name}', {occurrences_sql(text, needle)}"
        for side, text in (("s_", src), ("o_", out))
        for name, needle in ESCAPES.items()
    ]
    body = escape_messages_sql("p.s_", "p.o_")
    return F.expr(
        f"element_at(transform(array(named_struct({', '.join(counts)})), p -> {body}), 1)"
    )


def stray_sql(text: str, tags: str | None = None) -> str:
    """How many angle brackets and ampersands are neither a known tag nor an entity.

    A tag holds one bracket of each kind, so without ampersands a subtraction is exact; only texts
    with ampersands are rewritten.
    """
    tags = tags or tokens_sql("richtext", text)
    rest = f"regexp_replace({text}, {sql_text(RICH_TEXT + '|' + ENTITY)}, '')"
    counted = " + ".join(f"({occurrences_sql('r', m)})" for m in "<>&")
    rewritten = f"element_at(transform(array({rest}), r -> {counted}), 1)"
    brackets = f"({occurrences_sql(text, '<')}) + ({occurrences_sql(text, '>')})"
    return (
        f"case when contains({text}, '&') then {rewritten} "
        f"else {brackets} - 2L * size({tags}) end"
    )


def control_sql(text: str) -> str:
    return f"rlike({text}, {sql_text(CONTROL)})"


def stray_markup(text: str) -> Column:
    return F.expr(stray_sql(text))


def xml_safe_check(text: str) -> Column:
    """True where the text needs no escaping beyond the known tags and entities."""
    return F.expr(f"({stray_sql(text)}) = 0 and not {control_sql(text)}")


def xml_messages_sql(src: str, out: str) -> str:
    """A source may hold stray characters (they get escaped); a translation may not add any.

    Reads the columns ``<src>stray``, ``<out>stray`` and ``<out>control``.
    """
    return (
        f"filter(array(if({out}stray > {src}stray, 'xml stray markup added', null), "
        f"if({out}control, 'xml illegal control character', null)), m -> m is not null)"
    )
