"""DuckDB expressions the checks share."""

from __future__ import annotations

from beaconry import fixed_values as fixed


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values: list) -> str:
    return "(" + ", ".join(quote(v) if isinstance(v, str) else str(v) for v in values) + ")"


def replaced(text: str, pattern: str, by: str = fixed.REDACTED) -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {quote(by)}, 'g')"


def normalized_query(text: str) -> str:
    return f"trim({replaced(replaced(replaced(text, fixed.SQL_STRING, '?'), fixed.SQL_NUMBER, '?'), '[[:space:]]+', ' ')})"


def query_type(text: str) -> str:
    first = f"upper(regexp_extract({text}, '^[[:space:]]*([^[:space:]]+)', 1))"
    return f"CASE WHEN {first} IN {in_list(fixed.QUERY_TYPES)} THEN {first} ELSE 'OTHER' END"


def _path_part(text: str) -> str:
    path = f"regexp_extract({text}, '^([a-zA-Z][A-Za-z0-9_+.-]*:)?(//[^/?#]*)?([^?#]*)', 3)"
    return f"regexp_replace({path}, ';[^/]*$', '')"


def stripped_path(text: str) -> str:
    return f"coalesce(nullif({_path_part(text)}, ''), {text})"


def url_path(text: str) -> str:
    return f"coalesce(nullif({_path_part(text)}, ''), '/')"


def url_netloc(text: str) -> str:
    return f"regexp_extract({text}, '^([a-zA-Z][A-Za-z0-9_+.-]*:)?//([^/?#]*)', 2)"


def sampling_unit(key: str) -> str:
    return f"(CAST(concat('0x', substring(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


def trace_id(text: str, width: int = 32) -> str:
    cleaned = f"lower(trim({text}))"
    return (f"CASE WHEN regexp_matches({cleaned}, '^[0-9a-f]{{{width}}}$') AND {cleaned} <> repeat('0', {width}) "
            f"THEN {cleaned} END")


_PARENT = "^([0-9a-f][0-9a-f])-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f][0-9a-f])([[:space:]]|$)"


def with_traceparent(source: str, header: str = "traceparent") -> str:
    """``source`` plus tp_trace, tp_parent, tp_sampled (null when the header is not valid)."""
    text = f"lower(trim({header}))"

    def part(i: int) -> str:
        return f"regexp_extract({text}, '{_PARENT}', {i})"

    ok = (f"({part(1)} = '00' AND {part(2)} <> repeat('0', 32) AND {part(3)} <> repeat('0', 16))")
    return (f"SELECT *, CASE WHEN {ok} THEN {part(2)} END AS tp_trace, CASE WHEN {ok} THEN {part(3)} END AS tp_parent, "
            f"CASE WHEN {ok} THEN substring({part(4)}, 2, 1) IN ('1','3','5','7','9','b','d','f') END AS tp_sampled "
            f"FROM ({source})")


_LUHN = ("(length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
         "CASE WHEN i % 2 = 1 THEN CAST(d[length(d) - i + 1] AS INT) "
         "WHEN CAST(d[length(d) - i + 1] AS INT) > 4 THEN CAST(d[length(d) - i + 1] AS INT) * 2 - 9 "
         "ELSE CAST(d[length(d) - i + 1] AS INT) * 2 END)) % 10 = 0)")


def is_card(run: str) -> str:
    return _LUHN.replace("(d)", f"(regexp_replace({run}, '[ -]', '', 'g'))").replace(
        "CAST(d[", f"CAST(regexp_replace({run}, '[ -]', '', 'g')[")


# Letters beyond ASCII. DuckDB's word boundary knows ASCII only, so the check marks them while it looks for cards.
_LETTERS = r"[\x{00AA}\x{00B5}\x{00BA}\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{02FF}\x{0370}-\x{1FFF}\x{3040}-\x{D7FF}]"


def masked_cards(source: str, column: str, out: str) -> str:
    """``source`` plus ``out``: the text with its Luhn-valid runs masked."""
    marked = f"SELECT *, {replaced(column, f'({_LETTERS})', '_\\1_')} AS _marked FROM ({source})"
    unmarked = replaced("_masked", f"_({_LETTERS})_", "\\1")
    return (f"SELECT * EXCLUDE (_marked, _masked), {unmarked} AS {out} FROM "
            f"({_masked_runs(marked, '_marked', '_masked')})")


def _masked_runs(source: str, column: str, out: str) -> str:
    runs, gaps = f"regexp_extract_all({column}, {quote(fixed.CARD_RUN)})", f"string_split_regex({column}, {quote(fixed.CARD_RUN)})"
    parts = (f"list_transform(range(1, len(_gaps) + 1), lambda j: _gaps[j] || CASE WHEN j > len(_runs) THEN '' "
             f"WHEN {is_card('_runs[j]')} THEN '{fixed.REDACTED}' ELSE _runs[j] END)")
    return (f"SELECT * EXCLUDE (_runs, _gaps), CASE WHEN len(_runs) = 0 THEN {column} ELSE "
            f"array_to_string({parts}, '') END AS {out} FROM (SELECT *, {runs} AS _runs, {gaps} AS _gaps FROM ({source}))")


def scrubbed(source: str, column: str, out: str = "scrubbed", send_default_pii: bool = False) -> str:
    """``source`` plus ``out``: the text after all rules."""
    always = replaced(replaced(replaced("_cards", fixed.SSN), fixed.BEARER), fixed.JWT)
    everything = always if send_default_pii else replaced(replaced(always, fixed.EMAIL), fixed.IPV4)
    return (f"SELECT * EXCLUDE (_cards), {everything} AS {out} FROM ({masked_cards(source, column, '_cards')})")
