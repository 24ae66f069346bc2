"""Redaction of personal data and secrets in text columns and in nested columns."""

from __future__ import annotations

import functools
import json
import operator
import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from beaconry import fixed_values as fixed

_CARD_GUARD = r"(?U)\d(?:[ -]?\d){12}"

# The patterns count letters of any alphabet as word characters. The flag says so to Java; Python does it anyway.
CARD_RUN, SSN, BEARER, JWT, EMAIL, IPV4 = (
    "(?U)" + pattern for pattern in (fixed.CARD_RUN, fixed.SSN, fixed.BEARER, fixed.JWT, fixed.EMAIL, fixed.IPV4))


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` mentions it."""
    return F.get(F.transform(F.array(value), lambda bound: fn(bound)), F.lit(0))


def _guarded(text: Column, guard: Callable[[Column], Column], mask: Callable[[Column], Column]) -> Column:
    """Mask only where a cheap test says that there may be something to mask."""
    return _let(text, lambda t: F.when(guard(t), mask(t)).otherwise(t))


# Whether a text can hold what a rule masks: its fixed characters and its least bytes, before any pattern is tried.
def _may_hold_card(text: Column) -> Column:
    return (F.octet_length(text) >= 13) & text.rlike(_CARD_GUARD)


def _may_hold_ssn(text: Column) -> Column:
    return (F.octet_length(text) >= 11) & text.contains("-")


def _may_hold_bearer(text: Column) -> Column:
    return F.lower(text).contains("bearer")


def _may_hold_jwt(text: Column) -> Column:
    return text.contains("eyJ")


def _may_hold_email(text: Column) -> Column:
    return text.contains("@")


def _may_hold_ipv4(text: Column) -> Column:
    return (F.octet_length(text) >= 7) & text.contains(".")


def card_runs(text: Column) -> Column:
    """All candidate card runs of a text, as an array."""
    return F.regexp_extract_all(text, F.lit(CARD_RUN), F.lit(0))


def is_card(run: Column) -> Column:
    """True for a candidate run of 13 to 19 digits that passes the Luhn check."""
    digits = F.regexp_replace(run, "[ -]", "")
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _replace_cards(text: Column) -> Column:
    masked = F.transform(card_runs(text), lambda run: F.when(is_card(run), F.lit(fixed.REDACTED)).otherwise(run))
    between = F.split(text, CARD_RUN, -1)
    pieces = F.zip_with(between, F.concat(masked, F.array(F.lit(""))), lambda gap, run: F.concat(gap, run))
    return F.array_join(pieces, "")


def mask_cards(text: Column) -> Column:
    """Replace the Luhn-valid candidate runs, keep the others as they are."""
    return _guarded(text, _may_hold_card, _replace_cards)


def mask_ssn(text: Column) -> Column:
    return _guarded(text, _may_hold_ssn, lambda t: F.regexp_replace(t, SSN, fixed.REDACTED))


def mask_bearer(text: Column) -> Column:
    return _guarded(text, _may_hold_bearer, lambda t: F.regexp_replace(t, BEARER, fixed.REDACTED))


def mask_jwt(text: Column) -> Column:
    return _guarded(text, _may_hold_jwt, lambda t: F.regexp_replace(t, JWT, fixed.REDACTED))


def mask_email(text: Column) -> Column:
    return _guarded(text, _may_hold_email, lambda t: F.regexp_replace(t, EMAIL, fixed.REDACTED))


def mask_ipv4(text: Column) -> Column:
    return _guarded(text, _may_hold_ipv4, lambda t: F.regexp_replace(t, IPV4, fixed.REDACTED))


# The rules in the order they apply; the last two only without the opt-in.
RULES = {"card": mask_cards, "ssn": mask_ssn, "bearer": mask_bearer, "jwt": mask_jwt, "email": mask_email,
         "ipv4": mask_ipv4}
_GUARDS = {"email": _may_hold_email, "ipv4": _may_hold_ipv4, "ssn": _may_hold_ssn, "jwt": _may_hold_jwt, "bearer": _may_hold_bearer,
           "card": _may_hold_card}
_OPT_OUT = ("email", "ipv4")


def may_redact(text: Column, send_default_pii: bool = False) -> Column:
    """Whether any rule can find something in a text, or in several that are joined by line ends; errs on the safe side."""
    return functools.reduce(operator.or_, [guard(text) for rule, guard in _GUARDS.items() if not (send_default_pii and rule in _OPT_OUT)])


def scrub_text(text: Column, send_default_pii: bool = False, max_chars: int | None = None) -> Column:
    """Cards, SSNs, bearer tokens and JWTs always; e-mail and IPv4 addresses unless opted in.

    The whole text is scanned. The contract's clients leave texts over ``fixed.MAX_SCAN_CHARS`` unscanned; pass that
    as ``max_chars`` to reproduce it.
    """
    rules = [mask for rule, mask in RULES.items() if not (send_default_pii and rule in _OPT_OUT)]
    out = _guarded(text, lambda t: may_redact(t, send_default_pii), lambda t: functools.reduce(lambda value, mask: mask(value), rules, t))
    return out if max_chars is None else F.when(F.length(text) > max_chars, text).otherwise(out)


def redactions(text: Column) -> Column:
    """How many redaction marks a text holds."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(fixed.REDACTED), F.lit(""))))
            / len(fixed.REDACTED)).cast("bigint")


def denied_terms(extra: Iterable[str] = (), vendor: str | None = None) -> list[str]:
    """Lower-cased denied key terms; ``extra`` and the vendor's own key header can only add to them."""
    own = [f"x-{vendor.lower()}-key"] if vendor else []
    return fixed.DENIED_KEY_TERMS + own + [term.lower() for term in extra]


def _is_denied(name: str, terms: list[str]) -> bool:
    return any(term in name.lower() for term in terms)


def _key_rule(terms: list[str]) -> str:
    """A pattern for texts that hold a term; a term with a shorter one inside needs no branch."""
    return "|".join(re.escape(term) for term in terms if not any(other in term and other != term for other in terms))


def redact_keys(value: Column, data_type: T.DataType, extra: Iterable[str] = (), vendor: str | None = None) -> Column:
    """Replace the values of sensitive keys anywhere inside a struct, map or array column.

    The walk happens over the schema while the plan is built; what runs is native expressions. A struct field with
    a sensitive name becomes a string field; a null one stays null because the wire form leaves it out. Whether a map
    has a sensitive key shows only at run time, so the values of a map become text where they are not: JSON for nested
    ones, which can then stand beside the mark.
    """
    terms = denied_terms(extra, vendor)
    rule = _key_rule(terms)

    def walk(col: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            fields = [
                (F.when(col[f.name].isNotNull(), F.lit(fixed.REDACTED)) if _is_denied(f.name, terms)
                 else walk(col[f.name], f.dataType)).alias(f.name)
                for f in kind.fields
            ]
            return F.when(col.isNotNull(), F.struct(*fields))
        if isinstance(kind, T.MapType):
            if isinstance(kind.valueType, T.StringType):
                return F.transform_values(
                    col, lambda k, v: F.when(F.lower(k).rlike(rule), F.lit(fixed.REDACTED)).otherwise(v))
            nested = not isinstance(kind.valueType, T.AtomicType)
            return F.transform_values(col, lambda k, v: F.when(F.lower(k).rlike(rule), F.lit(fixed.REDACTED)).otherwise(
                F.to_json(walk(v, kind.valueType)) if nested else v.cast("string")))
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.AtomicType):
            return F.transform(col, lambda item: walk(item, kind.elementType))
        return col

    return walk(value, data_type)


def scrub_values(value: Column, data_type: T.DataType, send_default_pii: bool = False) -> Column:
    """Apply ``scrub_text`` to every string inside a column, except below the keys the contract leaves alone."""
    unscanned = set(fixed.UNSCANNED_KEYS)

    def walk(col: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return scrub_text(col, send_default_pii)
        if isinstance(kind, T.StructType):
            fields = [
                (col[f.name] if f.name.lower() in unscanned else walk(col[f.name], f.dataType)).alias(f.name)
                for f in kind.fields
            ]
            return F.when(col.isNotNull(), F.struct(*fields))
        if isinstance(kind, T.MapType):
            return F.transform_values(
                col,
                lambda k, v: F.when(F.lower(k).isin(fixed.UNSCANNED_KEYS), v)
                .otherwise(walk(v, kind.valueType)))
        if isinstance(kind, T.ArrayType):
            return F.transform(col, lambda item: walk(item, kind.elementType))
        return col

    return walk(value, data_type)


def scrub_typed(value: Column, data_type: T.DataType, extra: Iterable[str] = (), send_default_pii: bool = False,
                vendor: str | None = None, keep: Iterable[str] = ()) -> Column:
    """Both layers over a parsed document whose type is known, which stays: native expressions along the schema.

    A sensitive field that is no text becomes null, as the mark cannot be read as its type. ``keep`` names top-level
    fields that stay. Text that is itself JSON is scanned as text here; see ``holds_documents``.
    """
    terms, unscanned, kept = denied_terms(extra, vendor), set(fixed.UNSCANNED_KEYS), set(keep)
    rule = _key_rule(terms)

    def denied(col: Column, kind: T.DataType) -> Column:
        mark = F.lit(fixed.REDACTED) if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
        return F.when(col.isNotNull(), mark)

    def scrub_all(texts: Column) -> Column:
        """All texts of a struct by one expression, which keeps the plan small, and mostly by one test."""
        def clean(found: Column) -> Column:
            hit = _let(F.concat_ws("\n", found), lambda joined: may_redact(joined, send_default_pii))
            return F.when(hit, F.transform(found, lambda t: scrub_text(t, send_default_pii))).otherwise(found)

        return _let(texts, clean)

    def walk(col: Column, kind: T.DataType, scan: bool, top: bool = False) -> Column:
        if isinstance(kind, T.StringType):
            return scrub_text(col, send_default_pii) if scan else col
        if isinstance(kind, T.StructType):
            fields, texts = [], []
            for f in kind.fields:
                at = col[f.name]
                if not (top and f.name in kept):
                    scanned = scan and f.name.lower() not in unscanned
                    if _is_denied(f.name, terms):
                        at = denied(at, f.dataType)
                    elif scanned and isinstance(f.dataType, T.StringType):
                        texts.append(at)
                        fields.append((f.name, len(texts) - 1))
                        continue
                    else:
                        at = walk(at, f.dataType, scanned)
                fields.append((f.name, at))

            def built(clean: Column) -> Column:
                return F.struct(*[(F.get(clean, F.lit(at)) if isinstance(at, int) else at).alias(name) for name, at in fields])

            return F.when(col.isNotNull(), _let(scrub_all(F.array(*texts)), built) if texts else built(col))
        if isinstance(kind, T.MapType):
            def member(k: Column, v: Column) -> Column:
                free = F.when(F.lower(k).isin(fixed.UNSCANNED_KEYS), walk(v, kind.valueType, False)).otherwise(
                    walk(v, kind.valueType, scan))
                mark = F.lit(fixed.REDACTED) if isinstance(kind.valueType, T.StringType) else F.lit(None).cast(kind.valueType)
                return F.when(F.lower(k).rlike(rule), mark).otherwise(free)
            return F.transform_values(col, member)
        if isinstance(kind, T.ArrayType):
            return F.transform(col, lambda item: walk(item, kind.elementType, scan))
        return col

    return walk(value, data_type, True, top=True)


def may_hold_secrets(document: Column, extra: Iterable[str] = (), send_default_pii: bool = False, vendor: str | None = None,
                     values: bool = True) -> Column:
    """Whether a JSON text can have anything to redact: a quick native test that errs on the safe side.

    Where it says no, both layers leave every member as it is. Escapes may spell anything, so they count as a find.
    """
    finds = [F.lower(document).rlike(_key_rule(denied_terms(extra, vendor))), document.rlike(r"\\u[0-9a-fA-F]{4}")]
    if values:
        finds += [document.rlike(_CARD_GUARD), document.rlike(r"(?U)\d{3}-\d{2}-\d{4}"), F.lower(document).contains("bearer"),
                  document.contains("eyJ")]
        if not send_default_pii:
            finds += [document.contains("@"), document.rlike(r"(?U)\d\.\d+\.\d+\.\d")]
    out = finds[0]
    for find in finds[1:]:
        out = out | find
    return out


def holds_documents(value: Column, data_type: T.DataType, extra: Iterable[str] = (), send_default_pii: bool = False,
                    vendor: str | None = None) -> Column:
    """Whether text inside a parsed document was a nested document, or a number, with something in it to redact.

    Only free members can be: the values of maps, and text fields that may be given as anything. A number under a key whose
    values are not scanned stays either way.
    """
    def hit(scan: bool) -> Callable[[Column], Column]:
        shape = r"^\s*(?:[\[{]|-?\d{13}[\d.eE+-]*$)" if scan else r"^\s*[\[{]"
        return lambda text: F.coalesce(text.rlike(shape) & may_hold_secrets(text, extra, send_default_pii, vendor), F.lit(False))

    def has_text(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return any(has_text(f.dataType) for f in kind.fields)
        inner = kind.valueType if isinstance(kind, T.MapType) else kind.elementType if isinstance(kind, T.ArrayType) else kind
        return isinstance(inner, T.StringType) or inner is not kind and has_text(inner)

    def walk(col: Column, kind: T.DataType, scan: bool) -> Column:
        if isinstance(kind, T.StringType):
            return hit(scan)(col)
        if isinstance(kind, T.StructType):
            found, texts = [], {True: [], False: []}
            for f in kind.fields:
                scanned = scan and f.name.lower() not in fixed.UNSCANNED_KEYS
                if isinstance(f.dataType, T.StringType):
                    texts[scanned].append(col[f.name])
                elif has_text(f.dataType):
                    found.append(walk(col[f.name], f.dataType, scanned))
            return functools.reduce(operator.or_, [F.exists(F.array(*each), hit(scanned)) for scanned, each in texts.items() if each] + found)
        inner = kind.valueType if isinstance(kind, T.MapType) else kind.elementType
        return F.coalesce(F.exists(F.map_values(col) if isinstance(kind, T.MapType) else col, lambda v: walk(v, inner, scan)), F.lit(False))

    return walk(value, data_type, True) if has_text(data_type) else F.lit(False)


def may_hold_documents(payload: Column, batch: bool = False) -> Column:
    """Whether a JSON object can have a member as ``holds_documents`` looks for, told by its text; errs on the safe side.

    A nested document, text that looks like one, or such a number stands behind a colon or in an array that does; in a ``batch``
    so does the array of its items, once. Escapes may spell anything.
    """
    found = F.regexp_count(payload, F.lit(r""":\s*(?:["']\s*)?(?:[\[{]|-?\d{13})"""))
    return payload.contains("\\") | (found > (1 if batch else 0))


# ---- free-form JSON: the one place that needs Python, because its shape is not known to the plan ----

_CARD_RE, _SSN_RE, _BEARER_RE, _JWT_RE, _EMAIL_RE, _IPV4_RE = (
    re.compile(p) for p in (fixed.CARD_RUN, fixed.SSN, fixed.BEARER, fixed.JWT, fixed.EMAIL, fixed.IPV4))


def _luhn(digits: str) -> bool:
    if not (digits.isascii() and 13 <= len(digits) <= 19):
        return False
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    total = sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)
    return total % 10 == 0


def _mask_card(match: re.Match) -> str:
    return fixed.REDACTED if _luhn(re.sub("[ -]", "", match[0])) else match[0]


def _scrub_str(text: str, send_default_pii: bool) -> str:
    """The rules in their order, each only where its fixed characters stand."""
    out = _CARD_RE.sub(_mask_card, text) if len(text) >= 13 else text
    if "-" in out:
        out = _SSN_RE.sub(fixed.REDACTED, out)
    if "bearer" in out.lower():
        out = _BEARER_RE.sub(fixed.REDACTED, out)
    if "eyJ" in out:
        out = _JWT_RE.sub(fixed.REDACTED, out)
    if send_default_pii:
        return out
    if "@" in out:
        out = _EMAIL_RE.sub(fixed.REDACTED, out)
    return _IPV4_RE.sub(fixed.REDACTED, out) if "." in out else out


def _scrub_tree(root, terms: list[str], send_default_pii: bool, scan: bool):
    """Scrub a parsed document in place, however deep it is: what is still to be visited waits on a list."""
    holder, known = [root], {}  # known: per key, whether it is denied and whether its value is scanned
    waiting = [(holder, 0, scan)]
    while waiting:
        parent, at, scan_here = waiting.pop()
        node = parent[at]
        if isinstance(node, str):
            parent[at] = _scrub_str(node, send_default_pii) if scan_here else node
        elif isinstance(node, list):
            waiting += [(node, i, scan_here) for i in range(len(node))]
        elif isinstance(node, dict):
            for key, member in node.items():
                if key not in known:
                    known[key] = _is_denied(key, terms), key.lower() not in fixed.UNSCANNED_KEYS
                denied, scanned = known[key]
                if denied:
                    node[key] = fixed.REDACTED
                elif isinstance(member, str):
                    if scan_here and scanned:
                        node[key] = _scrub_str(member, send_default_pii)
                elif isinstance(member, (dict, list)):
                    waiting.append((node, key, scan_here and scanned))
    return holder[0]


def _scrub_broken(text: str, denied: re.Pattern, send_default_pii: bool, scan: bool) -> str:
    """Text that is no JSON, or nests too deep to be parsed: what follows a sensitive key goes, up to the next member
    that is not nested in it, and the rest is scanned as plain text."""
    out = denied.sub(lambda m: m[1] + f'"{fixed.REDACTED}"', text)
    return _scrub_str(out, send_default_pii) if scan else out


def _to_json(node) -> str:
    text = json.dumps(node, separators=(",", ":"), ensure_ascii=False)
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:  # half of a surrogate pair has no UTF-8 form: write all beyond ASCII as escapes
        return json.dumps(node, separators=(",", ":"))
    return text


def scrub_json(document: Column, extra: Iterable[str] = (), send_default_pii: bool = False,
               vendor: str | None = None, values: bool = True, keep: Iterable[str] = (), tested: bool = False) -> Column:
    """Both scrubbing layers over free-form JSON text, in Arrow batches. Text that is no JSON is scrubbed as text.

    A document in which a native test finds nothing to redact stays as it is and is not parsed; ``tested`` ones are known to hold
    something. ``keep`` names top-level keys that stay, such as the session id the records are joined on. No document fails the job.
    """
    kept = tuple(keep)
    terms = denied_terms(extra, vendor)
    word = "|".join(re.escape(term) for term in terms)
    # a sensitive member of broken JSON: its string, its brackets up to the end of the text, or its bare value
    denied = re.compile(rf"""("[^"]*(?:{word})[^"]*"\s*:\s*)(?:"(?:[^"\\]|\\.)*"?|[\[{{].*|[^,}}\]\s]+)""", re.IGNORECASE | re.DOTALL)

    @F.pandas_udf(T.StringType())
    def scrub_batch(batch: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                node = json.loads(text)
                top = {key: node[key] for key in kept if key in node} if isinstance(node, dict) else {}
                clean = _scrub_tree(node, terms, send_default_pii, values)
                if top:
                    clean.update(top)
                return _to_json(clean)
            except (ValueError, RecursionError):
                return _scrub_broken(text, denied, send_default_pii, values)
        return batch.map(one)

    def guarded(text: Column) -> Column:
        return may_hold_secrets(text, extra, send_default_pii, vendor, values)

    return scrub_batch(document) if tested else F.coalesce(scrub_batch(F.when(guarded(document), document)), document)
