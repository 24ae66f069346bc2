"""Scalar rules for statements, requests, log levels, headers, tracebacks and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry import fixed_values as fixed


def non_empty(value: Column) -> Column:
    """Null for the empty string, as the contract tests truthiness."""
    return F.nullif(value, F.lit(""))


# ---- statements ----

def normalize_query(statement: Column) -> Column:
    """Literals become ``?`` and white space collapses."""
    out = F.regexp_replace(statement, fixed.SQL_STRING, "?")
    out = F.regexp_replace(out, "(?U)" + fixed.SQL_NUMBER, "?")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def hash_query(normalized: Column) -> Column:
    return F.substring(F.md5(normalized), 1, 16)


def detect_query_type(statement: Column) -> Column:
    first = F.upper(F.regexp_extract(statement, r"(?U)^\s*(\S+)", 1))
    return F.when(first.isin(fixed.QUERY_TYPES), first).otherwise("OTHER")


# ---- requests ----

def _path_part(url: Column) -> Column:
    """The path of a path or URL without query and fragment, and without the ``;`` parameters of its last segment."""
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, ";[^/]*$", "")


def strip_query(path: Column) -> Column:
    """The path part of a path or URL; the input itself when that part is empty."""
    return F.coalesce(non_empty(_path_part(path)), path)


def url_host(url: Column) -> Column:
    return F.coalesce(non_empty(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)), url_path(url))


def url_path(url: Column) -> Column:
    return F.coalesce(non_empty(_path_part(url)), F.lit("/"))


def status_class(status: Column) -> Column:
    """What one delivery attempt means; 0 stands for a network error."""
    return (F.when(status == 401, "auth_stop")
            .when(status == 429, "retry_after")
            .when(status.between(400, 499), "rejected")
            .when(status == 503, "retry_after")
            .when((status >= 500) | (status == 0), "retry")
            .otherwise("sent"))


def spool_terminal(status: Column) -> Column:
    """True when a spooled entry is done: accepted, or refused for good."""
    return status.between(200, 299) | (status.between(400, 499) & (status != 429))


def is_failed_request(status: Column, raised: Column, failed_codes: list[int] | None = None) -> Column:
    """True for a status in the failed set; a raised exception without a status counts as 500."""
    effective = F.when(raised & F.coalesce(status == 0, F.lit(True)), 500).otherwise(F.coalesce(status, F.lit(0)))
    return effective.between(500, 599) if failed_codes is None else effective.isin(failed_codes)


def asgi_transaction(route: Column, endpoint: Column, style: str = "url") -> Column:
    named = [non_empty(endpoint)] if style == "endpoint" else []
    return F.coalesce(*named, non_empty(route), F.lit(fixed.UNMATCHED_ROUTE))


def django_transaction(route: Column, raw_path: Column, module: Column, view: Column, style: str = "route") -> Column:
    pattern = F.concat(F.lit("/"), F.regexp_replace(non_empty(route), "^/+", ""))
    dotted = F.concat(F.coalesce(F.concat(non_empty(module), F.lit(".")), F.lit("")), non_empty(view))
    named = [dotted] if style == "function_name" else []
    return F.coalesce(*named, pattern, raw_path)


def first_non_empty(*values: Column) -> Column:
    return F.coalesce(*[non_empty(v) for v in values])


def http_crumb_message(method: Column, url: Column, status: Column, raised: Column) -> Column:
    base = F.concat(method, F.lit(" "), F.substring_index(url, "?", 1), F.lit(" -> "))
    return F.when(raised.isNotNull(), F.concat(base, F.lit("failed: "), raised)).otherwise(
        F.concat(base, status.cast("string")))


def http_crumb_level(status: Column, raised: Column) -> Column:
    return F.when(raised.isNotNull() | (status >= 400), "error").otherwise("info")


def client_ip(forwarded_for: Column, remote_addr: Column, send_default_pii: bool) -> Column:
    if not send_default_pii:
        return F.lit(None).cast("string")
    return first_non_empty(F.trim(F.get(F.split(forwarded_for, ","), F.lit(0))), remote_addr)


def pick_user(user_id: list[Column], email: Column, ip: list[Column]) -> Column:
    """struct<id, email, ip>, or null when none of the three is known. An empty id or address is not known."""
    chosen, address = first_non_empty(*[c.cast("string") for c in user_id]), first_non_empty(*ip)
    return F.when(chosen.isNotNull() | email.isNotNull() | address.isNotNull(),
                  F.struct(chosen.alias("id"), email.alias("email"), address.alias("ip")))


def retry_after_seconds(value: Column, at: Column) -> Column:
    """A logged Retry-After header as seconds from ``at``: a count or an HTTP date; 0 when unusable, 300 at most."""
    text = F.trim(value)
    count = F.when(text.rlike(r"^[+-]?\d+$"), text).try_cast("double")
    date = F.regexp_replace(text, r"^\w{3}, ", "")
    until = F.coalesce(*[F.try_to_timestamp(date, F.lit(f"d MMM yyyy HH:mm:ss {zone}")) for zone in ("z", "xx")])
    wait = F.coalesce(count, (F.unix_micros(until) - F.unix_micros(at)) / F.lit(1e6), F.lit(0.0))
    return F.least(F.greatest(wait, F.lit(0.0)), F.lit(float(fixed.MAX_RETRY_AFTER_SECONDS)))


# ---- levels ----

def crumb_level_of(levelno: Column) -> Column:
    return F.when(levelno >= 40, "error").when(levelno >= 30, "warn").when(levelno >= 20, "info").otherwise("debug")


def event_level_of(levelno: Column) -> Column:
    return F.when(levelno >= 50, "fatal").when(levelno >= 40, "error").otherwise("warn")


def session_mark_of(level: Column, handled: Column) -> Column:
    """The session mark an error event makes: ``crash``, ``error`` or null."""
    effective = F.lower(F.coalesce(non_empty(level), F.lit("error")))
    return F.when((F.coalesce(handled, F.lit(True)) == F.lit(False)) | (effective == "fatal"), "crash").when(
        effective == "error", "error")


# ---- tracebacks ----

def traceback_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def traceback_frames(text: Column) -> Column:
    """Array of frames {filename, absPath, function, lineno, colno, inApp, platform} named by a formatted traceback."""
    line = r'File "([^"]+)", line (\d+), in (\S+)'

    def part(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(line), F.lit(group))

    zipped = F.arrays_zip(part(1).alias("file"), part(2).alias("line"), part(3).alias("name"))
    return F.transform(zipped, lambda f: F.struct(
        f["file"].alias("filename"), f["file"].alias("absPath"), f["name"].alias("function"),
        f["line"].cast("int").alias("lineno"), F.lit(None).cast("int").alias("colno"),
        (~(f["file"].startswith("<") | f["file"].contains("site-packages"))).alias("inApp"),
        F.lit("python").alias("platform")))


# ---- flags ----

def flag_as_bool(value: Column) -> Column:
    return F.lower(value).isin(fixed.TRUE_FLAGS)


def flag_as_int(value: Column) -> Column:
    return F.when(F.trim(value).rlike(r"^[+-]?\d+$"), F.trim(value)).try_cast("bigint")


def flag_as_float(value: Column) -> Column:
    return F.trim(value).try_cast("double")
