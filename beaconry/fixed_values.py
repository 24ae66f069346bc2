"""Constants of the wire contract that results must equal exactly.

Nothing in here is logic. Header and baggage names carry the vendor prefix of the deployment, so they are not
listed; they are built from the ``vendor`` argument of the functions that read them.
"""

# Ingest paths.
PATH_ERRORS = "/ingest/v1/errors"
PATH_LOGS = "/ingest/v1/logs"
PATH_HTTP = "/ingest/v1/http-requests"
PATH_SPANS = "/ingest/v1/spans"
PATH_DB = "/ingest/v1/db"
PATH_HEARTBEAT = "/ingest/v1/heartbeat"
PATH_REPLAY = "/ingest/v1/replay"
PATH_SESSION_START = "/ingest/v1/sessions/start"
PATH_SESSION_END = "/ingest/v1/sessions/end"
PATH_RELEASES = "/ingest/v1/releases"
PERSISTABLE_PATHS = [PATH_ERRORS, PATH_LOGS, PATH_SPANS, PATH_HTTP, PATH_DB]

# Enumerations.
ERROR_LEVELS = ["debug", "info", "warn", "error", "fatal", "warning"]
LOG_LEVELS = ["debug", "info", "warn", "error", "fatal"]
CRUMB_TYPES = ["http", "log", "ui", "navigation", "query", "default"]
CRUMB_LEVELS = ["info", "warn", "error", "debug"]
SPAN_STATUSES = ["ok", "error", "timeout"]
SESSION_STATUSES = ["ok", "errored", "crashed", "abnormal"]
QUERY_TYPES = ["SELECT", "INSERT", "UPDATE", "DELETE"]
CAPTURED_METHODS = ["CONNECT", "DELETE", "GET", "PATCH", "POST", "PUT", "TRACE"]
FRAMEWORK_4XX = ["Http404", "PermissionDenied", "SuspiciousOperation"]
INTERPRETER_EXITS = ["KeyboardInterrupt", "SystemExit"]
TRUE_FLAGS = ["true", "1", "yes"]
UNMATCHED_ROUTE = "generic ASGI request"
SLUG_PATTERN = r"^[a-z0-9\-]+$"

# Limits.
MAX_BATCH = 100
BUFFER_SIZE = 500
MAX_BREADCRUMBS = 50
MAX_ATTEMPTS = 5
BACKOFF_SECONDS = [1, 2, 4, 8]
MAX_RETRY_AFTER_SECONDS = 300
COMPRESSION_THRESHOLD_BYTES = 1024
SPOOL_MAX_EVENTS = 100
SPOOL_MAX_BYTES = 5 * 1024 * 1024
SPOOL_MAX_AGE_SECONDS = 48 * 3600
SPOOL_ENTRY_MAX_BYTES = 5 * 1024 * 1024
ERROR_MESSAGE_CHARS = 500
SPAN_DESCRIPTION_CHARS = 300
SESSION_STATE_MAX_AGE_MS = 7 * 24 * 60 * 60 * 1000
SESSION_RECOVERY_ATTEMPTS = 3
MAX_SAFE_INTEGER = 2**53 - 1

# Scrubbing.
REDACTED = "[REDACTED]"
DENIED_KEY_TERMS = [
    "authorization", "proxy-authorization", "cookie", "set-cookie", "password", "passwd", "pwd", "api_key",
    "apikey", "x-api-key", "x-auth-token", "x-access-token", "token", "bearer", "jwt", "session", "sessionid",
    "session_id", "secret", "credit_card", "card_number", "cvv", "ssn", "csrf",
]
UNSCANNED_KEYS = [
    "user", "userid", "user_id", "errorid", "error_id", "requestid", "request_id", "stacktrace", "frames",
    "filename", "abspath", "function", "module", "release", "dist", "platform", "sdkname", "sdkversion",
    "sdk.name", "sdk.version", "commit.sha", "commit.branch", "version", "sessionid", "session_id", "traceid",
    "trace_id", "spanid", "span_id", "parentspanid", "parent_span_id", "op", "operation", "url", "path",
    "queryhash",
]
MAX_SCAN_CHARS = 32768
MAX_SCAN_DEPTH = 25
CARD_RUN = r"\b(?:\d[ -]?){13,19}\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
BEARER = r"(?i)\bBearer\s+[A-Za-z0-9._~+/-]+=*"
JWT = r"\beyJ[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
IPV4 = r"\b(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}\b"

# Propagation headers.
TRACEPARENT = r"^\s*([0-9a-f]{2})-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})(?:\s|$)"

# Statement normalization.
SQL_STRING = r"'[^']*'"
SQL_NUMBER = r"\b\d+(\.\d+)?\b"
